"""Secret scan with corpus-wide ownership frequency, with DataFrame functions only.

1. Base patterns give the spans of three kinds; a looser pattern gives unnamed
   candidates (long runs of token characters with letters and digits, enough different
   characters, outside all base spans).
2. Hashes of all candidate values are aggregated over the corpus: in how many
   distinct owners and repositories does a value occur?
3. A value of at least ``example_owners`` owners is a widely copied example; one
   with fewer that looks random is a live-looking credential of its owner. Unnamed
   candidates that are live-looking become spans of the kind ``owned``. Base spans stay, whatever their owners.

Spans are code-point offsets, end exclusive. A value held by a third of the
corpus is spread over lanes before it meets its counts. Only hashes are shuffled.

Defined results: null and empty texts have no spans; repeated rows are reported
each; null ids stay null; null owners are one owner, null repositories one
repository of their owner. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: The base patterns, kind by kind, and the least length of what counts.
KEYWORD = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
ASSIGN = rf"""({KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
UNNAMED = "[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "owned")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, zero: int, op: Callable[[Column, Column], Column], width: int = 256) -> Column:
    """The results of folding ``values`` (an integer array) up to and with each element.

    An array that grows by one element is copied each time; so elements are folded in pieces of ``width``, each
    from the result of the pieces before it, and the work grows with the array's length, not its square.
    """
    def folded(piece: Column, start: Column, put: Callable[[Column, Column], Column]) -> Column:
        return F.aggregate(piece, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")),
                           lambda a, x: F.struct(op(a["at"], x).alias("at"), F.array_append(a["out"], put(a["at"], x)).alias("out")),
                           lambda a: a["out"])

    def in_pieces(all_values: Column) -> Column:
        last = F.greatest(F.floor((F.size(all_values) - 1) / width).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(all_values, c * width + 1, F.lit(width)))

    def joined_up(pieces: Column) -> Column:
        before = folded(F.transform(pieces, lambda p: F.aggregate(p, F.lit(zero), op)), F.lit(zero), lambda at, x: at)
        return F.flatten(F.zip_with(pieces, before, lambda p, b: folded(p, b, op)))

    return bound(bound(values, in_pieces), joined_up)


def _matches(pattern: str, group: int) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches in the column ``text``.

    The pieces between matches and the matches alternate, so each start is the
    sum of the lengths before it.
    """
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    lengths = F.zip_with(F.transform(F.split("text", pattern, -1), F.length), F.transform(found, F.length),
                         lambda piece, match: F.struct(piece.alias("piece"), F.coalesce(match, F.lit(0)).alias("match")))
    ends = lambda each: running(F.transform(each, lambda x: x["piece"] + x["match"]), 0, lambda at, x: at + x)
    walked = bound(lengths, lambda each: F.zip_with(ends(each), each, lambda end, x: end - x["match"]))
    spans = F.transform(F.arrays_zip(walked.alias("s"), found.alias("m"), values.alias("v")),
                        lambda x: F.struct(x["s"].alias("start"), (x["s"] + F.length(x["m"])).alias("end"), x["v"].alias("value")))
    some = F.filter(spans, lambda x: x["value"].isNotNull())  # the last piece has no match after it
    return F.when(F.col("text").rlike(pattern), some)


def _of_kind(kind: int, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"),
                                                 F.sha2(x["value"], 256).alias("h"), looks_random(x["value"]).alias("random")))


def looks_random(value: Column) -> Column:
    """Letters and digits, and at least eight different characters."""
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= 8))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, by start, then kind as listed."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def outside(spans: Column, base: Column) -> Column:
    """Spans that overlap no base span.

    Base spans by their start and the others by their end form one sorted list (at one place the others first: they only touch). A span
    overlaps a base span exactly if the farthest end among the base spans before it lies behind its start.
    """
    kind = "struct<start:int,kind:int,end:int,h:string,random:boolean>"
    place = lambda at, is_base, reach, x: F.struct(at.alias("at"), F.lit(is_base).alias("base"), reach.alias("reach"), x.alias("x"))
    events = F.array_sort(F.concat(
        F.transform(F.coalesce(spans, F.array().cast(f"array<{kind}>")), lambda x: place(x["end"], 0, F.lit(-1), x)),
        F.transform(base, lambda b: place(b["start"], 1, b["end"], F.lit(None).cast(kind)))))
    far = lambda each: running(F.transform(each, lambda e: e["reach"]), -1, lambda at, x: F.greatest(at, x))
    seen = bound(events, lambda each: F.zip_with(each, far(each), lambda e, reach: F.struct(
        ((e["base"] == 0) & (reach <= e["x"]["start"])).alias("free"), e["x"].alias("x"))))
    return F.transform(F.filter(seen, lambda e: e["free"]), lambda e: e["x"])


def candidates(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, owner, repo, base, loose)``: spans with value hashes of every row of ``(doc_id, text, owner, repo)``."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int,h:string,random:boolean>>")
    assign = F.filter(_matches(ASSIGN, 2), lambda x: F.length(x["value"]) >= 8)
    parts = docs.select("doc_id", "owner", "repo", assign.alias("a"), _matches(ACCESS, 0).alias("k"), _matches(HEX, 0).alias("x"),
                        F.filter(_matches(UNNAMED, 0), lambda x: looks_random(x["value"])).alias("u"))
    based = parts.select("doc_id", "owner", "repo", "u", F.concat(*[F.coalesce(_of_kind(i, F.col(c)), none)
                                                                    for i, c in enumerate("akx")]).alias("base"))
    free = F.when(F.size("base") == 0, _of_kind(3, F.col("u"))).otherwise(outside(_of_kind(3, F.col("u")), F.col("base")))
    return based.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repo", "base",
                        F.coalesce(free, none).alias("loose"))


def ownership(found: DataFrame) -> DataFrame:
    """``(h, owners, repos)`` for ``(h, owner, repo)`` rows; equal rows are merged in the tasks before each shuffle."""
    return (found.select("h", "owner", "repo").distinct()
            .groupBy("h", "owner").agg(F.count("*").alias("repos"))
            .groupBy("h").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos")))


def scan(docs: DataFrame, *, example_owners: int = 3, lanes: int = 256, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source", repo_col: str = "lang") -> DataFrame:
    """One row per document: its spans with kind, value hash, owners, repositories and judgement.

    Returns ``(doc_id, base, spans)``; both are arrays of structs ordered by start and kind.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(owner_col), F.lit("")).alias("owner"), F.coalesce(F.col(repo_col), F.lit("")).alias("repo"))
    held = cut(candidates(rows))
    each = held.select("row", "owner", "repo", F.explode(F.concat("base", "loose")).alias("c")).select("row", "owner", "repo", "c.*")
    laned = each.withColumn("lane", F.pmod(F.xxhash64("row"), F.lit(lanes)))
    facts = laned.select("h", "lane").distinct().join(ownership(each), "h")
    judged = laned.join(facts, ["h", "lane"])
    live = F.col("random") & (F.col("owners") < example_owners)
    spans = (judged.where((F.col("kind") < 3) | live)
             .groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
                 "start", "kind", "end", "h", "owners", "repos", live.alias("live"),
                 (F.col("owners") >= example_owners).alias("copied")))).alias("spans")))
    return held.select("row", "doc_id", "base").join(spans, "row", "left").select("doc_id", "base", "spans")
