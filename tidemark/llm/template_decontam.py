"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

A text is canonicalised twice. In the *literal* stream numbers and units are typed
placeholders and words are lower-cased; in the *template* stream capitalised words
inside a sentence (names) are placeholders too. The second exists only for texts with
such words; it catches questions whose names were exchanged, the first copies whose case was changed.

Windows of five tokens are hashed and joined with the windows of the benchmark. Matches are
grouped by document, item and alignment (the difference of positions). In one
alignment every slot value of the item must stand for one value of the document and
the other way round; where that fails, only windows whose slot values are the same count.
A document is contaminated by an item if the matched windows cover at least
``min_cover`` of the item's windows (``min_cover_same`` for alignments that failed), or if one
alignment matches ``min_run`` of the item's windows in a row, whatever share of a long item they are.

Items without a used window (few tokens, mostly numbers, a script without blanks) are found by their whole
sequence of tokens, values as they are: its windows of five (of all its tokens, if fewer) must all match in one alignment.
That needs three tokens at least, or a script without blanks, and ten letters and digits; a shorter item is found only
where it is all that a document holds. The documents are read for this only if there are such items.

The document side is never shuffled while the benchmark's windows are few enough to
broadcast (counted first); otherwise both sides are shuffled by the window hash. Groups hold at most as many
entries as an item has windows.

Defined results: null and empty texts, and texts without letters and digits, match nothing; windows with fewer than ``min_words`` plain words are not
used; repeated rows and null ids: rows of an id are one document, null one id of its own. Other columns
are not read. Empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Placeholders: private-use characters that mark a name's ends, and stand for a name, a number, a unit.
MARK, NAME, NUMBER, UNIT = "\ue001", "\ue002", "\ue003", "\ue004"
#: Repeated groups are possessive (``*+``): Java matches a greedy one by recursion, and a few thousand words or numbers in a row overflow the stack.
NAMES = r"([\p{Ll}\p{N},;] )(\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*+)"
#: The first is found wherever the second is, and seldom elsewhere (behind surrogates): most characters fail at the blank. The second is found where ``NAMES`` is.
MAY_HAVE_NAMES, HAS_NAMES = r" (?=\p{Lu}\p{Ll})(?<=[\p{Ll}\p{N},;\p{Cs}] )", r"[\p{Ll}\p{N},;] \p{Lu}\p{Ll}"
NUMBERS = r"\p{N}+(?:[.,]\p{N}+)*+"
#: Unit words that count as units after a number.
UNITS = ("kg g mg km m cm mm mile miles foot feet ft inch inches pound pounds lb lbs oz l ml liter liters litre litres "
         "second seconds minute minutes hour hours day days week weeks month months year years "
         "cent cents dollar dollars euro euros percent degrees").split()
AFTER_NUMBER = rf"({NUMBER} +)(?:{'|'.join(UNITS)})([^\p{{L}}\p{{M}}\p{{N}}]|$)"
TOKENS = rf"[\p{{L}}\p{{M}}]+|[{NAME}{NUMBER}{UNIT}]"
RAW_TOKENS = rf"{MARK}[^{MARK}]*{MARK}|{NUMBERS}|[\p{{L}}\p{{M}}]+"
WINDOW = 5
VALUES = rf"{NUMBERS}|[\p{{L}}\p{{M}}]+"
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
SHORT_TOKENS, SHORT_CHARS = 3, 10  #: what an item without windows needs to be looked for inside texts


def _tokens(stream: int) -> Column:
    """Canonical tokens of the column ``text``; in the template stream its names are marked."""
    named = F.regexp_replace("text", f"{MARK}[^{MARK}]*{MARK}", NAME) if stream else F.col("text")
    units = F.regexp_replace(F.regexp_replace(F.lower(named), NUMBERS, f" {NUMBER} "), AFTER_NUMBER, f"$1{UNIT}$2")
    canonical = F.when(F.col("text").rlike(r"\p{N}"), units).otherwise(F.lower(named))
    return F.regexp_extract_all(canonical, F.lit(TOKENS), F.lit(0))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hashes(tokens: Column) -> Column:
    """Hashes of all windows of an array of tokens, in order; null for fewer tokens than a window has.

    Words are hashed once; a window is hashed from the hashes of its words.
    """
    def five(words: Column) -> Column:
        first = F.slice(words, 1, F.size(words) - (WINDOW - 1))
        windows = F.transform(first, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, WINDOW))))
        return F.when(F.size(words) >= WINDOW, windows)

    return _let(F.transform(tokens, lambda t: F.xxhash64(t)), five)


def _of_stream(h: str) -> Column:
    """A hash that differs by the stream ``s``: a join by one long is much cheaper than by two columns."""
    return F.when(F.col("s") == 1, F.bitwise_not(h)).otherwise(F.col(h)).alias(h)


def _read(rows: DataFrame, stream: int) -> DataFrame:
    """``(id, x)`` of marked texts: canonical tokens, raw values, places of slots, window hashes."""
    raw = F.regexp_extract_all(F.lower(F.col("text")), F.lit(RAW_TOKENS), F.lit(0))
    slots = lambda t: F.filter(F.transform(t, lambda x, i: F.when(x.between(NAME, UNIT), i)), lambda i: i.isNotNull())
    return rows.select("id", _let(_tokens(stream), lambda t: F.struct(
        t.alias("tokens"), raw.alias("raw"), slots(t).alias("slots"), _hashes(t).alias("h"))).alias("x"))


def _windows_at(read: DataFrame, places: str, stream: int, min_words: int) -> DataFrame:
    """``(id, s, pos, h, types, raw)`` of the windows that start at ``places`` (SQL over ``x``), if they hold enough words."""
    every = F.expr(f"""flatten(transform(array(x), x -> transform(filter({places}, i -> i < size(x.h)),
        i -> named_struct('pos', i, 'h', element_at(x.h, i + 1), 'types', slice(x.tokens, i + 1, {WINDOW}),
                          'raw', slice(x.raw, i + 1, {WINDOW})))))""")
    enough = F.size(F.filter("types", lambda t: ~t.between(NAME, UNIT))) >= min_words
    return (read.select("id", F.explode(every).alias("w")).select("id", F.lit(stream).alias("s"), "w.*").where(enough))


def _streams(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(id, text)`` of the literal stream, and of the template stream with its names marked."""
    reserved = reduce(Column.__or__, [F.col("text").contains(c) for c in (MARK, NAME, NUMBER, UNIT)])
    clean = F.when(reserved, F.regexp_replace("text", f"[{MARK}-{UNIT}]", " ")).otherwise(F.col("text"))
    given = texts.where(F.col("text").isNotNull()).select("id", clean.alias("text"))
    named = given.where(F.col("text").rlike(MAY_HAVE_NAMES) & F.col("text").rlike(HAS_NAMES))
    return given, named.withColumn("text", F.regexp_replace("text", NAMES, f"$1{MARK}$2{MARK}"))


def item_windows(items: DataFrame, min_words: int) -> DataFrame:
    """``(id, s, pos, h, types, raw)`` of all windows of ``(id, text)`` items; ``types`` and ``raw`` are null without slots."""
    literal, named = _streams(items)
    parts = [_windows_at(_read(rows, s), "sequence(0, size(x.tokens))", s, min_words) for s, rows in ((0, literal), (1, named))]
    slot = F.exists("types", lambda t: t.between(NAME, UNIT))
    rows = parts[0].unionByName(parts[1])
    return rows.withColumn("raw", F.when(slot, F.col("raw"))).withColumn("types", F.when(slot, F.col("types")))


def document_windows(docs: DataFrame, min_words: int) -> DataFrame:
    """``(id, s, pos, h, raw)`` of all windows of ``(id, text)`` documents.

    Every window has a row without ``raw``; one that holds a slot has a second row with its values,
    and only that may be matched by an item's window with slots. Few windows hold one, so
    nearly all rows are a few numbers. Every text is tokenised once a stream.
    """
    literal, named = _streams(docs)
    numbered = F.col("text").rlike(r"\p{N}")
    words = F.regexp_extract_all(F.lower("text"), F.lit(TOKENS), F.lit(0))  # texts without numbers and marks have no slots
    parts = [literal.where(~numbered).select("id", F.posexplode(_hashes(words)).alias("pos", "h"))
             .select("id", F.lit(0).alias("s"), "pos", "h", F.lit(None).cast("array<string>").alias("raw"))]
    near = f"array_distinct(flatten(transform(x.slots, p -> sequence(greatest(p - {WINDOW - 1}, 0), p))))"
    enough = f"size(filter(slice(x.tokens, i + 1, {WINDOW}), t -> NOT t BETWEEN '{NAME}' AND '{UNIT}')) >= {int(min_words)}"
    both = F.expr(f"""flatten(transform(array(x), x -> concat(
        transform(x.h, (h, i) -> named_struct('pos', i, 'h', h, 'raw', CAST(NULL AS array<string>))),
        transform(filter({near}, i -> i < size(x.h) AND {enough}),
                  i -> named_struct('pos', i, 'h', element_at(x.h, i + 1), 'raw', slice(x.raw, i + 1, {WINDOW}))))))""")
    for stream, rows in ((0, literal.where(numbered)), (1, named)):
        parts.append(_read(rows, stream).select("id", F.explode(both).alias("w")).select("id", F.lit(stream).alias("s"), "w.*"))
    return reduce(DataFrame.unionByName, parts)


def _has_run(places: Column, least: int) -> Column:
    """Whether an array of distinct numbers holds ``least`` consecutive ones; false for null."""
    ordered = F.sort_array(places)
    ends = F.zip_with(ordered, F.slice(ordered, least, F.greatest(F.size(ordered), F.lit(1))), lambda a, b: b - a == least - 1)
    return F.coalesce(F.exists(ends, lambda x: F.coalesce(x, F.lit(False))), F.lit(False))


def _sequences(rows: DataFrame) -> DataFrame:
    """``(id, tokens)``: words and numbers as they are, lower-cased; texts without any are left out."""
    tokens = F.regexp_extract_all(F.lower(F.col("text")), F.lit(VALUES), F.lit(0))
    return rows.where(F.col("text").isNotNull()).select("id", tokens.alias("tokens")).where(F.size("tokens") > 0)


def _runs_of(tokens: Column, sizes: list[int]) -> Column:
    """``(k, pos, h)`` of all runs of k tokens, for each k of ``sizes`` (1 to five)."""
    def of_size(k: int) -> Column:
        single = F.transform(tokens, lambda t: F.xxhash64(t))
        hashes = single
        for i in range(1, k):
            hashes = F.zip_with(hashes, F.slice(single, i + 1, F.size(single)), lambda a, b: F.xxhash64(a, b))
        whole = F.slice(hashes, 1, F.greatest(F.size(hashes) - (k - 1), F.lit(0)))
        return F.transform(whole, lambda h, i: F.struct(F.lit(k).alias("k"), i.alias("pos"), h.alias("h")))

    return F.concat(*(of_size(k) for k in sizes))


def short_matches(docs: DataFrame, items: DataFrame, used: DataFrame, max_broadcast_windows: int) -> DataFrame | None:
    """``(doc_id, item_id, n_windows)`` of items that have no row in ``used`` and whose whole sequence a document holds; None without such items."""
    listed = items.join(used.select(F.col("item_id").alias("id")).distinct(), "id", "left_anti")
    chars = F.length(F.array_join("tokens", ""))
    inside = (chars >= SHORT_CHARS) & ((F.size("tokens") >= SHORT_TOKENS) | F.array_join("tokens", " ").rlike(UNSPACED))
    short = _sequences(listed).withColumn("inside", inside).withColumn("k", F.least(F.size("tokens"), F.lit(WINDOW)))
    counts = short.groupBy("inside", "k").agg(F.sum(F.size("tokens")).alias("n")).collect()  # ten rows at most
    if not counts:
        return None
    few = sum(r["n"] for r in counts) <= max_broadcast_windows
    fit = F.broadcast if few else (lambda df: df)
    own = _sequences(docs)
    found = []
    if any(not r["inside"] for r in counts):
        whole = short.where(~F.col("inside")).select(F.col("id").alias("item_id"), F.xxhash64("tokens").alias("h"), "tokens")
        hits = own.withColumn("h", F.xxhash64("tokens")).join(fit(whole.withColumnRenamed("tokens", "of_item")), "h")
        found.append(hits.where("tokens = of_item").select(F.col("id").alias("doc_id"), "item_id", F.lit(1).cast("long").alias("n_windows")))
    sizes = sorted({r["k"] for r in counts if r["inside"]})
    if sizes:
        windows = (short.where("inside").withColumn("w", F.explode(_runs_of(F.col("tokens"), sizes))).where("w.k = k")
                   .select(F.col("id").alias("item_id"), "w.k", F.col("w.pos").alias("item_pos"), "w.h",
                           (F.size("tokens") - F.col("k") + 1).cast("long").alias("n_windows")))
        runs = own.select(F.col("id").alias("doc_id"), F.explode(_runs_of(F.col("tokens"), sizes)).alias("w")).select("doc_id", "w.*")
        found.append(runs.join(fit(windows), ["k", "h"])
                     .groupBy("doc_id", "item_id", "n_windows", (F.col("pos") - F.col("item_pos")).alias("shift"))
                     .agg(F.countDistinct("item_pos").alias("n")).where("n = n_windows").select("doc_id", "item_id", "n_windows"))
    return reduce(DataFrame.unionByName, found).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, *, min_cover: float = 0.3, min_cover_same: float = 0.5, min_run: int = 20,
                 min_words: int = 3, max_broadcast_windows: int = 500_000, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, n_windows, n_matched, coverage, n_slots, consistent)`` of contaminated pairs."""
    given = benchmark.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = item_windows(given, min_words)
    items = items.select(F.col("id").alias("item_id"), "s", F.col("pos").alias("item_pos"), _of_stream("h"),
                         "types", F.col("raw").alias("item_raw"))
    # places among the item's used windows: a run goes on over windows that are not used
    items = items.withColumn("place", F.dense_rank().over(Window.partitionBy("item_id", "s").orderBy("item_pos")))
    sizes = items.groupBy("item_id", "s").agg(F.countDistinct("item_pos").alias("n_windows"))
    short = short_matches(texts, given, sizes, max_broadcast_windows)
    if items.count() <= max_broadcast_windows:
        items, sizes = F.broadcast(items), F.broadcast(sizes)
    own = document_windows(texts, min_words)
    own = own.select(F.col("id").alias("doc_id"), "pos", _of_stream("h"), F.col("raw").alias("doc_raw"))
    hits = own.join(items, "h").where(F.col("doc_raw").isNull() == F.col("types").isNull())
    slots = F.expr(f"filter(transform(types, (t, i) -> struct(t AS type, item_raw[i] AS a, doc_raw[i] AS b)), "
                   f"x -> x.type between '{NAME}' and '{UNIT}')")
    aligned = (hits.withColumn("slots", F.when(F.col("types").isNotNull(), slots))
               .withColumn("same", F.coalesce(F.expr("forall(slots, x -> x.a = x.b)"), F.lit(True)))
               .groupBy("doc_id", "item_id", "s", (F.col("pos") - F.col("item_pos")).alias("shift"))
               .agg(F.collect_set("item_pos").alias("every"),
                    F.collect_set(F.when(F.col("same"), F.col("item_pos"))).alias("same"),
                    F.collect_set("place").alias("places"),
                    F.collect_set(F.when(F.col("same"), F.col("place"))).alias("same_places"),
                    F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots")))
    one_to_one = F.expr("size(slots) = size(array_distinct(transform(slots, x -> struct(x.type, x.a)))) AND "
                        "size(slots) = size(array_distinct(transform(slots, x -> struct(x.type, x.b))))")
    judged = (aligned.withColumn("consistent", one_to_one)
              .withColumn("run", F.col("consistent") & _has_run(F.col("places"), min_run))
              .withColumn("same_run", _has_run(F.col("same_places"), min_run)))
    covered = (judged.groupBy("doc_id", "item_id", "s")
               .agg(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("consistent"), F.col("every"))))).alias("good"),
                    F.array_distinct(F.flatten(F.collect_list(F.col("same")))).alias("same"),
                    F.max(F.when(F.col("consistent"), F.size("slots"))).alias("n_slots"),
                    F.max("run").alias("run"), F.max("same_run").alias("same_run"))
               .join(sizes, ["item_id", "s"])
               .withColumn("consistent", (F.size("good") >= min_cover * F.col("n_windows")) | F.col("run"))
               .where(F.col("consistent") | (F.size("same") >= min_cover_same * F.col("n_windows")) | F.col("same_run")))
    found = F.when(F.col("consistent"), F.size("good")).otherwise(F.size("same")).cast("long")
    best = F.struct((found / F.col("n_windows")).alias("coverage"), F.col("consistent"), (-F.col("s")).alias("o"),
                    found.alias("n_matched"), F.col("n_windows"),
                    F.coalesce(F.when(F.col("consistent"), F.col("n_slots")), F.lit(0)).cast("long").alias("n_slots"))
    pairs = (covered.groupBy("doc_id", "item_id").agg(F.max(best).alias("best"))
             .select("doc_id", "item_id", "best.n_windows", "best.n_matched", "best.coverage", "best.n_slots", "best.consistent"))
    if short is None:
        return pairs
    return pairs.unionByName(short.select("doc_id", "item_id", "n_windows", F.col("n_windows").alias("n_matched"),
                                          F.lit(1.0).alias("coverage"), F.lit(0).cast("long").alias("n_slots"), F.lit(True).alias("consistent")))
