"""Benchmark decontamination: planted leaks, slots, and brute force."""
import re

import duckdb
import pandas as pd
from edges import edge_docs, empty_docs, rows_of
from pyspark.sql import functions as F

from tidemark.llm.queries import OP2_SQL
from tidemark.llm.template_decontam import contaminated

ITEM = "On Monday afternoon Tom bought 12 apples and gave 3 kg to Anna, then Tom ate 12 of them quickly before dinner time."
PLAIN = "rivers seldom forget the valleys that they carved so patiently over ten thousand quiet winters"


def found(spark, docs, items=((1, ITEM), (2, PLAIN), (3, "too short"), (4, None), (5, "")), **options):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    b = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in contaminated(d, b, **options).collect()}


def test_copies_and_new_parameters_are_found(spark):
    docs = [f"Some words first. {ITEM} And words after.", ITEM.upper(), f"a b c\n{PLAIN.upper()}!! d",
            "Well. On Monday afternoon Bob bought 15 apples and gave 7 lbs to Maria, then Bob ate 15 of them quickly before dinner time.",
            PLAIN.replace(" ", ", "), None, "", "an innocent text about rivers and valleys and winters and apples"]
    got = found(spark, docs)
    assert set(got) == {(0, 1), (1, 1), (2, 2), (3, 1), (4, 2)}
    assert got[3, 1].consistent and got[3, 1].n_slots >= 5  # two names, two numbers, a unit


def test_inconsistent_slots_are_left_alone(spark):
    """The template without one value for each slot is another question."""
    docs = ["On Monday afternoon Bob bought 15 apples and gave 7 lbs to Maria, then Zed ate 99 of them quickly before dinner time.",
            "On Monday afternoon Bob bought 7 apples and gave 7 lbs to Bob, then Bob ate 7 of them quickly before dinner time."]
    assert found(spark, docs) == {}


def test_part_of_a_passage_counts_by_cover(spark):
    words = PLAIN.split()
    docs = [" ".join(words[:9]), " ".join(words[:6]), " ".join(words[::-1])]
    assert set(found(spark, docs)) == {(0, 2)}


def test_a_long_excerpt_of_a_longer_item_is_found(spark):
    words = [f"{a}{b}" for a in ("river", "stone", "cloud", "grain", "flame", "shore", "field", "tower") for b in "abcdefghijklmnopqrstuvwxy"]
    item, numbered = " ".join(words), " ".join(words[:60] + ["7", "8", "9"] + words[60:])
    docs = [f"before it {' '.join(words[70:120])} and after", " ".join(words[70:90]), " ".join(words[i] for i in range(0, 200, 2)),
            " ".join(words[48:60] + ["7", "8", "9"] + words[60:72])]
    assert set(found(spark, docs, [(1, item)])) == {(0, 1)}
    assert set(found(spark, docs, [(2, numbered)])) == {(0, 2), (3, 2)}  # windows of numbers do not end a run


def test_both_joins_agree(spark):
    docs = [ITEM, PLAIN, f"{PLAIN} {ITEM}", "nothing of the kind is in here at all"] * 3
    assert found(spark, docs) == found(spark, docs, max_broadcast_windows=0)


SHORT = [(1, "Compute 12 * 7 + 3 / 4 - 9"), (2, "Name the largest planet"), (3, "日本で一番高い山は何という名前ですか。"),
         (4, "Paris"), (5, "1 2 3 4 5 6 7 8 9 10 11 12"), (6, "..."), (7, None)]


def test_items_without_windows_are_found_by_their_whole_sequence(spark):
    docs = ["Please do this: compute 12 * 7 + 3 / 4 - 9!", "Compute 12 * 7 + 3 / 4 - 8", "Now name the LARGEST planet, please",
            "name the largest of all planet names", "次の問い：日本で一番高い山は何という名前ですか？", "We flew to Paris in May", "paris!",
            "count: 0 1 2 3 4 5 6 7 8 9 10 11 12 13", "1 2 3 4 5 6 7 8 9 10 11 and 12", "", None, "!!!"]
    want = {(0, 1), (2, 2), (4, 3), (6, 4), (7, 5)}
    for most in (500_000, 0):
        got = found(spark, docs, SHORT, max_broadcast_windows=most)
        assert set(got) == want
        assert all(r.coverage == 1.0 and r.n_matched == r.n_windows for r in got.values())
    assert got[7, 5].n_windows == 8 and got[2, 2].n_windows == 1


def test_the_sql_has_every_rule(spark):
    """Long items, runs, slots and items without windows: the registered SQL gives the operator's rows."""
    words = [f"{a}{b}" for a in ("river", "stone", "cloud", "grain", "flame", "shore", "field", "tower") for b in "abcdefghijklmnopqrstuvwxy"]
    numbered = words[:60] + ["7", "8", "9"] + words[60:]
    items = [(11, " ".join(words)), (12, " ".join(numbered)), (13, ITEM), (14, PLAIN), *SHORT]
    docs = [f"before it {' '.join(words[70:120])} and after", " ".join(words[70:90]), " ".join(words[40:60] + ["7", "8", "9"] + words[60:80]),
            " ".join(words[40:60] + ["1", "2", "2"] + words[60:80]), " ".join(words[50:60] + ["1", "1", "2"] + words[60:70]),
            ITEM.replace("Tom", "Bob").replace("12", "15"), PLAIN[:60], "Now name the LARGEST planet", "paris",
            "compute 12 * 7 + 3 / 4 - 9", "日本で一番高い山は何という名前ですか", None, ""]
    d, b = pd.DataFrame({"doc_id": range(len(docs)), "text": docs}), pd.DataFrame(items, columns=["item_id", "text"])
    con = duckdb.connect()
    con.register("documents", d)
    con.register("benchmark", b)
    got = found(spark, docs, items)
    want = con.execute(OP2_SQL).df()
    names = ["n_windows", "n_matched", "coverage", "n_slots", "consistent"]
    assert {k: tuple(r[n] for n in names) for k, r in got.items()} == {
        (r.doc_id, r.item_id): tuple(getattr(r, n) for n in names) for r in want.itertuples()}
    assert {(0, 11), (2, 12), (7, 2), (8, 4), (9, 1), (10, 3)} <= set(got) and (1, 11) not in got


def brute(docs, items, k=5):
    words = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    grams = lambda w: {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
    held = [(i, [tuple(w[j:j + k]) for j in range(len(w) - k + 1)]) for i, t in items for w in [words(t)]]
    out = set()
    for d, t in docs:
        own = grams(words(t))
        out |= {(d, i) for i, g in held if g and sum(x in own for x in g) >= 0.3 * len(g)}
    return out


def test_generated_documents_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = set(rows_of(contaminated(docs, items), "doc_id", "item_id"))
    plain = [r for r in rows_of(docs, "doc_id", "text") if not re.search(r"\d", r[1] or "")]
    ids = {d for d, _ in plain}
    assert {p for p in got if p[0] in ids} == brute(plain, rows_of(items, "item_id", "text"))


def test_edge_rows(spark):
    items = spark.createDataFrame([(1, "The same line of text and another line here", "x"), (1, None, "x"), (None, "", "x")],
                                  "item_id long, text string, doc_id string")
    got = rows_of(contaminated(edge_docs(spark), items), "doc_id", "item_id", "coverage")
    assert (120, 1, 1.0) in got and (None, 1) not in {r[:2] for r in got if r[2] > 0.9}
    assert contaminated(empty_docs(spark), items).count() == 0
    assert contaminated(edge_docs(spark), items.limit(0)).count() == 0


def test_documents_are_tokenised_once_a_stream(spark):
    """Texts without names are told by a short pattern; a stream's plain and slotted windows come from one reading."""
    from tidemark.llm.template_decontam import HAS_NAMES, MAY_HAVE_NAMES, NAMES, document_windows, item_windows
    texts = ["", "Al", "He saw Anna Bell, and Bob.", "x Al", "X Al", "3 Al", ", Al", ". Al", "é Él", "x  Al", "x AL", " Al", "\n Al", "x Al",
             "\U00010428 \U00010400\U00010428", "\U0001d7cf Al", "\U0001f600 Al", "one two three four 5 kg six seven", "Anna of the 7 hills saw Bob Carr near the old mill"]
    df = spark.createDataFrame(list(enumerate([*texts, None])), "id long, text string")
    told = df.where((F.col("text").rlike(MAY_HAVE_NAMES) & F.col("text").rlike(HAS_NAMES)) != F.col("text").rlike(NAMES))
    assert told.count() == 0
    own = document_windows(df, 3)
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 3, plan
    got = {(r.id, r.s, r.pos, r.h) for r in own.where("raw IS NOT NULL").collect()}
    items = item_windows(df, 3)
    assert got and got == {(r.id, r.s, r.pos, r.h) for r in items.where("types IS NOT NULL").collect()}
    plain = item_windows(df, 0)
    assert {(r.id, r.s, r.pos, r.h) for r in own.where("raw IS NULL").collect()} == {(r.id, r.s, r.pos, r.h) for r in plain.collect()}


def _spans(spark, pattern, text):
    """Places of all matches of a pattern in Java, in the driver's thread: an overflow there does not end the session."""
    at, found = spark._jvm.java.util.regex.Pattern.compile(pattern).matcher(text), []
    while at.find():
        found.append((at.start(), at.end()))
    return found


def test_long_lists_of_names_do_not_overflow_the_stack(spark, tmp_dir):
    """The decontamination stage ended the executor by a StackOverflowError at some 2000 capitalised words in a row."""
    import corpus_pipeline
    from tidemark.llm.template_decontam import NAMES
    n = 50_000
    listed = "the " + " ".join("Von" if i % 3 else "Anna" for i in range(n))
    assert _spans(spark, NAMES, listed) == [(2, len(listed))]
    greedy = NAMES.replace("*+", "*")
    for text in ("a Von Bo Cat, Dan", "x Von Bo C", "x Von  Bo", "x Von BO Bo", "é Él Ünder 7 Al Bo\nCy", "X Al, Bo Cy. Di", ""):
        assert _spans(spark, NAMES, text) == _spans(spark, greedy, text)
    docs = [listed, f"{listed} and then. {ITEM}", f"{ITEM} {listed}", "an innocent text", None]
    assert set(found(spark, docs)) == {(1, 1), (2, 1)}
    rows = spark.createDataFrame([(i, t, "de", "src", 1) for i, t in enumerate(docs)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    assert {r.doc_id for r in corpus_pipeline.decontamination(spark, rows, tmp_dir).collect()} == {0, 3, 4}


def test_long_lists_of_numbers_do_not_overflow_the_stack(spark):
    """A list of some 3000 numbers ended the executor by a StackOverflowError, in windows and in whole sequences."""
    from tidemark.llm.template_decontam import NUMBERS
    listed = ",".join(str(i % 1000) for i in range(50_000))
    assert _spans(spark, NUMBERS, f"{listed} 7") == [(0, len(listed)), (len(listed) + 1, len(listed) + 2)]
    greedy = NUMBERS.replace("*+", "*")
    for text in ("1,2.3,,4", "1,2,", "1.a", ",1", "1 ,2", "12.5.6;7", "½,³x٣.٤", ""):
        assert _spans(spark, NUMBERS, text) == _spans(spark, greedy, text)
    docs = [listed, f"{listed} and then. {ITEM}", f"Compute 12 * 7 + 3 / 4 - 9, or {listed}", f"kilos 5 kg {listed} kg", None]
    for most in (500_000, 0):
        assert set(found(spark, docs, [(1, ITEM), (2, "Compute 12 * 7 + 3 / 4 - 9"), (3, f"{listed}; 2; 3; 4")], max_broadcast_windows=most)) == {(1, 1), (2, 2)}
