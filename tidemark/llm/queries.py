"""The registered queries of this folder and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe_counts import token_counts
from tidemark.llm.common import table
from tidemark.llm.cross_polytope import near_duplicates as near_vectors
from tidemark.llm.dom_extract import main_text
from tidemark.llm.hmm_lm import score_texts
from tidemark.llm.inverted_multi_index import hard_negatives
from tidemark.llm.language_crf import languages_of
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.merkle_manifest import leaf_digest, manifest
from tidemark.llm.packing import pack
from tidemark.llm.rff_quality import quality_scores
from tidemark.llm.secret_ownership import KINDS, joined, scan
from tidemark.llm.simhash_gph import near_duplicates
from tidemark.llm.template_decontam import contaminated


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Private-use characters: U+E001 marks a name's ends, U+E002 to U+E004 stand for a name, a number, a unit.
OP2_SQL = r"""
WITH src AS (SELECT 'doc' AS side, doc_id AS id, text FROM documents
             UNION ALL SELECT 'item', item_id, text FROM benchmark),
marked AS (SELECT side, id, text,
                  regexp_replace(text, '([\p{Ll}\p{N},;] )(\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*)', '\1@1\2@1', 'g') AS m
           FROM src WHERE text IS NOT NULL),
streams AS (SELECT side, id, 0 AS s, text AS t FROM marked
            UNION ALL SELECT side, id, 1, m FROM marked WHERE contains(m, '@1')),
numbered AS (SELECT side, id, s, t, regexp_replace(lower(regexp_replace(t, '@1[^@1]*@1', '@2', 'g')),
                                                   '\p{N}+(?:[.,]\p{N}+)*', ' @3 ', 'g') AS c FROM streams),
listed AS (SELECT side, id, s,
  regexp_extract_all(regexp_replace(c, '(@3 +)(?:kg|g|mg|km|m|cm|mm|mile|miles|foot|feet|ft|inch|inches|pound|pounds|lb|lbs|oz|l|ml|liter|liters|litre|litres|second|seconds|minute|minutes|hour|hours|day|days|week|weeks|month|months|year|years|cent|cents|dollar|dollars|euro|euros|percent|degrees)([^\p{L}\p{M}\p{N}]|$)', '\1@4\2', 'g'),
                     '[\p{L}\p{M}]+|[@2@3@4]') AS tokens,
  regexp_extract_all(lower(t), '@1[^@1]*@1|\p{N}+(?:[.,]\p{N}+)*|[\p{L}\p{M}]+') AS raw FROM numbered),
placed AS (SELECT side, id, s, i AS pos, tokens[i:i+4] AS w, raw[i:i+4] AS r
           FROM (SELECT *, unnest(range(1, greatest(len(tokens) - 3, 1))) AS i FROM listed)),
windows AS (SELECT * FROM placed WHERE len(list_filter(w, lambda x: x NOT IN ('@2', '@3', '@4'))) >= 3),
sizes AS (SELECT id AS item_id, s, count(*) AS n_windows FROM windows WHERE side = 'item' GROUP BY id, s),
places AS (SELECT *, row_number() OVER (PARTITION BY id, s ORDER BY pos) AS place FROM windows WHERE side = 'item'),
hits AS (SELECT d.id AS doc_id, b.id AS item_id, d.s AS s, d.pos - b.pos AS shift, b.pos AS pos, b.place AS place, d.w AS w, b.r AS a, d.r AS b
         FROM windows d JOIN places b ON d.side = 'doc' AND d.s = b.s AND d.w = b.w),
slots AS (SELECT doc_id, item_id, s, shift, pos, w[j] AS type, a[j] AS a, b[j] AS b
          FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS j FROM hits) WHERE w[j] IN ('@2', '@3', '@4')),
alignments AS (SELECT doc_id, item_id, s, shift, count(DISTINCT (type, a, b)) AS n_slots,
                      count(DISTINCT (type, a, b)) = count(DISTINCT (type, a)) AND
                      count(DISTINCT (type, a, b)) = count(DISTINCT (type, b)) AS consistent
               FROM slots GROUP BY ALL),
differ AS (SELECT DISTINCT doc_id, item_id, s, shift, pos FROM slots WHERE a <> b),
judged AS (SELECT h.doc_id, h.item_id, h.s, h.shift, h.pos, h.place, coalesce(l.consistent, true) AS consistent,
                  coalesce(l.n_slots, 0) AS n_slots, x.pos IS NULL AS same
           FROM hits h LEFT JOIN alignments l USING (doc_id, item_id, s, shift)
           LEFT JOIN differ x USING (doc_id, item_id, s, shift, pos)),
runs AS (SELECT doc_id, item_id, s, bool_or(consistent) AS run, bool_or(same) AS same_run
         FROM (SELECT doc_id, item_id, s, false AS consistent, true AS same
               FROM (SELECT *, place - row_number() OVER (PARTITION BY doc_id, item_id, s, shift ORDER BY place) AS stretch FROM judged WHERE same)
               GROUP BY doc_id, item_id, s, shift, stretch HAVING count(*) >= 20
               UNION ALL SELECT doc_id, item_id, s, true, false
               FROM (SELECT *, place - row_number() OVER (PARTITION BY doc_id, item_id, s, shift ORDER BY place) AS stretch FROM judged WHERE consistent)
               GROUP BY doc_id, item_id, s, shift, stretch HAVING count(*) >= 20)
         GROUP BY doc_id, item_id, s),
covered AS (SELECT j.doc_id, j.item_id, j.s, n_windows, count(DISTINCT pos) FILTER (WHERE consistent) AS good,
                   count(DISTINCT pos) FILTER (WHERE same) AS same, max(n_slots) FILTER (WHERE consistent) AS n_slots,
                   coalesce(any_value(run), false) AS run, coalesce(any_value(same_run), false) AS same_run
            FROM judged j JOIN sizes USING (item_id, s) LEFT JOIN runs USING (doc_id, item_id, s) GROUP BY j.doc_id, j.item_id, j.s, n_windows),
accepted AS (SELECT *, good >= 0.3 * n_windows OR run AS consistent FROM covered),
found AS (SELECT doc_id, item_id, s, n_windows, consistent,
                 CASE WHEN consistent THEN good ELSE same END AS n_matched,
                 CASE WHEN consistent THEN coalesce(n_slots, 0) ELSE 0 END AS n_slots
          FROM accepted WHERE consistent OR same >= 0.5 * n_windows OR same_run),
sequences AS (SELECT * FROM (SELECT side, id, regexp_extract_all(lower(text), '\p{N}+(?:[.,]\p{N}+)*|[\p{L}\p{M}]+') AS t
                             FROM src WHERE text IS NOT NULL) WHERE len(t) > 0),
short AS (SELECT id, t, '|' || array_to_string(t, '|') || '|' AS x,
                 length(array_to_string(t, '')) >= 10 AND (len(t) >= 3 OR regexp_matches(array_to_string(t, ' '),
                   '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]')) AS inside
          FROM sequences WHERE side = 'item' AND id NOT IN (SELECT item_id FROM sizes)),
wholes AS (SELECT DISTINCT d.id AS doc_id, i.id AS item_id, CASE WHEN inside THEN greatest(len(i.t) - 4, 1) ELSE 1 END AS n_windows
           FROM (SELECT id, t, '|' || array_to_string(t, '|') || '|' AS x FROM sequences
                 WHERE side = 'doc' AND EXISTS (SELECT 1 FROM short)) d
           JOIN short i ON CASE WHEN inside THEN contains(d.x, i.x) ELSE d.x = i.x END),
best AS (
SELECT doc_id, item_id, n_windows, n_matched, n_matched / n_windows AS coverage, n_slots, consistent FROM found
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_matched / n_windows DESC, consistent DESC, s) = 1)
SELECT * FROM best UNION ALL SELECT doc_id, item_id, n_windows, n_windows, 1.0::DOUBLE, 0, true FROM wholes
""".replace("@1", "\ue001").replace("@2", "\ue002").replace("@3", "\ue003").replace("@4", "\ue004")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "bucket")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
first AS (
  SELECT key, min(doc_id) AS doc_id FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.doc_id, pos, line, f.key IS NOT NULL AND f.doc_id <> k.doc_id AS gone
  FROM keyed k LEFT JOIN first f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2, seed=42)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    of_kind = lambda i: F.size(F.filter("base", lambda x: x["kind"] == i)).cast("long")
    count = lambda keep: F.coalesce(F.size(F.filter("spans", keep)), F.lit(0)).cast("long")
    return found.select("doc_id", *[of_kind(i).alias(f"n_{KINDS[i]}") for i in range(3)],
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        F.coalesce(joined(F.col("spans")), F.lit("")).alias("spans"),
                        count(lambda x: x["kind"] == 3).alias("n_owned"), count(lambda x: x["live"]).alias("n_live"),
                        count(lambda x: x["copied"]).alias("n_copied"))


def _sql_spans(kind: int, pattern: str, group: int, keep: str) -> str:
    """DuckDB: spans of one kind, from the pieces between the matches. The patterns are written out here on their own."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {kind} AS kind, start, start + length(m) AS stop, v FROM (
    SELECT doc_id, i, ms[i] AS m, vs[i] AS v,
           list_sum(list_transform(ps[1:i], lambda x: length(x))) +
           coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS start
    FROM (SELECT doc_id, regexp_extract_all(text, '{p}') AS ms, regexp_extract_all(text, '{p}', {group}) AS vs,
                 string_split_regex(text, '{p}') AS ps,
                 unnest(range(1, len(regexp_extract_all(text, '{p}')) + 1)) AS i FROM texts))
  WHERE {keep}"""


_RANDOM = ("regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') "
           "AND len(list_distinct(string_split(v, ''))) >= 8")

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
OP10_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, coalesce(lang, '') AS repo FROM documents),
base AS ({_sql_spans(0, _ASSIGN, 2, "length(v) >= 8")}
  UNION ALL {_sql_spans(1, "AKIA[A-Z0-9]+", 0, "length(v) >= 16")}
  UNION ALL {_sql_spans(2, "[0-9a-f]{32,}", 0, "true")}),
loose AS (SELECT * FROM ({_sql_spans(3, "[A-Za-z0-9+/_=-]{20,}", 0, _RANDOM)}) u WHERE NOT EXISTS (
  SELECT 1 FROM base b WHERE b.doc_id = u.doc_id AND b.start < u.stop AND u.start < b.stop)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM loose),
owners AS (SELECT v, count(DISTINCT owner) AS owners FROM every JOIN texts USING (doc_id) GROUP BY v),
judged AS (SELECT e.*, o.owners >= 3 AS copied, ({_RANDOM.replace("(v,", "(e.v,")}) AND o.owners < 3 AS live,
                  CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'owned' END
                  || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS said
           FROM every e JOIN owners o ON o.v = e.v)
SELECT t.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg(said, ',' ORDER BY start, kind) FILTER (WHERE kind < 3), '')) AS base_sha256,
       coalesce(string_agg(said, ',' ORDER BY start, kind) FILTER (WHERE kind < 3 OR live), '') AS spans,
       count(*) FILTER (WHERE kind = 3 AND live) AS n_owned,
       count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE copied AND kind < 3) AS n_copied
FROM texts t LEFT JOIN judged j ON j.doc_id = t.doc_id GROUP BY t.doc_id
"""


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages_of(table(spark, sf_dir, "documents"))


_LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    shown = F.when(tampered, n_chars + 1).otherwise(n_chars)
    claim = leaf_digest([shown if c == "n_chars" else F.col(c) for c in _LEAF])
    made = manifest(docs, _LEAF, id_col="doc_id", group_col="lang", claim=claim)
    as_text = lambda c: F.lower(F.hex(c))
    return made.select(F.col("item").alias("doc_id"), *[as_text(c).alias(c) for c in ("leaf", "subroot", "root")],
                       F.sha2(as_text("proof").cast("binary"), 256).alias("proof_sha256"), as_text("folded").alias("folded_root"),
                       (F.col("folded") == F.col("root")).alias("verified"))


def _sql_leaf(n_chars: str) -> str:
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    return f"sha256({' || '.join(field(n_chars if c == 'n_chars' else c) for c in _LEAF)})"


# DuckDB has no crc32: the remainder table of the polynomial 0xEDB88320 folds the id's bytes.
OP12_SQL = f"""
WITH RECURSIVE crc_step AS (
  SELECT i AS byte, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY byte) AS t FROM crc_step WHERE k = 8),
crc AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, CAST(4294967295 AS BIGINT) AS c, 0 AS k FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL SELECT doc_id, s, xor((SELECT t FROM crc_table)[CAST(xor(c & 255, ascii(substr(s, k + 1, 1))) AS INT) + 1], c >> 8), k + 1
  FROM crc WHERE k < length(s)),
bad AS (SELECT doc_id FROM crc WHERE k = length(s) AND xor(c, 4294967295) % 7 = 0),
rows_ AS (SELECT d.*, {_sql_leaf('n_chars')} AS leaf,
                 CASE WHEN doc_id IN (SELECT doc_id FROM bad) THEN {_sql_leaf('(n_chars + 1)')} ELSE {_sql_leaf('n_chars')} END AS claim
          FROM documents d),
placed AS (SELECT doc_id, leaf, claim, coalesce('=' || lang, '') AS grp,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                  count(*) OVER (PARTITION BY lang) AS n FROM rows_),
nodes AS (
  SELECT grp, 0 AS lvl, i, n, leaf AS h FROM placed
  UNION ALL SELECT grp, lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1
  GROUP BY grp, lvl, i // 2, n),
subroots AS (SELECT grp, h, row_number() OVER (ORDER BY grp) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper_ AS (
  SELECT 0 AS lvl, i, n, h FROM subroots
  UNION ALL SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM upper_ WHERE n > 1 GROUP BY lvl, i // 2, n),
top AS (SELECT h AS root FROM upper_ WHERE n = 1),
steps AS (
  SELECT p.grp, p.i, x.lvl, CASE WHEN (p.i >> x.lvl) & 1 = 1 THEN 'L' ELSE 'R' END AS side, s.h
  FROM placed p JOIN (SELECT DISTINCT grp, lvl FROM nodes WHERE n > 1) x ON x.grp = p.grp
  LEFT JOIN nodes s ON s.grp = p.grp AND s.lvl = x.lvl AND s.i = xor(p.i >> x.lvl, 1)
  UNION ALL
  SELECT p.grp, p.i, 1000 + x.lvl, CASE WHEN (r.i >> x.lvl) & 1 = 1 THEN 'L' ELSE 'R' END, s.h
  FROM placed p JOIN subroots r ON r.grp = p.grp CROSS JOIN (SELECT DISTINCT lvl FROM upper_ WHERE n > 1) x
  LEFT JOIN upper_ s ON s.lvl = x.lvl AND s.i = xor(r.i >> x.lvl, 1)),
proofs AS (SELECT grp, i, list({{'side': side, 'h': h}} ORDER BY lvl) AS steps, string_agg(h, '' ORDER BY lvl) AS said FROM steps GROUP BY grp, i),
folding AS (
  SELECT p.grp, p.i, p.claim AS h, coalesce(q.steps, []) AS steps, 0 AS k FROM placed p LEFT JOIN proofs q ON q.grp = p.grp AND q.i = p.i
  UNION ALL SELECT grp, i, sha256(CASE WHEN steps[k + 1].h IS NULL THEN h WHEN steps[k + 1].side = 'L' THEN steps[k + 1].h || h
                                       ELSE h || steps[k + 1].h END), steps, k + 1 FROM folding WHERE k < len(steps))
SELECT p.doc_id, p.leaf, r.h AS subroot, t.root, sha256(coalesce(q.said, '')) AS proof_sha256, f.h AS folded_root, f.h = t.root AS verified
FROM placed p JOIN subroots r ON r.grp = p.grp CROSS JOIN top t JOIN folding f ON f.grp = p.grp AND f.i = p.i AND f.k = len(f.steps)
LEFT JOIN proofs q ON q.grp = p.grp AND q.i = p.i
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, label=label)


OP13_SQL = """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT * FROM valid WHERE vec_id % 100 = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.q, r.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM anchors a JOIN valid r ON a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.other) AS INT) AS rank,
       n.other AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.other) <= 5
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_packing": op3_packing,
    "op4_html_extraction": op4_html_extraction,
    "op5_line_dedup": op5_line_dedup,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_secret_scan": op10_secret_scan,
    "op11_language_id": op11_language_id,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_hard_negatives": op13_hard_negatives,
}
SQL: dict[str, str] = {
    "op2_benchmark_decontamination": OP2_SQL,
    "op5_line_dedup": OP5_SQL,
    "op10_secret_scan": OP10_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
