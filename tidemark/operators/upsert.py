"""Bringing a target up to date by key.

* ``merge_upsert``  — key match → the source row replaces the target row; no
  match → the source row is inserted; other target rows are untouched. A
  target row matched by more than one source row is an error (the MERGE
  contract). NULL keys never match.
* ``stage_swap``    — delete every target row whose key is in the stage, then
  insert the whole stage. Stage duplicates are all kept, never an error.
* ``delete_by_keys`` / ``matched_by_keys`` — anti / semi join on the key list.
* ``merge_metrics`` — how many rows a merge updates / inserts / leaves alone; ``merge_observed`` counts them while
  the merge is written.

Plan shape: the key side (source keys) is broadcast only after a bounded
count proves it small — the usual case for an incremental slice; otherwise the
anti join is a shuffle join on the keys and AQE splits skewed key partitions.
No step collects rows to the driver; the only actions are bounded checks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.lists import key_list
from tidemark.operators.keys import all_present, any_null, duplicate_keys
from tidemark.operators.sizing import DEFAULT_BROADCAST_ROWS, at_most, is_empty


#: Keys compared as numbers keep ten places after the point: 1.0 and 1.4 are two keys.
DECIMAL_KEY = "decimal(38,10)"


class MergeAmbiguityError(ValueError):
    """More than one source row matches the same target row."""


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def align_to(target: DataFrame, source: DataFrame, allow_extra: bool = False) -> DataFrame:
    """Source columns in target order and types, matched by name (case-insensitively
    unless ``spark.sql.caseSensitive`` is on, like Spark's own name resolution)."""
    case_sensitive = str(source.sparkSession.conf.get("spark.sql.caseSensitive", "false")).lower() == "true"

    def norm(name: str) -> str:
        return name if case_sensitive else name.lower()

    by_name = {norm(c): c for c in source.columns}
    missing = [c for c in target.columns if norm(c) not in by_name]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    wanted = {norm(c) for c in target.columns}
    extra = [c for c in source.columns if norm(c) not in wanted]
    if extra and not allow_extra:
        raise ValueError(f"source has columns the target lacks: {extra}")
    src_types = {norm(n): t for n, t in source.dtypes}
    cols = []
    for f in target.schema.fields:
        src_name = by_name[norm(f.name)]
        c = F.col(_q(src_name))
        if src_types[norm(f.name)] != f.dataType.simpleString():
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return source.select(*cols)


def _key_join(left: DataFrame, keys_df: DataFrame, keys: list[str], how: str,
              keys_as_decimal: bool = False, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
              small: bool | None = None) -> DataFrame:
    """Semi/anti join of ``left`` with a key list; NULL keys never match.

    ``small`` — already known whether the keyed rows of ``keys_df`` fit
    ``broadcast_rows`` (skips the bounded count)."""
    right = keys_df.select(*[F.col(_q(k)) for k in keys]).where(all_present(keys))
    if small is None:
        small = at_most(right, broadcast_rows)
    if small:
        right = F.broadcast(right)
    else:
        # Shuffle join: de-duplicate the key side first (semi/anti joins ignore
        # repeats). Partial aggregation folds a hot key to one row per task, and
        # the result is already hash-partitioned on the keys for the join.
        right = right.distinct()
    lt, rt = left.alias("_l"), right.alias("_r")

    def side(alias: str, k: str):
        c = F.col(f"{alias}.{_q(k)}")
        return c.cast(DECIMAL_KEY) if keys_as_decimal else c

    cond = reduce(lambda a, b: a & b, [side("_l", k) == side("_r", k) for k in keys])
    return lt.join(rt, cond, how).select(*[F.col(f"_l.{_q(c)}") for c in left.columns])


def delete_by_keys(target: DataFrame, keys_df: DataFrame, keys: str | Iterable[str], *,
                   keys_as_decimal: bool = False, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                   small: bool | None = None) -> DataFrame:
    """Target rows whose key is *not* in ``keys_df`` (what survives the DELETE)."""
    return _key_join(target, keys_df, key_list(keys), "left_anti", keys_as_decimal, broadcast_rows, small)


def matched_by_keys(target: DataFrame, keys_df: DataFrame, keys: str | Iterable[str], *,
                    keys_as_decimal: bool = False, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    small: bool | None = None) -> DataFrame:
    """Target rows whose key *is* in ``keys_df`` (what the DELETE removes)."""
    return _key_join(target, keys_df, key_list(keys), "left_semi", keys_as_decimal, broadcast_rows, small)


def ambiguous_target_rows(target: DataFrame, source: DataFrame, keys: str | Iterable[str], *,
                          broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Target rows matched by more than one source row."""
    ks = key_list(keys)
    dup = duplicate_keys(source.where(all_present(ks)), ks).select(*map(_q, ks))
    return _key_join(target, dup, ks, "left_semi", broadcast_rows=broadcast_rows)


def stage_swap(target: DataFrame, stage: DataFrame, keys: str | Iterable[str], *,
               broadcast_rows: int = DEFAULT_BROADCAST_ROWS, small: bool | None = None) -> DataFrame:
    """DELETE target rows keyed in the stage, then INSERT the whole stage."""
    ks = key_list(keys)
    stage = align_to(target, stage)
    return delete_by_keys(target, stage, ks, broadcast_rows=broadcast_rows, small=small).unionByName(stage)


def source_key_stats(source: DataFrame, keys: list[str]) -> tuple[int, bool]:
    """(rows with all keys present, whether a key repeats) — one aggregation of the source."""
    per_key = source.where(all_present(keys)).groupBy(*map(_q, keys)).agg(F.count(F.lit(1)).alias("n"))
    r = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                    F.coalesce(F.max("n"), F.lit(0)).alias("max_n")).first()
    return int(r["rows"]), int(r["max_n"]) > 1


def merge_upsert(target: DataFrame, source: DataFrame, keys: str | Iterable[str], *,
                 check_ambiguous: bool = True, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                 small: bool | None = None) -> DataFrame:
    """MERGE: update matched rows with the source row, insert the rest.

    Raises ``MergeAmbiguityError`` when a target row is matched by several
    source rows. One aggregation of the source gives both its keyed row count
    (the broadcast decision) and whether any key repeats; only then is the
    target probed. The checks and the join each read the source: persist it
    first when it is expensive to recompute (a JDBC read, a wide join).
    """
    ks = key_list(keys)
    src = align_to(target, source)
    if check_ambiguous:
        keyed_rows, has_dup = source_key_stats(src, ks)
        if small is None:
            small = keyed_rows <= broadcast_rows
        if has_dup:
            dup = duplicate_keys(src.where(all_present(ks)), ks).select(*map(_q, ks))
            bad = _key_join(target, dup, ks, "left_semi", broadcast_rows=broadcast_rows)
            if not is_empty(bad):
                raise MergeAmbiguityError(
                    f"several source rows match the same target row on keys {ks}")
    return delete_by_keys(target, src, ks, broadcast_rows=broadcast_rows, small=small).unionByName(src)


def merge_observed(target: DataFrame, source: DataFrame, keys: str | Iterable[str], write: Callable[[DataFrame], object], *,
                   check_ambiguous: bool = True, broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> dict[str, int]:
    """MERGE through ``write`` and return the counts of ``merge_metrics``, observed while the rows are written.

    Target rows read and target rows kept are counted as they pass, so no job of its own counts them (the source's
    statistics are those that the merge needs anyway). The target's keys are taken to be unique, as primary keys are: each updated row is
    then the match of one source row, and all other source rows are insertions."""
    ks = key_list(keys)
    src = align_to(target, source)
    read, kept, given = Observation(), Observation(), Observation()
    one = F.count(F.lit(1)).alias("n")
    keyed_rows, has_dup = source_key_stats(src, ks)
    small = keyed_rows <= broadcast_rows
    if check_ambiguous and has_dup:
        merge_upsert(target, src, ks, broadcast_rows=broadcast_rows, small=small)  # raises where a target row has several
    survivors = delete_by_keys(target.observe(read, one), src, ks, broadcast_rows=broadcast_rows, small=small)
    write(survivors.observe(kept, one).unionByName(src.observe(given, one)))
    n_read, n_kept, n_source = (o.get["n"] for o in (read, kept, given))
    return {"rows_updated": n_read - n_kept, "rows_inserted": n_source - (n_read - n_kept), "rows_untouched": n_kept,
            "rows_after": n_kept + n_source}


def merge_metrics(target: DataFrame, source: DataFrame, keys: str | Iterable[str], *,
                  broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """One row: ``rows_updated``, ``rows_inserted``, ``rows_untouched``, ``rows_after``.

    Small source (its non-NULL keys proven to fit ``broadcast_rows``): every count
    comes from scans and broadcast semi/anti joins — the target is never
    shuffled. Large source: both sides are reduced to key columns, tagged,
    unioned and grouped once by key (partial aggregation first; no join).
    """
    ks = key_list(keys)
    kcols = [F.col(_q(k)) for k in ks]
    src_keys = source.select(*kcols).where(all_present(ks))
    if at_most(src_keys, broadcast_rows):
        small = F.broadcast(src_keys.distinct())
        tkeys = target.select(*kcols)
        matched = tkeys.join(small, ks, "left_semi")
        # distinct matched keys are at most the source's keys: safe to broadcast too
        matched_keys = F.broadcast(matched.distinct())
        parts = [
            tkeys.agg(F.count(F.lit(1)).alias("n")).withColumn("m", F.lit("t")),
            source.agg(F.count(F.lit(1)).alias("n")).withColumn("m", F.lit("s")),
            matched.agg(F.count(F.lit(1)).alias("n")).withColumn("m", F.lit("u")),
            source.select(*kcols).join(matched_keys, ks, "left_anti")
            .agg(F.count(F.lit(1)).alias("n")).withColumn("m", F.lit("i")),
        ]
        u = reduce(DataFrame.unionByName, parts)

        def pick(tag):
            return F.coalesce(F.sum(F.when(F.col("m") == tag, F.col("n"))), F.lit(0)).cast("bigint")

        return u.agg(pick("u").alias("rows_updated"), pick("i").alias("rows_inserted"),
                     (pick("t") - pick("u")).alias("rows_untouched"),
                     (pick("t") - pick("u") + pick("s")).alias("rows_after"))

    t = target.select(*kcols).withColumns({"_t": F.lit(1), "_s": F.lit(0)})
    s = source.select(*kcols).withColumns({"_t": F.lit(0), "_s": F.lit(1)})
    per_key = t.unionByName(s).groupBy(*ks).agg(
        F.sum("_t").alias("n_t"), F.sum("_s").alias("n_s"), any_null(ks).alias("_null"))
    matched = (F.col("n_t") > 0) & (F.col("n_s") > 0) & ~F.col("_null")

    def total(cond, col):
        return F.coalesce(F.sum(F.when(cond, F.col(col)).otherwise(0)), F.lit(0)).cast("bigint")

    out = per_key.agg(
        total(matched, "n_t").alias("rows_updated"),
        total(~matched, "n_s").alias("rows_inserted"),
        total(~matched, "n_t").alias("rows_untouched"),
        total(F.lit(True), "n_s").alias("_src"),
    )
    return out.select("rows_updated", "rows_inserted", "rows_untouched",
                      (F.col("rows_untouched") + F.col("_src")).alias("rows_after"))
