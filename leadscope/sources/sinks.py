"""Sinks (SNK-1 .. SNK-7): keyed upserts, snapshots and CSV exports.

Upserts are one shuffle on the key: old and new rows are unioned with a
version tag and reduced per key in one window pass (no join). The result is written as a new
snapshot; nothing is mutated in place, so a lost executor just re-runs tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_batch(new: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key inside a batch (greatest ``order`` tuple wins).
    ``row_number() = 1`` gets a partial WindowGroupLimit before the shuffle,
    so a key repeated millions of times is collapsed map-side instead of
    landing in one task."""
    ob = [F.col(c).desc_nulls_last() for c in order] or [F.lit(0)]
    w = Window.partitionBy(key).orderBy(*ob)
    return new.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def upsert(old: DataFrame, new: DataFrame, key: str = "task_id", keep_old: Sequence[str] = (),
           batch_order: Sequence[str] = ("last_modified_date",), default_now=None,
           batch_unique: bool = False, within: str | None = None, pieces: int = 1) -> DataFrame:
    """SNK-1/SNK-2/SET-3/JON-5: keyed replace.

    * rows of ``new`` with NULL or empty key are dropped;
    * duplicates inside ``new`` keep the greatest ``batch_order`` value;
    * on a shared key, columns supplied by ``new`` overwrite; columns missing
      from ``new`` and the ``keep_old`` columns keep the old value;
    * ``keep_old`` columns of inserted keys take ``new``'s value if supplied,
      else ``default_now``;
    * ``within``: a column that the key determines (its bucket); rows are
      shuffled by it alone, so that a bucket is written by one task, or cut
      into ``pieces`` by a hash of the key.

    Plan: old and new rows are unioned with a version tag and shuffled once by
    the key; one window pass (same partitioning and order for every window
    expression, so a single sort) picks the winning row and carries the
    kept-old values. No join, and no aggregate buffer holding wide rows.
    """
    new = new.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    types = dict(old.dtypes)
    cols = old.columns
    supplied = set(new.columns)
    order = [c for c in batch_order if c in supplied]
    order += [c for c in ("raw_description", "Description") if c in supplied and c in cols]
    if not batch_unique:
        new = dedupe_batch(new, key, order)
    tagged_old = old.select(*[F.col(c) for c in cols], F.lit(0).alias("_v"))
    new_full = new.select(*[F.col(c) if c in supplied else F.lit(None).cast(types[c]).alias(c) for c in cols],
                          F.lit(1).alias("_v"))
    u = tagged_old.unionByName(new_full)
    spread = [within] if within else []
    if within and pieces > 1:
        u = u.withColumn("_piece", F.pmod(F.xxhash64(key, F.lit(1)), F.lit(pieces)))
        spread = [within, "_piece"]
    if spread:
        u = u.repartition(*spread)
    w = Window.partitionBy(*spread, key).orderBy(F.col("_v").desc(), *[F.col(c).desc_nulls_last() for c in order])
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = {}
    for c in cols:
        if c != key and (c in keep_old or c not in supplied):
            v = F.coalesce(F.first(F.when(F.col("_v") == 0, F.col(c)), ignorenulls=True).over(whole), F.col(c))
            if c in keep_old and default_now is not None:
                v = F.coalesce(v, F.lit(default_now).cast(types[c]))
            carried[c] = v
    ranked = u.withColumns({**carried, "_rn": F.row_number().over(w)})
    return ranked.filter(F.col("_rn") == 1).select(*cols)


def upsert_parsed(old: DataFrame, new: DataFrame, now=None) -> DataFrame:
    """SNK-2: parsed rows keyed by ``task_id``; ``parsed_at`` is never
    overwritten (first parse time survives re-parses)."""
    return upsert(old, new, "task_id", keep_old=("parsed_at",), default_now=now)


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a new immutable snapshot (Parquet); readers switch paths atomically."""
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in ``spark.checkpoint.dir`` (shared
    storage on a cluster). Use it before fanning one expensive derived frame out
    to several consumers: each consumer then reads the compact checkpoint
    instead of recomputing the frame from raw data."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def serialise_api_response(c: F.Column) -> F.Column:
    """SNK-3: stored JSON text; empty/NULL -> '{}'."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("{}"))


def write_csv(df: DataFrame, path: str) -> None:
    """SNK-4/SNK-5/SNK-6: CSV with header (one part file per task)."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def touch_latest(pv: DataFrame, now) -> DataFrame:
    """SNK-7/JON-4: set ``parsed_at = now`` on the single newest good row.
    The top-1 row is bounded (one key), so joining it back is a broadcast."""
    top = (pv.filter(F.col("parse_error").isNull())
           .orderBy(F.col("parsed_at").desc_nulls_last(), F.col("task_id")).limit(1)
           .select(F.col("task_id").alias("_hit")))
    j = pv.join(F.broadcast(top), pv.task_id == top._hit, "left")
    return j.withColumn("parsed_at", F.when(F.col("_hit").isNotNull(), F.lit(str(now)).cast("timestamp_ntz"))
                        .otherwise(F.col("parsed_at"))).drop("_hit")
