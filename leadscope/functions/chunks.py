"""Ordered lists in bounded pieces, for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import checkpointed

SIZE = 1000


def ordered_chunks(rows: DataFrame, groups: Sequence[str], order: Sequence[str], value: str, name: str, size: int = SIZE,
                   separator: str = "; ") -> DataFrame:
    """AGG-12 in pieces: per group and chunk (from 0) the number of values and these, joined in order, ``size`` at most.

    groups, chunk, n, <name>. The chunks of a group, put together in order, are its whole list.

    Rows are range-partitioned by group and order, so that a group of any size is dealt to as many tasks as its share of
    the rows; a row's place is the number of its group's rows in earlier ranges (one count per range and group) and its
    place in its own. No task holds more than a range or a chunk. Rows equal in group and order stay in one range, so
    ``order`` should end with a key; ties are listed by value.

    Null values are in no list, and a group without values has no row. Null group keys are a group.
    """
    groups, order = list(groups), list(order)
    # the ranges are stored, as bounds are sampled: a repeated task must not deal its rows anew
    ranged = checkpointed(rows.filter(F.col(value).isNotNull()).select(*groups, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.col(value).alias("_value"))
                          .repartitionByRange(*groups, *[f"_o{i}" for i in range(len(order))]).withColumn("_range", F.spark_partition_id()))
    keys = [f"_o{i}" for i in range(len(order))] + ["_value"]
    counts = ranged.groupBy(*groups, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = counts.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(groups)], F.col("_range").alias("_r"), before.alias("_first"))
    same: Column = F.col("_range") == F.col("_r")
    for i, c in enumerate(groups):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    place = F.row_number().over(Window.partitionBy(*groups, "_range").orderBy(*keys)) - 1
    placed = ranged.withColumn("_place", place).join(firsts, same)
    chunked = placed.withColumn("chunk", F.floor((F.col("_first") + F.col("_place")) / size))
    pieces = F.transform(F.array_sort(F.collect_list(F.struct(F.col("_first") + F.col("_place"), "_value"))), lambda x: x["_value"])
    return chunked.groupBy(*groups, "chunk").agg(F.count(F.lit(1)).alias("n"), F.array_join(pieces, separator).alias(name))
