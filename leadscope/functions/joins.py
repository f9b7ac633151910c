"""Joins that stay even when one key holds a large part of all rows, and frames that several branches share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import checkpointed


def join_groups(rows: DataFrame, groups: DataFrame, on: Sequence[str], n: str, share: float = 1e-5) -> DataFrame:
    """Inner join of rows with one row per key, of which column ``n`` tells how many rows have the key.

    Keys that hold more than ``share`` of the rows are broadcast: there can be 1 / share of them at most. Rows of all
    other keys are shuffled, and none of these keys is large.
    """
    on = list(on)
    groups = checkpointed(groups)
    total = groups.agg(F.sum(n)).first()[0] or 0
    hot, cold = groups.filter(F.col(n) > share * total), groups.filter(F.col(n) <= share * total)
    out = rows.join(F.broadcast(hot), on)
    if cold.isEmpty():
        return out
    return out.unionByName(rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on))


def shared(df: DataFrame) -> DataFrame:
    """The same rows, of which no branch prunes a column.

    When several branches read one aggregate, each would ask its shuffle for other columns, and Spark would run the
    aggregate and its scan once per branch. With all columns in every branch the shuffles are equal, so Spark runs one
    and reuses it. For small frames (aggregates), since nothing above is pushed below.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
