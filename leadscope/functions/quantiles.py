"""Exact grouped median without gathering a group into one task.

``F.median`` merges a value->count map per group in a single task, so one hot
group (a third of all rows) would have to fit in one executor. This operator
brackets the median by a sketch and selects the exact rank inside:

1. per group: the row count and, from a mergeable quantile sketch, two values
   that the middle ranks lie between (some ranks apart, see ``SLACK``);
2. the rows up to the upper one are counted: those below the bracket as one
   number per group, those inside per distinct value (partial aggregation);
3. the distinct values inside are dealt into cells, whose bounds are quantiles
   of themselves; counts per cell give the cell(s) with the middle rank(s);
4. only the values of those cells are ranked one by one.

Bounds are ranks, not widths: an extreme value moves none of them. A bracket
holds about 2 * SLACK / accuracy of a group's rows, a cell 1 / CELLS of that.
Interpolation for an even count is ``lo + (hi - lo) * 0.5`` (continuous
quantile at 0.5). NULL values are ignored; a group of only NULLs has a NULL
median.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Relative rank error of the sketch is 1 / ACCURACY; the bracket is SLACK times as wide on either side.
ACCURACY, SLACK, CELLS = 10_000, 3, 128
#: A value's cell is found among every STEP-th bound, then among the STEP that follow.
STEP = 12


def bracketed(df: DataFrame, keys: Sequence[str], value: str, accuracy: int = ACCURACY) -> DataFrame:
    """keys, _n, _v, _w: the weighted distinct values in each group's bracket, and one row with NULL for what lies below."""
    keys = list(keys)
    v = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    ends = F.percentile_approx("_v", [0.5 - SLACK / accuracy, 0.5 + SLACK / accuracy], accuracy)
    stats = [F.count(F.lit(1)).alias("_n"), ends.alias("_ends")]
    if keys:
        met = v.join(v.groupBy(*keys).agg(*stats), keys)
    else:
        # global: the one-row statistics are a scalar subquery (no join on a constant key)
        s = v.agg(F.struct(*stats).alias("s")).scalar()
        met = v.withColumns({c: s[c] for c in ("_n", "_ends")})
    inside = F.when(F.col("_v") >= F.col("_ends")[0], F.col("_v"))
    return met.filter(F.col("_v") <= F.col("_ends")[1]).groupBy(*keys, "_n", inside.alias("_v")).agg(F.count(F.lit(1)).alias("_w"))


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median",
                   buckets: int = CELLS, accuracy: int = ACCURACY) -> DataFrame:
    """Return ``keys + [out]``, one row per group that has a non-NULL value; ``buckets``: cells of a bracket."""
    return _select_middle(bracketed(df, keys, value, accuracy), list(keys), out, buckets)


def weighted_median(counts: DataFrame, keys: Sequence[str], value: str, weight: str, out: str = "median",
                    buckets: int = CELLS) -> DataFrame:
    """Exact median of values that occur ``weight`` times each: keys + [out], one row per group that has a value.

    For value counts, which merge: those of days add up to those of weeks. A cell holds about 1 / buckets of a group's
    distinct values, and only the cells of the middle ranks are ranked. Rows with a NULL value or no weight don't count.
    """
    keys = list(keys)
    v = counts.select(*keys, F.col(value).cast("double").alias("_v"), F.col(weight).alias("_w"))
    v = v.filter(F.col("_v").isNotNull() & (F.col("_w") > 0)).groupBy(*keys, "_v").agg(F.sum("_w").alias("_w"))
    return _select_middle(v, keys, out, buckets)


def _select_middle(inside: DataFrame, keys: list[str], out: str, buckets: int) -> DataFrame:
    """Median of weighted distinct values (_v, _w); ``_n`` is a group's number of rows, or the sum of _w where absent."""
    # bounds of the cells: quantiles of the distinct values in the bracket; any bounds give the exact result
    stats = [F.percentile_approx("_v", [k / buckets for k in range(1, buckets)], buckets * 4).alias("_bounds")]
    stats += [] if "_n" in inside.columns else [F.sum("_w").alias("_n")]
    some = F.filter("_bounds", lambda b, i: i % STEP == STEP - 1).alias("_some")
    if keys:
        dealt = inside.join(inside.groupBy(*keys).agg(*stats).select("*", some), keys)
    else:
        s = inside.agg(*stats).select("*", some).select(F.struct("*").alias("s")).scalar()
        dealt = inside.withColumns({c: s[c] for c in ("_bounds", "_some", "_n") if c not in inside.columns})
    lower = F.size(F.filter("_some", lambda b: b < F.col("_v"))) * STEP
    below = F.when(F.col("_bounds").isNull(), 0).otherwise(
        lower + F.size(F.filter(F.slice("_bounds", lower + 1, STEP), lambda b: b < F.col("_v"))))
    dealt = dealt.select(*keys, "_n", "_v", "_w", F.when(F.col("_v").isNull(), -1).otherwise(below).alias("_c"))
    r1 = F.floor((F.col("_n") + 1) / 2).cast("bigint")
    r2 = (F.floor(F.col("_n") / 2) + 1).cast("bigint")
    in_order = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, 0)
    hist = dealt.groupBy(*keys, "_n", "_c").agg(F.sum("_w").alias("_in"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    hist = hist.withColumn("_upto", F.sum("_in").over(in_order)).withColumn("_before", F.col("_upto") - F.col("_in"))
    hits = hist.filter(((F.col("_before") < r1) & (r1 <= F.col("_upto"))) | ((F.col("_before") < r2) & (r2 <= F.col("_upto"))))
    hits = hits.select(*keys, "_n", "_c", "_before", "_lo", "_hi")
    if keys:
        # at most two cells of a group are hit; their ends pick the values without finding each value's cell again
        ranked = inside.select(*keys, "_v", "_w").join(hits, keys).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    else:
        ranked = dealt.drop("_n").join(hits, "_c")
    in_cell = Window.partitionBy(*keys, "_c").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranked.withColumn("_hiRank", F.col("_before") + F.sum("_w").over(in_cell))
    ranked = ranked.withColumn("_loRank", F.col("_hiRank") - F.col("_w"))
    pick = ranked.groupBy(*keys, "_n").agg(
        F.min(F.when((F.col("_loRank") < r1) & (r1 <= F.col("_hiRank")), F.col("_v"))).alias("_m1"),
        F.min(F.when((F.col("_loRank") < r2) & (r2 <= F.col("_hiRank")), F.col("_v"))).alias("_m2"))
    med = F.col("_m1") + (F.col("_m2") - F.col("_m1")) * F.lit(0.5)
    return pick.select(*keys, med.alias(out))


def approx_grouped_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median",
                          accuracy: int = 10000) -> DataFrame:
    """Opt-in approximate median: ``percentile_approx`` keeps a bounded,
    mergeable sketch per group (rank error about 1/accuracy), one shuffle.
    Returns an observed value rather than an interpolation."""
    return (df.filter(F.col(value).isNotNull()).groupBy(*keys)
            .agg(F.percentile_approx(F.col(value).cast("double"), 0.5, accuracy).alias(out)))


def median_by(df: DataFrame, keys: Sequence[str], value: str, out: str = "median",
              accuracy: int | None = None) -> DataFrame:
    """Exact distributed median, or the approximate one when ``accuracy`` is given."""
    if accuracy:
        return approx_grouped_median(df, keys, value, out, accuracy)
    return grouped_median(df, keys, value, out)


def grouped_medians(df: DataFrame, keys: Sequence[str], values: dict[str, str], accuracy: int | None = None) -> DataFrame:
    """Several medians per group in one pass: the value columns are stacked
    into (metric, value) rows, one :func:`grouped_median` runs with the metric
    as an extra key, and the results are folded back to one row per group.
    ``values`` maps output name -> input column."""
    keys = list(keys)
    pairs = F.array(*[F.struct(F.lit(out).alias("_metric"), F.col(c).cast("double").alias("_val"))
                      for out, c in values.items()])
    long = df.select(*keys, F.inline(pairs))
    if accuracy:
        m = approx_grouped_median(long, keys + ["_metric"], "_val", "_med", accuracy)
    else:
        m = grouped_median(long, keys + ["_metric"], "_val", "_med")
    return m.groupBy(*keys).agg(*[F.max(F.when(F.col("_metric") == out, F.col("_med"))).alias(out)
                                  for out in values])


def global_median(df: DataFrame, value: str, out: str = "median", accuracy: int | None = None) -> DataFrame:
    """Median over all rows (one output row, NULL when there is no value)."""
    m = (approx_grouped_median(df, [], value, out, accuracy) if accuracy
         else grouped_median(df, [], value, out))
    # exactly one row even without values: union with a NULL row and take max (no join)
    empty = df.sparkSession.range(1).select(F.lit(None).cast("double").alias(out))
    return m.select(out).unionByName(empty).agg(F.max(out).alias(out))
