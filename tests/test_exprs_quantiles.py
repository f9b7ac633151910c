import math
import random

from pyspark.sql import functions as F

from leadscope.functions.exprs import exact_avg, pct, round_half_away
from leadscope.functions.quantiles import global_median, grouped_median


def _ref_round(x, n):
    # IEEE product rounded half away from zero (the reports' ROUND on doubles)
    return math.copysign(math.floor(abs(x) * 10 ** n + 0.5), x) / 10 ** n


def test_round_half_away_matches_reference_rule(spark):
    vals = [1.005, 2.675, 66.665, 0.125, -2.675, 12.345, 0.0, None] + [random.Random(7).uniform(-100, 100)
                                                                     for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.select("x", round_half_away("x", 2).alias("r")).collect()
    for row in got:
        if row.x is None:
            assert row.r is None
        else:
            assert row.r == _ref_round(row.x, 2), row


def test_pct_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "n long, t long")
    r = df.select(pct("n", "t").alias("p")).collect()
    assert r[0].p is None and r[1].p == 33.33


def _median(xs):
    xs = sorted(xs)
    n = len(xs)
    lo, hi = xs[(n + 1) // 2 - 1], xs[n // 2]
    return lo + (hi - lo) * 0.5


def test_grouped_median_matches_bruteforce_with_hot_group(spark):
    rnd = random.Random(3)
    rows = [("hot", rnd.random()) for _ in range(3000)]          # one group holds most rows
    rows += [(f"g{i % 7}", float(rnd.randint(0, 20))) for i in range(900)]   # many ties
    rows += [("g1", None), ("nulls", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: r.m for r in grouped_median(df, ["k"], "v", "m", buckets=16).collect()}
    exp = {}
    for k, v in rows:
        if v is not None:
            exp.setdefault(k, []).append(v)
    assert set(got) == set(exp)
    for k, xs in exp.items():
        assert got[k] == _median(xs), k


def test_global_median_empty_and_single(spark):
    e = spark.createDataFrame([], "v double")
    assert global_median(e, "v", "m").collect()[0].m is None
    one = spark.createDataFrame([(2.5,)], "v double")
    assert global_median(one, "v", "m").collect()[0].m == 2.5


def test_approx_median_close_to_exact(spark):
    from leadscope.functions.quantiles import median_by
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), rnd.gauss(0, 1)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k string, v double")
    exact = {r.k: r.m for r in median_by(df, ["k"], "v", "m").collect()}
    approx = {r.k: r.m for r in median_by(df, ["k"], "v", "m", accuracy=1000).collect()}
    for k, xs in {k: sorted(v for kk, v in rows if kk == k) for k in "ab"}.items():
        pos = sum(1 for x in xs if x <= approx[k])
        assert abs(pos - len(xs) / 2) <= len(xs) / 1000 + 2       # rank error bounded by accuracy
        assert exact[k] == _median(xs)


def test_grouped_median_partitioning_invariant(spark):
    rnd = random.Random(11)
    rows = [(rnd.choice("abc"), rnd.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, v double")
    a = sorted(grouped_median(df.repartition(1), ["k"], "v").collect())
    b = sorted(grouped_median(df.repartition(13), ["k"], "v").collect())
    assert a == b


def test_exact_avg_counts_more_than_six_decimals(spark):
    vals = [0.0000004, 0.12345678949, 0.4875, 0.3, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.repartition(3).select(exact_avg("x").alias("a")).first().a
    assert abs(got - math.fsum(vals[:4]) / 4) < 1e-12
    # what has six decimals gives what whole units give
    units = [random.Random(k).randrange(10**6) for k in range(500)]
    few = spark.createDataFrame([(u / 1e6,) for u in units], "x double")
    assert few.select(exact_avg("x").alias("a")).first().a == sum(units) / 500 / 1e6


def test_an_extreme_value_leaves_the_bracket_small(spark):
    from leadscope.functions.quantiles import bracketed
    n = 100_000
    df = spark.range(n).select((F.col("id") % 2).alias("k"), (F.rand(5) * 10).alias("v"))
    wild = spark.createDataFrame([(0, 1e300), (0, -1e300), (1, float("inf"))], "k bigint, v double")
    got = bracketed(df.unionByName(wild), ["k"], "v").filter("_v IS NOT NULL").groupBy("k").count().collect()
    assert len(got) == 2 and all(r["count"] <= 120 for r in got)      # of 50,000 distinct values
    assert bracketed(df.unionByName(wild), [], "v").filter("_v IS NOT NULL").count() <= 240


def test_medians_with_ties_and_extremes(spark):
    import random
    import statistics
    rng = random.Random(9)
    rows = []
    for k in range(40):
        values = [rng.choice([rng.gauss(0, 1), 0.5, -1e200, 1e200, rng.randint(0, 3) * 1.0]) for _ in range(rng.choice([1, 2, 3, 10, 999, 1000]))]
        rows += [(k, v) for v in values] + [(k, None)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = {r.k: r.m for r in grouped_median(df, ["k"], "v", "m").collect()}
    for k in range(40):
        values = sorted(v for g, v in rows if g == k and v is not None)
        lo, hi = statistics.median_low(values), statistics.median_high(values)
        assert got[k] == lo + (hi - lo) * 0.5
