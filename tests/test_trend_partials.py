"""Daily partials of the trend reports: one scan, no multiplied rows, exact averages and medians after merging."""
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from leadscope.functions.exprs import exact_avg, fixed_avg, fixed_sums
from leadscope.functions.quantiles import weighted_median
from leadscope.plans import reports_vr as rv
from leadscope.sources import fixtures as fx
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def vr(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("partials"))
    fx.vr(spark, SF_SMALL).write.parquet(f"{d}/vr")
    return spark.read.parquet(f"{d}/vr")


REPORTS = {
    "vw10": lambda vr: rv.validation_metrics(rv.validation_summary(vr, fx.VR_AS_OF)),
    "vw11": lambda vr: rv.validation_by_source(rv.validation_summary(vr, fx.VR_AS_OF), fx.VR_AS_OF),
    "vw12": rv.validation_trends,
    "vw13": lambda vr: rv.simplified_trends_overall(vr, fx.VR_AS_OF),
    "vw14": lambda vr: rv.simplified_trends_by_source(vr, fx.VR_AS_OF),
}


@pytest.mark.parametrize("key", REPORTS)
def test_report_runs_one_scan_and_multiplies_no_raw_rows(vr, key):
    df = REPORTS[key](vr)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall("FileScan", final)) == 1, final      # all other branches reuse the partials' shuffle
    assert "Expand" not in final
    for line, below in zip(final.split("\n"), final.split("\n")[1:]):
        assert not ("Generate" in line and "FileScan" in below)


def test_weighted_median_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 3000)), rnd.randint(1, 9)) for _ in range(4000)]
    rows += [("few", 1.5, 3), ("few", 2.5, 3), ("one", -4.0, 1), ("none", None, 5), ("zero", 8.0, 0), ("huge", 1e300, 1), ("huge", 0.0, 2)]
    df = spark.createDataFrame(rows, "k string, v double, w long").repartition(7)
    want: dict[str, list[float]] = {}
    for k, v, w in rows:
        if v is not None and w:
            want.setdefault(k, []).extend([v] * w)
    for buckets in (2, 16, 128):
        got = {r.k: r.m for r in weighted_median(df, ["k"], "v", "w", "m", buckets=buckets).collect()}
        assert got == {k: statistics.median(v) for k, v in want.items()}
    everything = statistics.median([x for v in want.values() for x in v])
    assert [r.m for r in weighted_median(df, [], "v", "w", "m").collect()] == [everything]
    assert weighted_median(df.limit(0), ["k"], "v", "w").collect() == []
    assert weighted_median(df.limit(0), [], "v", "w").collect() == []


def test_partial_sums_merge_to_the_exact_average(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 11 != 0, F.rand(3)).alias("x"))
    df = df.withColumn("x", F.round("x", 9)).repartition(5)
    parts = df.groupBy("k").agg(*[c.alias(n) for c, n in zip(fixed_sums("x"), "urn")])
    merged = parts.agg(fixed_avg(F.sum("u"), F.sum("r"), F.sum("n")).alias("a")).first().a
    assert merged == df.select(exact_avg("x").alias("a")).first().a
    assert parts.limit(0).agg(fixed_avg(F.sum("u"), F.sum("r"), F.sum("n")).alias("a")).first().a is None


def test_empty_results_table(vr):
    empty = vr.limit(0)
    m = REPORTS["vw10"](empty).first()
    assert m.total_leads == 0 and m.excellent_count == 0 and m.median_overall_score is None and m.avg_overall_score is None
    assert all(REPORTS[k](empty).count() == 0 for k in ("vw11", "vw12", "vw13", "vw14"))
