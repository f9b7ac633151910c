"""Report lists on small fixtures, and the scans of the dashboard's combined datasets."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from leadscope.plans import datasets as ds
from leadscope.plans import loaders as ld
from leadscope.plans import report_lists as rl
from leadscope.plans import reports_pv as rp
from leadscope.sources import fixtures as fx

LEAD = ("lead_id string, overall_score double, validation_status string, first_name string, last_name string, company string, "
        "email string, lead_source string, validation_timestamp timestamp_ntz")


def _leads(spark):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([
        ("c", 3.0, "Poor", "Ann", None, "", None, None, t), ("a", 3.0, "Poor", None, "Bo", "Co", "x@y.z", "", t),
        ("b", 3.0, "Poor", None, None, None, "", "Web", t + dt.timedelta(1)), ("d", 1.0, "Invalid", "D", "E", "F", "g", "H", None)], LEAD)


def test_leads_are_listed_worst_first_with_texts_for_what_is_missing(spark):
    got = [tuple(r) for r in rl.worst_leads(_leads(spark)).collect()]
    assert got == [("d", 1.0, "D E", "F", "g", "H"), ("b", 3.0, " ", "N/A", "N/A", "Web"),
                   ("a", 3.0, " Bo", "Co", "x@y.z", "Unknown"), ("c", 3.0, "Ann ", "N/A", "N/A", "Unknown")]
    assert [r.lead_id for r in rl.review_list(_leads(spark), n=2).collect()] == ["d", "b"]
    assert rl.worst_leads(_leads(spark).limit(0)).collect() == []


def test_last_means_take_sources_without_a_mean_first(spark):
    means = spark.createDataFrame([("a", 5.0), ("b", None), ("c", 4.0), ("d", 4.0), ("e", 9.0)], "lead_source string, avg_quality double")
    assert [r.lead_source for r in rl.last_means(means).collect()] == ["b", "d", "c"]
    assert [r.lead_source for r in rl.last_means(means.filter("avg_quality > 4")).collect()] == ["a", "e"]


def test_combined_datasets_scan_once(spark, tmp_path):
    fx.pv(spark, SF_SMALL).write.parquet(f"{tmp_path}/pv")
    pv = spark.read.parquet(f"{tmp_path}/pv")
    months = ld.source_month_performance(pv)
    series = ds.top_source_series(months)
    frames = {"dd08": (series, 1), "dd09": (ds.latest_month_slice(series), 1),
              "dd10": (ds.month_over_month(ld.creation_month_analysis(pv), months), 2),   # two groupings
              "dd15": (ds.source_overview(rp.source_quality_summary(pv, ordered=False)), 1)}
    for key, (df, scans) in frames.items():
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert final.count("FileScan") == scans, (key, final.count("FileScan"))
