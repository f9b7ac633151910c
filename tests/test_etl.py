import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from leadscope.plans import etl
from leadscope.sources import fixtures as fx
from leadscope.sources import render
from leadscope.streaming import stream as st


def test_two_runs_keep_first_parse_time(spark, tmp_path):
    root, land1, land2 = str(tmp_path / "tables"), str(tmp_path / "l1"), str(tmp_path / "l2")
    pv = fx.pv(spark, SF_SMALL)
    tasks = render.render_tasks(pv)
    st.land_tasks_json(tasks, land1, files=2)
    c1 = etl.run_etl(spark, land1, root, 1, "2001-08-01", force_refresh=True).collect()[0]
    assert c1.validations_parsed == pv.count()
    # second run: a subset re-landed with a different description
    changed = tasks.filter(F.col("Id").endswith("1")).withColumn(
        "Description", F.regexp_replace("Description", "Lead Score: ", "Lead Score: 1"))
    st.land_tasks_json(changed, land2, files=1)
    etl.run_etl(spark, land2, root, 2, "2001-08-02", force_refresh=True)
    parsed = spark.read.parquet(st.latest_snapshot(spark, f"{root}/{etl.PARSED_TABLE}"))
    assert parsed.count() == pv.count()
    upd = parsed.filter(F.col("task_id").endswith("1"))
    assert upd.filter(F.col("parsed_at") != F.lit("2001-08-01").cast("timestamp_ntz")).count() == 0
    assert upd.filter(F.col("lead_score") >= 10).count() > 0
    # the same run again gives the same table; a run id that is older than what is stored is refused
    etl.run_etl(spark, land2, root, 2, "2001-08-02", force_refresh=True)
    assert spark.read.parquet(st.latest_snapshot(spark, f"{root}/{etl.PARSED_TABLE}")).count() == pv.count()
    with pytest.raises(ValueError):
        etl.run_etl(spark, land2, root, 1, "2001-08-02", force_refresh=True)
    # validation-only re-parse of the stored tasks table, with a CSV backup of the result
    backup = str(tmp_path / "backup")
    c3 = etl.run_etl(spark, land2, root, 3, "2001-08-03", validation_only=True, backup=backup).collect()[0]
    assert c3.validations_parsed == pv.count()
    csv = spark.read.option("header", True).option("multiLine", True).csv(backup)   # descriptions span lines
    assert csv.count() == pv.count() and "task_id" in csv.columns and "parsed_at" in csv.columns


def test_register_views(spark):
    pv = fx.pv(spark, SF_SMALL)
    vr = fx.vr(spark, SF_SMALL)
    names = etl.register_views(spark, pv, vr, "2001-08-01")
    assert "lead_validation_overview" in names and "simplified_trends_by_source" in names
    n = spark.sql("SELECT COUNT(*) AS n FROM lead_source_quality_summary WHERE total_leads > 0").collect()[0].n
    assert n == pv.filter("parse_error IS NULL").select(F.coalesce("lead_source", F.lit("Unknown"))).distinct().count()
