import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from leadscope.plans import datasets as ds
from leadscope.plans import loaders as ld


def test_factor_parser(spark):
    rows = [("Known fake lead from database, ML fraud model: HIGH RISK score: 87",),
            ("Email not deliverable, Invalid phone",),
            ("Valid email format, Valid phone number, ZIP/state consistent, Data completeness (5/7)",),
            ("Email deliverable, Valid state, Valid postal code",),
            ("No specific factors",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    f = ds.parse_factors(F.col("t"))
    got = df.select(*[f[k].alias(k) for k in ds.FACTOR_COLUMNS]).collect()
    assert got[0]["Known Fake Lead"] == "TRUE" and got[0]["ML Fraud Score"] == "87" and got[0]["ML Risk Level"] == "HIGH"
    assert got[1]["Email Deliverable"] == "NO" and got[1]["Phone Valid"] == "NO"
    assert got[2]["Email Format Valid"] == "YES" and got[2]["Data Completeness"] == "5/7"
    assert got[2]["ZIP State Consistent"] == "YES" and got[2]["Phone Valid"] == "YES"
    assert got[3]["Email Deliverable"] == "YES" and got[3]["State Valid"] == "YES" and got[3]["Postal Code Valid"] == "YES"
    assert all(v is None for v in got[4].asDict().values()) and all(v is None for v in got[5].asDict().values())


def test_period_filters(spark):
    ts = [dt.datetime(2001, 8, 1), dt.datetime(2001, 7, 31, 23), dt.datetime(2001, 7, 1), dt.datetime(2001, 6, 30),
          dt.datetime(2001, 7, 20), None]
    df = spark.createDataFrame([(t,) for t in ts], "created_date timestamp_ntz")
    n = {p: ld.period_filter(df, p, "2001-08-01").count() for p in ld.PERIODS}
    assert n == {"All Time": 5, "Last 30 Days": 3, "Last 7 Days": 2, "This Month": 1, "Last Month": 3}
    r = ld.date_range_filter(df, "2001-07-01", "2001-07-31").count()
    assert r == 3


def test_histogram_top_edge_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.49,), (0.5,), (9.99,), (10.0,), (None,)], "overall_score double")
    got = {r.bin: r.leads for r in ds.score_histogram(df).collect()}
    assert got == {1: 2, 2: 1, 20: 2}


def test_stream_ingest_matches_batch_parse(spark, tmp_path):
    from leadscope.operators.parse import parse_descriptions
    from leadscope.sources import fixtures as fx
    from leadscope.sources import render
    from leadscope.streaming import stream as st
    tasks = render.render_tasks(fx.pv(spark, SF_SMALL))
    base = str(tmp_path)
    st.land_tasks_json(tasks, f"{base}/landing", files=2)
    q = st.start_task_ingest(spark, f"{base}/landing", f"{base}/table", f"{base}/ckpt", now="2001-08-01",
                             available_now=True, max_files=1)
    q.awaitTermination()
    out = spark.read.parquet(st.latest_snapshot(spark, f"{base}/table"))
    batch = parse_descriptions(tasks)
    cols = ["task_id", "lead_score", "api_quality_score", "api_fraud_factors", "parse_error", "created_date"]
    assert sorted(out.select(*cols).collect()) == sorted(batch.select(*cols).collect())
    assert out.filter(F.col("parsed_at").isNull()).count() == 0


def test_monitor_counts_late_repeated_and_moved_tasks_once(spark, tmp_path):
    from leadscope.sources import fixtures as fx
    from leadscope.sources import render
    from leadscope.streaming import stream as st
    tasks = render.render_tasks(fx.pv(spark, SF_SMALL))
    newer = F.col("CreatedDate") >= F.lit("2001-07-15").cast("timestamp_ntz")
    moved = tasks.filter(newer).withColumn("LeadSource", F.lit("Moved"))
    base = str(tmp_path)
    for k, part in enumerate((tasks.filter(newer), tasks.filter(~newer), moved)):
        st.land_tasks_json(part, f"{base}/landing/page={k}", files=2)
        st.start_daily_monitor(spark, f"{base}/landing/*", f"{base}/monitor", f"{base}/ckpt", available_now=True,
                               max_files=1).awaitTermination()
    assert len(st.snapshots(spark, f"{base}/monitor")) == 6
    got = spark.read.parquet(st.latest_snapshot(spark, f"{base}/monitor"))
    final = tasks.withColumn("LeadSource", F.when(newer, "Moved").otherwise(F.col("LeadSource")))
    st.land_tasks_json(final, f"{base}/once/page=0")
    st.start_daily_monitor(spark, f"{base}/once/*", f"{base}/monitor1", f"{base}/ckpt1", available_now=True).awaitTermination()
    want = spark.read.parquet(st.latest_snapshot(spark, f"{base}/monitor1"))
    assert sorted(got.collect()) == sorted(want.collect()) and want.count() > 0


def test_a_batch_reads_smaller_ids_only(spark, tmp_path):
    from leadscope.streaming import stream as st
    table = str(tmp_path / "t")
    for i in (0, 1):
        spark.range(i + 1).write.parquet(f"{table}/batch={i:012d}")
    assert st.latest_snapshot(spark, table, before=0) is None
    assert st.latest_snapshot(spark, table, before=1).endswith("batch=000000000000")
    assert st.latest_snapshot(spark, table).endswith("batch=000000000001")
