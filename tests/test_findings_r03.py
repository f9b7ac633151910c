"""Tests of the findings of round 3."""

import pytest

from leadscope.operators import rules as ru


def test_typos_are_sought_per_domain_not_per_lead(spark, monkeypatch):
    """F2..F9, F12..F15: no filter with the fuzzy ratio below the distinct over domains."""
    leads = spark.createDataFrame([(str(i), f"u{i}@gmial.com") for i in range(20)] + [("a", "x@corp.com"), ("b", None)], "Id string, Email string")
    plans = []
    stored = ru.checkpointed

    def spy(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df)

    monkeypatch.setattr(ru, "checkpointed", spy)
    rows = {r["Id"]: r["_typo"] for r in ru._with_typos(leads).collect()}
    assert rows["0"] == rows["19"] == "gmail.com" and rows["a"] is None and rows["b"] is None
    (plan,) = plans
    below = plan[plan.rindex("Aggregate ["):].split("\n", 1)[1]
    assert "lambda" not in below and "lambda" in plan


def test_leads_of_one_partition_are_checked_by_several_tasks(spark):
    """F3..F8, F13, F14: all checks of all leads ran in the one task that had read them."""
    from pyspark.sql import functions as F
    names = ["Id", "FirstName", "LastName", "Email", "Phone", "Company", "Status", "Title", "Industry", "LeadSource", "City", "State", "Country"]
    rows = [(f"L{i % 70}" if i % 9 else None, "Ann", "Lee", f"u{i}@gmial.com" if i % 2 else None, "2125550100", *["x y"] * 8) for i in range(100)]
    leads = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ru.validate_leads(leads).select("Id", "email_score", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.task for r in got}) > 1
    assert sorted((r.Id or "", r.email_score) for r in got) == sorted((x[0] or "", 0.8 if x[3] else 0.0) for x in rows)


SCHEMA = "task_id string, v int, parsed_at timestamp_ntz"


def _table(spark, path, **more):
    from leadscope.sources.keyed import KeyedTable
    return KeyedTable(spark, str(path), spark.createDataFrame([], SCHEMA).schema, ignored=("parsed_at",), **more)


def _rows(spark, values):
    return spark.createDataFrame([(f"k{i}", v, None) for i, v in values], SCHEMA)


def test_landed_pages_are_compressed_and_small(spark, tmp_path, monkeypatch):
    """F1, F10, F11, F16, F18: pages took as much disk as their text; a compressed page is one task's, so pages are cut."""
    from leadscope.streaming import stream as st
    monkeypatch.setattr(st, "PAGE_RECORDS", 40)
    text = "same text " * 100
    tasks = spark.range(100).selectExpr("cast(id as string) Id", "'w' WhoId", "'x' WhatId", "'Lead Validation' Subject", f"'{text}' Description", "timestamp_ntz'2001-01-01' CreatedDate",
                                        "timestamp_ntz'2001-01-01' LastModifiedDate", "'s' LeadSource", "'c' Company", "'e' Email")
    st.land_tasks_json(tasks, str(tmp_path / "landing"), files=1)
    pages = [f for f in (tmp_path / "landing").iterdir() if f.name.endswith(".json.gz")]
    assert len(pages) == 3 and sum(f.stat().st_size for f in pages) < 100 * len(text) / 10
    read = spark.read.json(str(tmp_path / "landing"))
    assert read.count() == 100 and read.filter(read.Description == text).count() == 100


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    """a bucket was sorted and written by one task, however large."""
    from leadscope.sources import keyed
    monkeypatch.setattr(keyed, "PIECE_ROWS", 10)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = _table(spark, tmp_path / "t", buckets=1)
        assert table.upsert(_rows(spark, [(i, 1) for i in range(100)]), 0, keep_old=("parsed_at",)) == [0]
        assert len([f for f in (tmp_path / "t/rows/bucket=0").iterdir() if f.name.endswith(".parquet")]) > 1
        table.upsert(_rows(spark, [(i, 2) for i in range(90, 120)]), 1, keep_old=("parsed_at",))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((r.task_id, r.v) for r in table.read().collect()) == sorted((f"k{i}", 1 if i < 90 else 2) for i in range(120))


def test_buckets_are_put_in_place_once_more_after_a_loss(spark, tmp_path):
    """A driver lost while buckets are renamed: the rest follows, those in place stay."""
    table = _table(spark, tmp_path / "t", buckets=4)
    table.upsert(_rows(spark, [(i, 1) for i in range(50)]), 0)
    put, table._put_in_place = table._put_in_place, lambda: None
    table.upsert(_rows(spark, [(i, 2) for i in range(50)]), 1)
    table._put_in_place = put
    staged = f"{table.staged}/batch=000000000001"
    one = sorted(n for n in table._names(staged) if n.startswith("bucket="))[0]
    table.fs.delete(table._path(f"{table.rows}/{one}"), True)
    table.fs.rename(table._path(f"{staged}/{one}"), table._path(f"{table.rows}/{one}"))
    assert table.read().filter("v = 2").count() == 50 and table.read().count() == 50 and table._names(table.staged) == []


def test_a_monitor_batch_is_read_once_and_not_persisted(spark, tmp_path):
    """F10, F16, F18: the parsed batch was kept whole, all its columns, for a second reading."""
    from pyspark.sql import functions as F

    from leadscope.streaming import stream as st
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def one(_):
        seen.add(1)
        return 1

    new = spark.createDataFrame([(f"t{i}",) for i in range(6)], "task_id string").select(
        "task_id", F.lit("2001-01-01").cast("timestamp_ntz").alias("day"), F.lit("x").alias("lead_source"), one("task_id").alias("total_leads"),
        F.lit(0).cast("bigint").alias("fake_leads_count"), F.lit(0).cast("bigint").alias("critical_fraud_count"))
    path = str(tmp_path / "m")
    st.merge_monitor(spark, st.monitor_table(spark, path, buckets=4), new, path, 0)
    assert [r.total_leads for r in spark.read.parquet(st.latest_snapshot(spark, path)).collect()] == [6]
    assert seen.value == 6


def test_written_tables_leave_no_shuffle_files(spark):
    """op13: shuffles of orders already counted lay on disk beside that of the next one, until the driver's memory was cleaned."""
    import os
    import time

    from leadscope.llm.common import SHUFFLES_GO, Tables
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files():
        return {x for d in folders for _, _, names in os.walk(d) for x in names if x.startswith("shuffle_")}

    before, tables = files(), Tables(spark, "test")
    rows = spark.range(1000).selectExpr("id", "id % 7 AS k").repartition(3, "k")
    kept = tables.keep(rows, "a"), tables.keep_by(rows, "b", "k")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(SHUFFLES_GO, None) is None
    assert [sorted(map(tuple, t.collect())) for t in kept] == [sorted((i, i % 7) for i in range(1000))] * 2
    tables.drop("a", "b")


def test_rows_of_pairs_end_alike():
    """op13: a row's number lay between bytes that repeat from row to row, which cut them in two for the shuffle's compression."""
    import numpy as np
    import pyarrow as pa

    from leadscope.llm import collocations as c
    rng = np.random.default_rng(3)
    ids = rng.choice(1 << 18, 2000, replace=False).astype(np.int64) | rng.integers(0, 50, 2000) << 33
    at = (rng.zipf(1.3, 60_000) % 2001 - 1).astype(np.int32)
    state = pa.record_batch([pa.array([7 << 32]), pa.array([c._packed(at)], pa.binary()), pa.array([ids], pa.list_(pa.int64()))], names=["block", "places", "ids"])
    (got,) = c._counted_pairs([state])
    tally = got["tally"].to_numpy()
    numbers, counts = tally & 0xFFFFFFFF, tally >> 32
    assert counts.sum() == ((at[:-1] >= 0) & (at[1:] >= 0)).sum() and (numbers == np.arange(len(tally))).all()

    def size(columns):
        rows = np.column_stack([np.full(len(tally), 40 << 24), np.zeros(len(tally), dtype=np.int64), *columns])
        return len(pa.compress(rows.tobytes(), codec="lz4", asbytes=True))

    before = size([got["pre"], got["suf"], got["block"], numbers << 32 | counts])
    assert size([x.to_numpy() for x in got.columns]) < 0.95 * before


def test_texts_go_to_workers_in_batches_of_few_bytes(spark):
    """pipeline: 10,000 whole texts made a batch, which JVM and worker held in several copies beside all else."""
    import numpy as np
    from pyspark.sql import functions as F

    from leadscope.llm import bpe, decontam, ngram_join, quality
    from leadscope.llm.common import BATCH_BYTES, BATCHES
    from leadscope.llm.queries import WORD_BPE, vocabulary

    class Bytes:
        """A model that says how many bytes of text it was given at once."""

        def probability(self, texts):
            return np.full(len(texts), float(sum(len(t) for t in texts if t)))

    long = 50_000
    docs = spark.range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 50 > 0, F.repeat(F.lit("a b c d "), long // 8)).alias("text"))
    benchmark = spark.createDataFrame([("i", "a b")], "item_id string, text string")
    own = spark.conf.get(BATCHES, None)
    try:
        spark.conf.unset(BATCHES)
        rows = quality.scored(docs, Bytes()).collect()
        assert sorted(r.doc_id for r in rows) == list(range(300))
        assert long < max(r.score for r in rows) <= BATCH_BYTES + 2 * long
        for stage in (lambda: quality.accepted(docs, Bytes()), lambda: decontam.judged(docs, benchmark), lambda: bpe.digests(docs, vocabulary(WORD_BPE)),
                      lambda: ngram_join.joined(docs.limit(3))):
            spark.conf.unset(BATCHES)
            stage()
            assert int(spark.conf.get(BATCHES)) == BATCH_BYTES
            spark.conf.set(BATCHES, "12345678")
            quality.accepted(docs, Bytes())
            assert spark.conf.get(BATCHES) == "12345678"
    finally:
        spark.conf.unset(BATCHES) if own is None else spark.conf.set(BATCHES, own)
