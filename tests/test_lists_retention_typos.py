"""Lists in pieces, retention by day, hourly pattern, domain typos with a hot domain."""
import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from leadscope.functions.chunks import ordered_chunks
from leadscope.operators import rules as ru
from leadscope.plans import retention as rt


def test_chunks_are_the_whole_list_in_bounded_pieces(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else rng.choice(["a", "b", None]), f"k{i:05d}", None if rng.random() < 0.1 else f"v{i}") for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k string, v string").repartition(7)
    got = ordered_chunks(df, ["g"], ["k"], "v", "list", 64, ",").collect()
    for g in {r[0] for r in rows}:
        whole = [v for _, v in sorted((k, v) for h, k, v in rows if h == g and v is not None)]
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.chunk)
        assert [r.chunk for r in mine] == list(range(-(-len(whole) // 64)))
        assert [r.n for r in mine] == [64] * (len(whole) // 64) + ([len(whole) % 64] if len(whole) % 64 else [])
        assert ",".join(r.list for r in mine) == ",".join(whole)


def test_chunks_of_ties_and_of_nothing(spark):
    ties = spark.createDataFrame([("g", "k", v) for v in "cab" * 3], "g string, k string, v string").repartition(5)
    got = sorted(ordered_chunks(ties, ["g"], ["k"], "v", "list", 4, "").collect(), key=lambda r: r.chunk)
    assert [r.list for r in got] == ["aaab", "bbcc", "c"]
    assert ordered_chunks(ties.filter("v IS NULL"), ["g"], ["k"], "v", "list").count() == 0


def test_no_task_sees_a_whole_hot_group(spark):
    """The windows and the aggregate are keyed by range or by chunk besides the group."""
    df = spark.range(100).select(F.lit("g").alias("g"), "id", F.col("id").cast("string").alias("v"))
    plan = ordered_chunks(df, ["g"], ["id"], "v", "list", 10)._jdf.queryExecution().executedPlan().toString()
    rows = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert rows and all("_range" in line for line in rows) and "Cartesian" not in plan


def test_retention_by_rows_and_by_days(spark, tmp_path):
    days = ["2001-04-01 10:00:00", "2001-05-02 23:59:59", "2001-05-03 00:00:00", "2001-07-31 12:00:00", None]
    df = spark.createDataFrame(list(enumerate(days)), "id int, t string").select("id", F.col("t").cast("timestamp_ntz").alias("last_modified_date"))
    assert {r.id for r in rt.retained(df, "2001-08-01").collect()} == {2, 3, 4}
    path = str(tmp_path / "tasks")
    rt.write_by_day(df, path)
    kept = rt.read_retained(spark, path, "2001-08-01")
    assert {r.id for r in kept.collect()} == {2, 3, 4} and kept.columns == df.columns
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(day" in plan and "PushedFilters: []" in plan      # days are pruned, no row is read for it
    before = {d: sorted(os.listdir(os.path.join(path, d))) for d in os.listdir(path) if d.startswith("day=")}
    rt.write_by_day(df.filter("id = 3"), path)                                           # replaces its day alone
    after = {d: sorted(os.listdir(os.path.join(path, d))) for d in os.listdir(path) if d.startswith("day=")}
    assert [d for d in before if before[d] != after[d]] == ["day=2001-07-31"]
    assert rt.expire(spark, path, "2001-08-01") == ["2001-04-01", "2001-05-02"] and rt.expire(spark, path, "2001-08-01") == []
    assert {r.id for r in spark.read.parquet(path).collect()} == {2, 3, 4}


def test_completeness_flag_of_null(spark):
    df = spark.createDataFrame([("a", 0.7), ("b", 0.69), ("c", None)], "Id string, completeness_score double")
    assert {r.lead_id: r.meets_minimum for r in rt.completeness_flags(df).collect()} == {"a": True, "b": False, "c": False}


@pytest.fixture(scope="module")
def many_domains(spark):
    rng = random.Random(5)
    names = ["gmail.com", "gmial.com", "gmaill.com", "yaho.com", "hotmial.com", "outlok.com", "g.co", "", "x" * 300 + ".com"]
    names += ["".join(rng.choice("abcdegilmnouy") for _ in range(rng.randint(1, 14))) + rng.choice([".com", ".org", ".co"]) for _ in range(3000)]
    rows = [(str(i), f"u{i}@gmail.com") for i in range(3000)] + [(f"d{i}", f"u@{n}") for i, n in enumerate(names, 2999)] + [("n", None), ("o", "none")]
    return spark.createDataFrame(rows, "Id string, Email string"), names


def test_domain_typos_of_thousands_of_domains(spark, many_domains):
    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row
            row = [0]
            for j, y in enumerate(b):
                row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
        return row[-1]

    leads, names = many_domains
    want = {n: next((c for c in ru.COMMON_DOMAINS if 60 <= round(200 * common(n, c) / (len(n) + len(c))) < 90), None) for n in names}
    got = {r._domain: r._typo for r in ru.domain_typos(leads).collect()}
    assert got == want and sum(v is not None for v in want.values()) > 20


def test_hot_domain_is_not_shuffled(spark, many_domains):
    leads, _ = many_domains
    for most in (ru.TYPO_ROWS, 0):
        df = ru._with_typos(leads, most)
        assert df.count() == leads.count()
        by = {r.Id: r._typo for r in df.collect()}
        assert by["0"] == "hotmail.com" and by["n"] is None and by["o"] is None and by["d3000"] == "gmail.com"   # alike common domains count
    plan = ru._with_typos(leads)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_lead_dates_pass_through(spark):
    names = ["Id", "FirstName", "LastName", "Email", "Phone", "Company", "Status", "LeadSource", "CreatedDate"]
    row = ("1", "Ann", "Lee", "a@b.com", "2125551234", "Acme", "converted", "Web", "2024-01-02 03:04:05")
    out = ru.validation_results(spark.createDataFrame([row], names), "2024-01-31").first()
    assert out.created_date == datetime.datetime(2024, 1, 2, 3, 4, 5) and out.converted_date is None and out.is_converted
