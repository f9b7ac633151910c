"""Ladder edges: rows built to land exactly on thresholds."""
import datetime as dt

from pyspark.sql import types as T

from leadscope.plans import reports_pv as rp
from leadscope.sources.fixtures import PV_COLUMNS

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
          "timestamp": T.TimestampNTZType()}
SCHEMA = T.StructType([T.StructField(c, _TYPES[t]) for c, _, t in PV_COLUMNS])
DAY = dt.datetime(2001, 8, 1, 10)


def _rows(source, n, fake, quality=7, fraud=0, start=0):
    out = []
    for i in range(n):
        r = dict.fromkeys(SCHEMA.names)
        r.update(task_id=f"{source}-{start + i:04d}", lead_source=source, api_quality_score=quality,
                 api_fraud_score=fraud, api_fake_lead=i < fake, created_date=DAY, parsed_at=DAY,
                 api_first_name="F", api_last_name="L")
        out.append(tuple(r[c] for c in SCHEMA.names))
    return out


def test_daily_risk_ladder_edges(spark):
    rows = (_rows("p50", 10, 5) + _rows("p20", 10, 2) + _rows("p10", 10, 1) + _rows("p5", 20, 1)
            + _rows("p0", 10, 0) + _rows("p25", 4, 1) + _rows("crit", 4, 1, fraud=8))
    pv = spark.createDataFrame(rows, SCHEMA)
    got = {r.lead_source: r for r in rp.daily_fake_leads_by_source(pv, "2001-08-01", ordered=False).collect()}
    assert got["p50"].daily_risk_level == "CRITICAL" and got["p50"].recommended_action.startswith("PAUSE")
    assert got["p20"].daily_risk_level == "HIGH"
    assert got["p10"].daily_risk_level == "MEDIUM"
    assert got["p5"].daily_risk_level == "LOW" and got["p5"].fake_leads_percentage == 5.0
    assert got["p0"].daily_risk_level == "CLEAN" and got["p0"].fake_leads_list is None
    assert got["p25"].alert_percentage and not got["p25"].alert_critical_fraud
    assert got["crit"].alert_critical_fraud and got["crit"].daily_status.endswith("IMMEDIATE ACTION REQUIRED")
    assert got["p50"].fake_leads_list.split("; ")[0] == "F L (p50-0000)"       # ordered by task_id


def test_grade_and_risk_edges(spark):
    # 20 leads each; fake share exactly 5 % / 10 % / 35 %, averages exactly on 8.5 / 7.5 / 4.0
    rows = (_rows("aplus", 20, 1, quality=9)[:10] + _rows("aplus", 20, 0, quality=8, start=10)[:10]  # avg 8.5, 5 %
            + _rows("a", 20, 2, quality=8)[:10] + _rows("a", 20, 0, quality=7, start=10)[:10]       # avg 7.5, 10 %
            + _rows("d", 20, 7, quality=4))                                                        # avg 4.0, 35 %
    pv = spark.createDataFrame(rows, SCHEMA)
    got = {r.lead_source: r for r in rp.source_quality_summary(pv, ordered=False).collect()}
    assert got["aplus"].avg_quality_score == 8.5 and got["aplus"].fake_leads_percentage == 5.0
    assert got["aplus"].quality_grade == "A+" and got["aplus"].risk_level == "LOW_RISK"
    assert got["a"].quality_grade == "A" and got["a"].risk_level == "LOW_RISK"
    assert got["d"].quality_grade == "D" and got["d"].risk_level == "HIGH_RISK"    # fake 35 % > 25 %
    assert got["aplus"].excellent_count == 10 and got["aplus"].good_count == 10


def test_null_quality_counts_in_no_band(spark):
    rows = _rows("s", 3, 0, quality=None)
    pv = spark.createDataFrame(rows, SCHEMA)
    r = rp.source_quality_summary(pv, ordered=False).collect()[0]
    assert r.total_leads == 3 and r.avg_quality_score is None
    assert r.excellent_count + r.good_count + r.fair_count + r.poor_count + r.invalid_count == 0
    assert r.quality_grade == "F" and r.risk_level == "LOW_RISK"       # NULL comparisons never fire
