from pyspark.sql import functions as F

from leadscope.operators.parse import parse_counters, parse_descriptions
from leadscope.sources import sinks

TASK_SCHEMA = "Id string, WhoId string, Subject string, Description string, LastModifiedDate string"

GOOD = """=== LEAD VALIDATION RESULTS ===
Lead Score: 8
Quality Score: 7
Data Quality: 85%
Fraud Score: 3
Recommendation: accept
Market Segment: Small Business Lending
=== PHONE VALIDATION ===
Phone Valid: true
Carrier: null
Type: mobile
National Format: (212) 555-0100
=== EMAIL VALIDATION ===
Email Valid: TRUE
Gibberish Score: 0.1
=== EMAIL SUMMARY ===
Total Emails: 2
Email Quality Score: 6
=== RAW API RESPONSE ===
junk before {"leadScore": 8.5, "qualityScore": "7", "isFakeLead": true, "phone": 2125550100,
 "qualityFactors": ["Valid email format", "Valid phone number"], "emailSummary": {"totalEmails": 3}} junk after"""


def _parse(spark, rows):
    df = spark.createDataFrame([(f"T{i}", "L1", "Lead Validation", d, None) for i, d in enumerate(rows)],
                               TASK_SCHEMA)
    return {r.task_id: r for r in parse_descriptions(df).collect()}


def test_full_description(spark):
    r = _parse(spark, [GOOD])["T0"]
    assert (r.lead_score, r.quality_score, r.data_quality, r.fraud_score) == (8, 7, 85, 3)
    assert r.recommendation == "accept" and r.market_segment == "Small Business Lending"
    assert r.phone_valid is True and r.phone_carrier is None and r.phone_type == "mobile"
    assert r.email_valid is True and r.gibberish_score == "0.1" and r.email_sendable is None
    assert r.total_emails == 2 and r.email_quality_score == 6 and r.valid_emails is None
    assert r.api_lead_score == 8 and r.api_quality_score == 7     # 8.5 rounds half-even; "7" converts
    assert r.api_fake_lead is True and r.api_phone == "2125550100"
    assert r.api_quality_factors == "Valid email format, Valid phone number"
    assert r.api_total_emails == 3 and r.parse_error is None
    assert r.raw_api_response.startswith("{") and r.raw_api_response.endswith("}")


def test_edge_rows(spark):
    rows = [
        None, "",                                                   # empty -> nothing parsed
        "=== EMAIL SUMMARY ===\r\nTotal Emails: 4\r\n=== LEAD VALIDATION RESULTS ===\r\nLead Score: 5\r\n",
        "=== RAW API RESPONSE ===\n{not json}",                    # bad JSON is not a parse error
        '=== RAW API RESPONSE ===\n{"fraudFactors": null}',
        '=== RAW API RESPONSE ===\n{"emailSummary": null, "leadScore": 3}',
        '=== RAW API RESPONSE ===\n{"summaryNotes": ["a", null]}',
        '=== RAW API RESPONSE ===\n{"marketSegment": "x === y"}',   # '=== ' inside JSON cuts the section
    ]
    r = _parse(spark, rows)
    assert r["T0"].raw_description is None and r["T0"].parse_error is None and r["T0"].raw_api_response == "{}"
    assert r["T1"].lead_score is None
    assert r["T2"].total_emails == 4 and r["T2"].lead_score == 5       # reordered sections, CRLF
    assert r["T3"].parse_error is None and "json_parse_error" in r["T3"].raw_api_response
    assert r["T4"].parse_error == "can only join an iterable"
    assert r["T5"].parse_error == "'NoneType' object has no attribute 'get'" and r["T5"].api_lead_score is None
    assert r["T6"].parse_error == "sequence item 1: expected str instance, NoneType found"
    assert r["T7"].api_market_segment is None and "json_parse_error" in r["T7"].raw_api_response
    c = parse_counters(parse_descriptions(spark.createDataFrame(
        [(f"T{i}", "L", "S", d, None) for i, d in enumerate(rows + [GOOD])], TASK_SCHEMA))).collect()[0]
    assert c.validations_parsed == 9 and c.parsing_errors == 3 and c.high_quality_leads == 1


def _pv(spark, rows):
    return spark.createDataFrame(rows, "task_id string, api_quality_score int, last_modified_date timestamp_ntz, "
                                       "parsed_at timestamp_ntz")


def test_upsert_semantics(spark):
    import datetime as dt
    t0, t1, t2 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
    old = _pv(spark, [("a", 1, t0, t0), ("b", 2, t0, t0)])
    new = _pv(spark, [("b", 20, t1, t2), ("b", 21, t2, t2), ("c", 3, t1, None), (None, 9, t1, t1), ("", 9, t1, t1)])
    out = {r.task_id: r for r in sinks.upsert_parsed(old, new, now="2024-02-01").collect()}
    assert set(out) == {"a", "b", "c"}
    assert out["b"].api_quality_score == 21 and out["b"].parsed_at == t0     # newest dup wins, parsed_at kept
    assert out["c"].parsed_at == dt.datetime(2024, 2, 1)                       # inserted: default now
    again = sinks.upsert_parsed(sinks.upsert_parsed(old, new, now="2024-02-01"), new, now="2024-02-01")
    assert sorted(again.collect()) == sorted(out.values())                      # idempotent


def test_upsert_keeps_unsupplied_columns(spark):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    old = _pv(spark, [("a", 1, t0, t0)])
    new = spark.createDataFrame([("a", 5)], "task_id string, api_quality_score int")
    r = sinks.upsert(old, new, "task_id", keep_old=("parsed_at",)).collect()[0]
    assert r.api_quality_score == 5 and r.last_modified_date == t0 and r.parsed_at == t0
