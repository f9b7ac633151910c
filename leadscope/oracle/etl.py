"""DuckDB oracle SQL for the ETL operators: parser round trip, counters,
task filters/semi-join, upsert and touch."""

from ..operators.parse import API_FIELDS, LIST_KEYS, SUMMARY_KEYS
from ..sources.fixtures import PV_AS_OF, PV_COLUMNS, with_ctes

META = ["task_id", "who_id", "lead_source", "lead_company", "lead_email", "created_date"]
PARSED = (["lead_score", "quality_score", "data_quality", "fraud_score", "recommendation", "phone_valid",
           "email_valid", "email_sendable", "bounce_likely"]
          + [c for c, _, _ in API_FIELDS] + [c for c, _ in SUMMARY_KEYS] + [c for c, _ in LIST_KEYS])
ROUNDTRIP_COLUMNS = META + PARSED + ["has_parse_error"]

PRS_ROUNDTRIP = with_ctes(
    "SELECT " + ", ".join(META) + ", "
    + ", ".join(f"CASE WHEN parse_error IS NULL THEN {c} END AS {c}" for c in PARSED)
    + ", parse_error IS NOT NULL AS has_parse_error FROM pv", "pv")

PRS_COUNTERS = with_ctes("""
SELECT COUNT(*) AS validations_parsed,
  COUNT(*) FILTER (WHERE parse_error IS NULL AND COALESCE(NULLIF(quality_score, 0), api_quality_score) >= 7)
    AS high_quality_leads,
  COUNT(*) FILTER (WHERE parse_error IS NULL AND COALESCE(NULLIF(quality_score, 0), api_quality_score) < 7)
    AS low_quality_leads,
  COUNT(*) FILTER (WHERE parse_error IS NOT NULL) AS parsing_errors
FROM pv""", "pv")

TASK_COLS = ("task_id AS Id, who_id AS WhoId, 'Lead Validation Results' AS Subject, lead_source AS LeadSource, "
             "lead_company AS Company, lead_email AS Email, created_date AS CreatedDate, "
             "COALESCE(last_modified_date, parsed_at) AS LastModifiedDate")

JON2 = with_ctes(f"SELECT {TASK_COLS} FROM pv WHERE who_id IN (SELECT Id FROM leads WHERE LeadSource IS NOT NULL)",
                 "pv", "leads")

SRC2 = with_ctes(f"SELECT {TASK_COLS} FROM pv "
                 f"WHERE COALESCE(last_modified_date, parsed_at) >= TIMESTAMP '{PV_AS_OF}' - INTERVAL 30 DAY", "pv")

_ALL = [c for c, _, _ in PV_COLUMNS]
_K = "CAST(substr(task_id, 2) AS BIGINT)"
_NEW_SELECT = ", ".join(
    f"CASE WHEN {_K} % 97 = 0 THEN NULL WHEN {_K} % 89 = 0 THEN '' ELSE task_id END AS task_id" if c == "task_id"
    else "api_quality_score + 1 AS api_quality_score" if c == "api_quality_score"
    else f"TIMESTAMP '{PV_AS_OF}' AS parsed_at" if c == "parsed_at" else c for c in _ALL)
SNK2 = with_ctes(f"""
WITH old AS (SELECT * FROM pv WHERE {_K} % 3 <> 0 OR {_K} % 2 <> 0),
new0 AS (SELECT {_NEW_SELECT} FROM pv WHERE {_K} % 2 = 0),
new AS (SELECT * FROM new0 WHERE task_id IS NOT NULL AND task_id <> '')
SELECT * FROM old WHERE task_id NOT IN (SELECT task_id FROM new)
UNION ALL
SELECT {", ".join("COALESCE(o.parsed_at, n.parsed_at) AS parsed_at" if c == "parsed_at" else f"n.{c}" for c in _ALL)}
FROM new n LEFT JOIN old o ON n.task_id = o.task_id
""", "pv")

SNK7 = with_ctes(f"""
WITH top AS (SELECT task_id FROM pv WHERE parse_error IS NULL ORDER BY parsed_at DESC NULLS LAST, task_id LIMIT 1)
SELECT {", ".join(f"CASE WHEN task_id IN (SELECT task_id FROM top) THEN TIMESTAMP '{PV_AS_OF} 12:00:00' ELSE parsed_at END AS parsed_at" if c == "parsed_at" else c for c in _ALL)}
FROM pv""", "pv")

JON1 = with_ctes("""
SELECT task_id AS Id, who_id AS WhoId, 'Lead Validation Results' AS Subject, l.LeadSource, l.Company, l.Email,
  created_date AS CreatedDate, COALESCE(last_modified_date, parsed_at) AS LastModifiedDate
FROM pv LEFT JOIN (SELECT DISTINCT ON (Id) Id, LeadSource, Company, Email FROM leads ORDER BY Id) l ON pv.who_id = l.Id
""", "pv", "leads")

ORACLE = {"jon1_attach_who": JON1, "prs_roundtrip": PRS_ROUNDTRIP, "prs12_counters": PRS_COUNTERS, "jon2_semi": JON2,
          "src2_incremental": SRC2, "snk2_upsert": SNK2, "snk7_touch": SNK7}

STR2 = with_ctes("""
SELECT date_trunc('day', created_date) AS day, COALESCE(lead_source, 'Unknown') AS lead_source,
  COUNT(*) AS total_leads, COUNT(*) FILTER (WHERE COALESCE(api_fake_lead, FALSE)) AS fake_leads_count,
  COUNT(*) FILTER (WHERE COALESCE(api_fraud_score, 0) >= 8) AS critical_fraud_count
FROM pv WHERE parse_error IS NULL GROUP BY 1, 2""", "pv")

STR2_REPORT = with_ctes("""
WITH m AS (
  SELECT date_trunc('day', created_date) AS day, COALESCE(lead_source, 'Unknown') AS lead_source,
    COUNT(*) AS total_leads, COUNT(*) FILTER (WHERE COALESCE(api_fake_lead, FALSE)) AS fake_leads_count,
    COUNT(*) FILTER (WHERE COALESCE(api_fraud_score, 0) >= 8) AS critical_fraud_count
  FROM pv WHERE parse_error IS NULL AND CAST(created_date AS DATE) = DATE '2001-07-15' GROUP BY 1, 2
), p AS (SELECT *, ROUND(CAST(fake_leads_count AS DOUBLE) / total_leads * 100, 2) AS fake_leads_percentage FROM m)
SELECT day, lead_source, total_leads, fake_leads_count, critical_fraud_count, fake_leads_percentage,
  CASE WHEN fake_leads_percentage >= 50 THEN 'CRITICAL' WHEN fake_leads_percentage >= 20 THEN 'HIGH'
       WHEN fake_leads_percentage >= 10 THEN 'MEDIUM' WHEN fake_leads_percentage > 0 THEN 'LOW' ELSE 'CLEAN' END
    AS daily_risk_level,
  RANK() OVER (ORDER BY fake_leads_percentage DESC) AS worst_source_rank,
  fake_leads_count >= 3 AS alert_volume, fake_leads_percentage >= 25 AS alert_percentage,
  critical_fraud_count >= 1 AS alert_critical_fraud
FROM p""", "pv")

ORACLE.update({"snk1_keyed_table": SNK2, "str1_stream_ingest": PRS_ROUNDTRIP, "str1_repeated": PRS_ROUNDTRIP, "str2_daily_monitor": STR2, "str2_late_repeated": STR2,
               "str2_monitor_report": STR2_REPORT})

_WEEKLY = """(SELECT date_trunc('week', validation_timestamp) AS week, COALESCE(lead_source, 'Unknown') AS lead_source,
  COUNT(*) AS validations FROM vr GROUP BY 1, 2) w"""
ORACLE.update({
    "agg12_listagg": with_ctes("""SELECT date_trunc('day', created_date) AS day,
  COALESCE(lead_source, 'Unknown') AS lead_source,
  STRING_AGG(CASE WHEN COALESCE(api_fake_lead, FALSE) THEN COALESCE(api_first_name, '') || ' '
                  || COALESCE(api_last_name, '') || ' (' || task_id || ')' END, '; ' ORDER BY task_id) AS fake_leads_list
FROM pv WHERE parse_error IS NULL AND created_date >= TIMESTAMP '2001-07-01 00:00:00'
  AND created_date <= TIMESTAMP '2001-07-31 23:59:59'
GROUP BY 1, 2""", "pv"),
    "agg10_median": with_ctes("""SELECT COALESCE(lead_source, 'Unknown') AS lead_source,
  MEDIAN(overall_score) AS median_overall_score FROM vr GROUP BY 1""", "vr"),
    "win1_latest": with_ctes("""SELECT lead_id, validation_timestamp, event_id, overall_score FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY lead_id ORDER BY validation_timestamp DESC, event_id DESC) AS rn FROM vr) x
  WHERE rn = 1""", "vr"),
    "win5_rank_in_period": with_ctes(f"""SELECT week, lead_source, validations,
  RANK() OVER (PARTITION BY week ORDER BY validations DESC) AS volume_rank_in_week FROM {_WEEKLY}""", "vr"),
    "win7_lag": with_ctes(f"""SELECT week, lead_source, validations,
  LAG(validations) OVER (PARTITION BY lead_source ORDER BY week) AS prev_validations FROM {_WEEKLY}""", "vr"),
})
