"""DuckDB oracle SQL for the loader queries (LQ-*) and FB-3 (the other fallbacks are in ``banded``)."""

from ..sources.fixtures import PV_AS_OF, with_ctes
from .pv_reports import DQ3, F0, FAKE, Q, VW02

D = f"DATE '{PV_AS_OF}'"
TS = f"TIMESTAMP '{PV_AS_OF} 00:00:00'"
RANGE = ("2001-07-01", "2001-07-31")
GOOD = "parse_error IS NULL"
BAND = (f"CASE WHEN {Q} >= 9 THEN 'Excellent' WHEN {Q} >= 7 THEN 'Good' WHEN {Q} >= 5 THEN 'Fair' "
        f"WHEN {Q} >= 3 THEN 'Poor' ELSE 'Invalid' END")
CONTACT = ("COALESCE(api_first_name, '') AS first_name, COALESCE(api_last_name, '') AS last_name, "
           "COALESCE(api_email, lead_email) AS email, COALESCE(api_phone, '') AS phone, "
           "COALESCE(api_company, lead_company) AS company")


def cnt(pred: str) -> str:
    return f"CAST(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END) AS BIGINT)"


def pc(n: str, t: str, d: int = 2) -> str:
    return f"ROUND(CAST({n} AS DOUBLE) / {t} * 100, {d})"


LQ02 = f"""
SELECT task_id, who_id AS lead_id, lead_source, {Q} AS overall_score, {BAND} AS validation_status, {CONTACT},
  created_date, last_modified_date, FALSE AS is_converted, CAST(NULL AS TIMESTAMP) AS converted_date,
  parsed_at AS validation_timestamp
FROM pv WHERE {GOOD}
ORDER BY parsed_at DESC NULLS LAST, task_id LIMIT 1000
"""

LQ04 = f"""
WITH d AS (
  SELECT date_trunc('day', created_date) AS period_start, COUNT(*) AS leads_validated, AVG({Q}) AS a,
    {cnt(f'{Q} >= 7')} AS quality_leads, {cnt(FAKE)} AS converted_leads,
    COUNT(DISTINCT lead_source) AS unique_sources
  FROM pv WHERE {GOOD} AND created_date >= {D} - INTERVAL 30 DAY
  GROUP BY 1
)
SELECT 'daily' AS period_type, period_start, period_start + INTERVAL 1 DAY AS period_end, leads_validated,
  ROUND(a, 4) AS avg_score, quality_leads, {pc('quality_leads', 'leads_validated')} AS quality_percentage,
  converted_leads, {pc('converted_leads', 'leads_validated')} AS conversion_rate, unique_sources,
  LAG(a) OVER (ORDER BY period_start) AS prev_avg_score,
  ROUND(a - LAG(a) OVER (ORDER BY period_start), 4) AS score_change,
  LAG(leads_validated) OVER (ORDER BY period_start) AS prev_volume,
  leads_validated - LAG(leads_validated) OVER (ORDER BY period_start) AS volume_change
FROM d ORDER BY period_start DESC LIMIT 30
"""

LQ05 = f"""
SELECT task_id AS lead_id, parsed_at AS validation_timestamp, {Q} AS overall_score, {BAND} AS validation_status,
  {CONTACT}, lead_source, FALSE AS is_converted
FROM pv WHERE {GOOD} ORDER BY parsed_at DESC NULLS LAST, task_id LIMIT 100
"""

LQ06 = f"""
SELECT task_id AS lead_id, {Q} AS overall_score, {BAND} AS validation_status, {CONTACT}, lead_source,
  parsed_at AS validation_timestamp, FALSE AS is_converted
FROM pv WHERE {GOOD} AND {Q} < 6
ORDER BY {Q} ASC, parsed_at DESC NULLS LAST, task_id LIMIT 500
"""

LQ07 = f"""
SELECT score_category, COUNT(*) AS total_leads, {cnt('fk')} AS converted_leads,
  {pc(cnt('fk'), 'COUNT(*)')} AS conversion_rate, AVG(q) AS avg_score
FROM (SELECT {BAND} AS score_category, {Q} AS q, {FAKE} AS fk FROM pv WHERE {GOOD}) c
GROUP BY 1
"""

LQ09 = f"""
SELECT * FROM ({VW02}) w
ORDER BY problem_score DESC NULLS LAST, total_leads DESC, remediation_priority LIMIT 20
"""

LQ10 = f"""
WITH a AS (
  SELECT MAX(parsed_at) AS last_validation, COUNT(DISTINCT task_id) AS total_leads, COUNT(*) AS total_validations,
    AVG({Q}) AS avg_score
  FROM pv WHERE {GOOD}
), h AS (SELECT *, CAST(date_diff('second', last_validation, {TS}) AS DOUBLE) / 3600.0 AS hrs FROM a)
SELECT CASE WHEN last_validation IS NULL THEN 'No data' WHEN hrs <= 24 THEN 'Fresh' WHEN hrs <= 168 THEN 'Recent'
            ELSE 'Stale' END AS status,
  last_validation, hrs AS hours_since_validation,
  CASE WHEN last_validation IS NULL THEN 0 ELSE total_leads END AS total_leads,
  CASE WHEN last_validation IS NULL THEN 0 ELSE total_validations END AS total_validations,
  COALESCE(avg_score, 0.0) AS avg_score
FROM h
"""

_IN_RANGE = (f"created_date >= TIMESTAMP '{RANGE[0]} 00:00:00' AND created_date <= TIMESTAMP '{RANGE[1]} 23:59:59'")

LQ11 = f"""
WITH g AS (
  SELECT COALESCE(lead_source, 'Unknown') AS lead_source, COUNT(*) AS total_leads_today,
    {cnt(FAKE)} AS fake_leads_count, {cnt(f'{F0} >= 8')} AS critical_fraud_count,
    AVG({Q}) AS avg_quality_score, AVG({F0}) AS avg_fraud_score,
    MIN(created_date) AS earliest_lead_today, MAX(created_date) AS latest_lead_today
  FROM pv WHERE {GOOD} AND {_IN_RANGE}
  GROUP BY 1
), r AS (SELECT *, CAST(fake_leads_count AS DOUBLE) / total_leads_today * 100 AS raw FROM g)
SELECT lead_source, total_leads_today, fake_leads_count, critical_fraud_count,
  ROUND(raw, 2) AS fake_leads_percentage, {pc('critical_fraud_count', 'total_leads_today')} AS critical_fraud_percentage,
  avg_quality_score, avg_fraud_score,
  CASE WHEN raw >= 50 THEN 'CRITICAL' WHEN raw >= 20 THEN 'HIGH' WHEN raw >= 10 THEN 'MEDIUM'
       WHEN fake_leads_count > 0 THEN 'LOW' ELSE 'CLEAN' END AS daily_risk_level,
  RANK() OVER (ORDER BY raw DESC) AS worst_source_rank,
  fake_leads_count >= 3 AS alert_volume, raw >= 25 AS alert_percentage,
  earliest_lead_today, latest_lead_today, CAST({D} AS TIMESTAMP) AS report_date
FROM r
"""

LQ12 = f"""
SELECT task_id AS lead_id, lead_source, {CONTACT}, {F0} AS fraud_score,
  COALESCE(api_fraud_factors, 'No specific factors') AS fraud_factors,
  COALESCE(api_quality_factors, 'No specific factors') AS quality_factors,
  COALESCE(api_recommendation, 'review') AS recommendation, {FAKE} AS is_fake, created_date, parsed_at,
  CASE WHEN {FAKE} THEN 'FAKE' WHEN {F0} >= 8 THEN 'HIGH_RISK' ELSE 'OTHER' END AS lead_type
FROM pv WHERE {GOOD} AND {_IN_RANGE} AND ({FAKE} OR {F0} >= 8)
"""

LQ13 = f"""
SELECT COALESCE(strftime(MAX(parsed_at), '%I:%M %p on %B %d, %Y'), 'Unknown') AS last_refresh
FROM pv WHERE {GOOD}
"""

LQ14 = f"""
SELECT date_trunc('month', created_date) AS creation_month, COUNT(*) AS total_leads,
  AVG({DQ3}) / 10.0 AS avg_data_quality_score, AVG({F0}) / 10.0 AS avg_fraud_score,
  {cnt(FAKE)} AS fake_leads_count, {pc(cnt(FAKE), 'COUNT(*)')} AS fake_leads_percentage,
  {pc(cnt(f'{Q} >= 7'), 'COUNT(*)')} AS high_quality_percentage,
  COUNT(DISTINCT lead_source) AS unique_sources, AVG(COALESCE(api_lead_score, 0)) AS avg_lead_score
FROM pv WHERE {GOOD} AND created_date IS NOT NULL
GROUP BY 1
"""

LQ15 = f"""
SELECT date_trunc('month', created_date) AS creation_month, lead_source, COUNT(*) AS total_leads,
  AVG({DQ3}) / 10.0 AS avg_data_quality_score, AVG({F0}) / 10.0 AS avg_fraud_score,
  {cnt(FAKE)} AS fake_leads_count, {pc(cnt(FAKE), 'COUNT(*)')} AS fake_leads_percentage
FROM pv WHERE {GOOD} AND created_date IS NOT NULL AND lead_source IS NOT NULL
GROUP BY 1, 2 HAVING COUNT(*) >= 5
"""

FB3 = f"""
SELECT task_id AS lead_id, lead_source, parsed_at AS validation_timestamp, {CONTACT},
  {DQ3} / 10.0 AS data_quality_score, {F0} / 10.0 AS fraud_score, {Q} / 10.0 AS overall_score,
  COALESCE(api_fraud_risk_level, CASE WHEN {F0} >= 8 THEN 'high' WHEN {F0} >= 5 THEN 'medium' ELSE 'low' END)
    AS fraud_risk_level,
  COALESCE(api_email_valid, COALESCE(api_email, lead_email) IS NOT NULL AND COALESCE(api_email, lead_email) <> '')
    AS email_valid,
  COALESCE(api_phone_valid, api_phone IS NOT NULL AND api_phone <> '') AS phone_valid,
  COALESCE(api_fraud_factors, 'No specific fraud factors identified') AS fraud_factors,
  COALESCE(api_quality_factors, 'No specific quality factors identified') AS quality_factors,
  COALESCE(api_summary_notes, 'Flagged as fake lead') AS summary_notes,
  COALESCE(api_quality_level, 'unknown') AS quality_level,
  COALESCE(api_recommendation, 'review') AS recommended_action,
  api_fake_lead, api_market_segment, raw_api_response, raw_description
FROM pv WHERE {GOOD} AND created_date IS NOT NULL AND ({FAKE} OR {F0} >= 5)
ORDER BY {F0} DESC, {Q} ASC NULLS LAST, task_id LIMIT 100
"""

ORACLE = {k: with_ctes(v, "pv") for k, v in {
    "lq02_lead_list": LQ02, "lq04_daily_trends": LQ04, "lq05_recent_validations": LQ05,
    "lq06_problematic_leads": LQ06, "lq07_category_analysis": LQ07, "lq09_top_worst_sources": LQ09,
    "lq10_data_freshness": LQ10, "lq11_daily_fake_leads": LQ11, "lq12_daily_fake_detail": LQ12,
    "lq13_last_refresh": LQ13, "lq14_creation_months": LQ14, "lq15_source_months": LQ15,
    "fb3_fake_leads": FB3,
}.items()}
