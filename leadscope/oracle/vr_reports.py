"""DuckDB oracle SQL for the validation_results reports (VW-9 .. VW-14)."""

from ..sources.fixtures import VR_AS_OF, with_ctes

D = f"DATE '{VR_AS_OF}'"


def XAVG(x: str) -> str:
    """Partition-independent average of a double: exact fixed-point (1e-6) sum, one division."""
    return (f"(CAST(SUM(CAST(floor(CAST({x} AS DOUBLE) * 1000000.0 + 0.5) AS BIGINT)) AS DOUBLE) "
            f"/ CAST(COUNT({x}) AS DOUBLE) / 1000000.0)")

VW09 = f"""
SELECT lead_id, validation_timestamp, overall_score, validation_status, first_name, last_name, email, phone,
  company, status AS lead_status, lead_source, created_date, last_modified_date, is_converted, converted_date,
  CASE WHEN overall_score >= 0.9 THEN 'Excellent' WHEN overall_score >= 0.8 THEN 'Good'
       WHEN overall_score >= 0.6 THEN 'Fair' WHEN overall_score >= 0.4 THEN 'Poor' ELSE 'Invalid' END AS score_category,
  CAST({D} - CAST(created_date AS DATE) AS BIGINT) AS lead_age_days,
  CAST({D} - CAST(validation_timestamp AS DATE) AS BIGINT) AS days_since_validation,
  CASE WHEN is_converted THEN 'Converted' ELSE 'Not Converted' END AS conversion_status,
  CASE WHEN is_converted AND converted_date IS NOT NULL
       THEN CAST(CAST(converted_date AS DATE) - CAST(created_date AS DATE) AS BIGINT) END AS days_to_conversion
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY lead_id ORDER BY validation_timestamp DESC, event_id DESC) AS rn
  FROM vr
) x WHERE rn = 1
"""


def _p(n, t="total_leads", d=2):
    return f"ROUND(CAST({n} AS DOUBLE) / {t} * 100, {d})"


VW10 = f"""
WITH s AS ({VW09}),
b AS (
  SELECT COUNT(*) AS total_leads, {XAVG('overall_score')} AS avg_overall_score,
    MEDIAN(overall_score) AS median_overall_score,
    COUNT(*) FILTER (WHERE overall_score >= 0.9) AS excellent_count,
    COUNT(*) FILTER (WHERE overall_score >= 0.8 AND overall_score < 0.9) AS good_count,
    COUNT(*) FILTER (WHERE overall_score >= 0.6 AND overall_score < 0.8) AS fair_count,
    COUNT(*) FILTER (WHERE overall_score >= 0.4 AND overall_score < 0.6) AS poor_count,
    COUNT(*) FILTER (WHERE overall_score < 0.4) AS invalid_count,
    COUNT(*) FILTER (WHERE is_converted) AS converted_leads,
    COUNT(*) FILTER (WHERE NOT is_converted) AS not_converted_leads,
    COUNT(DISTINCT lead_source) AS unique_lead_sources,
    MIN(created_date) AS earliest_lead_date, MAX(created_date) AS latest_lead_date,
    AVG(lead_age_days) AS avg_lead_age_days,
    MIN(validation_timestamp) AS earliest_validation, MAX(validation_timestamp) AS latest_validation,
    AVG(days_since_validation) AS avg_days_since_validation
  FROM s
)
SELECT total_leads, ROUND(avg_overall_score, 10) AS avg_overall_score, median_overall_score,
  excellent_count, {_p('excellent_count')} AS excellent_percentage,
  good_count, {_p('good_count')} AS good_percentage,
  fair_count, {_p('fair_count')} AS fair_percentage,
  poor_count, {_p('poor_count')} AS poor_percentage,
  invalid_count, {_p('invalid_count')} AS invalid_percentage,
  converted_leads, not_converted_leads, {_p('converted_leads')} AS conversion_rate_percentage,
  {_p('excellent_count + good_count')} AS quality_leads_percentage,
  unique_lead_sources, earliest_lead_date, latest_lead_date, avg_lead_age_days,
  earliest_validation, latest_validation, avg_days_since_validation,
  CASE WHEN avg_days_since_validation <= 1 THEN 'Very Fresh' WHEN avg_days_since_validation <= 7 THEN 'Fresh'
       WHEN avg_days_since_validation <= 30 THEN 'Moderate' ELSE 'Stale' END AS data_freshness_status
FROM b
"""

VW11 = f"""
WITH s AS ({VW09}),
g AS (
  SELECT COALESCE(lead_source, 'Unknown') AS lead_source, COUNT(*) AS total_leads,
    {XAVG('overall_score')} AS avg_score, MEDIAN(overall_score) AS median_score,
    MIN(overall_score) AS min_score, MAX(overall_score) AS max_score,
    COUNT(*) FILTER (WHERE overall_score >= 0.9) AS excellent_count,
    COUNT(*) FILTER (WHERE overall_score >= 0.8 AND overall_score < 0.9) AS good_count,
    COUNT(*) FILTER (WHERE overall_score >= 0.6 AND overall_score < 0.8) AS fair_count,
    COUNT(*) FILTER (WHERE overall_score >= 0.4 AND overall_score < 0.6) AS poor_count,
    COUNT(*) FILTER (WHERE overall_score < 0.4) AS invalid_count,
    COUNT(*) FILTER (WHERE overall_score >= 0.8) AS q,
    COUNT(*) FILTER (WHERE is_converted) AS converted_leads,
    COUNT(*) FILTER (WHERE created_date >= {D} - INTERVAL 30 DAY) AS leads_last_30_days,
    COUNT(*) FILTER (WHERE created_date >= {D} - INTERVAL 60 DAY AND created_date < {D} - INTERVAL 30 DAY)
      AS leads_previous_30_days
  FROM s GROUP BY 1
)
SELECT lead_source, total_leads, ROUND(avg_score, 10) AS avg_score, median_score, min_score, max_score,
  excellent_count, good_count, fair_count, poor_count, invalid_count,
  {_p('excellent_count')} AS excellent_percentage, {_p('good_count')} AS good_percentage,
  {_p('fair_count')} AS fair_percentage, {_p('poor_count')} AS poor_percentage,
  {_p('invalid_count')} AS invalid_percentage, {_p('q')} AS quality_percentage,
  converted_leads, {_p('converted_leads')} AS conversion_rate,
  leads_last_30_days, leads_previous_30_days,
  RANK() OVER (ORDER BY avg_score DESC NULLS LAST) AS score_rank,
  RANK() OVER (ORDER BY total_leads DESC) AS volume_rank,
  RANK() OVER (ORDER BY CAST(converted_leads AS DOUBLE) / total_leads DESC NULLS LAST) AS conversion_rank
FROM g
"""


def _grain_block(kind: str, unit: str, step: str) -> str:
    return f"""
  SELECT '{kind}' AS period_type, date_trunc('{unit}', validation_timestamp) AS period_start,
    COUNT(*) AS leads_validated, {XAVG('overall_score')} AS a,
    COUNT(*) FILTER (WHERE overall_score >= 0.8) AS quality_leads,
    COUNT(*) FILTER (WHERE is_converted) AS converted_leads,
    COUNT(DISTINCT lead_source) AS unique_sources,
    INTERVAL {step} AS step
  FROM vr GROUP BY 2"""


VW12 = f"""
WITH g AS (
{_grain_block('daily', 'day', '1 DAY')}
  UNION ALL {_grain_block('weekly', 'week', '7 DAY')}
  UNION ALL {_grain_block('monthly', 'month', '1 MONTH')}
)
SELECT period_type, period_start, period_start + step AS period_end, leads_validated,
  ROUND(a, 4) AS avg_score, quality_leads,
  ROUND(CAST(quality_leads AS DOUBLE) / leads_validated * 100, 2) AS quality_percentage,
  converted_leads, ROUND(CAST(converted_leads AS DOUBLE) / leads_validated * 100, 2) AS conversion_rate,
  unique_sources,
  ROUND(LAG(a) OVER w, 6) AS prev_avg_score,
  ROUND(a - LAG(a) OVER w, 4) AS score_change,
  LAG(leads_validated) OVER w AS prev_volume,
  leads_validated - LAG(leads_validated) OVER w AS volume_change
FROM g
WINDOW w AS (PARTITION BY period_type ORDER BY period_start)
"""

_POINTS = ("email", "phone", "name", "company", "completeness")


def _trend_block(kind: str, unit: str, by_source: bool) -> str:
    src = "COALESCE(lead_source, 'Unknown') AS lead_source," if by_source else ""
    grp = "GROUP BY 2, 3" if by_source else "GROUP BY 2"
    pts = ",\n    ".join(
        f"{XAVG(f'CAST(COALESCE(json_extract_string(validation_details, {chr(39)}$.{p}.score{chr(39)}), {chr(39)}0{chr(39)}) AS DOUBLE)')} AS a_{p},\n    "
        f"COUNT(*) FILTER (WHERE CAST(COALESCE(json_extract_string(validation_details, '$.{p}.score'), '0') AS DOUBLE)"
        f" >= 0.7) AS p_{p}" for p in _POINTS)
    fake = "COUNT(*) FILTER (WHERE fraud_score >= 0.7) AS likely_fake_count," if by_source else ""
    return f"""
  SELECT '{kind}' AS period_type, date_trunc('{unit}', validation_timestamp) AS trend_date, {src}
    COUNT(*) AS total_validations,
    {XAVG('data_quality_score')} AS a_dq, MEDIAN(data_quality_score) AS m_dq,
    {XAVG('fraud_score')} AS a_fr, MEDIAN(fraud_score) AS m_fr, {XAVG('overall_score')} AS a_ov,
    {pts},
    {fake}
    COUNT(*) FILTER (WHERE data_quality_score >= 0.7) AS hq,
    COUNT(*) FILTER (WHERE fraud_score >= 0.6) AS hf
  FROM vr WHERE validation_timestamp >= {D} - INTERVAL 90 DAY
  {grp}"""


def _trend_select(by_source: bool) -> str:
    n = "total_validations"
    pts_avg = ", ".join(f"ROUND(a_{p}, 3) AS avg_{p}_score" for p in _POINTS)
    pts_pass = ", ".join(f"ROUND(CAST(p_{p} AS DOUBLE) / {n} * 100, 1) AS {p}_pass_rate_percent" for p in _POINTS)
    part = "PARTITION BY period_type, lead_source" if by_source else "PARTITION BY period_type"
    extra_cols = "lead_source," if by_source else ""
    tail = ""
    if by_source:
        tail = """,
  likely_fake_count,
  LAG(total_validations) OVER w AS prev_volume,
  total_validations - LAG(total_validations) OVER w AS volume_change,
  RANK() OVER (PARTITION BY period_type, trend_date ORDER BY a_dq DESC NULLS LAST) AS daily_quality_rank,
  RANK() OVER (PARTITION BY period_type, trend_date ORDER BY a_fr ASC NULLS LAST) AS daily_fraud_safety_rank"""
    return f"""
SELECT period_type, trend_date, {extra_cols} total_validations,
  ROUND(a_dq, 3) AS avg_data_quality_score, ROUND(m_dq, 3) AS median_data_quality_score,
  ROUND(a_fr, 3) AS avg_fraud_score, ROUND(m_fr, 3) AS median_fraud_score, ROUND(a_ov, 3) AS avg_overall_score,
  {pts_avg},
  {pts_pass},
  ROUND(CAST(hq AS DOUBLE) / {n} * 100, 1) AS high_quality_percentage,
  ROUND(CAST(hf AS DOUBLE) / {n} * 100, 1) AS high_fraud_risk_percentage,
  ROUND(LAG(a_dq) OVER w, 6) AS prev_data_quality_score,
  ROUND(a_dq - LAG(a_dq) OVER w, 4) AS data_quality_change,
  ROUND(LAG(a_fr) OVER w, 6) AS prev_fraud_score,
  ROUND(a_fr - LAG(a_fr) OVER w, 4) AS fraud_score_change{tail}
FROM t
{"WHERE (period_type = 'daily' AND total_validations >= 5) OR (period_type = 'weekly' AND total_validations >= 10)" if by_source else ""}
WINDOW w AS ({part} ORDER BY trend_date)
"""


VW13 = f"WITH t AS ({_trend_block('daily', 'day', False)}\n  UNION ALL {_trend_block('weekly', 'week', False)}\n)" \
       + _trend_select(False)
VW14 = f"WITH t AS ({_trend_block('daily', 'day', True)}\n  UNION ALL {_trend_block('weekly', 'week', True)}\n)" \
       + _trend_select(True)

ORACLE = {
    "vw09_validation_summary": with_ctes(VW09, "vr"),
    "vw10_validation_metrics": with_ctes(VW10, "vr"),
    "vw11_validation_by_source": with_ctes(VW11, "vr"),
    "vw12_validation_trends": with_ctes(VW12, "vr"),
    "vw13_trends_overall": with_ctes(VW13, "vr"),
    "vw14_trends_by_source": with_ctes(VW14, "vr"),
}
