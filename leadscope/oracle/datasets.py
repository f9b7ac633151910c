"""DuckDB oracle SQL for the derived datasets (DD-*)."""

import re

from ..sources.fixtures import with_ctes
from .loaders import FB3, LQ02, LQ04, LQ06, LQ11, LQ12, LQ14, LQ15, RANGE
from .pv_reports import F0, FAKE, VW01, VW02, VW03
from .vr_reports import VW10, XAVG

_IN_RANGE = (f"created_date >= TIMESTAMP '{RANGE[0]} 00:00:00' AND created_date <= TIMESTAMP '{RANGE[1]} 23:59:59'")


def _all(query: str) -> str:
    """A loader's query without its row limit: what its aggregates count."""
    return re.sub(r"\s+LIMIT\s+\d+\s*$", "", query.rstrip())


def _rint(x, d):
    return f"round_even(({x}) * {10 ** d}, 0) / {float(10 ** d)}"


DD01 = f"""
SELECT COUNT(*) AS total_leads, COUNT(*) FILTER (WHERE {FAKE}) AS total_fake_leads,
  CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE {FAKE}) AS DOUBLE) / COUNT(*) * 100 ELSE 0.0 END
    AS total_fake_percentage,
  COUNT(*) FILTER (WHERE {FAKE} OR {F0} >= 8) AS total_problematic_leads,
  COUNT(*) FILTER (WHERE {FAKE}) AS fake_count_unique,
  COUNT(*) FILTER (WHERE NOT {FAKE} AND {F0} >= 8) AS high_risk_count_unique,
  CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE {FAKE} OR {F0} >= 8) AS DOUBLE) / COUNT(*) * 100 ELSE 0.0 END
    AS total_problematic_percentage
FROM pv WHERE parse_error IS NULL AND {_IN_RANGE}
"""

DD02 = f"""SELECT lead_source, total_leads_today, fake_leads_count, critical_fraud_count,
  {_rint('fake_leads_percentage', 1)} AS fake_leads_percentage,
  {_rint('critical_fraud_percentage', 1)} AS critical_fraud_percentage
FROM ({LQ11}) d"""

DD03 = f"""SELECT COUNT(*) AS total_sources, COUNT(*) FILTER (WHERE fake_leads_count > 0) AS sources_with_fakes
FROM ({LQ11}) d"""

_FACTORS = ["Data Completeness", "Email Deliverable", "Email Format Valid", "Known Fake Lead", "ML Fraud Score",
            "ML Risk Level", "Phone Valid", "Postal Code Valid", "State Valid", "ZIP State Consistent"]


def _factor(t: str, f: str) -> str:
    x = f"CASE WHEN {t} NOT IN ('No specific factors', 'No factors') THEN {t} END"
    if f == "Known Fake Lead":
        return f"CASE WHEN contains({x}, 'Known fake lead from database') THEN 'TRUE' END"
    if f == "ML Fraud Score":
        p = r"ML fraud model.*?score[:\s]*(\d+)"
        return f"CASE WHEN contains({x}, 'ML fraud model') AND regexp_matches({x}, '{p}') THEN regexp_extract({x}, '{p}', 1) END"
    if f == "ML Risk Level":
        p = r"ML fraud model[:\s]*(MEDIUM|HIGH|LOW|NORMAL) RISK"
        return f"CASE WHEN contains({x}, 'ML fraud model') AND regexp_matches({x}, '{p}') THEN regexp_extract({x}, '{p}', 1) END"
    if f == "Email Deliverable":
        return (f"CASE WHEN contains({x}, 'Email deliverable') AND NOT contains({x}, 'not') THEN 'YES' "
                f"WHEN contains({x}, 'Email not deliverable') THEN 'NO' END")
    if f == "Email Format Valid":
        return f"CASE WHEN contains({x}, 'Invalid email') THEN 'NO' WHEN contains({x}, 'Valid email format') THEN 'YES' END"
    if f == "Phone Valid":
        return f"CASE WHEN contains({x}, 'Invalid phone') THEN 'NO' WHEN contains({x}, 'Valid phone number') THEN 'YES' END"
    if f == "ZIP State Consistent":
        return f"CASE WHEN contains({x}, 'ZIP/state consistent') THEN 'YES' END"
    if f == "Postal Code Valid":
        return f"CASE WHEN contains({x}, 'Valid postal code') THEN 'YES' END"
    if f == "State Valid":
        return f"CASE WHEN contains({x}, 'Valid state') THEN 'YES' END"
    p = r"Data completeness \((\d+)/(\d+)\)"
    return (f"CASE WHEN regexp_matches({x}, '{p}') THEN regexp_extract({x}, '{p}', 1) || '/' "
            f"|| regexp_extract({x}, '{p}', 2) END")


def _fname(f):
    return "factor_" + f.lower().replace(" ", "_")


DD05 = f"""SELECT lead_id, lead_type, first_name || ' ' || last_name AS name, email,
  CASE WHEN COALESCE(length(phone), 0) > 0 THEN phone ELSE 'Missing' END AS phone_display,
  CASE WHEN COALESCE(length(company), 0) > 0 THEN company ELSE 'Missing' END AS company_display,
  lead_source, fraud_score, recommendation,
  {", ".join(f"COALESCE({_factor('quality_factors', f)}, {_factor('fraud_factors', f)}, '') AS {_fname(f)}" for f in _FACTORS)},
  fraud_factors AS original_fraud_factors, quality_factors AS original_quality_issues
FROM ({LQ12}) d"""

DD06 = f"""SELECT lead_source, COUNT(*) AS fake_leads_count FROM ({_all(FB3)}) f WHERE lead_source IS NOT NULL GROUP BY 1"""


def _js(path, default):
    return (f"CASE WHEN json_valid(raw_api_response) AND json_type(raw_api_response) = 'OBJECT' THEN "
            f"COALESCE(json_extract_string(raw_api_response, '{path}'), '{default}') END")


def _jb(path):
    return (f"CASE WHEN json_valid(raw_api_response) AND json_type(raw_api_response) = 'OBJECT' THEN "
            f"COALESCE(TRY_CAST(json_extract_string(raw_api_response, '{path}') AS BOOLEAN), FALSE) END")


DD07 = f"""SELECT lead_id, {_js('$.summaryNotes', '[]')} AS summary_notes, {_js('$.fakeSource', '')} AS fake_source,
  {_js('$.fakeReason', '')} AS fake_reason, {_js('$.fakeConfidence', '')} AS fake_confidence,
  {_js('$.validationMethod', '')} AS validation_method,
  {_js('$.recommendationConfidence', '')} AS recommendation_confidence,
  {_js('$.mlFraudDetection', '{}')} AS ml_fraud_detection, {_js('$.emailSummary', '{}')} AS email_summary,
  {_jb('$.hasGibberishNames')} AS has_gibberish_names, {_jb('$.hasGibberishCompany')} AS has_gibberish_company
FROM ({_all(FB3)}) f"""

_TOP6 = f"""(SELECT lead_source FROM ({LQ15}) s GROUP BY 1 ORDER BY SUM(total_leads) DESC, lead_source LIMIT 6)"""
DD08 = f"SELECT * FROM ({LQ15}) s WHERE lead_source IN {_TOP6}"
DD09 = f"""SELECT lead_source, total_leads, {_rint('avg_data_quality_score', 2)} AS avg_data_quality_score,
  fake_leads_count FROM ({DD08}) t WHERE creation_month = (SELECT MAX(creation_month) FROM ({DD08}) u)"""

DD10 = f"""
WITH m AS (SELECT *, ROW_NUMBER() OVER (ORDER BY creation_month DESC) AS rn FROM ({LQ14}) x),
best AS (SELECT lead_source FROM ({DD08}) t WHERE creation_month = (SELECT MAX(creation_month) FROM ({DD08}) u)
         ORDER BY avg_data_quality_score DESC, lead_source LIMIT 1),
h AS (SELECT *, ROW_NUMBER() OVER (ORDER BY creation_month DESC) AS rn FROM ({LQ15}) s
      WHERE lead_source IN (SELECT lead_source FROM best))
SELECT (SELECT MAX(avg_data_quality_score) FILTER (WHERE rn = 1) - MAX(avg_data_quality_score) FILTER (WHERE rn = 2)
        FROM m) AS quality_change,
       (SELECT MAX(avg_fraud_score) FILTER (WHERE rn = 1) - MAX(avg_fraud_score) FILTER (WHERE rn = 2) FROM m)
         AS fraud_change,
       (SELECT lead_source FROM best) AS top_source,
       (SELECT MAX(avg_data_quality_score) FILTER (WHERE rn = 1) - MAX(avg_data_quality_score) FILTER (WHERE rn = 2)
        FROM h) AS top_source_quality_change
"""

DD11 = f"""SELECT * FROM (
  SELECT 'Excellent (9-10)' AS category, 1 AS position, excellent_leads AS leads, excellent_percentage AS percentage FROM ({VW03}) o
  UNION ALL SELECT 'Good (7-8)', 2, good_leads, good_percentage FROM ({VW03}) o
  UNION ALL SELECT 'Fair (5-6)', 3, fair_leads, fair_percentage FROM ({VW03}) o
  UNION ALL SELECT 'Poor (3-4)', 4, poor_leads, poor_percentage FROM ({VW03}) o
  UNION ALL SELECT 'Invalid (0-2)', 5, invalid_leads, invalid_percentage FROM ({VW03}) o) d"""

DD12 = f"""SELECT bin, 0.0 + (bin - 1) * 0.5 AS bin_start, 0.0 + bin * 0.5 AS bin_end, COUNT(*) AS leads FROM (
  SELECT least(20, CAST(floor((overall_score - 0.0) / 0.5) AS INT) + 1) AS bin FROM ({_all(LQ02)}) l
  WHERE overall_score IS NOT NULL) b GROUP BY 1"""

DD13 = f"""SELECT lead_source, total_leads, avg_quality_score AS quality, fake_leads_percentage AS fake_rate,
  sqrt(total_leads) * 3.0 AS bubble_size,
  CASE WHEN avg_quality_score >= 7 AND fake_leads_percentage < 10 THEN 'Excellent'
       WHEN avg_quality_score < 7 AND fake_leads_percentage < 10 THEN 'Needs Work'
       WHEN avg_quality_score >= 7 AND fake_leads_percentage >= 10 THEN 'Investigate' ELSE 'Critical' END AS quadrant
FROM ({VW01}) s"""

DD14 = f"""SELECT COUNT(*) AS worst_sources, COUNT(*) FILTER (WHERE risk_level = 'HIGH_RISK') AS high_risk_sources,
  COUNT(*) FILTER (WHERE risk_level = 'MEDIUM_RISK') AS medium_risk_sources, {XAVG('problem_score')} AS avg_problem_score
FROM ({VW02}) w"""

DD15 = f"""SELECT total_sources, high_quality_sources,
  CASE WHEN total_sources > 0 THEN CAST(high_quality_sources AS DOUBLE) / total_sources * 100 ELSE 0.0 END
    AS high_quality_pct, problem_sources, ROUND(avg_quality, 10) AS avg_quality
FROM (SELECT COUNT(*) AS total_sources, COUNT(*) FILTER (WHERE quality_grade IN ('A+', 'A')) AS high_quality_sources,
             {XAVG('avg_quality_score')} AS avg_quality FROM ({VW01}) s) a,
     (SELECT COUNT(*) AS problem_sources FROM ({VW02}) w) b"""

DD16 = f"""SELECT lead_source, total_leads, avg_quality_score, quality_grade, fake_leads_percentage,
  email_valid_percentage, phone_valid_percentage, quality_leads_percentage, risk_level, quality_rank
FROM ({VW01}) s WHERE total_leads >= 10"""

DD17 = f"""SELECT MAX(period_start) FILTER (WHERE rn = 1) AS latest_period,
  MAX(avg_score) FILTER (WHERE rn = 1) - MAX(avg_score) FILTER (WHERE rn = 2) AS score_change,
  MAX(leads_validated) FILTER (WHERE rn = 1) - MAX(leads_validated) FILTER (WHERE rn = 2) AS volume_change
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY period_start DESC) AS rn FROM ({LQ04}) t) x"""

DD18 = f"""SELECT total_leads, avg_overall_score, quality_leads_percentage, conversion_rate_percentage,
  earliest_lead_date, latest_lead_date, problematic_leads,
  CASE WHEN quality_leads_percentage >= 80 THEN 'Excellent' WHEN quality_leads_percentage >= 60 THEN 'Moderate'
       ELSE 'Action Required' END AS quality_status,
  greatest(problematic_leads - 20, 0) AS problematic_not_listed,
  strftime(earliest_lead_date, '%Y-%m-%d') AS period_from, strftime(latest_lead_date, '%Y-%m-%d') AS period_to
FROM ({VW10}) m, (SELECT COUNT(*) AS problematic_leads FROM ({_all(LQ06)}) p) p"""

DD19 = f"""SELECT total_leads, excellent_count + good_count AS quality_leads, quality_leads_percentage,
  poor_count + invalid_count AS non_compliant_leads, poor_percentage + invalid_percentage AS non_compliant_percentage,
  avg_overall_score, quality_leads_percentage >= 70 AS is_compliant, leads_below_threshold
FROM ({VW10}) m, (SELECT COUNT(*) AS leads_below_threshold FROM ({_all(LQ06)}) p) p"""

DD20 = """SELECT lead_source, COUNT(*) AS records FROM pv WHERE lead_source IS NOT NULL GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 5"""

_BANDS = [(9, 10, "Excellent"), (7, 9, "Good"), (5, 7, "Fair"), (3, 5, "Poor"), (0, 3, "Invalid")]
DD21A = "WITH s AS (SELECT api_quality_score AS q FROM pv WHERE api_quality_score IS NOT NULL)\n" + "\nUNION ALL\n".join(
    f"SELECT '{lbl}' AS band, {lo} AS min_score, {hi} AS max_score, COUNT(*) FILTER (WHERE q >= {lo} AND q < {hi}) "
    f"AS leads, CAST(COUNT(*) FILTER (WHERE q >= {lo} AND q < {hi}) AS DOUBLE) / COUNT(*) * 100 AS percentage FROM s"
    for lo, hi, lbl in _BANDS)
DD21B = f"""SELECT lead_source, {_rint('AVG(api_quality_score)', 2)} AS avg_quality,
  {_rint('AVG(api_lead_score)', 2)} AS avg_lead, {_rint('AVG(api_fraud_score)', 2)} AS avg_fraud,
  COUNT(task_id) AS count
FROM pv WHERE lead_source IS NOT NULL GROUP BY 1"""
DD21C = """SELECT COUNT(*) FILTER (WHERE COALESCE(api_fake_lead, FALSE)) AS fake_leads,
  COUNT(*) FILTER (WHERE COALESCE(api_disposable_email, FALSE)) AS disposable_emails,
  COUNT(*) FILTER (WHERE COALESCE(api_fake_phone, FALSE)) AS fake_phones FROM pv"""
DD22 = f"""SELECT lead_source, total_leads, avg_quality_score, quality_grade, risk_level FROM ({VW01}) s
ORDER BY avg_quality_score DESC NULLS LAST, lead_source LIMIT 15"""

ORACLE = {
    "dd01_daily_totals": with_ctes(DD01, "pv"), "dd02_source_table": with_ctes(DD02, "pv"),
    "dd03_sources_with_fakes": with_ctes(DD03, "pv"), "dd05_problematic_export": with_ctes(DD05, "pv"),
    "dd06_suspicious_per_source": with_ctes(DD06, "pv"), "dd07_raw_json_details": with_ctes(DD07, "pv"),
    "dd08_top_source_series": with_ctes(DD08, "pv"), "dd09_latest_month": with_ctes(DD09, "pv"),
    "dd10_month_over_month": with_ctes(DD10, "pv"), "dd11_score_distribution": with_ctes(DD11, "pv"),
    "dd12_score_histogram": with_ctes(DD12, "pv"), "dd13_quadrants": with_ctes(DD13, "pv"),
    "dd14_worst_summary": with_ctes(DD14, "pv"), "dd15_source_overview": with_ctes(DD15, "pv"),
    "dd16_filtered_sources": with_ctes(DD16, "pv"), "dd17_trend_delta": with_ctes(DD17, "pv"),
    "dd18_comprehensive_report": with_ctes(DD18, "pv", "vr"), "dd19_compliance_report": with_ctes(DD19, "pv", "vr"),
    "dd20_top_sources": with_ctes(DD20, "pv"), "dd21_score_bands": with_ctes(DD21A, "pv"),
    "dd21_source_means": with_ctes(DD21B, "pv"), "dd21_flag_sums": with_ctes(DD21C, "pv"),
    "dd22_top_quality_sources": with_ctes(DD22, "pv"),
}
