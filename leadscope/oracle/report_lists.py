"""DuckDB SQL for the report lists: picked by row numbers from the oracles of the reports that they list."""

from __future__ import annotations

from .datasets import ORACLE as DATASETS
from .datasets import _rint
from .loaders import ORACLE as LOADERS
from .pv_reports import ORACLE as PV
from .vr_reports import ORACLE as VR


def _first(report: str, order: str, n: int, columns: str) -> str:
    return (f"SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS place FROM ({report}) report) numbered "
            f"WHERE place <= {n}")


_METRICS = VR["vw10_validation_metrics"]
_LEADS, _WORST = LOADERS["lq06_problematic_leads"], "overall_score, validation_timestamp DESC NULLS LAST, lead_id"

ORACLE = {
    "dd14_worst_list": _first(PV["vw02_worst_sources"], "remediation_priority", 10, f"""lead_source, total_leads,
        {_rint('avg_quality_score', 1)} AS avg_quality_score, quality_grade,
        {_rint('fake_leads_percentage', 1)} AS fake_leads_percentage, risk_level, recommendation, remediation_priority"""),
    "dd17_recent_trends": _first(LOADERS["lq04_daily_trends"], "period_start DESC", 7, f"""
        strftime(period_start, '%Y-%m-%d') AS period_start, leads_validated, {_rint('avg_score', 3)} AS avg_score,
        quality_percentage, conversion_rate"""),
    "dd18_band_table": f"""
        WITH m AS (SELECT * FROM ({_METRICS}) one)
        SELECT 1 AS position, 'Excellent (0.9-1.0)' AS band, excellent_count AS leads, excellent_percentage AS percentage FROM m
        UNION ALL SELECT 2, 'Good (0.8-0.9)', good_count, good_percentage FROM m
        UNION ALL SELECT 3, 'Fair (0.6-0.8)', fair_count, fair_percentage FROM m
        UNION ALL SELECT 4, 'Poor (0.4-0.6)', poor_count, poor_percentage FROM m
        UNION ALL SELECT 5, 'Invalid (0.0-0.4)', invalid_count, invalid_percentage FROM m""",
    "dd18_best_sources": _first(VR["vw11_validation_by_source"], "avg_score DESC NULLS LAST, lead_source", 10,
                                "lead_source, total_leads, avg_score, quality_percentage, conversion_rate"),
    "dd18_worst_leads": _first(_LEADS, _WORST, 20, """lead_id, overall_score,
        COALESCE(first_name, '') || ' ' || COALESCE(last_name, '') AS name, COALESCE(NULLIF(company, ''), 'N/A') AS company,
        COALESCE(NULLIF(email, ''), 'N/A') AS email, COALESCE(NULLIF(lead_source, ''), 'Unknown') AS lead_source"""),
    "dd19_review_list": _first(_LEADS, _WORST, 50, "lead_id, overall_score, validation_status, 'Review Required' AS issues"),
    "dd21_last_means": _first(DATASETS["dd21_source_means"], "avg_quality NULLS FIRST, lead_source DESC", 3,
                              "lead_source, avg_quality, avg_lead, avg_fraud, count"),
}
