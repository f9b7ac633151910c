"""DuckDB oracle SQL of the banded reports (VW-4, VW-5, FB-1, FB-2, FB-4, FB-5), from the report definitions in SURVEY App. A.

All six have one form: scores of a row are turned into (metric, value) rows; means, extremes and band counts are
aggregates of these, with the bands in a table; grades and states come from tables of rungs.
"""

from __future__ import annotations

from ..sources.fixtures import PV_AS_OF, with_ctes

AS_OF = f"DATE '{PV_AS_OF}'"
OVERALL = "coalesce(api_quality_score, quality_score)"
FRAUD = "coalesce(api_fraud_score, 0)"
IS_FAKE = "coalesce(api_fake_lead, false)"

# Bands (metric, from, below) by the name of their count, and rungs of the ladders in order.
TOP = "'infinity'"
QUALITY = {"excellent_quality_count": ("overall", 9, TOP), "good_quality_count": ("overall", 7, 9),
           "fair_quality_count": ("overall", 5, 7), "poor_quality_count": ("overall", "'-infinity'", 5)}
RISK = {"critical_fraud_risk_count": ("fraud", 8, TOP), "high_fraud_risk_count": ("fraud", 6, 8), "medium_fraud_risk_count": ("fraud", 4, 6)}
PLAIN_QUALITY = {"excellent_quality_count": ("overall", 7, TOP), "good_quality_count": ("overall", 5, 7),
                 "fair_quality_count": ("overall", 3, 5), "poor_quality_count": ("overall", "'-infinity'", 3)}
STATUS = [("EXCELLENT", 8, 3), ("GOOD", 7, 4), ("FAIR", 6, 5), ("POOR", 4, 7)]
GRADE = [("A+", 9, 2), ("A", 8, 3), ("B", 7, 4), ("C", 6, 5), ("D", 4, 6)]
SOURCE_RISK = [("CRITICAL", 7, "at7", 0.3), ("HIGH", 5, "at6", 0.2), ("MEDIUM", 3, "at5", 0.1), ("LOW", 2, "at5", 2)]
PLAIN_STATUS = [("EXCELLENT", 8), ("GOOD", 6), ("FAIR", 4)]
PLAIN_RISK = [("CRITICAL", 0.7), ("HIGH", 0.5), ("MEDIUM", 0.3)]
PLAIN_GRADE = [("A+", 9), ("A", 7), ("B", 5), ("C", 3)]
CHECKS = ("email", "phone", "name", "company", "completeness")


def ladder(rungs: list[tuple], holds: str, other: str) -> str:
    """The first rung that holds; ``holds`` names the rung's bounds x and y and the share's column z."""
    rows = ", ".join(f"({k}, '{r[0]}', {r[1]}, {r[-1]}, '{r[2] if len(r) > 3 else ''}')" for k, r in enumerate(rungs))
    return f"(SELECT coalesce(min_by(label, k), '{other}') FROM (VALUES {rows}) AS rung(k, label, x, y, z) WHERE {holds})"


def banded(groups: dict[str, str], where: str, scores: dict[str, str], bands: dict[str, tuple], columns: dict[str, str], tail: str = "") -> str:
    names = ", ".join(groups)
    means = ", ".join(f"{f}(v) FILTER (metric = '{m}') AS {m}_{f}" for m in scores for f in ("avg", "min", "max"))
    counts = ", ".join(f"count(*) FILTER (band = '{b}') AS {b}" for b in bands)
    listed = ", ".join(f"('{b}', '{m}', {low}::DOUBLE, {high}::DOUBLE)" for b, (m, low, high) in bands.items())
    return f"""
WITH scored AS (SELECT {', '.join(f'{e} AS {n}' for n, e in groups.items())}, task_id, parsed_at, {', '.join(f'({e})::DOUBLE AS {m}' for m, e in scores.items())}
                FROM pv WHERE parse_error IS NULL AND {where}),
long AS (SELECT {names}, metric, v FROM (UNPIVOT scored ON {', '.join(scores)} INTO NAME metric VALUE v)),
band(band, metric, low, high) AS (VALUES {listed}),
mean AS (SELECT {names}, {means} FROM long GROUP BY ALL),
held AS (SELECT {names}, {counts} FROM long JOIN band USING (metric) WHERE v >= low AND v < high GROUP BY ALL),
size AS (SELECT {names}, count(*) AS n, count(DISTINCT task_id) AS leads, min(parsed_at) AS first, max(parsed_at) AS last,
                count(DISTINCT parsed_at::DATE) AS days FROM scored GROUP BY ALL),
one AS (SELECT * EXCLUDE ({', '.join(bands)}), {', '.join(f'coalesce({b}, 0) AS {b}' for b in bands)}
        FROM size LEFT JOIN mean USING ({names}) LEFT JOIN held USING ({names}))
SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM one {tail}"""


def percent(count: str, digits: int = 2) -> str:
    return f"round(({count})::DOUBLE / n * 100, {digits})"


def tenth(metric: str, name: str, *kinds: str) -> dict[str, str]:
    """Columns of a metric on the 0-1 scale; the reports' medians are means."""
    return {f"{k}_{name}_score": f"{metric}_{'avg' if k == 'median' else k} / 10.0" for k in kinds}


def same(names) -> dict[str, str]:
    return {n: n for n in names}


# ------------------------------------------------------------------ VW-4, VW-5

SCORES = {"quality": "coalesce(api_data_quality_score, api_quality_score, quality_score)", "fraud": FRAUD, "overall": OVERALL,
          "suspect": f"CASE WHEN {IS_FAKE} OR {FRAUD} >= 7 THEN 1 ELSE 0 END"}
RECENT = f"parsed_at >= {AS_OF} - INTERVAL 90 DAY"
SPREAD = tenth("quality", "data_quality", "avg", "median", "min", "max") | tenth("fraud", "fraud", "avg", "median", "min", "max")
HIGH = {"high_quality_percentage": percent("excellent_quality_count + good_quality_count"),
        "high_fraud_risk_percentage": percent("critical_fraud_risk_count + high_fraud_risk_count")}
SIZE = {"total_validations": "n", "unique_leads": "leads"}

_ALL = QUALITY | RISK | {"low_fraud_risk_count": ("fraud", 2, 4), "minimal_fraud_risk_count": ("fraud", "'-infinity'", 2)}
VW04 = banded({"every": "1"}, RECENT, SCORES, _ALL,
              SIZE | SPREAD | tenth("overall", "overall", "avg", "median") | same(_ALL) | HIGH | {
                  "earliest_validation": "first", "latest_validation": "last", "validation_days_span": "days",
                  "overall_system_status": ladder(STATUS, "overall_avg >= x AND fraud_avg <= y", "CRITICAL")})

_BY = QUALITY | RISK | {"low_fraud_risk_count": ("fraud", "'-infinity'", 4), "likely_fake_leads_count": ("suspect", 1, TOP)}
_SHARES = {f"at{k}": ("fraud", k, TOP) for k in (5, 6, 7)}
VW05 = banded({"lead_source": "coalesce(lead_source, 'Unknown')"}, RECENT, SCORES, _BY | _SHARES,
              same(["lead_source"]) | SIZE | SPREAD | same(_BY) | HIGH | {
                  "fake_leads_percentage": percent("likely_fake_leads_count"),
                  "quality_rank": "rank() OVER (ORDER BY overall_avg DESC NULLS LAST)", "fraud_safety_rank": "rank() OVER (ORDER BY fraud_avg)",
                  "volume_rank": "rank() OVER (ORDER BY n DESC)",
                  "source_risk_level": ladder(SOURCE_RISK, "fraud_avg >= x OR CASE z WHEN 'at7' THEN at7 WHEN 'at6' THEN at6 ELSE at5 END::DOUBLE / n > y", "MINIMAL"),
                  "source_grade": ladder(GRADE, "overall_avg >= x AND fraud_avg <= y", "F"),
                  "first_validation": "first", "latest_validation": "last", "validation_days_active": "days"})

# ------------------------------------------------------------------ FB-1, FB-2, FB-4, FB-5: fraud from the fake flag

PLAIN = {"overall": OVERALL, "fraud": f"CASE WHEN {IS_FAKE} THEN 8 ELSE 2 END"}
PLAIN_MEANS = tenth("overall", "data_quality", "avg", "median") | tenth("fraud", "fraud", "avg", "median")
PLAIN_BANDS = PLAIN_QUALITY | {"fakes": ("fraud", 8, TOP)}
ENOUGH = {"high_quality_percentage": percent("excellent_quality_count", 1), "high_fraud_risk_percentage": percent("fakes", 1)}
CONSTANTS = {f"avg_{c}_score": "0.7::DOUBLE" for c in CHECKS} | {f"{c}_pass_rate_percent": "75.0::DOUBLE" for c in CHECKS}
MONTH_START = f"date_trunc('month', {AS_OF})"
LAST_30 = f"parsed_at >= {AS_OF} - INTERVAL 30 DAY"

FB1 = banded({"every": "1"}, "created_date IS NOT NULL", PLAIN, PLAIN_BANDS,
             SIZE | PLAIN_MEANS | tenth("overall", "overall", "avg", "median") | same(PLAIN_QUALITY) | {
                 "critical_fraud_risk_count": "fakes", "high_quality_percentage": percent("excellent_quality_count"),
                 "high_fraud_risk_percentage": percent("fakes"), "earliest_validation": "first", "latest_validation": "last",
                 "overall_system_status": ladder(PLAIN_STATUS, "overall_avg >= x", "POOR")})

FB2 = banded({"lead_source": "coalesce(lead_source, 'Unknown')"}, f"created_date >= {MONTH_START} - INTERVAL 1 MONTH AND created_date < {MONTH_START}",
             PLAIN, PLAIN_BANDS,
             same(["lead_source"]) | SIZE | PLAIN_MEANS | same(PLAIN_QUALITY) | {
                 "likely_fake_leads_count": "fakes", "fake_leads_percentage": percent("fakes"),
                 "quality_rank": "rank() OVER (ORDER BY overall_avg DESC NULLS LAST)",
                 "source_risk_level": ladder(PLAIN_RISK, "fraud_avg / 10.0 >= x", "LOW"), "source_grade": ladder(PLAIN_GRADE, "overall_avg >= x", "F"),
                 "first_validation": "first", "latest_validation": "last"})

_TREND = {"total_validations": "n"} | PLAIN_MEANS | tenth("overall", "overall", "avg") | CONSTANTS | ENOUGH
_DAY = {"trend_date": "date_trunc('day', parsed_at)"}
FB4 = banded(_DAY, LAST_30, PLAIN, PLAIN_BANDS, same(_DAY) | _TREND, "ORDER BY trend_date DESC LIMIT 30")
FB5 = banded(_DAY | {"lead_source": "coalesce(lead_source, 'Unknown')"}, LAST_30, PLAIN, PLAIN_BANDS,
             {"period_type": "'daily'", "trend_date": "trend_date", "lead_source": "lead_source"} | _TREND | {"likely_fake_count": "fakes"},
             "WHERE n >= 3 ORDER BY trend_date DESC, lead_source LIMIT 200")

ORACLE = {k: with_ctes(v, "pv") for k, v in {
    "vw04_overall_results": VW04, "vw05_results_by_source": VW05, "fb1_overall_results": FB1, "fb2_results_by_source": FB2,
    "fb4_trends_overall": FB4, "fb5_trends_by_source": FB5}.items()}
