"""Lists of the HTML reports, the dashboard and the ETL log: the tables beside the one-row summaries of DD-14, 17, 18, 19, 21.

Each is a top-k over a report or loader (``n`` rows, the report's feature): an ordered limit, which Spark runs as one
bounded heap per partition. Every order ends in a unique column. Empty inputs give empty lists; missing names, companies
and sources get the reports' texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .datasets import round_half_even

# Labels of the report's band table and texts that must read as in the reports.
BANDS = {"excellent": "Excellent (0.9-1.0)", "good": "Good (0.8-0.9)", "fair": "Fair (0.6-0.8)", "poor": "Poor (0.4-0.6)",
         "invalid": "Invalid (0.0-0.4)"}
MISSING, UNKNOWN, REVIEW = "N/A", "Unknown", "Review Required"


def worst_sources(worst: DataFrame, n: int = 10) -> DataFrame:
    """DD-14: the first ``n`` sources of VW-2, most urgent first."""
    return worst.orderBy("remediation_priority").limit(n).select(
        "lead_source", "total_leads", round_half_even(F.col("avg_quality_score"), 1).alias("avg_quality_score"),
        "quality_grade", round_half_even(F.col("fake_leads_percentage"), 1).alias("fake_leads_percentage"),
        "risk_level", "recommendation", "remediation_priority")


def recent_trends(trends: DataFrame, n: int = 7) -> DataFrame:
    """DD-17: the latest ``n`` days of LQ-4."""
    return trends.orderBy(F.col("period_start").desc()).limit(n).select(
        F.date_format("period_start", "yyyy-MM-dd").alias("period_start"), "leads_validated",
        round_half_even(F.col("avg_score"), 3).alias("avg_score"), "quality_percentage", "conversion_rate")


def band_table(metrics: DataFrame) -> DataFrame:
    """DD-18: the five score bands of VW-10 as rows."""
    rows = [F.struct(F.lit(i).alias("position"), F.lit(label).alias("band"), F.col(f"{k}_count").alias("leads"),
                     F.col(f"{k}_percentage").alias("percentage")) for i, (k, label) in enumerate(BANDS.items(), 1)]
    return metrics.select(F.inline(F.array(*rows)))


def best_sources(by_source: DataFrame, n: int = 10) -> DataFrame:
    """DD-18: the first ``n`` sources of VW-11, best mean score first."""
    return (by_source.orderBy(F.col("avg_score").desc_nulls_last(), "lead_source").limit(n)
            .select("lead_source", "total_leads", "avg_score", "quality_percentage", "conversion_rate"))


def _worst_first(problematic: DataFrame, n: int) -> DataFrame:
    return problematic.orderBy("overall_score", F.col("validation_timestamp").desc_nulls_last(), "lead_id").limit(n)


def worst_leads(problematic: DataFrame, n: int = 20) -> DataFrame:
    """DD-18: the ``n`` worst leads of LQ-6 with the report's texts for what is missing."""
    def text(c: str, other: str) -> F.Column:
        return F.coalesce(F.when(F.col(c) != "", F.col(c)), F.lit(other)).alias(c)

    name = F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "), F.coalesce("last_name", F.lit(""))).alias("name")
    return _worst_first(problematic, n).select("lead_id", "overall_score", name, text("company", MISSING),
                                               text("email", MISSING), text("lead_source", UNKNOWN))


def review_list(problematic: DataFrame, n: int = 50) -> DataFrame:
    """DD-19: the first ``n`` leads below the threshold."""
    return _worst_first(problematic, n).select("lead_id", "overall_score", "validation_status", F.lit(REVIEW).alias("issues"))


def last_means(means: DataFrame, n: int = 3) -> DataFrame:
    """DD-21 / SRT-5: the last ``n`` sources of the ETL's ranking (those without a mean stand last)."""
    return means.orderBy(F.col("avg_quality").asc_nulls_first(), F.col("lead_source").desc()).limit(n)
