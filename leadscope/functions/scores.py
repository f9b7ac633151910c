"""Derived score columns of ``parsed_validations`` (0-10 integer scale).

The model's central rule: the API value wins, else the value parsed from the
text sections. Defined once here so every report agrees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exprs import flag


def quality() -> Column:
    return F.coalesce(F.col("api_quality_score"), F.col("quality_score"))


def lead() -> Column:
    return F.coalesce(F.col("api_lead_score"), F.col("lead_score"))


def fraud() -> Column:
    """Fraud score with text fallback (source-quality family)."""
    return F.coalesce(F.col("api_fraud_score"), F.col("fraud_score"))


def fraud0() -> Column:
    """Fraud score with 0 default (simplified/daily family)."""
    return F.coalesce(F.col("api_fraud_score"), F.lit(0))


def data_quality() -> Column:
    return F.coalesce(F.col("api_data_quality_score"), F.col("data_quality"))


def data_quality3() -> Column:
    """Data quality falling back to the quality score (simplified family)."""
    return F.coalesce(F.col("api_data_quality_score"), F.col("api_quality_score"), F.col("quality_score"))


def recommendation_upper() -> Column:
    return F.upper(F.coalesce(F.col("api_recommendation"), F.col("recommendation")))


def is_fake() -> Column:
    return flag("api_fake_lead")


def source() -> Column:
    return F.coalesce(F.col("lead_source"), F.lit("Unknown"))


def good_rows(pv: DataFrame) -> DataFrame:
    """Rows that parsed cleanly; every report excludes the others."""
    return pv.filter(F.col("parse_error").isNull())


def contact_columns() -> list[Column]:
    """Contact projection shared by the row-level reports."""
    return [
        F.coalesce(F.col("api_first_name"), F.lit("")).alias("first_name"),
        F.coalesce(F.col("api_last_name"), F.lit("")).alias("last_name"),
        F.coalesce(F.col("api_email"), F.col("lead_email")).alias("email"),
        F.coalesce(F.col("api_phone"), F.lit("")).alias("phone"),
        F.coalesce(F.col("api_company"), F.col("lead_company")).alias("company"),
    ]


def status_band(q: Column) -> Column:
    """Excellent/Good/Fair/Poor/Invalid at 9/7/5/3; NULL is Invalid."""
    return (F.when(q >= 9, "Excellent").when(q >= 7, "Good").when(q >= 5, "Fair")
            .when(q >= 3, "Poor").otherwise("Invalid"))
