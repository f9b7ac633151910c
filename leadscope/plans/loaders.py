"""Loader queries (LQ-*) and the dashboard's fallback variants (FB-*).

Top-k loaders use ``orderBy(...).limit(k)`` with a unique tie-break, which
Spark plans as TakeOrderedAndProject: every partition keeps its own top k and
only k rows per partition reach the final merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions.exprs import (as_of_ts, count_if, day, days_before, dbl, ladder, pct, rank_by, ratio,
                               round_half_away, trunc_ntz)
from . import reports_pv as rp

PERIODS = ("All Time", "Last 30 Days", "Last 7 Days", "This Month", "Last Month")

# Default texts and formats of the loaders.
NO_FACTORS = "No specific factors"
FB_DEFAULTS = {"fraud_factors": "No specific fraud factors identified",
               "quality_factors": "No specific quality factors identified",
               "summary_notes": "Flagged as fake lead", "quality_level": "unknown", "recommended_action": "review"}
REFRESH_FORMAT = "hh:mm a 'on' MMMM dd, yyyy"      # e.g. "03:00 PM on August 01, 2001"


def period_filter(df: DataFrame, period: str, as_of, col: str = "created_date") -> DataFrame:
    """PRJ-6: named period on ``col`` relative to ``as_of``."""
    c = F.col(col)
    month = F.date_trunc("month", F.lit(str(as_of)).cast("timestamp_ntz")).cast("timestamp_ntz")
    if period == "Last 30 Days":
        return df.filter(c >= days_before(as_of, 30))
    if period == "Last 7 Days":
        return df.filter(c >= days_before(as_of, 7))
    if period == "This Month":
        return df.filter(c >= month)
    if period == "Last Month":
        return df.filter((c >= F.add_months(month, -1).cast("timestamp_ntz")) & (c < month))
    if period == "All Time":
        return df.filter(c.isNotNull())
    raise ValueError(f"unknown period {period!r}; expected one of {PERIODS}")


def date_range_filter(df: DataFrame, start: str, end: str, col: str = "created_date") -> DataFrame:
    """PRJ-8: inclusive day range ``start 00:00:00 .. end 23:59:59``."""
    lo = F.lit(f"{start} 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{end} 23:59:59").cast("timestamp_ntz")
    return df.filter((F.col(col) >= lo) & (F.col(col) <= hi))


def _lead_row(q: Column) -> list[Column]:
    return [q.alias("overall_score"), S.status_band(q).alias("validation_status"), *S.contact_columns()]


def _first(rows: DataFrame, limit: int | None, *order: Column) -> DataFrame:
    """The first ``limit`` rows in an order; all rows, unordered, without a limit (what aggregates are fed with)."""
    return rows if limit is None else rows.orderBy(*order).limit(limit)


# ------------------------------------------------------------------ LQ-2, LQ-5, LQ-6

def lead_list(pv: DataFrame, limit: int | None = 1000) -> DataFrame:
    """LQ-2: newest leads with score band, contact data and conversion stub."""
    q = S.quality()
    return (_first(S.good_rows(pv), limit, F.col("parsed_at").desc_nulls_last(), F.col("task_id"))
            .select("task_id", F.col("who_id").alias("lead_id"), "lead_source", *_lead_row(q),
                    "created_date", "last_modified_date", F.lit(False).alias("is_converted"),
                    F.lit(None).cast("timestamp_ntz").alias("converted_date"),
                    F.col("parsed_at").alias("validation_timestamp")))


def recent_validations(pv: DataFrame, limit: int | None = 100) -> DataFrame:
    """LQ-5: the ``limit`` most recently parsed validations."""
    q = S.quality()
    return (_first(S.good_rows(pv), limit, F.col("parsed_at").desc_nulls_last(), F.col("task_id"))
            .select(F.col("task_id").alias("lead_id"), F.col("parsed_at").alias("validation_timestamp"),
                    *_lead_row(q), "lead_source", F.lit(False).alias("is_converted")))


def problematic_leads(pv: DataFrame, score_threshold: float = 6, limit: int | None = 500) -> DataFrame:
    """LQ-6: leads with quality below ``score_threshold`` (0-10 scale), worst first."""
    q = S.quality()
    return (_first(S.good_rows(pv).filter(q < score_threshold), limit,
                   q.asc(), F.col("parsed_at").desc_nulls_last(), F.col("task_id"))
            .select(F.col("task_id").alias("lead_id"), *_lead_row(q), "lead_source",
                    F.col("parsed_at").alias("validation_timestamp"), F.lit(False).alias("is_converted")))


# ------------------------------------------------------------------ LQ-4

def daily_trends(pv: DataFrame, as_of, days: int = 30, limit: int = 30) -> DataFrame:
    """LQ-4: daily volume/score on ``created_date`` over the last ``days``.
    ``converted_leads``/``conversion_rate`` carry the *fake* count and rate."""
    q = S.quality()
    rows = S.good_rows(pv).filter(F.col("created_date") >= days_before(as_of, days))
    a = rows.groupBy(day("created_date").alias("period_start")).agg(
        F.count(F.lit(1)).alias("leads_validated"), F.avg(q).alias("_avg"),
        count_if(q >= 7).alias("quality_leads"), count_if(S.is_fake()).alias("converted_leads"),
        F.count_distinct("lead_source").alias("unique_sources"))
    w = Window.orderBy("period_start")
    n = F.col("leads_validated")
    prev = F.lag("_avg").over(w)
    out = a.select(
        F.lit("daily").alias("period_type"), "period_start",
        (F.col("period_start") + F.expr("INTERVAL 1 DAY")).alias("period_end"),
        "leads_validated", round_half_away("_avg", 4).alias("avg_score"),
        "quality_leads", pct("quality_leads", n).alias("quality_percentage"),
        "converted_leads", pct("converted_leads", n).alias("conversion_rate"),
        "unique_sources", prev.alias("prev_avg_score"),
        round_half_away(F.col("_avg") - prev, 4).alias("score_change"),
        F.lag(n).over(w).alias("prev_volume"), (n - F.lag(n).over(w)).alias("volume_change"))
    return out.orderBy(F.col("period_start").desc()).limit(limit)


# ------------------------------------------------------------------ LQ-7

def quality_category_analysis(pv: DataFrame) -> DataFrame:
    """LQ-7: per score category: count, fake count ('converted'), fake rate, mean score."""
    q = S.quality()
    a = (S.good_rows(pv).groupBy(S.status_band(q).alias("score_category"))
         .agg(F.count(F.lit(1)).alias("total_leads"), count_if(S.is_fake()).alias("converted_leads"),
              F.avg(q).alias("avg_score")))
    order = F.when(F.col("score_category") == "Excellent", 1).when(F.col("score_category") == "Good", 2) \
        .when(F.col("score_category") == "Fair", 3).when(F.col("score_category") == "Poor", 4).otherwise(5)
    return (a.select("score_category", "total_leads", "converted_leads",
                     pct("converted_leads", "total_leads").alias("conversion_rate"), "avg_score")
            .orderBy(order))


# ------------------------------------------------------------------ LQ-9, LQ-10, LQ-13

def top_worst_sources(pv: DataFrame, limit: int = 20) -> DataFrame:
    """LQ-9: the ``limit`` worst sources of VW-2."""
    w = rp.worst_lead_sources(rp.source_quality_summary(pv, ordered=False), ordered=False)
    return w.orderBy(F.col("problem_score").desc_nulls_last(), F.col("total_leads").desc(),
                     "remediation_priority").limit(limit)


def data_freshness(pv: DataFrame, as_of, keyed: bool = False) -> DataFrame:
    """LQ-10: last validation time, counts, mean score and a freshness label
    (Fresh <= 24 h, Recent <= 168 h, else Stale; 'No data' when empty).
    ``keyed``: the table has one row per task."""
    a = S.good_rows(pv).agg(F.max("parsed_at").alias("last_validation"),
                            rp.task_count(keyed).alias("total_leads"),
                            F.count(F.lit(1)).alias("total_validations"),
                            F.avg(S.quality()).alias("avg_score"))
    hours = F.timestamp_diff("SECOND", F.col("last_validation"), as_of_ts(as_of)).cast("double") / 3600.0
    last = F.col("last_validation")
    return a.select(
        ladder([(last.isNull(), "No data"), (hours <= 24, "Fresh"), (hours <= 168, "Recent")], "Stale").alias("status"),
        "last_validation", hours.alias("hours_since_validation"),
        F.when(last.isNull(), F.lit(0).cast("bigint")).otherwise(F.col("total_leads")).alias("total_leads"),
        F.when(last.isNull(), F.lit(0).cast("bigint")).otherwise(F.col("total_validations")).alias("total_validations"),
        F.coalesce(F.col("avg_score"), dbl(0.0)).alias("avg_score"))


def last_refresh_time(pv: DataFrame) -> DataFrame:
    """LQ-13: newest good ``parsed_at`` as text ('hh:mm AM on Month dd, yyyy')."""
    m = S.good_rows(pv).agg(F.max("parsed_at").alias("_m"))
    txt = F.date_format(F.col("_m"), REFRESH_FORMAT)
    return m.select(F.coalesce(txt, F.lit("Unknown")).alias("last_refresh"))


# ------------------------------------------------------------------ LQ-11, LQ-12

def daily_fake_leads(pv: DataFrame, start: str, end: str, as_of) -> DataFrame:
    """LQ-11: fake leads per source in an inclusive date range; the risk level,
    rank and percentage alert use the unrounded percentage."""
    f0, fake = S.fraud0(), S.is_fake()
    rows = date_range_filter(S.good_rows(pv), start, end)
    a = rows.groupBy(S.source().alias("lead_source")).agg(
        F.count(F.lit(1)).alias("total_leads_today"), count_if(fake).alias("fake_leads_count"),
        count_if(f0 >= 8).alias("critical_fraud_count"),
        F.avg(S.quality()).alias("avg_quality_score"), F.avg(f0).alias("avg_fraud_score"),
        F.min("created_date").alias("earliest_lead_today"), F.max("created_date").alias("latest_lead_today"))
    t, fc = F.col("total_leads_today"), F.col("fake_leads_count")
    raw = ratio(fc, t) * 100.0
    out = a.select(
        "lead_source", "total_leads_today", "fake_leads_count", "critical_fraud_count",
        pct(fc, t).alias("fake_leads_percentage"), pct("critical_fraud_count", t).alias("critical_fraud_percentage"),
        "avg_quality_score", "avg_fraud_score",
        ladder([(raw >= 50, "CRITICAL"), (raw >= 20, "HIGH"), (raw >= 10, "MEDIUM"), (fc > 0, "LOW")],
               "CLEAN").alias("daily_risk_level"),
        rank_by(raw.desc_nulls_last()).alias("worst_source_rank"),
        (fc >= 3).alias("alert_volume"), (raw >= 25).alias("alert_percentage"),
        "earliest_lead_today", "latest_lead_today", as_of_ts(as_of).alias("report_date"))
    return out.orderBy(F.col("fake_leads_percentage").desc(), fc.desc(), "lead_source")


def daily_fake_leads_detail(pv: DataFrame, start: str, end: str) -> DataFrame:
    """LQ-12: fake or high-risk (fraud >= 8) leads in the range, typed FAKE/HIGH_RISK."""
    f0, fake = S.fraud0(), S.is_fake()
    rows = date_range_filter(S.good_rows(pv), start, end).filter(fake | (f0 >= 8))
    return rows.select(
        F.col("task_id").alias("lead_id"), "lead_source", *S.contact_columns(),
        f0.alias("fraud_score"),
        F.coalesce("api_fraud_factors", F.lit(NO_FACTORS)).alias("fraud_factors"),
        F.coalesce("api_quality_factors", F.lit(NO_FACTORS)).alias("quality_factors"),
        F.coalesce("api_recommendation", F.lit("review")).alias("recommendation"),
        fake.alias("is_fake"), "created_date", "parsed_at",
        ladder([(fake, "FAKE"), (f0 >= 8, "HIGH_RISK")], "OTHER").alias("lead_type"))


# ------------------------------------------------------------------ LQ-14, LQ-15

def creation_month_analysis(pv: DataFrame) -> DataFrame:
    """LQ-14: quality, fraud and fake share per creation month."""
    q, fake = S.quality(), S.is_fake()
    rows = S.good_rows(pv).filter(F.col("created_date").isNotNull())
    a = rows.groupBy(trunc_ntz("month", "created_date").alias("creation_month")).agg(
        F.count(F.lit(1)).alias("total_leads"),
        (F.avg(S.data_quality3()) / 10.0).alias("avg_data_quality_score"),
        (F.avg(S.fraud0()) / 10.0).alias("avg_fraud_score"),
        count_if(fake).alias("fake_leads_count"), count_if(q >= 7).alias("_hq"),
        F.count_distinct("lead_source").alias("unique_sources"),
        F.avg(F.coalesce(F.col("api_lead_score"), F.lit(0))).alias("avg_lead_score"))
    t = F.col("total_leads")
    return a.select("creation_month", "total_leads", "avg_data_quality_score", "avg_fraud_score",
                    "fake_leads_count", pct("fake_leads_count", t).alias("fake_leads_percentage"),
                    pct("_hq", t).alias("high_quality_percentage"), "unique_sources", "avg_lead_score") \
        .orderBy(F.col("creation_month").desc())


def source_month_performance(pv: DataFrame, min_leads: int = 5) -> DataFrame:
    """LQ-15: (creation month, source) performance; NULL source dropped; >= ``min_leads``."""
    rows = S.good_rows(pv).filter(F.col("created_date").isNotNull() & F.col("lead_source").isNotNull())
    a = rows.groupBy(trunc_ntz("month", "created_date").alias("creation_month"), "lead_source").agg(
        F.count(F.lit(1)).alias("total_leads"),
        (F.avg(S.data_quality3()) / 10.0).alias("avg_data_quality_score"),
        (F.avg(S.fraud0()) / 10.0).alias("avg_fraud_score"),
        count_if(S.is_fake()).alias("fake_leads_count"))
    a = a.filter(F.col("total_leads") >= min_leads)
    return a.withColumn("fake_leads_percentage", pct("fake_leads_count", "total_leads")) \
        .orderBy(F.col("creation_month").desc(), F.col("avg_data_quality_score").desc(), "lead_source")


# ------------------------------------------------------------------ FB-1 .. FB-5

def _fake_proxy_avg() -> Column:
    """Fallback fraud proxy AVG(0.8 if fake else 0.2), summed exactly as tenths."""
    return F.avg(F.when(S.is_fake(), 8).otherwise(2)) / 10.0


def overall_results(pv: DataFrame, as_of, date_filter: str = "All Time", variant: str = "fallback",
                    keyed: bool = False) -> DataFrame:
    """FB-1 (``variant='fallback'``) or VW-4 (``'view'``)."""
    if variant == "view":
        return rp.simplified_overall_results(pv, as_of, keyed=keyed)
    q, fake = S.quality(), S.is_fake()
    rows = period_filter(S.good_rows(pv), date_filter, as_of)
    a = rows.agg(
        F.count(F.lit(1)).alias("total_validations"), rp.task_count(keyed).alias("unique_leads"),
        (F.avg(q) / 10.0).alias("avg_data_quality_score"), (F.avg(q) / 10.0).alias("median_data_quality_score"),
        _fake_proxy_avg().alias("avg_fraud_score"), _fake_proxy_avg().alias("median_fraud_score"),
        (F.avg(q) / 10.0).alias("avg_overall_score"), (F.avg(q) / 10.0).alias("median_overall_score"),
        count_if(q >= 7).alias("excellent_quality_count"),
        count_if((q >= 5) & (q < 7)).alias("good_quality_count"),
        count_if((q >= 3) & (q < 5)).alias("fair_quality_count"),
        count_if(q < 3).alias("poor_quality_count"),
        count_if(fake).alias("critical_fraud_risk_count"),
        F.min("parsed_at").alias("earliest_validation"), F.max("parsed_at").alias("latest_validation"),
        F.avg(q).alias("_aq"))
    t = F.col("total_validations")
    aq = F.col("_aq")
    return a.select(
        "total_validations", "unique_leads", "avg_data_quality_score", "median_data_quality_score",
        "avg_fraud_score", "median_fraud_score", "avg_overall_score", "median_overall_score",
        "excellent_quality_count", "good_quality_count", "fair_quality_count", "poor_quality_count",
        "critical_fraud_risk_count",
        pct("excellent_quality_count", t).alias("high_quality_percentage"),
        pct("critical_fraud_risk_count", t).alias("high_fraud_risk_percentage"),
        "earliest_validation", "latest_validation",
        ladder([(aq >= 8, "EXCELLENT"), (aq >= 6, "GOOD"), (aq >= 4, "FAIR")], "POOR").alias("overall_system_status"))


def results_by_source(pv: DataFrame, as_of, date_filter: str = "All Time", variant: str = "fallback",
                      keyed: bool = False) -> DataFrame:
    """FB-2 or VW-5."""
    if variant == "view":
        return rp.simplified_results_by_source(pv, as_of, keyed=keyed)
    q, fake = S.quality(), S.is_fake()
    rows = period_filter(S.good_rows(pv), date_filter, as_of)
    a = rows.groupBy(S.source().alias("lead_source")).agg(
        F.count(F.lit(1)).alias("total_validations"), rp.task_count(keyed).alias("unique_leads"),
        F.avg(q).alias("_aq"), _fake_proxy_avg().alias("avg_fraud_score"),
        count_if(q >= 7).alias("excellent_quality_count"),
        count_if((q >= 5) & (q < 7)).alias("good_quality_count"),
        count_if((q >= 3) & (q < 5)).alias("fair_quality_count"),
        count_if(q < 3).alias("poor_quality_count"),
        count_if(fake).alias("likely_fake_leads_count"),
        F.min("parsed_at").alias("first_validation"), F.max("parsed_at").alias("latest_validation"))
    aq, af, t = F.col("_aq"), F.col("avg_fraud_score"), F.col("total_validations")
    out = a.select(
        "lead_source", "total_validations", "unique_leads",
        (aq / 10.0).alias("avg_data_quality_score"), (aq / 10.0).alias("median_data_quality_score"),
        "avg_fraud_score", F.col("avg_fraud_score").alias("median_fraud_score"),
        "excellent_quality_count", "good_quality_count", "fair_quality_count", "poor_quality_count",
        "likely_fake_leads_count", pct("likely_fake_leads_count", t).alias("fake_leads_percentage"),
        rank_by(aq.desc_nulls_last()).alias("quality_rank"),
        ladder([(af >= 0.7, "CRITICAL"), (af >= 0.5, "HIGH"), (af >= 0.3, "MEDIUM")], "LOW").alias("source_risk_level"),
        ladder([(aq >= 9, "A+"), (aq >= 7, "A"), (aq >= 5, "B"), (aq >= 3, "C")], "F").alias("source_grade"),
        "first_validation", "latest_validation")
    return out.orderBy(F.col("avg_data_quality_score").desc_nulls_last(), "lead_source")


def fake_leads(pv: DataFrame, as_of, date_filter: str = "All Time", variant: str = "fallback",
               limit: int | None = 100) -> DataFrame:
    """FB-3 (fake or fraud >= 5, API values first, worst 100) or VW-6 top 100."""
    if variant == "view":
        d = rp.fake_leads_detail(pv)
        return _first(d, limit, F.col("fraud_score").desc(), F.col("lead_id"))
    f0, q = S.fraud0(), S.quality()
    rows = period_filter(S.good_rows(pv), date_filter, as_of).filter(S.is_fake() | (f0 >= 5))
    email = F.coalesce(F.col("api_email"), F.col("lead_email"))
    top = _first(rows, limit, f0.desc(), q.asc_nulls_last(), F.col("task_id"))
    return top.select(
        F.col("task_id").alias("lead_id"), "lead_source", F.col("parsed_at").alias("validation_timestamp"),
        *S.contact_columns(),
        (S.data_quality3() / 10.0).alias("data_quality_score"), (f0 / 10.0).alias("fraud_score"),
        (q / 10.0).alias("overall_score"),
        F.coalesce(F.col("api_fraud_risk_level"),
                   ladder([(f0 >= 8, "high"), (f0 >= 5, "medium")], "low")).alias("fraud_risk_level"),
        F.coalesce(F.col("api_email_valid"), email.isNotNull() & (email != "")).alias("email_valid"),
        F.coalesce(F.col("api_phone_valid"),
                   F.col("api_phone").isNotNull() & (F.col("api_phone") != "")).alias("phone_valid"),
        *[F.coalesce(f"api_{k}" if k != "recommended_action" else "api_recommendation", F.lit(v)).alias(k)
          for k, v in FB_DEFAULTS.items()],
        "api_fake_lead", "api_market_segment", "raw_api_response", "raw_description")


def _fallback_trend_cols(q: Column, n: Column) -> list[Column]:
    consts = [dbl(0.7).alias(f"avg_{p}_score") for p in ("email", "phone", "name", "company", "completeness")]
    consts += [dbl(75.0).alias(f"{p}_pass_rate_percent") for p in ("email", "phone", "name", "company", "completeness")]
    return consts


def trends_overall(pv: DataFrame, as_of, days: int = 30, limit: int = 30) -> DataFrame:
    """FB-4: daily trends on ``parsed_at``; point scores are fixed placeholders."""
    q = S.quality()
    rows = S.good_rows(pv).filter(F.col("parsed_at") >= days_before(as_of, days))
    a = rows.groupBy(day("parsed_at").alias("trend_date")).agg(
        F.count(F.lit(1)).alias("total_validations"), F.avg(q).alias("_aq"),
        _fake_proxy_avg().alias("avg_fraud_score"),
        count_if(q >= 7).alias("_hq"), count_if(S.is_fake()).alias("_fk"))
    n, aq = F.col("total_validations"), F.col("_aq")
    return a.select(
        "trend_date", "total_validations", (aq / 10.0).alias("avg_data_quality_score"),
        (aq / 10.0).alias("median_data_quality_score"), "avg_fraud_score",
        F.col("avg_fraud_score").alias("median_fraud_score"), (aq / 10.0).alias("avg_overall_score"),
        *_fallback_trend_cols(q, n),
        pct("_hq", n, 1).alias("high_quality_percentage"), pct("_fk", n, 1).alias("high_fraud_risk_percentage"),
    ).orderBy(F.col("trend_date").desc()).limit(limit)


def trends_by_source(pv: DataFrame, as_of, sources: Sequence[str] | None = None, days: int = 30,
                     min_count: int = 3, limit: int = 200) -> DataFrame:
    """FB-5: daily per-source trends on ``parsed_at``, optional source list, >= ``min_count`` rows."""
    q = S.quality()
    rows = S.good_rows(pv).filter(F.col("parsed_at") >= days_before(as_of, days)) \
        .withColumn("lead_source", S.source())
    if sources:
        rows = rows.filter(F.col("lead_source").isin(*sources))
    a = rows.groupBy(day("parsed_at").alias("trend_date"), "lead_source").agg(
        F.count(F.lit(1)).alias("total_validations"), F.avg(q).alias("_aq"),
        _fake_proxy_avg().alias("avg_fraud_score"),
        count_if(q >= 7).alias("_hq"), count_if(S.is_fake()).alias("likely_fake_count"))
    a = a.filter(F.col("total_validations") >= min_count)
    n, aq = F.col("total_validations"), F.col("_aq")
    return a.select(
        F.lit("daily").alias("period_type"), "trend_date", "lead_source", "total_validations",
        (aq / 10.0).alias("avg_data_quality_score"), (aq / 10.0).alias("median_data_quality_score"),
        "avg_fraud_score", F.col("avg_fraud_score").alias("median_fraud_score"),
        (aq / 10.0).alias("avg_overall_score"), *_fallback_trend_cols(q, n),
        pct("_hq", n, 1).alias("high_quality_percentage"),
        pct("likely_fake_count", n, 1).alias("high_fraud_risk_percentage"), "likely_fake_count",
    ).orderBy(F.col("trend_date").desc(), "lead_source").limit(limit)
