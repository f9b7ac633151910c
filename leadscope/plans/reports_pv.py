"""Reports over ``parsed_validations`` (0-10 integer scores): VW-1 .. VW-8.

Shape of every report: filter (pushed to the scan) -> one hash aggregate per
report key (partial aggregation before the shuffle absorbs a hot source) ->
windows over the *aggregated* rows only -> ladders. Global RANK windows see at
most one row per source, never raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions.chunks import SIZE, ordered_chunks
from ..functions.exprs import (as_of_ts, combine_rows, count_if, date_diff_days, day, days_before, dbl, flag, ladder,
                               pct, rank_by, ratio, round_half_away, trunc_ntz)
from ..functions.joins import shared

# Sources treated as high volume by the status-anomaly report.
HIGH_VOLUME_SOURCES = ("businessloans.com", "Lending Tree", "Fundera")

# Report texts that must read exactly as in the source reports ("{}" marks the value).
WORST_ISSUES = {"low_quality": "Very Low Quality Score ({})", "high_fraud": "High Fraud Score ({})",
                "fake_rate": "High Fake Lead Rate ({}%)", "low_quality_rate": "Low Quality Lead Rate ({}%)",
                "multiple": "Multiple Issues"}
WORST_RECOMMENDATIONS = {"urgent": "URGENT: Suspend source immediately",
                         "high": "HIGH: Review source criteria and validation",
                         "improve": "MEDIUM: Improve source quality controls",
                         "investigate": "MEDIUM: Investigate fake lead patterns",
                         "monitor": "LOW: Monitor closely"}
DETAIL_SUMMARIES = {"critical": "Multiple fraud indicators detected - HIGH PRIORITY",
                    "high": "Likely fraudulent lead - investigate",
                    "medium": "Suspicious patterns found - review recommended",
                    "low": "Minor quality issues detected"}
DAILY_STATUS = {"immediate": "\U0001F6A8 IMMEDIATE ACTION REQUIRED", "monitor": "⚠️ MONITOR CLOSELY",
                "investigate": "\U0001F50D INVESTIGATE", "clean": "✅ CLEAN TODAY"}
DAILY_ACTIONS = {"pause": "PAUSE SOURCE - Review immediately", "quarantine": "QUARANTINE - Manual review all leads",
                 "investigate": "INVESTIGATE - Check lead quality processes",
                 "monitor": "MONITOR - Track patterns closely", "continue": "CONTINUE - Source performing well"}
ANOMALY_DESCRIPTIONS = {
    "FLAGGED_AS_FAKE": "Lead was explicitly flagged as fake but current status suggests otherwise",
    "CRITICAL_FRAUD_RISK": "Lead had critical fraud score (8+/10) but current status suggests legitimate",
    "HIGH_FRAUD_RISK": "Lead had high fraud score (7+/10) but current status suggests legitimate",
    "RECOMMENDED_REJECT": "Validation system recommended rejection but lead progressed",
    "OTHER_ISSUE": "Other validation concern with positive outcome"}
ANOMALY_ACTIONS = {"CRITICAL": "IMMEDIATE REVIEW - Investigate validation accuracy",
                   "HIGH": "REVIEW REQUIRED - Check for false positive",
                   "MEDIUM": "MONITOR - Track validation performance",
                   "LOW": "DOCUMENT - Note for validation tuning"}


def _quality_bands(q: Column) -> dict[str, Column]:
    return {
        "excellent": count_if(q >= 9),
        "good": count_if((q >= 7) & (q <= dbl(8.99))),
        "fair": count_if((q >= 5) & (q <= dbl(6.99))),
        "poor": count_if((q >= 3) & (q <= dbl(4.99))),
        "invalid": count_if(q < 3),
    }


# --------------------------------------------------------------------- VW-1

#: Counts of the daily partials of a source, merged by sums.
_SUMMED = ("n", "q", "q_n", "lead", "lead_n", "fraud", "fraud_n", "dq", "dq_n", "excellent", "good", "fair", "poor", "invalid",
           "fake", "fake_phone", "disposable", "bounce", "gibberish", "email_ok", "sendable", "phone_ok", "bs",
           "accept", "reject", "review")


def source_days(pv: DataFrame) -> DataFrame:
    """One row of mergeable counts and sums per source and day: what VW-1 and VW-3 are made from, in one scan."""
    scores = {"q": S.quality(), "lead": S.lead(), "fraud": S.fraud(), "dq": S.data_quality()}
    rec = S.recommendation_upper()
    flags = {"fake": flag("api_fake_lead"), "fake_phone": flag("api_fake_phone"), "disposable": flag("api_disposable_email"),
             "bounce": flag("api_bounce_likely", "bounce_likely"), "gibberish": flag("api_gibberish_email"),
             "email_ok": F.coalesce("api_email_valid", "email_valid"),
             "sendable": F.coalesce("api_email_sendable", "email_sendable"),
             "phone_ok": F.coalesce("api_phone_valid", "phone_valid"),
             "accept": rec == "ACCEPT", "reject": rec == "REJECT", "review": rec == "REVIEW"}
    parts = S.good_rows(pv).groupBy("lead_source", day("created_date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        *[x for k, c in scores.items() for x in (F.sum(c).alias(k), F.count(c).alias(f"{k}_n"))],
        *[v.alias(k) for k, v in _quality_bands(S.quality()).items()],
        *[count_if(c).alias(k) for k, c in flags.items()],
        F.sum(F.coalesce(F.col("api_business_strength_score"), F.lit(0))).alias("bs"),
        F.min("created_date").alias("first"), F.max("created_date").alias("last"))
    return shared(parts)


def _merged_days(parts: DataFrame, *keys: Column) -> DataFrame:
    """Partials of :func:`source_days` summed per key (without keys: one row), and the number of days."""
    return parts.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in _SUMMED],
        F.min("first").alias("first"), F.max("last").alias("last"), F.count_distinct("day").alias("days"))


def source_quality_summary(pv: DataFrame | None, ordered: bool = True, parts: DataFrame | None = None) -> DataFrame:
    """VW-1: one row per lead source (NULL -> 'Unknown'), 44 columns; ``parts``: its daily partials, if at hand."""
    parts = parts if parts is not None else source_days(pv)
    m = _merged_days(parts, S.source().alias("lead_source"))
    m = m.select(
        "lead_source", F.col("n").alias("total_leads"),
        *[ratio(k, f"{k}_n").alias(f"_avg_{k}") for k in ("q", "lead", "fraud", "dq")],
        *[F.col(k).alias(f"{k}_count") for k in ("excellent", "good", "fair", "poor", "invalid")],
        F.col("fake").alias("fake_leads"), F.col("fake_phone").alias("fake_phones"),
        F.col("disposable").alias("disposable_emails"), F.col("bounce").alias("bounce_likely_emails"),
        F.col("gibberish").alias("gibberish_emails"),
        ratio("email_ok", "n").alias("_email_valid_rate"), ratio("sendable", "n").alias("_email_sendable_rate"),
        ratio("phone_ok", "n").alias("_phone_valid_rate"), ratio("bs", "n").alias("_avg_bs"),
        *[F.col(k).alias(f"{k}_recommendations") for k in ("accept", "reject", "review")],
        F.col("first").alias("first_validation_date"), F.col("last").alias("last_validation_date"),
        F.col("days").alias("active_days"))
    n = F.col("total_leads")
    m = m.withColumns({
        **{f"{k}_percentage": pct(f"{k}_count", n) for k in ("excellent", "good", "fair", "poor", "invalid")},
        "quality_leads_percentage": pct(F.col("excellent_count") + F.col("good_count"), n),
        "fake_leads_percentage": pct("fake_leads", n),
        "fake_phones_percentage": pct("fake_phones", n),
        "disposable_emails_percentage": pct("disposable_emails", n),
        "bounce_likely_percentage": pct("bounce_likely_emails", n),
        "accept_percentage": pct("accept_recommendations", n),
        "reject_percentage": pct("reject_recommendations", n),
        "review_percentage": pct("review_recommendations", n),
        "email_valid_percentage": round_half_away(F.col("_email_valid_rate") * 100.0, 2),
        "email_sendable_percentage": round_half_away(F.col("_email_sendable_rate") * 100.0, 2),
        "phone_valid_percentage": round_half_away(F.col("_phone_valid_rate") * 100.0, 2),
    })
    aq, af, fp = F.col("_avg_q"), F.col("_avg_fraud"), F.col("fake_leads_percentage")
    out = m.select(
        "lead_source", "total_leads",
        round_half_away(aq, 2).alias("avg_quality_score"),
        round_half_away("_avg_lead", 2).alias("avg_lead_score"),
        round_half_away(af, 2).alias("avg_fraud_score"),
        round_half_away("_avg_dq", 2).alias("avg_data_quality_score"),
        round_half_away("_avg_bs", 2).alias("avg_business_strength"),
        "excellent_count", "excellent_percentage", "good_count", "good_percentage",
        "fair_count", "fair_percentage", "poor_count", "poor_percentage",
        "invalid_count", "invalid_percentage", "quality_leads_percentage",
        "fake_leads", "fake_leads_percentage", "fake_phones", "fake_phones_percentage",
        "disposable_emails", "disposable_emails_percentage",
        "bounce_likely_emails", "bounce_likely_percentage", "gibberish_emails",
        "email_valid_percentage", "email_sendable_percentage", "phone_valid_percentage",
        "accept_recommendations", "accept_percentage", "reject_recommendations", "reject_percentage",
        "review_recommendations", "review_percentage",
        "first_validation_date", "last_validation_date", "active_days",
        # ranks use the unrounded averages and the rounded percentage
        rank_by(aq.desc_nulls_last()).alias("quality_rank"),
        rank_by(n.desc_nulls_last()).alias("volume_rank"),
        rank_by(fp.asc_nulls_last(), af.asc_nulls_last()).alias("fraud_rank"),
        ladder([((aq >= 8.5) & (fp <= 5), "A+"), ((aq >= 7.5) & (fp <= 10), "A"),
                ((aq >= 6.5) & (fp <= 15), "B"), ((aq >= 5.5) & (fp <= 25), "C"),
                ((aq >= 4.0) & (fp <= 35), "D")], "F").alias("quality_grade"),
        ladder([((aq < 4) | (fp > 25) | (af > 5), "HIGH_RISK"),
                ((aq < 6) | (fp > 15) | (af > 3), "MEDIUM_RISK")], "LOW_RISK").alias("risk_level"),
    )
    return out.orderBy(F.col("avg_quality_score").desc_nulls_last(), "lead_source") if ordered else out


# --------------------------------------------------------------------- VW-2

def needs_attention(min_leads: int = 10) -> Column:
    """VW-2's selection over VW-1 rows: enough volume and a quality/fraud problem."""
    q, f, fp, n = (F.col(c) for c in ("avg_quality_score", "avg_fraud_score", "fake_leads_percentage",
                                       "total_leads"))
    return (n >= min_leads) & ((q < 7) | (fp > 10) | (f > 3) | F.col("risk_level").isin("HIGH_RISK", "MEDIUM_RISK"))


def worst_lead_sources(summary: DataFrame, min_leads: int = 10, ordered: bool = True) -> DataFrame:
    """VW-2: sources with >= ``min_leads`` leads and a quality/fraud problem,
    with a composite problem score and remediation priority. Input: VW-1."""
    q, f, qp, fp, n = (F.col(c) for c in ("avg_quality_score", "avg_fraud_score",
                                           "quality_leads_percentage", "fake_leads_percentage", "total_leads"))
    volume_pts = F.when(n > 100, 2).when(n > 50, 1).otherwise(0)
    problem = ((F.when(q.isNull(), dbl(10.0)).otherwise(F.lit(10.0) - q) * 0.4)
               + (F.coalesce(f, dbl(0.0)) * 0.3)
               + (F.coalesce(fp, dbl(0.0)) * 0.02)
               + (volume_pts.cast("double") * 0.1))

    def text(key: str, x: Column) -> Column:
        head, tail = WORST_ISSUES[key].split("{}")
        return F.concat(F.lit(head), round_half_away(x, 1).cast("string"), F.lit(tail))

    issue = ladder([(q < 4, text("low_quality", q)), (f > 5, text("high_fraud", f)),
                    (fp > 25, text("fake_rate", fp)), (qp < 30, text("low_quality_rate", qp))],
                   WORST_ISSUES["multiple"])
    impact = ladder([(n > 100, "HIGH_IMPACT"), (n > 50, "MEDIUM_IMPACT")], "LOW_IMPACT")
    problems = (summary.filter(needs_attention(min_leads))
                .withColumn("_problem", problem))
    prio = Window.orderBy(F.col("_problem").desc_nulls_last(), n.desc_nulls_last(), F.col("lead_source"))
    out = problems.select(
        "lead_source", "total_leads",
        round_half_away(q, 2).alias("avg_quality_score"),
        round_half_away(f, 2).alias("avg_fraud_score"),
        round_half_away(qp, 1).alias("quality_leads_percentage"),
        round_half_away(fp, 1).alias("fake_leads_percentage"),
        "quality_grade", "risk_level",
        impact.alias("improvement_impact"),
        round_half_away("_problem", 2).alias("problem_score"),
        issue.alias("primary_issues"),
        F.row_number().over(prio).cast("bigint").alias("remediation_priority"),
        ladder([(q < 3, WORST_RECOMMENDATIONS["urgent"]), ((q < 5) & (fp > 20), WORST_RECOMMENDATIONS["high"]),
                (q < 6, WORST_RECOMMENDATIONS["improve"]), (fp > 15, WORST_RECOMMENDATIONS["investigate"])],
               WORST_RECOMMENDATIONS["monitor"]).alias("recommendation"),
        round_half_away(n.cast("double") / 30.0 * fp * 0.01 * 30.0, 0).alias("estimated_monthly_fake_leads"),
        F.lit("STABLE").alias("trend"),
    )
    if ordered:
        out = out.orderBy(F.col("problem_score").desc_nulls_last(), F.col("total_leads").desc_nulls_last(),
                          "remediation_priority")
    return out


# --------------------------------------------------------------------- VW-3

def validation_overview(pv: DataFrame, as_of, summary: DataFrame | None = None,
                        min_leads: int = 10) -> DataFrame:
    """VW-3: one executive row. The daily partials of all sources give the overall counts and VW-1, whose grades, risks and
    VW-2 selection are counted; one-row results are combined by a union + max. Different names are counted from their two
    columns alone, so that no aggregate is computed once per kind of distinct count."""
    parts = source_days(pv)
    summary = summary if summary is not None else source_quality_summary(None, ordered=False, parts=parts)
    om = _merged_days(parts).select(
        F.col("n").alias("total_validations"),
        *[ratio(k, f"{k}_n").alias(f"_avg_{k}") for k in ("q", "lead", "fraud", "dq")],
        *[F.col(k).alias(f"{k}_leads") for k in ("excellent", "good", "fair", "poor", "invalid")],
        F.col("fake").alias("total_fake_leads"), F.col("fake_phone").alias("total_fake_phones"),
        F.col("disposable").alias("total_disposable_emails"), F.col("bounce").alias("total_bounce_likely"),
        ratio("email_ok", "n").alias("_email_rate"), ratio("phone_ok", "n").alias("_phone_rate"),
        *[F.col(k).alias(f"{k}_count") for k in ("accept", "reject", "review")],
        F.col("first").alias("earliest_validation"), F.col("last").alias("latest_validation"),
        F.col("days").alias("validation_days"))
    sources = parts.agg(F.count_distinct("lead_source").alias("total_sources"))
    name = F.coalesce(F.concat("api_first_name", F.lit(" "), "api_last_name"), F.lit("Unknown"))
    names = S.good_rows(pv).agg(F.count_distinct(name).alias("unique_leads"))
    g = F.col("quality_grade")
    sq = summary.agg(
        count_if(g.isin("A+", "A")).alias("high_quality_sources"),
        count_if(g.isin("B", "C")).alias("medium_quality_sources"),
        count_if(g.isin("D", "F")).alias("low_quality_sources"),
        count_if(F.col("risk_level") == "HIGH_RISK").alias("high_risk_sources"),
        count_if(F.col("risk_level") == "MEDIUM_RISK").alias("medium_risk_sources"),
        count_if(needs_attention(min_leads)).alias("sources_needing_attention"))
    one = combine_rows(om, sources, names, sq)

    t = F.col("total_validations")
    aq = F.col("_avg_q")
    fake_ratio = ratio("total_fake_leads", t)
    age = date_diff_days("latest_validation", F.lit(str(as_of)).cast("date"))
    return one.select(
        "total_validations", "total_sources", "unique_leads",
        round_half_away(ratio(t, "validation_days"), 1).alias("avg_daily_validations"),
        round_half_away(aq, 2).alias("avg_quality_score"),
        round_half_away("_avg_lead", 2).alias("avg_lead_score"),
        round_half_away("_avg_fraud", 2).alias("avg_fraud_score"),
        round_half_away("_avg_dq", 2).alias("avg_data_quality_score"),
        "excellent_leads", pct("excellent_leads", t).alias("excellent_percentage"),
        "good_leads", pct("good_leads", t).alias("good_percentage"),
        "fair_leads", pct("fair_leads", t).alias("fair_percentage"),
        "poor_leads", pct("poor_leads", t).alias("poor_percentage"),
        "invalid_leads", pct("invalid_leads", t).alias("invalid_percentage"),
        (F.col("excellent_leads") + F.col("good_leads")).alias("quality_leads"),
        pct(F.col("excellent_leads") + F.col("good_leads"), t).alias("quality_leads_percentage"),
        "total_fake_leads", pct("total_fake_leads", t).alias("fake_leads_percentage"),
        "total_fake_phones", pct("total_fake_phones", t).alias("fake_phones_percentage"),
        "total_disposable_emails", pct("total_disposable_emails", t).alias("disposable_emails_percentage"),
        "total_bounce_likely", pct("total_bounce_likely", t).alias("bounce_likely_percentage"),
        round_half_away(F.col("_email_rate") * 100.0, 2).alias("email_validation_percentage"),
        round_half_away(F.col("_phone_rate") * 100.0, 2).alias("phone_validation_percentage"),
        "accept_count", pct("accept_count", t).alias("accept_percentage"),
        "reject_count", pct("reject_count", t).alias("reject_percentage"),
        "review_count", pct("review_count", t).alias("review_percentage"),
        "high_quality_sources", "medium_quality_sources", "low_quality_sources",
        "high_risk_sources", "medium_risk_sources", "sources_needing_attention",
        ladder([((aq >= 8) & (fake_ratio < 0.05), "EXCELLENT"), ((aq >= 7) & (fake_ratio < 0.1), "GOOD"),
                ((aq >= 6) & (fake_ratio < 0.15), "FAIR"), ((aq >= 5) & (fake_ratio < 0.25), "POOR")],
               "CRITICAL").alias("overall_health_status"),
        "earliest_validation", "latest_validation", "validation_days",
        age.alias("days_since_last_validation"),
        F.coalesce(F.col("high_risk_sources") > 0, F.lit(False)).alias("has_high_risk_sources"),
        F.coalesce(fake_ratio > 0.15, F.lit(False)).alias("high_fraud_alert"),
        F.coalesce(aq < 6, F.lit(False)).alias("low_quality_alert"),
        F.coalesce(age > 7, F.lit(False)).alias("stale_data_alert"),
    )


# --------------------------------------------------------------------- VW-4 / VW-5

def task_count(keyed: bool) -> Column:
    """Number of different tasks; a count where the table is keyed by task (one row each, as upserts leave it)."""
    return F.count("task_id") if keyed else F.count_distinct("task_id")


def _simplified_aggs(q: Column, dq: Column, f0: Column, low_fraud_split: bool, keyed: bool) -> list[Column]:
    aggs = [
        F.count(F.lit(1)).alias("total_validations"),
        task_count(keyed).alias("unique_leads"),
        (F.avg(dq) / 10.0).alias("avg_data_quality_score"),
        (F.avg(dq) / 10.0).alias("median_data_quality_score"),
        (F.min(dq) / 10.0).alias("min_data_quality_score"),
        (F.max(dq) / 10.0).alias("max_data_quality_score"),
        (F.avg(f0) / 10.0).alias("avg_fraud_score"),
        (F.avg(f0) / 10.0).alias("median_fraud_score"),
        (F.min(f0) / 10.0).alias("min_fraud_score"),
        (F.max(f0) / 10.0).alias("max_fraud_score"),
        count_if(q >= 9).alias("excellent_quality_count"),
        count_if((q >= 7) & (q < 9)).alias("good_quality_count"),
        count_if((q >= 5) & (q < 7)).alias("fair_quality_count"),
        count_if(q < 5).alias("poor_quality_count"),
        count_if(f0 >= 8).alias("critical_fraud_risk_count"),
        count_if((f0 >= 6) & (f0 < 8)).alias("high_fraud_risk_count"),
        count_if((f0 >= 4) & (f0 < 6)).alias("medium_fraud_risk_count"),
    ]
    if low_fraud_split:
        aggs += [count_if((f0 >= 2) & (f0 < 4)).alias("low_fraud_risk_count"),
                 count_if(f0 < 2).alias("minimal_fraud_risk_count")]
    else:
        aggs += [count_if(f0 < 4).alias("low_fraud_risk_count")]
    aggs += [count_if(q >= 7).alias("_n_q7"), count_if(f0 >= 6).alias("_n_f6"),
             count_if(f0 >= 7).alias("_n_f7"), count_if(f0 >= 5).alias("_n_f5"),
             count_if(S.is_fake() | (f0 >= 7)).alias("likely_fake_leads_count"),
             F.avg(q).alias("_avg_q"), F.avg(f0).alias("_avg_f0"),
             F.min("parsed_at").alias("_first"), F.max("parsed_at").alias("_last"),
             F.count_distinct(day("parsed_at")).alias("_days")]
    return aggs


def simplified_overall_results(pv: DataFrame, as_of, window_days: int = 90, keyed: bool = False) -> DataFrame:
    """VW-4: one row over the last ``window_days`` of ``parsed_at``; scores on
    the 0-1 scale. The 'median' columns are averages, as in the source view.
    ``keyed``: the table has one row per task, so tasks needn't be told apart."""
    q, dq, f0 = S.quality(), S.data_quality3(), S.fraud0()
    rows = S.good_rows(pv).filter(F.col("parsed_at") >= days_before(as_of, window_days))
    a = rows.agg(*_simplified_aggs(q, dq, f0, low_fraud_split=True, keyed=keyed))
    t = F.col("total_validations")
    aq, af = F.col("_avg_q"), F.col("_avg_f0")
    return a.select(
        "total_validations", "unique_leads",
        "avg_data_quality_score", "median_data_quality_score", "min_data_quality_score", "max_data_quality_score",
        "avg_fraud_score", "median_fraud_score", "min_fraud_score", "max_fraud_score",
        (aq / 10.0).alias("avg_overall_score"), (aq / 10.0).alias("median_overall_score"),
        "excellent_quality_count", "good_quality_count", "fair_quality_count", "poor_quality_count",
        "critical_fraud_risk_count", "high_fraud_risk_count", "medium_fraud_risk_count",
        "low_fraud_risk_count", "minimal_fraud_risk_count",
        pct("_n_q7", t).alias("high_quality_percentage"),
        pct("_n_f6", t).alias("high_fraud_risk_percentage"),
        F.col("_first").alias("earliest_validation"), F.col("_last").alias("latest_validation"),
        F.col("_days").alias("validation_days_span"),
        ladder([((aq >= 8) & (af <= 3), "EXCELLENT"), ((aq >= 7) & (af <= 4), "GOOD"),
                ((aq >= 6) & (af <= 5), "FAIR"), ((aq >= 4) & (af <= 7), "POOR")],
               "CRITICAL").alias("overall_system_status"),
    )


def simplified_results_by_source(pv: DataFrame, as_of, window_days: int = 90, ordered: bool = True,
                                 keyed: bool = False) -> DataFrame:
    """VW-5: VW-4 per source plus ranks, risk level and grade."""
    q, dq, f0 = S.quality(), S.data_quality3(), S.fraud0()
    rows = S.good_rows(pv).filter(F.col("parsed_at") >= days_before(as_of, window_days))
    a = rows.groupBy(S.source().alias("lead_source")).agg(*_simplified_aggs(q, dq, f0, low_fraud_split=False, keyed=keyed))
    t = F.col("total_validations")
    aq, af = F.col("_avg_q"), F.col("_avg_f0")
    out = a.select(
        "lead_source", "total_validations", "unique_leads",
        "avg_data_quality_score", "median_data_quality_score", "min_data_quality_score", "max_data_quality_score",
        "avg_fraud_score", "median_fraud_score", "min_fraud_score", "max_fraud_score",
        "excellent_quality_count", "good_quality_count", "fair_quality_count", "poor_quality_count",
        "critical_fraud_risk_count", "high_fraud_risk_count", "medium_fraud_risk_count", "low_fraud_risk_count",
        pct("_n_q7", t).alias("high_quality_percentage"),
        pct("_n_f6", t).alias("high_fraud_risk_percentage"),
        "likely_fake_leads_count",
        pct("likely_fake_leads_count", t).alias("fake_leads_percentage"),
        rank_by(aq.desc_nulls_last()).alias("quality_rank"),
        rank_by(af.asc_nulls_last()).alias("fraud_safety_rank"),
        rank_by(t.desc_nulls_last()).alias("volume_rank"),
        ladder([(af >= 7, "CRITICAL"), (ratio("_n_f7", t) > 0.3, "CRITICAL"),
                (af >= 5, "HIGH"), (ratio("_n_f6", t) > 0.2, "HIGH"),
                (af >= 3, "MEDIUM"), (ratio("_n_f5", t) > 0.1, "MEDIUM"),
                (af >= 2, "LOW")], "MINIMAL").alias("source_risk_level"),
        ladder([((aq >= 9) & (af <= 2), "A+"), ((aq >= 8) & (af <= 3), "A"), ((aq >= 7) & (af <= 4), "B"),
                ((aq >= 6) & (af <= 5), "C"), ((aq >= 4) & (af <= 6), "D")], "F").alias("source_grade"),
        F.col("_first").alias("first_validation"), F.col("_last").alias("latest_validation"),
        F.col("_days").alias("validation_days_active"),
    )
    if ordered:
        out = out.orderBy(F.col("avg_data_quality_score").desc_nulls_last(),
                          F.col("avg_fraud_score").asc_nulls_last(), "lead_source")
    return out


# --------------------------------------------------------------------- VW-6

def _point_result(flagged: Column | None, score: Column) -> Column:
    rungs = [] if flagged is None else [(flagged, "FRAUD DETECTED")]
    rungs += [(score >= 0.8, "PASS"), (score >= 0.5, "WARNING")]
    return ladder(rungs, "FAIL")


def fake_leads_detail(pv: DataFrame, ordered: bool = False) -> DataFrame:
    """VW-6: one row per suspicious lead (fake, or fraud >= 6) with a result per
    validation point. The e-mail point reads the stored ``email_quality_score``;
    the other points use the fixed default score 0.8."""
    f0 = S.fraud0()
    raw = F.col("raw_api_response")

    def any_like(*pats: str) -> Column:
        c = None
        for p in pats:
            c = raw.like(p) if c is None else (c | raw.like(p))
        return F.coalesce(c, F.lit(False))

    flags = {
        "email": any_like("%email%fraud%", "%email%invalid%"),
        "phone": any_like("%phone%fraud%", "%phone%invalid%"),
        "name": any_like("%name%gibberish%", "%hasGibberishNames%true%"),
        "company": any_like("%company%gibberish%", "%hasGibberishCompany%true%"),
    }
    default = dbl(0.8)
    email_score = F.col("email_quality_score")
    rows = S.good_rows(pv).filter(S.is_fake() | (f0 >= 6))
    n_flags = sum((F.when(v, 1).otherwise(0) for v in flags.values()), F.lit(0))
    out = rows.select(
        F.col("task_id").alias("lead_id"), "lead_source", F.col("parsed_at").alias("validation_timestamp"),
        *S.contact_columns(),
        (S.data_quality3() / 10.0).alias("data_quality_score"),
        (f0 / 10.0).alias("fraud_score"),
        (S.quality() / 10.0).alias("overall_score"),
        ladder([(f0 >= 8, "CRITICAL"), (f0 >= 7, "HIGH"), (f0 >= 6, "MEDIUM")], "LOW").alias("fraud_risk_level"),
        email_score.alias("email_quality_score"),
        _point_result(flags["email"], email_score).alias("email_validation_result"),
        default.alias("phone_quality_score"),
        _point_result(flags["phone"], default).alias("phone_validation_result"),
        default.alias("name_quality_score"),
        _point_result(flags["name"], default).alias("name_validation_result"),
        default.alias("company_quality_score"),
        _point_result(flags["company"], default).alias("company_validation_result"),
        default.alias("completeness_score"),
        _point_result(None, default).alias("completeness_validation_result"),
        n_flags.alias("fraud_indicators_count"),
        ladder([(f0 >= 8, DETAIL_SUMMARIES["critical"]), (f0 >= 7, DETAIL_SUMMARIES["high"]),
                (f0 >= 6, DETAIL_SUMMARIES["medium"])], DETAIL_SUMMARIES["low"]).alias("validation_summary"),
        F.coalesce(F.col("api_recommendation"),
                   ladder([(f0 >= 8, "reject"), (f0 >= 7, "review"), (f0 >= 6, "flag")], "monitor")
                   ).alias("recommended_action"),
        f0.alias("_f0"),
    )
    if ordered:
        out = out.orderBy(F.col("_f0").desc(), F.col("validation_timestamp").desc_nulls_last(), "lead_id")
    return out.drop("_f0")


# --------------------------------------------------------------------- VW-7

def fake_lead_label() -> Column:
    """"first last (task)" of a fake lead; NULL for others."""
    name = F.concat(F.coalesce("api_first_name", F.lit("")), F.lit(" "), F.coalesce("api_last_name", F.lit("")))
    return F.when(S.is_fake(), F.concat(name, F.lit(" ("), F.col("task_id"), F.lit(")")))


def fake_lead_chunks(pv: DataFrame, size: int = SIZE) -> DataFrame:
    """VW-7's lists of fake leads for every day and source, in pieces of ``size`` leads: day, lead_source, chunk, n,
    fake_leads. Where a source's day is too long for one string, read this in place of ``fake_leads_list``."""
    rows = S.good_rows(pv).select(trunc_ntz("day", "created_date").alias("day"), S.source().alias("lead_source"), "task_id", fake_lead_label().alias("_label"))
    return ordered_chunks(rows, ["day", "lead_source"], ["task_id"], "_label", "fake_leads", size)


def daily_fake_leads_by_source(pv: DataFrame, as_of, ordered: bool = True) -> DataFrame:
    """VW-7: today's (``as_of``) fake-lead counts per source with risk, ranks,
    alerts, the ordered list of fake leads, status and action.

    The day filter is a half-open range on ``created_date`` so Parquet
    statistics / partition pruning apply.
    """
    start = as_of_ts(as_of)
    f0, q = S.fraud0(), S.quality()
    fake = S.is_fake()
    rows = S.good_rows(pv).filter((F.col("created_date") >= start)
                                  & (F.col("created_date") < start + F.expr("INTERVAL 1 DAY")))
    a = (rows.withColumn("_label", fake_lead_label())
         .groupBy(S.source().alias("lead_source"))
         .agg(F.count(F.lit(1)).alias("total_leads_today"),
              count_if(fake).alias("fake_leads_count"),
              count_if(f0 >= 8).alias("critical_fraud_count"),
              count_if(f0 >= 5).alias("high_fraud_count"),
              F.avg(q).alias("_avg_q"), F.avg(f0).alias("_avg_f0"),
              F.expr("listagg(_label, '; ') WITHIN GROUP (ORDER BY task_id)").alias("fake_leads_list"),
              F.min("created_date").alias("earliest_lead_today"),
              F.max("created_date").alias("latest_lead_today")))
    t = F.col("total_leads_today")
    fc = F.col("fake_leads_count")
    a = a.withColumn("fake_leads_percentage", pct(fc, t))
    fp = F.col("fake_leads_percentage")
    av, ap, ac = fc >= 3, fp >= 25, F.col("critical_fraud_count") >= 1
    out = a.select(
        "lead_source", "total_leads_today", "fake_leads_count", "fake_leads_percentage",
        "critical_fraud_count", "high_fraud_count",
        ladder([(fp >= 50, "CRITICAL"), (fp >= 20, "HIGH"), (fp >= 10, "MEDIUM"), (fp > 0, "LOW")],
               "CLEAN").alias("daily_risk_level"),
        round_half_away("_avg_q", 1).alias("avg_quality_score"),
        round_half_away("_avg_f0", 1).alias("avg_fraud_score"),
        rank_by(fp.desc_nulls_last()).alias("worst_source_rank"),
        rank_by(t.desc_nulls_last()).alias("volume_rank"),
        rank_by(F.col("_avg_q").desc_nulls_last()).alias("quality_rank"),
        av.alias("alert_volume"), ap.alias("alert_percentage"), ac.alias("alert_critical_fraud"),
        "fake_leads_list", "earliest_lead_today", "latest_lead_today",
        as_of_ts(as_of).alias("report_date"),
        ladder([(ac & ap, DAILY_STATUS["immediate"]), (av | ap, DAILY_STATUS["monitor"]),
                (fc > 0, DAILY_STATUS["investigate"])], DAILY_STATUS["clean"]).alias("daily_status"),
        ladder([(fp >= 50, DAILY_ACTIONS["pause"]), (fp >= 25, DAILY_ACTIONS["quarantine"]),
                (fc >= 3, DAILY_ACTIONS["investigate"]), (fc >= 1, DAILY_ACTIONS["monitor"])],
               DAILY_ACTIONS["continue"]).alias("recommended_action"),
    )
    if ordered:
        out = out.orderBy(fp.desc_nulls_last(), fc.desc_nulls_last(), t.desc_nulls_last(), "lead_source")
    return out


# --------------------------------------------------------------------- VW-8

def fake_leads_status_anomalies(pv: DataFrame, as_of,
                                high_volume_sources: Sequence[str] = HIGH_VOLUME_SOURCES,
                                ordered: bool = False) -> DataFrame:
    """VW-8: leads flagged fake / high fraud / reject, with the lead status
    recorded in the raw API JSON and a severity, priority and impact ladder."""
    f0 = S.fraud0()
    rows = S.good_rows(pv).filter(S.is_fake() | (f0 >= 7)
                                  | (F.coalesce(F.col("api_recommendation"), F.lit("")) == "reject"))
    fake = S.is_fake()
    rec = F.coalesce(F.col("api_recommendation"), F.lit("unknown"))
    flag_type = ladder([(fake, "FLAGGED_AS_FAKE"), (f0 >= 8, "CRITICAL_FRAUD_RISK"),
                        (f0 >= 7, "HIGH_FRAUD_RISK"), (rec == "reject", "RECOMMENDED_REJECT")], "OTHER_ISSUE")
    severity = ladder([(fake & (f0 >= 8), "CRITICAL"), (fake | (f0 >= 7), "HIGH"), (f0 >= 5, "MEDIUM")], "LOW")
    impact_src = F.when(F.col("lead_source").isin(*high_volume_sources), "HIGH_VOLUME_SOURCE") \
        .otherwise("STANDARD_SOURCE")
    raw = F.col("raw_api_response")
    staged = rows.select(
        "task_id", F.col("who_id").alias("lead_id"), *S.contact_columns(), "lead_source",
        day("created_date").alias("creation_date"), day("parsed_at").alias("validation_date"),
        flag_type.alias("validation_flag_type"), severity.alias("anomaly_severity"),
        ladder([(fake, 1), (f0 >= 8, 2), (rec == "reject", 3)], 4).alias("investigation_priority"),
        f0.alias("fraud_score"),
        F.coalesce("api_fraud_factors", F.lit("No factors")).alias("fraud_factors"),
        F.coalesce("api_quality_factors", F.lit("No factors")).alias("quality_factors"),
        rec.alias("validation_recommendation"),
        F.coalesce("api_fraud_risk_level", F.lit("unknown")).alias("fraud_risk_level"),
        F.coalesce(F.get_json_object(raw, "$.leadStatus"), F.get_json_object(raw, "$.status"),
                   F.lit("unknown")).alias("status_at_validation_time"),
        impact_src.alias("source_impact_level"),
    )
    ft, sev = F.col("validation_flag_type"), F.col("anomaly_severity")
    out = staged.select(
        "*",
        ladder([(ft == k, v) for k, v in ANOMALY_DESCRIPTIONS.items() if k != "OTHER_ISSUE"],
               ANOMALY_DESCRIPTIONS["OTHER_ISSUE"]).alias("anomaly_description"),
        ladder([(sev == k, v) for k, v in ANOMALY_ACTIONS.items() if k != "LOW"],
               ANOMALY_ACTIONS["LOW"]).alias("recommended_action"),
        ladder([((ft == "FLAGGED_AS_FAKE") & (F.col("source_impact_level") == "HIGH_VOLUME_SOURCE"),
                 "HIGH_BUSINESS_IMPACT"),
                (ft == "FLAGGED_AS_FAKE", "MEDIUM_BUSINESS_IMPACT"),
                (sev == "CRITICAL", "MEDIUM_BUSINESS_IMPACT")], "LOW_BUSINESS_IMPACT").alias("business_impact"),
        as_of_ts(as_of).alias("report_date"),
    )
    if ordered:
        out = out.orderBy("investigation_priority", sev.desc(), F.col("fraud_score").desc(),
                          F.col("validation_date").desc_nulls_last(), "task_id")
    return out
