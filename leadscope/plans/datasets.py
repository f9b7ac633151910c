"""Derived datasets (DD-1 .. DD-22): the data behind dashboard widgets,
exports and HTML reports, as DataFrames (drawing and templating are not part
of the engine).

Most are small post-aggregations of a report; where the dashboard combines two
loaders (e.g. DD-1 = sums over LQ-11 + counts over LQ-12) the dataset is
computed in a single pass over ``parsed_validations`` instead of joining the
two loader outputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions.exprs import count_if, exact_avg, ladder, ratio
from ..functions.joins import shared
from . import loaders as ld
from . import reports_pv as rp
from . import reports_vr as rv

# Factor names of the export (sorted, as the CSV lists them) and report labels.
FACTOR_COLUMNS = ["Data Completeness", "Email Deliverable", "Email Format Valid", "Known Fake Lead", "ML Fraud Score",
                  "ML Risk Level", "Phone Valid", "Postal Code Valid", "State Valid", "ZIP State Consistent"]
DISTRIBUTION_LABELS = ["Excellent (9-10)", "Good (7-8)", "Fair (5-6)", "Poor (3-4)", "Invalid (0-2)"]
QUADRANTS = {"hq_lf": "Excellent", "lq_lf": "Needs Work", "hq_hf": "Investigate", "lq_hf": "Critical"}


def round_half_even(c: Column, digits: int) -> Column:
    """Dashboard-side rounding (NumPy): half-even on the scaled binary value."""
    m = float(10 ** digits)
    return F.rint(c * m) / m


# ------------------------------------------------------------------ DD-1 .. DD-3 (daily monitor)

def daily_totals(pv: DataFrame, start: str, end: str) -> DataFrame:
    """DD-1: totals of the daily monitor in one pass over the date range."""
    f0, fake = S.fraud0(), S.is_fake()
    rows = ld.date_range_filter(S.good_rows(pv), start, end)
    a = rows.agg(F.count(F.lit(1)).alias("total_leads"), count_if(fake).alias("total_fake_leads"),
                 count_if(fake | (f0 >= 8)).alias("total_problematic_leads"),
                 count_if(fake).alias("fake_count_unique"),
                 count_if(~fake & (f0 >= 8)).alias("high_risk_count_unique"))
    t = F.col("total_leads")
    pct0 = lambda n: F.when(t > 0, ratio(n, t) * 100.0).otherwise(F.lit(0.0))
    return a.select("total_leads", "total_fake_leads", pct0("total_fake_leads").alias("total_fake_percentage"),
                    "total_problematic_leads", "fake_count_unique", "high_risk_count_unique",
                    pct0("total_problematic_leads").alias("total_problematic_percentage"))


def source_table(daily: DataFrame) -> DataFrame:
    """DD-2: LQ-11 as the monitor's table, sorted by fake count, critical count, share."""
    return daily.select(
        "lead_source", "total_leads_today", "fake_leads_count", "critical_fraud_count",
        round_half_even(F.col("fake_leads_percentage"), 1).alias("fake_leads_percentage"),
        round_half_even(F.col("critical_fraud_percentage"), 1).alias("critical_fraud_percentage"),
    ).orderBy(F.col("fake_leads_count").desc(), F.col("critical_fraud_count").desc(),
              F.col("fake_leads_percentage").desc(), "lead_source")


def sources_with_fakes(daily: DataFrame) -> DataFrame:
    """DD-3: how many of the day's sources sent at least one fake lead."""
    return daily.agg(F.count(F.lit(1)).alias("total_sources"),
                     count_if(F.col("fake_leads_count") > 0).alias("sources_with_fakes"))


# ------------------------------------------------------------------ DD-4 / DD-5 (export)

def parse_factors(text: Column) -> dict[str, Column]:
    """DD-4: factor text -> the 10 named factors (NULL when not mentioned)."""
    t = F.when(~text.isin("No specific factors", "No factors"), text)

    def has(s: str) -> Column:
        return F.instr(t, s) > 0

    def grab(pattern: str, n: int = 1) -> Column:
        return F.when(t.rlike(pattern), F.regexp_extract(t, pattern, n))

    ml = has("ML fraud model")
    deliverable = F.when(has("Email deliverable") & ~has("not"), F.lit("YES")) \
        .when(has("Email not deliverable"), F.lit("NO"))
    fmt = F.when(has("Invalid email"), F.lit("NO")).when(has("Valid email format"), F.lit("YES"))
    phone = F.when(has("Invalid phone"), F.lit("NO")).when(has("Valid phone number"), F.lit("YES"))
    comp = r"Data completeness \((\d+)/(\d+)\)"
    return {
        "Known Fake Lead": F.when(has("Known fake lead from database"), F.lit("TRUE")),
        "ML Fraud Score": F.when(ml, grab(r"ML fraud model.*?score[:\s]*(\d+)")),
        "ML Risk Level": F.when(ml, grab(r"ML fraud model[:\s]*(MEDIUM|HIGH|LOW|NORMAL) RISK")),
        "Email Deliverable": deliverable,
        "Email Format Valid": fmt,
        "Phone Valid": phone,
        "ZIP State Consistent": F.when(has("ZIP/state consistent"), F.lit("YES")),
        "Postal Code Valid": F.when(has("Valid postal code"), F.lit("YES")),
        "State Valid": F.when(has("Valid state"), F.lit("YES")),
        "Data Completeness": F.when(t.rlike(comp), F.concat(F.regexp_extract(t, comp, 1), F.lit("/"),
                                                             F.regexp_extract(t, comp, 2))),
    }


def factor_column_name(f: str) -> str:
    return "factor_" + f.lower().replace(" ", "_")


def problematic_export(detail: DataFrame) -> DataFrame:
    """DD-5: the wide export of LQ-12: nine base columns, one column per
    factor (quality factors override fraud factors, '' when absent), then the
    two original texts. CSV headers are in ``EXPORT_HEADERS``."""
    fr = parse_factors(F.col("fraud_factors"))
    qu = parse_factors(F.col("quality_factors"))
    blank = lambda c: F.when(F.coalesce(F.length(c), F.lit(0)) > 0, c).otherwise(F.lit("Missing"))
    return detail.select(
        "lead_id", "lead_type", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("name"),
        "email", blank(F.col("phone")).alias("phone_display"), blank(F.col("company")).alias("company_display"),
        "lead_source", "fraud_score", "recommendation",
        *[F.coalesce(qu[f], fr[f], F.lit("")).alias(factor_column_name(f)) for f in FACTOR_COLUMNS],
        F.col("fraud_factors").alias("original_fraud_factors"),
        F.col("quality_factors").alias("original_quality_issues"))


EXPORT_HEADERS = (["Lead ID", "Type", "Name", "Email", "Phone", "Company", "Source", "Fraud Score", "Action"]
                  + FACTOR_COLUMNS + ["Original Fraud Factors", "Original Quality Issues"])


# ------------------------------------------------------------------ DD-6 / DD-7 (fake lead details)

def suspicious_per_source(fake_list: DataFrame) -> DataFrame:
    """DD-6: fake/suspicious leads per source (FB-3 list), count descending."""
    return (fake_list.filter(F.col("lead_source").isNotNull()).groupBy("lead_source")
            .agg(F.count(F.lit(1)).alias("fake_leads_count"))
            .orderBy(F.col("fake_leads_count").desc(), "lead_source"))


def raw_json_details(df: DataFrame, raw: str = "raw_api_response", key: str = "lead_id") -> DataFrame:
    """DD-7: ten detail keys from the stored API JSON, with the dashboard's defaults."""
    js = F.col(raw)
    ok = F.json_object_keys(js).isNotNull()

    def s(path: str, default: str = "") -> Column:
        return F.when(ok, F.coalesce(F.get_json_object(js, path), F.lit(default)))

    def b(path: str) -> Column:
        return F.when(ok, F.coalesce(F.get_json_object(js, path).try_cast("boolean"), F.lit(False)))

    return df.select(
        key, s("$.summaryNotes", "[]").alias("summary_notes"), s("$.fakeSource").alias("fake_source"),
        s("$.fakeReason").alias("fake_reason"), s("$.fakeConfidence").alias("fake_confidence"),
        s("$.validationMethod").alias("validation_method"),
        s("$.recommendationConfidence").alias("recommendation_confidence"),
        s("$.mlFraudDetection", "{}").alias("ml_fraud_detection"), s("$.emailSummary", "{}").alias("email_summary"),
        b("$.hasGibberishNames").alias("has_gibberish_names"), b("$.hasGibberishCompany").alias("has_gibberish_company"))


# ------------------------------------------------------------------ DD-8 .. DD-10 (creation-date analysis)

def top_source_series(source_months: DataFrame, n: int = 6) -> DataFrame:
    """DD-8: the ``n`` sources with most leads over all months, and their monthly rows.
    The monthly rows are aggregated once, for the ranking and for the result."""
    source_months = shared(source_months)
    top = (source_months.groupBy("lead_source").agg(F.sum("total_leads").alias("_n"))
           .orderBy(F.col("_n").desc(), "lead_source").limit(n).select("lead_source"))
    return source_months.join(top, "lead_source", "left_semi")


def latest_month_slice(series: DataFrame) -> DataFrame:
    """DD-9: rows of the latest month, best quality first (quality rounded to 2)."""
    latest = series.agg(F.max("creation_month").alias("_m"))
    return (series.join(latest, series.creation_month == latest._m, "left_semi")
            .select("lead_source", "total_leads",
                    round_half_even(F.col("avg_data_quality_score"), 2).alias("avg_data_quality_score"),
                    "fake_leads_count", F.col("avg_data_quality_score").alias("_q"))
            .orderBy(F.col("_q").desc(), "lead_source").drop("_q"))


def month_over_month(months: DataFrame, source_months: DataFrame, n_top: int = 6) -> DataFrame:
    """DD-10: latest-minus-previous month change of quality and fraud overall,
    and of quality for the best source of the latest month (top-``n_top``)."""
    w = Window.orderBy(F.col("creation_month").desc())
    m = months.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
    overall = m.agg(
        (F.max(F.when(F.col("_rn") == 1, F.col("avg_data_quality_score")))
         - F.max(F.when(F.col("_rn") == 2, F.col("avg_data_quality_score")))).alias("quality_change"),
        (F.max(F.when(F.col("_rn") == 1, F.col("avg_fraud_score")))
         - F.max(F.when(F.col("_rn") == 2, F.col("avg_fraud_score")))).alias("fraud_change"))
    source_months = shared(source_months)
    series = top_source_series(source_months, n_top)
    best = latest_month_slice(series).limit(1).select(F.col("lead_source").alias("top_source"))
    ws = Window.partitionBy("lead_source").orderBy(F.col("creation_month").desc())
    hist = (source_months.join(best, source_months.lead_source == best.top_source, "left_semi")
            .withColumn("_rn", F.row_number().over(ws)).filter("_rn <= 2"))
    src = hist.groupBy("lead_source").agg(
        (F.max(F.when(F.col("_rn") == 1, F.col("avg_data_quality_score")))
         - F.max(F.when(F.col("_rn") == 2, F.col("avg_data_quality_score")))).alias("top_source_quality_change"))
    return rv.combine_rows(overall, best, src.select(F.col("lead_source").alias("top_source"),
                                                     "top_source_quality_change"))


# ------------------------------------------------------------------ DD-11 .. DD-17 (dashboard widgets)

def score_distribution(overview: DataFrame) -> DataFrame:
    """DD-11: VW-3's five quality bands unpivoted to (category, leads, percentage)."""
    names = ["excellent", "good", "fair", "poor", "invalid"]
    pairs = [F.struct(F.lit(lbl).alias("category"), F.lit(i).alias("position"),
                      F.col(f"{n}_leads").alias("leads"), F.col(f"{n}_percentage").alias("percentage"))
             for i, (lbl, n) in enumerate(zip(DISTRIBUTION_LABELS, names), 1)]
    return overview.select(F.inline(F.array(*pairs)))


def score_histogram(scores: DataFrame, col: str = "overall_score", lo: float = 0.0, hi: float = 10.0,
                    bins: int = 20) -> DataFrame:
    """DD-12: equal-width histogram over [lo, hi]; the top edge falls in the last bin."""
    width = (hi - lo) / bins
    b = F.least(F.lit(bins), F.floor((F.col(col) - lo) / width).cast("int") + 1)
    return (scores.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("leads"))
            .select("bin", (F.lit(lo) + (F.col("bin") - 1) * width).alias("bin_start"),
                    (F.lit(lo) + F.col("bin") * width).alias("bin_end"), "leads"))


def quality_fraud_quadrants(summary: DataFrame, x_line: float = 7.0, y_line: float = 10.0) -> DataFrame:
    """DD-13: each source placed by quality (x) and fake share (y), bubble size sqrt(n)*3."""
    x, y = F.col("avg_quality_score"), F.col("fake_leads_percentage")
    q = ladder([((x >= x_line) & (y < y_line), QUADRANTS["hq_lf"]), ((x < x_line) & (y < y_line), QUADRANTS["lq_lf"]),
                ((x >= x_line) & (y >= y_line), QUADRANTS["hq_hf"])], QUADRANTS["lq_hf"])
    return summary.select("lead_source", "total_leads", x.alias("quality"), y.alias("fake_rate"),
                          (F.sqrt(F.col("total_leads")) * 3.0).alias("bubble_size"), q.alias("quadrant"))


def worst_source_summary(worst: DataFrame) -> DataFrame:
    """DD-14: counts of high/medium risk among worst sources and their mean problem score."""
    return worst.agg(F.count(F.lit(1)).alias("worst_sources"),
                     count_if(F.col("risk_level") == "HIGH_RISK").alias("high_risk_sources"),
                     count_if(F.col("risk_level") == "MEDIUM_RISK").alias("medium_risk_sources"),
                     exact_avg("problem_score").alias("avg_problem_score"))


def source_overview(summary: DataFrame, min_leads: int = 10) -> DataFrame:
    """DD-15/AGG-18: high-quality (A+/A) source count and share, sources needing
    attention (VW-2's rule), mean of the per-source mean quality; one pass over VW-1."""
    one = summary.agg(F.count(F.lit(1)).alias("total_sources"),
                      count_if(F.col("quality_grade").isin("A+", "A")).alias("high_quality_sources"),
                      count_if(rp.needs_attention(min_leads)).alias("problem_sources"),
                      exact_avg("avg_quality_score").alias("avg_quality"))
    t = F.col("total_sources")
    return one.select("total_sources", "high_quality_sources",
                      F.when(t > 0, ratio("high_quality_sources", t) * 100.0).otherwise(F.lit(0.0))
                      .alias("high_quality_pct"), "problem_sources",
                      F.round(F.col("avg_quality"), 10).alias("avg_quality"))


SORTS = {"Quality Score": ("avg_quality_score", False), "Total Leads": ("total_leads", False),
         "Quality Grade": ("quality_rank", False), "Fraud Rate": ("fake_leads_percentage", True)}


def filtered_sources(summary: DataFrame, grade: str = "All", min_volume: int = 0,
                     sort_by: str = "Quality Score") -> DataFrame:
    """DD-16/SRT-6: grade and volume filter, user-chosen sort column."""
    df = summary
    if grade != "All":
        df = df.filter(F.col("quality_grade") == grade)
    if min_volume > 0:
        df = df.filter(F.col("total_leads") >= min_volume)
    col, asc = SORTS[sort_by]
    df = df.select("lead_source", "total_leads", "avg_quality_score", "quality_grade", "fake_leads_percentage",
                   "email_valid_percentage", "phone_valid_percentage", "quality_leads_percentage", "risk_level",
                   "quality_rank")
    return df.orderBy(F.col(col).asc() if asc else F.col(col).desc(), "lead_source")


def trend_delta(trends: DataFrame) -> DataFrame:
    """DD-17: latest vs previous period (score and volume change) of LQ-4."""
    w = Window.orderBy(F.col("period_start").desc())
    t = trends.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 2")
    one = lambda c, i: F.max(F.when(F.col("_rn") == i, F.col(c)))
    return t.agg(one("period_start", 1).alias("latest_period"),
                 (one("avg_score", 1) - one("avg_score", 2)).alias("score_change"),
                 (one("leads_validated", 1) - one("leads_validated", 2)).alias("volume_change"))


# ------------------------------------------------------------------ DD-18 / DD-19 (reports)

def quality_status(p: Column, good: float = 80, fair: float = 60) -> Column:
    return ladder([(p >= good, "Excellent"), (p >= fair, "Moderate")], "Action Required")


def comprehensive_report(metrics: DataFrame, problematic: DataFrame) -> DataFrame:
    """DD-18: one-row summary of the comprehensive report (VW-10 + LQ-6)."""
    p = problematic.agg(F.count(F.lit(1)).alias("problematic_leads"))
    one = rv.combine_rows(metrics.select("total_leads", "avg_overall_score", "quality_leads_percentage",
                                         "conversion_rate_percentage", "earliest_lead_date", "latest_lead_date"), p)
    return one.select("*", quality_status(F.col("quality_leads_percentage")).alias("quality_status"),
                      F.greatest(F.col("problematic_leads") - 20, F.lit(0)).alias("problematic_not_listed"),
                      F.date_format("earliest_lead_date", "yyyy-MM-dd").alias("period_from"),
                      F.date_format("latest_lead_date", "yyyy-MM-dd").alias("period_to"))


def compliance_report(metrics: DataFrame, problematic: DataFrame, threshold: float = 70) -> DataFrame:
    """DD-19: compliance verdict (quality share >= ``threshold``) and counts."""
    p = problematic.agg(F.count(F.lit(1)).alias("leads_below_threshold"))
    one = rv.combine_rows(metrics.select("total_leads", "excellent_count", "good_count", "poor_count",
                                         "invalid_count", "poor_percentage", "invalid_percentage",
                                         "quality_leads_percentage", "avg_overall_score"), p)
    q = F.col("quality_leads_percentage")
    return one.select(
        "total_leads", (F.col("excellent_count") + F.col("good_count")).alias("quality_leads"),
        q.alias("quality_leads_percentage"),
        (F.col("poor_count") + F.col("invalid_count")).alias("non_compliant_leads"),
        (F.col("poor_percentage") + F.col("invalid_percentage")).alias("non_compliant_percentage"),
        "avg_overall_score", (q >= threshold).alias("is_compliant"), "leads_below_threshold")


# ------------------------------------------------------------------ DD-20 .. DD-22 (ETL insights, rankings)

def top_sources_by_count(pv: DataFrame, n: int = 5) -> DataFrame:
    """DD-20: the ``n`` most frequent lead sources (NULL source not counted)."""
    return (pv.filter(F.col("lead_source").isNotNull()).groupBy("lead_source")
            .agg(F.count(F.lit(1)).alias("records")).orderBy(F.col("records").desc(), "lead_source").limit(n))


ETL_BANDS = [(9, 10, "Excellent"), (7, 9, "Good"), (5, 7, "Fair"), (3, 5, "Poor"), (0, 3, "Invalid")]


def etl_score_bands(pv: DataFrame, col: str = "api_quality_score") -> DataFrame:
    """DD-21a: half-open [min, max) bands over non-NULL scores (10 falls in no band)."""
    s = F.col(col)
    rows = pv.filter(s.isNotNull())
    a = rows.agg(F.count(F.lit(1)).alias("_n"),
                 *[count_if((s >= lo) & (s < hi)).alias(f"b{i}") for i, (lo, hi, _) in enumerate(ETL_BANDS)])
    pairs = [F.struct(F.lit(lbl).alias("band"), F.lit(lo).alias("min_score"), F.lit(hi).alias("max_score"),
                      F.col(f"b{i}").alias("leads"), (ratio(f"b{i}", "_n") * 100.0).alias("percentage"))
             for i, (lo, hi, lbl) in enumerate(ETL_BANDS)]
    return a.select(F.inline(F.array(*pairs)))


def etl_source_means(pv: DataFrame) -> DataFrame:
    """DD-21b: per-source means (2 dp, NumPy rounding) and counts, best first."""
    a = pv.filter(F.col("lead_source").isNotNull()).groupBy("lead_source").agg(
        F.avg("api_quality_score").alias("_q"), F.avg("api_lead_score").alias("_l"),
        F.avg("api_fraud_score").alias("_f"), F.count("task_id").alias("count"))
    return (a.select("lead_source", round_half_even(F.col("_q"), 2).alias("avg_quality"),
                     round_half_even(F.col("_l"), 2).alias("avg_lead"),
                     round_half_even(F.col("_f"), 2).alias("avg_fraud"), "count")
            .orderBy(F.col("avg_quality").desc_nulls_last(), "lead_source"))


def etl_flag_sums(pv: DataFrame) -> DataFrame:
    """DD-21c: counts of fake leads, disposable e-mails and fake phones."""
    return pv.agg(count_if(F.coalesce("api_fake_lead", F.lit(False))).alias("fake_leads"),
                  count_if(F.coalesce("api_disposable_email", F.lit(False))).alias("disposable_emails"),
                  count_if(F.coalesce("api_fake_phone", F.lit(False))).alias("fake_phones"))


def top_quality_sources(summary: DataFrame, n: int = 15) -> DataFrame:
    """DD-22: the ``n`` best sources by average quality (VW-1 order)."""
    return (summary.orderBy(F.col("avg_quality_score").desc_nulls_last(), "lead_source").limit(n)
            .select("lead_source", "total_leads", "avg_quality_score", "quality_grade", "risk_level"))

