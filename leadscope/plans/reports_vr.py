"""Reports over ``validation_results`` (0-1 double scores): VW-9 .. VW-14.

Scale notes:
* latest-per-lead is ``row_number() = 1``, which gets a partial
  WindowGroupLimit before the shuffle (top row per lead per map partition);
* trends aggregate rows once into daily partials (sums, counts and counts per
  score), which merge into weeks and months; rows are never multiplied, and
  all branches share the partials' one shuffle;
* exact medians come from counts per score (:mod:`leadscope.functions.quantiles`),
  which never hold a whole group in one task;
* JSON details are parsed once per row with ``from_json``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import (combine_rows, count_if, date_diff_days, days_before, fixed_avg, fixed_sums, ladder, pct, rank_by,
                               ratio, round_half_away, trunc_ntz)
from ..functions.joins import shared
from ..functions.quantiles import global_median, grouped_medians, median_by, weighted_median

SUMMARY_COLUMNS = ["lead_id", "validation_timestamp", "overall_score", "validation_status", "first_name",
                   "last_name", "email", "phone", "company", "lead_status", "lead_source", "created_date",
                   "last_modified_date", "is_converted", "converted_date"]

POINTS = ("email", "phone", "name", "company", "completeness")
_DETAILS = T.StructType([T.StructField(p, T.StructType([T.StructField("score", T.StringType())])) for p in POINTS])


def score_category(s: Column) -> Column:
    return ladder([(s >= 0.9, "Excellent"), (s >= 0.8, "Good"), (s >= 0.6, "Fair"), (s >= 0.4, "Poor")], "Invalid")


# --------------------------------------------------------------------- partials

def _partial(name: str, c: Column | str) -> list[Column]:
    """Aggregates that keep an exact average mergeable."""
    return [x.alias(f"{name}_{part}") for part, x in zip("urn", fixed_sums(c))]


def _sum(c: Column | str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def _merged_avg(name: str) -> Column:
    """The average of all rows behind merged partials."""
    return fixed_avg(F.sum(f"{name}_u"), F.sum(f"{name}_r"), F.sum(f"{name}_n"))


# --------------------------------------------------------------------- VW-9

def latest_per_lead(vr: DataFrame, key: str = "lead_id", ts: str = "validation_timestamp",
                    tie: str = "event_id", columns: Sequence[str] | None = None) -> DataFrame:
    """WIN-1: newest row per lead (ties broken by ``tie``).

    ``row_number() ... = 1`` lets the optimizer insert a partial
    WindowGroupLimit before the shuffle: every map partition keeps only its
    newest row per lead, so a lead with very many validations is reduced
    map-side, and only the surviving rows are shuffled and sorted."""
    cols = [c for c in (columns or vr.columns) if c != key and c in vr.columns]
    order = [F.col(ts).desc_nulls_last()] + ([F.col(tie).desc_nulls_last()] if tie in vr.columns else [])
    w = Window.partitionBy(key).orderBy(*order)
    return (vr.select(key, *cols, *([tie] if tie in vr.columns and tie not in cols else []))
            .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).select(key, *cols))


def validation_summary(vr: DataFrame, as_of) -> DataFrame:
    """VW-9: latest validation per lead with category, ages and conversion."""
    base = [c if c != "lead_status" else "status" for c in SUMMARY_COLUMNS]
    latest = latest_per_lead(vr, columns=base).withColumnRenamed("status", "lead_status")
    d = F.lit(str(as_of)).cast("date")
    conv = F.col("is_converted")
    return latest.select(
        *SUMMARY_COLUMNS,
        score_category(F.col("overall_score")).alias("score_category"),
        date_diff_days("created_date", d).alias("lead_age_days"),
        date_diff_days("validation_timestamp", d).alias("days_since_validation"),
        F.when(conv, "Converted").otherwise("Not Converted").alias("conversion_status"),
        F.when(conv & F.col("converted_date").isNotNull(),
               date_diff_days("created_date", "converted_date")).alias("days_to_conversion"),
    )


# --------------------------------------------------------------------- VW-10

def _summary_partials(summary: DataFrame, as_of=None) -> DataFrame:
    """Counts, sums and extremes of VW-9 per source and score: what VW-10 and VW-11 merge."""
    st, cd = F.col("validation_status"), F.col("created_date")
    aggs = [F.count(F.lit(1)).alias("n"), *_partial("ov", "overall_score"),
            *[count_if(st == x).alias(f"status_{x.lower()}") for x in ("Excellent", "Good", "Fair", "Poor", "Invalid")],
            count_if(F.col("is_converted")).alias("converted"), count_if(~F.col("is_converted")).alias("not_converted"),
            F.min("created_date").alias("min_created"), F.max("created_date").alias("max_created"),
            F.sum("lead_age_days").alias("age"), F.count("lead_age_days").alias("age_n"),
            F.min("validation_timestamp").alias("min_validated"), F.max("validation_timestamp").alias("max_validated"),
            F.sum("days_since_validation").alias("since"), F.count("days_since_validation").alias("since_n")]
    if as_of is not None:
        d30, d60 = days_before(as_of, 30), days_before(as_of, 60)
        aggs += [count_if(cd >= d30).alias("last_30"), count_if((cd >= d60) & (cd < d30)).alias("previous_30")]
    return shared(summary.groupBy("lead_source", "overall_score").agg(*aggs))


def _merged_bands(s: Column, n: str = "n") -> list[Column]:
    bands = {"excellent_count": s >= 0.9, "good_count": (s >= 0.8) & (s < 0.9), "fair_count": (s >= 0.6) & (s < 0.8),
             "poor_count": (s >= 0.4) & (s < 0.6), "invalid_count": s < 0.4}
    return [_sum(F.when(band, F.col(n))).alias(k) for k, band in bands.items()]


def validation_metrics(summary: DataFrame, median_accuracy: int | None = None) -> DataFrame:
    """VW-10: one row of score bands, status counts, conversion, freshness over VW-9."""
    parts = _summary_partials(summary)
    base = parts.agg(
        _sum("n").alias("total_leads"), _merged_avg("ov").alias("avg_overall_score"),
        *_merged_bands(F.col("overall_score")),
        *[_sum(c).alias(c) for c in parts.columns if c.startswith("status_")],
        _sum("converted").alias("converted_leads"), _sum("not_converted").alias("not_converted_leads"),
        F.count_distinct("lead_source").alias("unique_lead_sources"),
        F.min("min_created").alias("earliest_lead_date"), F.max("max_created").alias("latest_lead_date"),
        ratio(F.sum("age"), F.sum("age_n")).alias("avg_lead_age_days"),
        F.min("min_validated").alias("earliest_validation"), F.max("max_validated").alias("latest_validation"),
        ratio(F.sum("since"), F.sum("since_n")).alias("avg_days_since_validation"),
    )
    if median_accuracy:
        med = global_median(summary, "overall_score", "median_overall_score", accuracy=median_accuracy)
    else:
        med = weighted_median(parts, [], "overall_score", "n", "median_overall_score")
    one = combine_rows(base, med)
    t = F.col("total_leads")
    fresh = F.col("avg_days_since_validation")
    return one.select(
        "total_leads", round_half_away("avg_overall_score", 10).alias("avg_overall_score"), "median_overall_score",
        "excellent_count", pct("excellent_count", t).alias("excellent_percentage"),
        "good_count", pct("good_count", t).alias("good_percentage"),
        "fair_count", pct("fair_count", t).alias("fair_percentage"),
        "poor_count", pct("poor_count", t).alias("poor_percentage"),
        "invalid_count", pct("invalid_count", t).alias("invalid_percentage"),
        "converted_leads", "not_converted_leads",
        pct("converted_leads", t).alias("conversion_rate_percentage"),
        pct(F.col("excellent_count") + F.col("good_count"), t).alias("quality_leads_percentage"),
        "unique_lead_sources", "earliest_lead_date", "latest_lead_date", "avg_lead_age_days",
        "earliest_validation", "latest_validation", "avg_days_since_validation",
        ladder([(fresh <= 1, "Very Fresh"), (fresh <= 7, "Fresh"), (fresh <= 30, "Moderate")],
               "Stale").alias("data_freshness_status"),
    )


# --------------------------------------------------------------------- VW-11

def validation_by_source(summary: DataFrame, as_of, median_accuracy: int | None = None) -> DataFrame:
    """VW-11: per-source score statistics, bands, conversion, 30-day volumes, ranks."""
    src = summary.withColumn("lead_source", F.coalesce(F.col("lead_source"), F.lit("Unknown")))
    parts = _summary_partials(src, as_of)
    s = F.col("overall_score")
    agg = parts.groupBy("lead_source").agg(
        _sum("n").alias("total_leads"), _merged_avg("ov").alias("avg_score"),
        F.min(s).alias("min_score"), F.max(s).alias("max_score"), *_merged_bands(s),
        _sum(F.when(s >= 0.8, F.col("n"))).alias("_q"), _sum("converted").alias("converted_leads"),
        _sum("last_30").alias("leads_last_30_days"), _sum("previous_30").alias("leads_previous_30_days"),
    )
    if median_accuracy:
        med = median_by(src, ["lead_source"], "overall_score", "median_score", accuracy=median_accuracy)
    else:
        med = weighted_median(parts, ["lead_source"], "overall_score", "n", "median_score")
    t = F.col("total_leads")
    a = agg.join(med, "lead_source", "left")
    return a.select(
        "lead_source", "total_leads", round_half_away("avg_score", 10).alias("avg_score"), "median_score",
        "min_score", "max_score",
        "excellent_count", "good_count", "fair_count", "poor_count", "invalid_count",
        *[pct(c, t).alias(c.replace("_count", "_percentage"))
          for c in ("excellent_count", "good_count", "fair_count", "poor_count", "invalid_count")],
        pct("_q", t).alias("quality_percentage"),
        "converted_leads", pct("converted_leads", t).alias("conversion_rate"),
        "leads_last_30_days", "leads_previous_30_days",
        rank_by(F.col("avg_score").desc_nulls_last()).alias("score_rank"),
        rank_by(t.desc()).alias("volume_rank"),
        rank_by(ratio("converted_leads", t).desc_nulls_last()).alias("conversion_rank"),
    )


# --------------------------------------------------------------------- VW-12

_GRAIN_UNIT = {"daily": "day", "weekly": "week", "monthly": "month"}
_GRAIN_STEP = {"daily": "INTERVAL 1 DAY", "weekly": "INTERVAL 7 DAYS", "monthly": "INTERVAL 1 MONTH"}


def explode_grains(df: DataFrame, ts: str, grains: Sequence[str], out: str) -> DataFrame:
    """SET-1/SET-2: one row per (row, grain) with the truncated period start, in place of a UNION ALL of per-grain
    scans. Meant for daily partials, which are few, not for raw rows."""
    g = F.explode(F.array(*[F.lit(x) for x in grains])).alias("period_type")
    start = None
    for x in grains:
        e = trunc_ntz(_GRAIN_UNIT[x], ts)
        start = F.when(F.col("period_type") == x, e) if start is None else start.when(F.col("period_type") == x, e)
    return df.select("*", g).withColumn(out, start)


def period_end(period_start: Column) -> Column:
    out = None
    for x, step in _GRAIN_STEP.items():
        e = period_start + F.expr(step)
        out = F.when(F.col("period_type") == x, e) if out is None else out.when(F.col("period_type") == x, e)
    return out


def validation_trends(vr: DataFrame, grains: Sequence[str] = ("daily", "weekly", "monthly")) -> DataFrame:
    """VW-12: daily + weekly + monthly volume/score trends with previous-period deltas."""
    s = F.col("overall_score")
    daily = vr.groupBy(trunc_ntz("day", "validation_timestamp").alias("day"), "lead_source").agg(
        F.count(F.lit(1)).alias("n"), *_partial("ov", s), count_if(s >= 0.8).alias("quality"),
        count_if(F.col("is_converted")).alias("converted"))
    a = explode_grains(daily, "day", grains, "period_start").groupBy("period_type", "period_start").agg(
        _sum("n").alias("leads_validated"),
        _merged_avg("ov").alias("_avg"),
        _sum("quality").alias("quality_leads"),
        _sum("converted").alias("converted_leads"),
        F.count_distinct("lead_source").alias("unique_sources"),
    )
    w = Window.partitionBy("period_type").orderBy("period_start")
    n = F.col("leads_validated")
    prev = F.lag("_avg").over(w)
    return a.select(
        "period_type", "period_start", period_end(F.col("period_start")).alias("period_end"),
        "leads_validated", round_half_away("_avg", 4).alias("avg_score"),
        "quality_leads", pct("quality_leads", n).alias("quality_percentage"),
        "converted_leads", pct("converted_leads", n).alias("conversion_rate"),
        "unique_sources",
        round_half_away(prev, 6).alias("prev_avg_score"),
        round_half_away(F.col("_avg") - prev, 4).alias("score_change"),
        F.lag(n).over(w).alias("prev_volume"),
        (n - F.lag(n).over(w)).alias("volume_change"),
    )


# --------------------------------------------------------------------- VW-13 / VW-14

def _point_scores(vr: DataFrame) -> DataFrame:
    d = F.from_json(F.col("validation_details"), _DETAILS)
    return vr.withColumns({f"_{p}": F.coalesce(d[p]["score"], F.lit("0")).cast("double") for p in POINTS})


def _trend_frame(vr: DataFrame, as_of, window_days: int, by_source: bool,
                 median_accuracy: int | None = None) -> tuple[DataFrame, list[str]]:
    rows = vr.filter(F.col("validation_timestamp") >= days_before(as_of, window_days))
    rows = _point_scores(rows)
    if by_source:
        rows = rows.withColumn("lead_source", F.coalesce(F.col("lead_source"), F.lit("Unknown")))
    keys = ["period_type", "trend_date"] + (["lead_source"] if by_source else [])
    grains = ("daily", "weekly")
    scores = {"dq": "data_quality_score", "fr": "fraud_score"}
    # one row per day (and source) and pair of scores, so that averages, shares and medians come from one aggregate
    parts = rows.groupBy(trunc_ntz("day", "validation_timestamp").alias("day"), *keys[2:],
                         *[F.col(c).cast("double").alias(k) for k, c in scores.items()]).agg(
        F.count(F.lit(1)).alias("n"), *_partial("ov", "overall_score"),
        *[x for k, c in scores.items() for x in _partial(k, c)],
        *[x for p in POINTS for x in _partial(p, f"_{p}")],
        *[count_if(F.col(f"_{p}") >= 0.7).alias(f"pass_{p}") for p in POINTS])
    e = explode_grains(shared(parts), "day", grains, "trend_date")
    dq, fr, n = F.col("dq"), F.col("fr"), F.col("n")
    aggs = [_sum("n").alias("total_validations"), *[_merged_avg(k).alias(f"_avg_{k}") for k in ("dq", "fr", "ov", *POINTS)],
            *[_sum(f"pass_{p}").alias(f"_pass_{p}") for p in POINTS],
            _sum(F.when(dq >= 0.7, n)).alias("_hq"), _sum(F.when(fr >= 0.6, n)).alias("_hf")]
    if by_source:
        aggs.append(_sum(F.when(fr >= 0.7, n)).alias("likely_fake_count"))
    a = e.groupBy(*keys).agg(*aggs)
    if median_accuracy:
        med = grouped_medians(explode_grains(rows, "validation_timestamp", grains, "trend_date"), keys,
                              {f"_med_{k}": c for k, c in scores.items()}, accuracy=median_accuracy)
    else:
        stacked = F.array(*[F.struct(F.lit(k).alias("_metric"), F.col(k).alias("_val")) for k in scores])
        m = weighted_median(e.select(*keys, "n", F.inline(stacked)), [*keys, "_metric"], "_val", "n", "_med")
        med = m.groupBy(*keys).agg(*[F.max(F.when(F.col("_metric") == k, F.col("_med"))).alias(f"_med_{k}") for k in scores])
    a = a.join(med, keys, "left")
    return a, keys


def _trend_columns(n: Column) -> list[Column]:
    r3 = lambda c, name: round_half_away(c, 3).alias(name)
    cols = [r3("_avg_dq", "avg_data_quality_score"), r3("_med_dq", "median_data_quality_score"),
            r3("_avg_fr", "avg_fraud_score"), r3("_med_fr", "median_fraud_score"),
            r3("_avg_ov", "avg_overall_score"),
            *[r3(f"_avg_{p}", f"avg_{p}_score") for p in POINTS],
            *[pct(f"_pass_{p}", n, 1).alias(f"{p}_pass_rate_percent") for p in POINTS],
            pct("_hq", n, 1).alias("high_quality_percentage"),
            pct("_hf", n, 1).alias("high_fraud_risk_percentage")]
    return cols


def _lags(w: Window) -> list[Column]:
    pdq, pfr = F.lag("_avg_dq").over(w), F.lag("_avg_fr").over(w)
    return [round_half_away(pdq, 6).alias("prev_data_quality_score"),
            round_half_away(F.col("_avg_dq") - pdq, 4).alias("data_quality_change"),
            round_half_away(pfr, 6).alias("prev_fraud_score"),
            round_half_away(F.col("_avg_fr") - pfr, 4).alias("fraud_score_change")]


def simplified_trends_overall(vr: DataFrame, as_of, window_days: int = 90,
                              median_accuracy: int | None = None) -> DataFrame:
    """VW-13: daily + weekly score/fraud/point trends with median and lag deltas
    (exact medians unless ``median_accuracy`` asks for sketches)."""
    a, _ = _trend_frame(vr, as_of, window_days, by_source=False, median_accuracy=median_accuracy)
    n = F.col("total_validations")
    w = Window.partitionBy("period_type").orderBy("trend_date")
    return a.select("period_type", "trend_date", "total_validations", *_trend_columns(n), *_lags(w))


def simplified_trends_by_source(vr: DataFrame, as_of, window_days: int = 90,
                                min_daily: int = 5, min_weekly: int = 10,
                                median_accuracy: int | None = None) -> DataFrame:
    """VW-14: VW-13 per source, volume-filtered *before* the lag/rank windows."""
    a, _ = _trend_frame(vr, as_of, window_days, by_source=True, median_accuracy=median_accuracy)
    n = F.col("total_validations")
    a = a.filter(((F.col("period_type") == "daily") & (n >= min_daily))
                 | ((F.col("period_type") == "weekly") & (n >= min_weekly)))
    w = Window.partitionBy("period_type", "lead_source").orderBy("trend_date")
    return a.select(
        "period_type", "trend_date", "lead_source", "total_validations", *_trend_columns(n),
        "likely_fake_count", *_lags(w),
        F.lag(n).over(w).alias("prev_volume"), (n - F.lag(n).over(w)).alias("volume_change"),
        rank_by(F.col("_avg_dq").desc_nulls_last(), partition=["period_type", "trend_date"]).alias("daily_quality_rank"),
        rank_by(F.col("_avg_fr").asc_nulls_last(), partition=["period_type", "trend_date"]).alias("daily_fraud_safety_rank"),
    )
