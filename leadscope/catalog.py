"""Registry of named queries: ``key -> f(spark, sf_dir) -> DataFrame``.

Each query reads the test tables through the fixture adapters and runs one
report/operator over the whole input. ``oracle()`` returns the matching DuckDB
SQL where the operator is SQL-expressible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .operators import duplicates as dup
from .operators import fraud as fr
from .operators import parse as ps
from .operators import rules as ru
from .plans import datasets as ds
from .plans import loaders as ld
from .plans import report_lists as rl
from .plans import reports_pv as rp
from .plans import reports_vr as rv
from .plans import retention as rt
from .sources import fixtures as fx
from .sources import ingest as ing
from .sources import render as rd
from .sources import sinks as sk

Query = Callable[[SparkSession, str], DataFrame]

PV = fx.PV_AS_OF
VR = fx.VR_AS_OF


def _pv_queries() -> dict[str, Query]:
    # keyed: parsed_validations holds one row per task (order), as upserts leave it
    return {
        "vw01_source_quality": lambda s, d: rp.source_quality_summary(fx.pv(s, d)),
        "vw02_worst_sources": lambda s, d: rp.worst_lead_sources(rp.source_quality_summary(fx.pv(s, d), ordered=False)),
        "vw03_overview": lambda s, d: rp.validation_overview(fx.pv(s, d), PV),
        "vw04_overall_results": lambda s, d: rp.simplified_overall_results(fx.pv(s, d), PV, keyed=True),
        "vw05_results_by_source": lambda s, d: rp.simplified_results_by_source(fx.pv(s, d), PV, keyed=True),
        "vw06_fake_leads_detail": lambda s, d: rp.fake_leads_detail(fx.pv(s, d)),
        "vw07_daily_fake_leads": lambda s, d: rp.daily_fake_leads_by_source(fx.pv(s, d), PV),
        "vw08_status_anomalies": lambda s, d: rp.fake_leads_status_anomalies(fx.pv(s, d), PV),
    }


def _vr_queries() -> dict[str, Query]:
    return {
        "vw09_validation_summary": lambda s, d: rv.validation_summary(fx.vr(s, d), VR),
        "vw10_validation_metrics": lambda s, d: rv.validation_metrics(rv.validation_summary(fx.vr(s, d), VR)),
        "vw11_validation_by_source": lambda s, d: rv.validation_by_source(rv.validation_summary(fx.vr(s, d), VR), VR),
        "vw12_validation_trends": lambda s, d: rv.validation_trends(fx.vr(s, d)),
        "vw13_trends_overall": lambda s, d: rv.simplified_trends_overall(fx.vr(s, d), VR),
        "vw14_trends_by_source": lambda s, d: rv.simplified_trends_by_source(fx.vr(s, d), VR),
    }


RANGE = ("2001-07-01", "2001-07-31")


def _loader_queries() -> dict[str, Query]:
    return {
        "lq02_lead_list": lambda s, d: ld.lead_list(fx.pv(s, d)),
        "lq04_daily_trends": lambda s, d: ld.daily_trends(fx.pv(s, d), PV),
        "lq05_recent_validations": lambda s, d: ld.recent_validations(fx.pv(s, d)),
        "lq06_problematic_leads": lambda s, d: ld.problematic_leads(fx.pv(s, d)),
        "lq07_category_analysis": lambda s, d: ld.quality_category_analysis(fx.pv(s, d)),
        "lq09_top_worst_sources": lambda s, d: ld.top_worst_sources(fx.pv(s, d)),
        "lq10_data_freshness": lambda s, d: ld.data_freshness(fx.pv(s, d), PV, keyed=True),
        "lq11_daily_fake_leads": lambda s, d: ld.daily_fake_leads(fx.pv(s, d), *RANGE, PV),
        "lq12_daily_fake_detail": lambda s, d: ld.daily_fake_leads_detail(fx.pv(s, d), *RANGE),
        "lq13_last_refresh": lambda s, d: ld.last_refresh_time(fx.pv(s, d)),
        "lq14_creation_months": lambda s, d: ld.creation_month_analysis(fx.pv(s, d)),
        "lq15_source_months": lambda s, d: ld.source_month_performance(fx.pv(s, d)),
        "fb1_overall_results": lambda s, d: ld.overall_results(fx.pv(s, d), PV, "All Time", keyed=True),
        "fb2_results_by_source": lambda s, d: ld.results_by_source(fx.pv(s, d), PV, "Last Month", keyed=True),
        "fb3_fake_leads": lambda s, d: ld.fake_leads(fx.pv(s, d), PV, "All Time"),
        "fb4_trends_overall": lambda s, d: ld.trends_overall(fx.pv(s, d), PV),
        "fb5_trends_by_source": lambda s, d: ld.trends_by_source(fx.pv(s, d), PV),
    }


def _joined(c: str, sep: str = " | ") -> F.Column:
    return F.array_join(F.col(c), sep).alias(c)


def _rule_queries() -> dict[str, Query]:
    def v(s, d):
        return ru.validate_leads(fx.leads(s, d)).withColumnRenamed("Id", "lead_id")

    return {
        "frd1_scores": lambda s, d: fr.fraud_scores(fx.leads(s, d)).select(
            F.col("Id").alias("lead_id"), "fraud_email_score", "fraud_phone_score", "fraud_name_score",
            "fraud_company_score", "fraud_consistency_score", "fraud_score", "is_likely_fake", "risk_level",
            _joined("fraud_indicators")),
        "frd7_levels": lambda s, d: fr.fraud_scores(fx.leads(s, d)).groupBy("risk_level").agg(
            F.count(F.lit(1)).alias("leads"), F.count_if("is_likely_fake").cast("bigint").alias("likely_fake")),
        "doc1_lead_clusters": lambda s, d: dup.duplicate_clusters(fx.leads(s, d)),
        "doc3_retained": lambda s, d: rt.retained(fx.pv(s, d), PV, ts="created_date").select("task_id", "created_date"),
        "doc4_completeness": lambda s, d: rt.completeness_flags(ru.validate_leads(fx.leads(s, d))),
        "doc6_hourly_fraud": lambda s, d: rt.hourly_pattern(fx.pv(s, d)),
        "val2_email": lambda s, d: v(s, d).select("lead_id", "email_valid", "email_score", _joined("email_issues")),
        "val3_domain_typos": lambda s, d: ru.domain_typos(fx.leads(s, d)).select(
            F.col("_domain").alias("domain"), F.col("_typo").alias("typo")),
        "val4_phone": lambda s, d: v(s, d).select("lead_id", "phone_valid", "phone_score", "phone_e164",
                                                  "phone_national", _joined("phone_issues")),
        "val4_line_type": lambda s, d: ru.line_types(ru.validate_leads(fx.leads(s, d))),
        "val5_name": lambda s, d: v(s, d).select("lead_id", "name_score", "name_valid", _joined("name_issues")),
        "val6_company": lambda s, d: v(s, d).select("lead_id", "company_score", "company_valid",
                                                    _joined("company_issues")),
        "val7_completeness": lambda s, d: v(s, d).select(
            "lead_id", "completeness_score", "required_fields_filled", "important_fields_filled",
            "total_fields_filled", _joined("completeness_issues")),
        "val8_data_quality": lambda s, d: v(s, d).select("lead_id", "lint_score", "lint_checks", "lint_issue_count",
                                                         _joined("lint_issues")),
        "val9_quality_score": lambda s, d: v(s, d).select("lead_id", "data_quality_score"),
        "val11_status": lambda s, d: v(s, d).select("lead_id", "data_quality_score", "fraud_score",
                                                    "overall_score", "validation_status"),
        "val12_results": lambda s, d: ru.validation_results(fx.leads(s, d), VR).select(
            "*", F.get_json_object("validation_details", "$.email.score").cast("double").alias("details_email_score"),
            F.get_json_object("validation_details", "$.fraud.risk_level").alias("details_fraud_risk_level"),
        ).drop("validation_details"),
        "val13_issues": lambda s, d: ru.issues_long(ru.validate_leads(fx.leads(s, d))).select(
            "lead_id", "check", "issue", "n_in_check"),
    }


def _parsed_roundtrip(s, d):
    from .oracle.etl import ROUNDTRIP_COLUMNS
    parsed = ps.parse_descriptions(rd.render_tasks(fx.pv(s, d)))
    return parsed.withColumn("has_parse_error", F.col("parse_error").isNotNull()).select(*ROUNDTRIP_COLUMNS)


def _upsert_inputs(s, d):
    pv = fx.pv(s, d)
    k = F.expr("CAST(substring(task_id, 2) AS BIGINT)")
    old = pv.filter((k % 3 != 0) | (k % 2 != 0))
    new = (pv.filter(k % 2 == 0)
           .withColumn("task_id", F.when(k % 97 == 0, F.lit(None)).when(k % 89 == 0, F.lit(""))
                       .otherwise(F.col("task_id")))
           .withColumn("api_quality_score", F.col("api_quality_score") + 1)
           .withColumn("parsed_at", F.lit(PV).cast("timestamp_ntz")))
    return old, new


def _keyed_table(s, d):
    """Three batches into a table of tasks: the old rows, the new ones, and these once more (which writes nothing)."""
    import uuid

    from .session import ensure_checkpoint_dir
    from .sources.keyed import KeyedTable
    old, new = _upsert_inputs(s, d)
    path = f"{ensure_checkpoint_dir(s).rstrip('/')}/leadscope-keyed-{uuid.uuid4().hex[:12]}"
    table = KeyedTable(s, path, old.schema, buckets=16, ignored=("parsed_at",))
    for batch, rows in enumerate((old, new, new)):
        written = table.upsert(rows, batch, keep_old=("parsed_at",))
    if written:
        raise AssertionError(f"a repeated batch wrote buckets {written}")
    return table.read()


def _etl_queries() -> dict[str, Query]:
    def tasks(s, d):
        return rd.render_tasks(fx.pv(s, d))

    task_cols = ["Id", "WhoId", "Subject", "LeadSource", "Company", "Email", "CreatedDate", "LastModifiedDate"]
    return {
        "prs_roundtrip": _parsed_roundtrip,
        "prs12_counters": lambda s, d: ps.parse_counters(ps.parse_descriptions(tasks(s, d))),
        "jon2_semi": lambda s, d: ing.validation_tasks(
            tasks(s, d), force_refresh=True,
            leads=fx.leads(s, d).filter(F.col("LeadSource").isNotNull())).select(*task_cols),
        "src2_incremental": lambda s, d: ing.validation_tasks(tasks(s, d), as_of=PV, days_back=30).select(*task_cols),
        "jon1_attach_who": lambda s, d: ing.attach_who(tasks(s, d), fx.leads(s, d)).select(*task_cols),
        "snk2_upsert": lambda s, d: sk.upsert_parsed(*_upsert_inputs(s, d)),
        "snk1_keyed_table": _keyed_table,
        "snk7_touch": lambda s, d: sk.touch_latest(fx.pv(s, d), f"{PV} 12:00:00"),
    }


def _dataset_queries() -> dict[str, Query]:
    def summary(s, d):
        return rp.source_quality_summary(fx.pv(s, d), ordered=False)

    def worst(s, d):
        return rp.worst_lead_sources(summary(s, d), ordered=False)

    def metrics(s, d):
        return rv.validation_metrics(rv.validation_summary(fx.vr(s, d), VR))

    def series(s, d):
        return ds.top_source_series(ld.source_month_performance(fx.pv(s, d)))

    return {
        "dd01_daily_totals": lambda s, d: ds.daily_totals(fx.pv(s, d), *RANGE),
        "dd02_source_table": lambda s, d: ds.source_table(ld.daily_fake_leads(fx.pv(s, d), *RANGE, PV)),
        "dd03_sources_with_fakes": lambda s, d: ds.sources_with_fakes(ld.daily_fake_leads(fx.pv(s, d), *RANGE, PV)),
        "dd05_problematic_export": lambda s, d: ds.problematic_export(ld.daily_fake_leads_detail(fx.pv(s, d), *RANGE)),
        "dd06_suspicious_per_source": lambda s, d: ds.suspicious_per_source(
            ld.fake_leads(fx.pv(s, d), PV, limit=None)),
        "dd07_raw_json_details": lambda s, d: ds.raw_json_details(ld.fake_leads(fx.pv(s, d), PV, limit=None)),
        "dd08_top_source_series": series,
        "dd09_latest_month": lambda s, d: ds.latest_month_slice(series(s, d)),
        "dd10_month_over_month": lambda s, d: ds.month_over_month(
            ld.creation_month_analysis(fx.pv(s, d)), ld.source_month_performance(fx.pv(s, d))),
        "dd11_score_distribution": lambda s, d: ds.score_distribution(rp.validation_overview(fx.pv(s, d), PV)),
        "dd12_score_histogram": lambda s, d: ds.score_histogram(ld.lead_list(fx.pv(s, d), limit=None)),
        "dd13_quadrants": lambda s, d: ds.quality_fraud_quadrants(summary(s, d)),
        "dd14_worst_summary": lambda s, d: ds.worst_source_summary(worst(s, d)),
        "dd15_source_overview": lambda s, d: ds.source_overview(summary(s, d)),
        "dd16_filtered_sources": lambda s, d: ds.filtered_sources(summary(s, d), "All", 10, "Fraud Rate"),
        "dd17_trend_delta": lambda s, d: ds.trend_delta(ld.daily_trends(fx.pv(s, d), PV)),
        "dd18_comprehensive_report": lambda s, d: ds.comprehensive_report(
            metrics(s, d), ld.problematic_leads(fx.pv(s, d), limit=None)),
        "dd19_compliance_report": lambda s, d: ds.compliance_report(
            metrics(s, d), ld.problematic_leads(fx.pv(s, d), limit=None)),
        "dd20_top_sources": lambda s, d: ds.top_sources_by_count(fx.pv(s, d)),
        "dd21_score_bands": lambda s, d: ds.etl_score_bands(fx.pv(s, d)),
        "dd21_source_means": lambda s, d: ds.etl_source_means(fx.pv(s, d)),
        "dd21_flag_sums": lambda s, d: ds.etl_flag_sums(fx.pv(s, d)),
        "dd14_worst_list": lambda s, d: rl.worst_sources(worst(s, d)),
        "dd17_recent_trends": lambda s, d: rl.recent_trends(ld.daily_trends(fx.pv(s, d), PV)),
        "dd18_band_table": lambda s, d: rl.band_table(metrics(s, d)),
        "dd18_best_sources": lambda s, d: rl.best_sources(
            rv.validation_by_source(rv.validation_summary(fx.vr(s, d), VR), VR)),
        "dd18_worst_leads": lambda s, d: rl.worst_leads(ld.problematic_leads(fx.pv(s, d), limit=None)),
        "dd19_review_list": lambda s, d: rl.review_list(ld.problematic_leads(fx.pv(s, d), limit=None)),
        "dd21_last_means": lambda s, d: rl.last_means(ds.etl_source_means(fx.pv(s, d))),
        "dd22_top_quality_sources": lambda s, d: ds.top_quality_sources(summary(s, d)),
    }


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(_primitive_queries())
    out.update(_stream_queries())
    out.update(_dataset_queries())
    out.update(_etl_queries())
    out.update(_pv_queries())
    out.update(_vr_queries())
    out.update(_loader_queries())
    out.update(_rule_queries())
    return out


def oracle() -> dict[str, str]:
    from .oracle import banded, datasets, duplicates, etl, loaders, pv_reports, report_lists, retention, rules, vr_reports
    out: dict[str, str] = {}
    out.update(datasets.ORACLE)
    out.update(etl.ORACLE)
    out.update(rules.ORACLE)
    out.update(loaders.ORACLE)
    out.update(pv_reports.ORACLE)
    out.update(banded.ORACLE)
    out.update(duplicates.ORACLE)
    out.update(retention.ORACLE)
    out.update(vr_reports.ORACLE)
    out.update(report_lists.ORACLE)
    return {k: v for k, v in out.items() if k in queries()}


# ------------------------------------------------------------------ streaming (STR-1, STR-2)

def _stream_base(spark: SparkSession) -> str:
    import uuid

    from .session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/leadscope-stream-{uuid.uuid4().hex[:12]}"


def _str1(s, d):
    from .oracle.etl import ROUNDTRIP_COLUMNS
    from .streaming import stream as st
    base = _stream_base(s)
    st.land_tasks_json(rd.render_tasks(fx.pv(s, d)), f"{base}/landing")
    q = st.start_task_ingest(s, f"{base}/landing", f"{base}/table", f"{base}/ckpt-ingest", now=PV,
                             available_now=True)
    q.awaitTermination()
    out = s.read.parquet(st.latest_snapshot(s, f"{base}/table"))
    return out.withColumn("has_parse_error", F.col("parse_error").isNotNull()).select(*ROUNDTRIP_COLUMNS)


def _str1_repeated(s, d):
    """Tasks land in two parts, then all once more, changed and unchanged: the table has each task's last version."""
    from .oracle.etl import ROUNDTRIP_COLUMNS
    from .streaming import stream as st
    base = _stream_base(s)
    tasks = rd.render_tasks(fx.pv(s, d))
    newer = F.col("CreatedDate") >= F.lit("2001-07-15").cast("timestamp_ntz")
    first = tasks.filter(newer).withColumn("Description", F.regexp_replace("Description", "Lead Score: ", "Lead Score: 1"))
    for k, part in enumerate((first, tasks.filter(~newer | newer.isNull()), tasks)):
        st.land_tasks_json(part, f"{base}/landing/page={k}")
        st.start_task_ingest(s, f"{base}/landing/*", f"{base}/table", f"{base}/ckpt-ingest", now=PV, available_now=True,
                             buckets=16).awaitTermination()
    out = s.read.parquet(st.latest_snapshot(s, f"{base}/table"))
    return out.withColumn("has_parse_error", F.col("parse_error").isNotNull()).select(*ROUNDTRIP_COLUMNS)


def _str2(s, d):
    from .streaming import stream as st
    base = _stream_base(s)
    st.land_tasks_json(rd.render_tasks(fx.pv(s, d)), f"{base}/landing")
    q = st.start_daily_monitor(s, f"{base}/landing", f"{base}/monitor", f"{base}/ckpt-monitor", available_now=True)
    q.awaitTermination()
    return s.read.parquet(st.latest_snapshot(s, f"{base}/monitor"))


def _str2_late(s, d):
    """Newer tasks land first, older ones after them, then the newer ones once more: three batches at least."""
    from .streaming import stream as st
    base = _stream_base(s)
    tasks = rd.render_tasks(fx.pv(s, d))
    newer = F.col("CreatedDate") >= F.lit("2001-07-15").cast("timestamp_ntz")
    for k, part in enumerate((tasks.filter(newer), tasks.filter(~newer | newer.isNull()), tasks.filter(newer))):
        st.land_tasks_json(part, f"{base}/landing/page={k}")
        st.start_daily_monitor(s, f"{base}/landing/*", f"{base}/monitor", f"{base}/ckpt-monitor",
                               available_now=True).awaitTermination()
    return s.read.parquet(st.latest_snapshot(s, f"{base}/monitor"))


def _str2_report(s, d):
    from .streaming import stream as st
    return st.monitor_report(_str2(s, d), "2001-07-15")


def _stream_queries() -> dict[str, Query]:
    return {"str1_stream_ingest": _str1, "str1_repeated": _str1_repeated, "str2_daily_monitor": _str2, "str2_late_repeated": _str2_late,
            "str2_monitor_report": _str2_report}


# ------------------------------------------------------------------ primitives (AGG-10, WIN-1, WIN-5, WIN-7)

def _primitive_queries() -> dict[str, Query]:
    from pyspark.sql import Window as W

    from .functions import scores as S
    from .functions.exprs import rank_by, trunc_ntz
    from .functions.quantiles import grouped_median

    def weekly(s, d):
        v = fx.vr(s, d).withColumn("lead_source", F.coalesce("lead_source", F.lit("Unknown")))
        return v.groupBy(trunc_ntz("week", "validation_timestamp").alias("week"), "lead_source").agg(
            F.count(F.lit(1)).alias("validations"), F.sum("data_quality_score").alias("_s"))

    def listagg(s, d):
        rows = ld.date_range_filter(S.good_rows(fx.pv(s, d)), *RANGE)
        return (rows.withColumn("_label", rp.fake_lead_label())
                .groupBy(trunc_ntz("day", "created_date").alias("day"), S.source().alias("lead_source"))
                .agg(F.expr("listagg(_label, '; ') WITHIN GROUP (ORDER BY task_id)").alias("fake_leads_list")))

    return {
        "agg12_listagg": listagg,
        "agg12_list_chunks": lambda s, d: rp.fake_lead_chunks(fx.pv(s, d), size=5),
        "agg10_median": lambda s, d: grouped_median(
            fx.vr(s, d).withColumn("lead_source", F.coalesce("lead_source", F.lit("Unknown"))),
            ["lead_source"], "overall_score", "median_overall_score"),
        "win1_latest": lambda s, d: rv.latest_per_lead(fx.vr(s, d)).select(
            "lead_id", "validation_timestamp", "event_id", "overall_score"),
        "win5_rank_in_period": lambda s, d: weekly(s, d).select(
            "week", "lead_source", "validations",
            rank_by(F.col("validations").desc(), partition=["week"]).alias("volume_rank_in_week")),
        "win7_lag": lambda s, d: weekly(s, d).select(
            "week", "lead_source", "validations",
            F.lag("validations").over(W.partitionBy("lead_source").orderBy("week")).alias("prev_validations")),
    }
