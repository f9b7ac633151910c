"""The ETL run: landed tasks -> validation tasks table + parsed table
snapshots, CSV backup and run counters (the batch ETL entry point), plus
view registration for SQL users.

Tables are keyed tables in hash buckets (``sources.keyed``): a run rewrites the
buckets of its changed tasks, and can simply be run again if it fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.parse import parse_counters, parse_descriptions
from ..sources import ingest, sinks
from ..sources.keyed import KeyedTable
from ..streaming.stream import latest_snapshot
from . import reports_pv as rp
from . import reports_vr as rv

TASKS_TABLE = "validation_tasks"
PARSED_TABLE = "parsed_validations"


def stored_tables(spark: SparkSession, root: str, buckets: int = 64) -> dict[str, KeyedTable]:
    """The tables that exist under a root."""
    paths = {name: latest_snapshot(spark, f"{root}/{name}") for name in (TASKS_TABLE, PARSED_TABLE)}
    return {name: KeyedTable(spark, f"{root}/{name}", spark.read.parquet(path).schema, buckets=buckets) for name, path in paths.items() if path}


def tasks_table(tasks: DataFrame, extracted_at) -> DataFrame:
    """Rows of ``validation_tasks`` (snake_case names, extraction stamp)."""
    return tasks.select(
        F.col("Id").alias("task_id"), F.col("WhoId").alias("who_id"), F.col("WhatId").alias("what_id"),
        F.col("Subject").alias("subject"), F.col("Description").alias("description"),
        F.col("LeadSource").alias("lead_source"), F.col("Company").alias("lead_company"),
        F.col("Email").alias("lead_email"), F.col("CreatedDate").alias("created_date"),
        F.col("LastModifiedDate").alias("last_modified_date"),
        F.lit(str(extracted_at)).cast("timestamp_ntz").alias("extracted_at"))


def run_etl(spark: SparkSession, landing: str, root: str, run_id: int, as_of, days_back: int = 30,
            force_refresh: bool = False, validation_only: bool = False, leads: DataFrame | None = None,
            backup: str | None = None, buckets: int = 64) -> DataFrame:
    """One ETL run; returns the run counters (PRS-12) as a one-row DataFrame.

    * extract: landed task pages, ``Subject`` prefix, ``LastModifiedDate``
      cutoff unless ``force_refresh``, known leads only when ``leads`` given;
    * ``validation_only``: re-parse the stored tasks table instead;
    * save: keyed upsert of tasks (``task_id``) and parsed rows (``parsed_at``
      of already-parsed tasks is kept); unchanged tasks write nothing;
    * backup: optional CSV copy of the parsed table.

    A run may be repeated under its id; an id below that of a stored run raises,
    as its tasks would replace newer ones.
    """
    if (done := stored_tables(spark, root, buckets)) and (newest := max((t.last_batch() or 0 for t in done.values()), default=0)) > run_id:
        raise ValueError(f"run {run_id} is older than run {newest} under {root}")
    if validation_only:
        if TASKS_TABLE not in done:
            raise FileNotFoundError(f"no {TASKS_TABLE} under {root}")
        tasks = ingest.stored_tasks(spark, latest_snapshot(spark, f"{root}/{TASKS_TABLE}"))
    else:
        raw = ingest.flatten_tasks(ingest.read_landed_tasks(spark, landing))
        tasks = ingest.validation_tasks(raw, as_of=as_of, days_back=days_back, force_refresh=force_refresh,
                                        leads=leads)
        # the landed pages are read once; the tasks table and the parser read what was extracted
        aside = f"{root}/extracted/run={run_id:012d}"
        tasks.write.mode("overwrite").parquet(aside)
        tasks = spark.read.schema(tasks.schema).parquet(aside)
        new_tasks = tasks_table(tasks, as_of)
        KeyedTable(spark, f"{root}/{TASKS_TABLE}", new_tasks.schema, buckets=buckets, ignored=("extracted_at",)).upsert(new_tasks, run_id)

    parsed = parse_descriptions(tasks).withColumn("parsed_at", F.lit(str(as_of)).cast("timestamp_ntz"))
    table = KeyedTable(spark, f"{root}/{PARSED_TABLE}", parsed.schema, buckets=buckets, ignored=("parsed_at",))
    table.upsert(parsed, run_id, keep_old=("parsed_at",), default_now=as_of)
    stored = table.read()
    if not validation_only:
        table.fs.delete(table._path(aside), True)
    if backup:
        sinks.write_csv(stored, backup)
    return parse_counters(stored)


def register_views(spark: SparkSession, pv: DataFrame, vr: DataFrame | None, as_of) -> list[str]:
    """LQ-8: register the report views in dependency order (VW-1 before VW-2
    before VW-3 ...) so SQL users can query them by name. Views are lazy."""
    names = []

    def reg(name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)
        names.append(name)

    reg("parsed_validations", pv)
    summary = rp.source_quality_summary(pv, ordered=False)
    reg("lead_source_quality_summary", summary)
    worst = rp.worst_lead_sources(summary, ordered=False)
    reg("worst_lead_sources", worst)
    reg("lead_validation_overview", rp.validation_overview(pv, as_of, summary))
    reg("simplified_overall_results", rp.simplified_overall_results(pv, as_of))
    reg("simplified_results_by_source", rp.simplified_results_by_source(pv, as_of, ordered=False))
    reg("fake_leads_detail", rp.fake_leads_detail(pv))
    reg("daily_fake_leads_by_source", rp.daily_fake_leads_by_source(pv, as_of, ordered=False))
    reg("fake_leads_status_anomalies", rp.fake_leads_status_anomalies(pv, as_of))
    if vr is not None:
        reg("validation_results", vr)
        s = sinks.checkpointed(rv.validation_summary(vr, as_of))
        reg("validation_summary", s)
        reg("validation_metrics", rv.validation_metrics(s))
        reg("validation_by_source", rv.validation_by_source(s, as_of))
        reg("validation_trends", rv.validation_trends(vr))
        reg("simplified_trends_overall", rv.simplified_trends_overall(vr, as_of))
        reg("simplified_trends_by_source", rv.simplified_trends_by_source(vr, as_of))
    return names
