"""Benchmark: headline reports at $BENCH_SF_DIR on local[$BENCH_CPUS].

The lead tables are first derived from the test data and written once as
Parquet (what the ETL stores in production: ``parsed_validations``,
``validation_results``, leads, rendered tasks); each query then runs over the
stored tables. Reported time per query is the median of 3 warm runs, each
fully executed (``noop`` write, so nothing is collected to the driver).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from leadscope.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(f"local[{cpus}]", app="leadscope-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    from leadscope.operators import fraud, parse, rules
    from leadscope.plans import loaders as ld
    from leadscope.plans import reports_pv as rp
    from leadscope.plans import reports_vr as rv
    from leadscope.sources import fixtures as fx
    from leadscope.sources import render, sinks

    work = tempfile.mkdtemp(prefix="leadscope-bench-")
    t0 = time.time()
    # stored tables laid out with one file per core (as a production table has many splits)
    n = int(cpus)
    fx.pv(spark, sf_dir).repartition(n).write.parquet(f"{work}/pv")
    fx.vr(spark, sf_dir).repartition(n).write.parquet(f"{work}/vr")
    fx.leads(spark, sf_dir).repartition(n).write.parquet(f"{work}/leads")
    render.render_tasks(fx.pv(spark, sf_dir)).repartition(n).write.parquet(f"{work}/tasks")
    prep = time.time() - t0

    pv = spark.read.parquet(f"{work}/pv")
    vr = spark.read.parquet(f"{work}/vr")
    leads = spark.read.parquet(f"{work}/leads")
    tasks = spark.read.parquet(f"{work}/tasks")
    PV, VR = fx.PV_AS_OF, fx.VR_AS_OF

    headline = {
        "vw01_source_quality": lambda: rp.source_quality_summary(pv),
        "vw03_overview": lambda: rp.validation_overview(pv, PV),
        "vw05_results_by_source": lambda: rp.simplified_results_by_source(pv, PV),
        "vw06_fake_leads_detail": lambda: rp.fake_leads_detail(pv),
        "vw07_daily_fake_leads": lambda: rp.daily_fake_leads_by_source(pv, PV),
        "vw08_status_anomalies": lambda: rp.fake_leads_status_anomalies(pv, PV),
        "vw10_validation_metrics": lambda: rv.validation_metrics(sinks.checkpointed(rv.validation_summary(vr, VR))),
        "vw11_validation_by_source": lambda: rv.validation_by_source(
            sinks.checkpointed(rv.validation_summary(vr, VR)), VR),
        "vw12_validation_trends": lambda: rv.validation_trends(vr),
        "vw14_trends_by_source": lambda: rv.simplified_trends_by_source(vr, VR),
        "lq02_lead_list": lambda: ld.lead_list(pv),
        "lq11_daily_fake_leads": lambda: ld.daily_fake_leads(pv, "2001-07-01", "2001-07-31", PV),
        "fb2_results_by_source": lambda: ld.results_by_source(pv, PV, "Last Month"),
        "val11_validate_leads": lambda: rules.validate_leads(leads),
        "frd1_fraud_scores": lambda: fraud.fraud_scores(leads),
        "prs_parse_tasks": lambda: parse.parse_descriptions(tasks),
        "snk2_upsert": lambda: sinks.upsert_parsed(pv, pv.filter("parse_error IS NULL"), now=PV),
    }
    only = [k for k in os.environ.get("BENCH_ONLY", "").split(",") if k]
    times = {}
    for name, q in headline.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(reps):
            s = time.time()
            q().write.format("noop").mode("overwrite").save()
            runs.append(time.time() - s)
        times[name] = round(statistics.median(runs), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "sum of per-query warm median seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
                      "prep_sec": round(prep, 3), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
