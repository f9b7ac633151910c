"""Metamorphic properties."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from leadscope.plans import reports_pv as rp
from leadscope.plans import reports_vr as rv
from leadscope.sources import fixtures as fx


def test_union_of_grains_equals_separate_runs(spark):
    vr = fx.vr(spark, SF_SMALL)
    together = rv.validation_trends(vr)
    for g in ("daily", "weekly", "monthly"):
        alone = rv.validation_trends(vr, grains=(g,))
        a = sorted(together.filter(F.col("period_type") == g).collect())
        b = sorted(alone.collect())
        assert a == b, g


def test_source_totals_equal_overall(spark):
    pv = fx.pv(spark, SF_SMALL)
    overall = rp.simplified_overall_results(pv, fx.PV_AS_OF).collect()[0]
    by_source = rp.simplified_results_by_source(pv, fx.PV_AS_OF, ordered=False)
    s = by_source.agg(F.sum("total_validations").alias("n"), F.sum("excellent_quality_count").alias("e"),
                      F.sum("critical_fraud_risk_count").alias("c")).collect()[0]
    assert (s.n, s.e, s.c) == (overall.total_validations, overall.excellent_quality_count,
                               overall.critical_fraud_risk_count)


def test_partitioning_does_not_change_trends(spark):
    vr = fx.vr(spark, SF_SMALL)
    a = sorted(rv.simplified_trends_by_source(vr.repartition(1), fx.VR_AS_OF).collect())
    b = sorted(rv.simplified_trends_by_source(vr.repartition(37), fx.VR_AS_OF).collect())
    assert a == b
