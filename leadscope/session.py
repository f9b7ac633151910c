"""Session construction and cluster-facing settings.

Library functions never create sessions; they take DataFrames. This module is
for entry points (bench, tests, CLI) that need one.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that shape every plan. AQE re-plans joins, coalesces small shuffle
# partitions and splits skewed ones at runtime; the rest pin down semantics
# (UTC, ANSI) so results do not depend on the machine running them.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# For jobs over wide rows. HotSpot doesn't compile methods of more than 8000 bytes: whole-stage code of some 60 columns would
# be interpreted, so Spark is to run such a stage by operators, whose code it cuts into small methods.
WIDE_CONF = {"spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """Runs a job with other settings of the session, which come back after it."""
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def build_session(master: str | None = None, app: str = "leadscope",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Only when it is unset (local tests) do we choose a folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = os.environ.get("LEADSCOPE_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="leadscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d
