"""DOC-3, DOC-4, DOC-6: retention by day, minimum completeness, hourly fraud pattern."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions.exprs import count_if, pct

# The configured retention and completeness.
RETENTION_DAYS, MINIMUM_COMPLETENESS = 90, 0.7
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def retained(rows: DataFrame, as_of, days: int = RETENTION_DAYS, ts: str = "last_modified_date") -> DataFrame:
    """DOC-3: rows modified on the day ``days`` before ``as_of`` or later. Rows without a date have no age and stay."""
    first = F.lit(str(as_of)).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAY")
    return rows.filter(F.col(ts).isNull() | (F.col(ts) >= first))


def write_by_day(rows: DataFrame, path: str, ts: str = "last_modified_date") -> None:
    """Store rows in day partitions (``day=``), replacing the days that the rows hold and no others."""
    (rows.withColumn("day", F.col(ts).cast("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def read_retained(spark: SparkSession, path: str, as_of, days: int = RETENTION_DAYS) -> DataFrame:
    """What the table holds of the days in retention: other days' files are not read."""
    first = datetime.date.fromisoformat(str(as_of)[:10]) - datetime.timedelta(days=days)
    return spark.read.parquet(path).filter(F.col("day").isNull() | (F.col("day") >= F.lit(first))).drop("day")


def expire(spark: SparkSession, path: str, as_of, days: int = RETENTION_DAYS) -> list[str]:
    """Remove whole days that are past retention, without reading a row; the days removed.

    Days are found in the folder's names, so the work is one listing. Removing a day twice does nothing, so a run that
    was cut off is simply repeated.
    """
    first = datetime.date.fromisoformat(str(as_of)[:10]) - datetime.timedelta(days=days)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        day = name.removeprefix("day=")
        if name.startswith("day=") and day != NO_DAY and datetime.date.fromisoformat(day) < first:
            fs.delete(status.getPath(), True)
            gone.append(day)
    return sorted(gone)


def completeness_flags(validated: DataFrame, minimum: float = MINIMUM_COMPLETENESS) -> DataFrame:
    """DOC-4: lead_id, completeness_score and whether it reaches the minimum, over VAL-7's scores."""
    return validated.select(F.col("Id").alias("lead_id"), "completeness_score",
                            F.coalesce(F.col("completeness_score") >= minimum, F.lit(False)).alias("meets_minimum"))


def hourly_pattern(pv: DataFrame) -> DataFrame:
    """DOC-6: leads and fake leads by hour of creation (0-23), over all parsed rows with a creation time."""
    rows = S.good_rows(pv).filter(F.col("created_date").isNotNull())
    hours = rows.groupBy(F.hour("created_date").cast("bigint").alias("hour")).agg(
        F.count(F.lit(1)).alias("total_leads"), count_if(S.is_fake()).alias("fake_leads"), F.count_distinct(S.source()).alias("sources"))
    return hours.withColumn("fake_percentage", pct(F.col("fake_leads"), F.col("total_leads")))
