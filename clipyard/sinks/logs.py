"""Writing log events: daily indices, per-severity daily files, retention."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipyard.operators.logs import INDEX_PREFIX, RETENTION_DAYS, expired, with_daily_index


def write_daily_indices(events: DataFrame, root: str, mode: str = "append") -> None:
    """One folder per day below ``root``.

    Range partitioning on (day, time) gives every task few days and cuts a day
    that holds much of the data into several tasks.
    """
    named = with_daily_index(events)
    named.repartitionByRange("index_name", "ts").write.mode(mode).partitionBy("index_name").parquet(root)


def write_severity_files(routed: DataFrame, root: str, mode: str = "append") -> None:
    """Lines as text, one folder per day and sink."""
    rows = routed.repartitionByRange("day", "sink", "ts").select("day", "sink", "line")
    rows.write.mode(mode).partitionBy("day", "sink").text(root)


def drop_expired(
    spark: SparkSession, table: str, as_of, days: int = RETENTION_DAYS, prefix: str = INDEX_PREFIX
) -> list[str]:
    """Drop the expired indices (partitions of ``table``); none is fine.

    An index is as old as the day in its name. Only the partition list, one row per
    day, comes to the driver.
    """
    listed = spark.sql(f"SHOW PARTITIONS {table}").select(
        F.substring_index("partition", "=", -1).alias("index_name")
    )
    day = F.regexp_replace(F.expr(f"substring(index_name, {len(prefix) + 1})"), "\\.", "-")
    dated = listed.withColumn("created", day.try_cast("timestamp_ntz"))
    names = [r[0] for r in dated.filter(expired(prefix, as_of, days)).select("index_name").collect()]
    if names:  # one statement, one change of the table
        parts = ", ".join(f"PARTITION (index_name = '{name}')" for name in names)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    return names
