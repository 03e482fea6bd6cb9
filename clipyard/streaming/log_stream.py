"""Continuous log ingest: daily index of every line, severity files of parsed ones.

Each micro-batch is written as a batch job (``foreachBatch``) with a rebalance on its
folders: adaptive execution cuts a folder that gets many bytes into several tasks and
merges light ones into one file, by the bytes it observes rather than a fixed number of
tasks. A batch lands in partitions ``batch=<writer>-<id>`` of its own and replaces them
when it is replayed, so delivery is effectively once.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipyard.operators.logs import route_by_severity, with_daily_index
from clipyard.sources.logs import parse_lines
from clipyard.streaming.index_stream import writer_of


def _start(rows: DataFrame, path: str, checkpoint: str, by: list[str], trigger: dict):
    writer = writer_of(rows.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch", F.lit(f"{writer}-{batch_id}"))
            .hint("rebalance", *by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by, "batch")
            .parquet(path)
        )

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_severity_files(lines: DataFrame, path: str, checkpoint: str, line="value", **trigger):
    """Parse a stream of lines and write each event to its sinks by day."""
    return _start(
        route_by_severity(parse_lines(lines, line)), path, checkpoint, ["day", "sink"], trigger
    )


def start_daily_indices(lines: DataFrame, path: str, checkpoint: str, line="value", **trigger):
    """Write a stream of lines to daily indices; lines that do not parse by arrival."""
    arrival = F.current_timestamp().cast("timestamp_ntz")
    rows = with_daily_index(parse_lines(lines, line), arrival=arrival)
    return _start(rows, path, checkpoint, ["index_name"], trigger)
