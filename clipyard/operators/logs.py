"""Severity routing and daily naming of log events, and retention of old indices."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Severity ranks (smaller is more severe).
LEVELS = {"FATAL": 100, "ERROR": 200, "WARN": 300, "INFO": 400, "DEBUG": 500, "TRACE": 600}
#: Least severe level any sink gets to see.
ROOT_LEVEL = "INFO"
#: Sink name: most and least severe level it accepts, level of its reference.
SINKS = {
    "DATA": ("FATAL", "INFO", "INFO"),
    "error": ("FATAL", "ERROR", "ERROR"),
    "warn": ("WARN", "WARN", "WARN"),
    "all": ("FATAL", "INFO", "DEBUG"),
}
# Daily index naming and retention.
INDEX_PREFIX = "logstash-"
INDEX_DAY = "yyyy.MM.dd"
RETENTION_DAYS = 2


def severity(level) -> Column:
    """Rank of a level name, null when unknown."""
    pairs = [F.lit(x) for item in LEVELS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.upper(level))


def level_between(level, most_severe: str, least_severe: str) -> Column:
    """Is the level in the range, both ends included?"""
    return severity(level).between(LEVELS[most_severe], LEVELS[least_severe])


def route_by_severity(events: DataFrame, level: str = "level") -> DataFrame:
    """Every event once per sink that accepts it, with ``sink`` and ``day``."""
    accepted = [
        F.when(
            level_between(level, most, least) & (severity(level) <= LEVELS[reference]),
            F.lit(name),
        )
        for name, (most, least, reference) in SINKS.items()
    ]
    passes_root = severity(level) <= LEVELS[ROOT_LEVEL]
    return (
        events.filter(passes_root)
        .withColumn("sink", F.explode(F.array_compact(F.array(*accepted))))
        .withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    )


def with_daily_index(events: DataFrame, ts: str = "ts", arrival: Column | None = None) -> DataFrame:
    """Add ``index_name``, one index per day.

    An event without a time of its own (a line that does not parse) goes to the day of
    ``arrival``; without that its index stays null.
    """
    day = F.col(ts) if arrival is None else F.coalesce(ts, arrival)
    return events.withColumn("index_name", F.concat(F.lit(INDEX_PREFIX), F.date_format(day, INDEX_DAY)))


def expired(prefix: str, as_of, days: int, name="index_name", created="created") -> Column:
    """Has the index the prefix and an age of more than ``days``?"""
    limit = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    return F.col(name).startswith(prefix) & (F.col(created).cast("timestamp_ntz") < limit)


def retain(rows: DataFrame, as_of, days: int = RETENTION_DAYS, prefix: str = INDEX_PREFIX) -> DataFrame:
    """Rows of the indices that retention keeps."""
    return rows.filter(~expired(prefix, as_of, days))
