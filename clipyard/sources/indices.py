"""Reading a set of named indices: one folder per ``index_name`` below a root."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def index_set(spark: SparkSession, root: str, pattern: str = "*", schema=None) -> DataFrame:
    """All rows of the indices whose name matches a ``*`` pattern.

    The name is a partition column, so other indices are pruned, not scanned.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(root)
    if pattern == "*":
        return rows
    escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return rows.filter(F.col("index_name").like(escaped.replace("*", "%")))
