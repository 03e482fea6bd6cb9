"""JSON text of rows, the wire format of tasks, articles and hits."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode(*columns: str) -> Column:
    """The named columns as one JSON object."""
    return F.to_json(F.struct(*columns))
