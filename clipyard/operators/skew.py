"""Joins that hold when one key carries a large share of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(facts: DataFrame, keys: DataFrame, on, how="left") -> DataFrame:
    """Join ``facts`` to a table with one row per key, safe for hot keys.

    A plain equi-join of two shuffled tables, which is the form whose skewed partitions
    Spark splits at run time: whatever the number of hot keys, rows of ``facts`` of one
    key go to as many tasks as their size asks for, and the one row of the key goes to
    each. ``how`` is ``left`` or ``inner``. Null keys match nothing.
    """
    on = [on] if isinstance(on, str) else list(on)
    values = [c for c in keys.columns if c not in on]
    renamed = keys.select(*[F.col(c).alias(f"_k_{c}") for c in on], *values)
    match = [F.col(c) == F.col(f"_k_{c}") for c in on]
    joined = facts.join(renamed, match, how)
    return joined.select(*[joined[c] for c in facts.columns], *[joined[v] for v in values])
