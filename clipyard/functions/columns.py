"""Keeping costly expressions from being computed more than once per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    A higher-order function re-evaluates whatever expression its lambda
    mentions; passing the value in as the element of a one-element array makes
    it a lambda variable instead.
    """
    return F.transform(F.array(value), body)[0]


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections cannot compute again.

    A filter on a plain computed column is pushed below the projection together
    with a copy of the expression. Generating the columns from a one-row array
    keeps them where they are; the plan stays narrow.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def fresh(columns: list[str], base: str) -> str:
    """A column name like ``base`` that none of ``columns`` has (case blind, as Spark)."""
    taken = {c.lower() for c in columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name
