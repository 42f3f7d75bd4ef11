"""One row per key, and how many rows that removes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep the first row of each key (a column or several), by ``order_by`` and then all other columns.

    Ascending, NULLs first, so the choice does not depend on input order. Spark
    applies the limit of one row per key on both sides of the shuffle: a key that
    holds a third of all rows leaves each map task as one row. NULL is a key like
    any other.
    """
    keys = [key] if isinstance(key, str) else [*key]
    rest = [*order_by, *[c for c in df.columns if c not in keys and c not in order_by]]
    if not rest:
        return df.distinct()
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in rest])
    number = "_n"
    while number in {c.lower() for c in df.columns}:
        number += "_"
    return df.withColumn(number, F.row_number().over(first)).where(F.col(number) == 1).drop(number)


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows before and after :func:`dedupe`, in one pass over the key alone."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )
