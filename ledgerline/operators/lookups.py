"""Key lookups of the star build and left joins of the models.

No join carries a broadcast hint. The dimensions are written before they are
joined, so Spark knows their true size: below ``autoBroadcastJoinThreshold`` they
are broadcast and the fact is not moved; above it both sides are shuffled, and
AQE splits the partition of a key that holds a large share of the fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_key(df: DataFrame, dim: DataFrame, on: Sequence[str], key: str) -> DataFrame:
    """Add the dimension's ``key``; a NULL member of the dimension matches NULL."""
    side = dim.select(key, *[F.col(c).alias(f"_dim_{c}") for c in on])
    same = reduce(
        lambda left, right: left & right,
        [F.col(c).eqNullSafe(F.col(f"_dim_{c}")) for c in on],
    )
    return df.join(side, same, "left").select(*df.columns, key)


def left_lookup(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left equi-join that adds ``columns`` of the dimension."""
    return fact.join(dim.select(key, *columns), key, "left")


def one_row_per_key(
    dim: DataFrame, key: str, columns: Sequence[str], known: str | None = None
) -> DataFrame:
    """First row of each key by ``columns``: joining it never repeats a fact row.

    Rows that have a value in column ``known`` come before those that lack it.

    Grouping by a struct of the key looks odd but matters at scale. Grouped by the
    key itself, the result would already lie as the join needs it, and AQE splits a
    skewed partition only when both sides of the join come straight from a shuffle.
    So the reduced dimension is shuffled once more, and a hot key is split.
    """
    lacking = [F.col(known).isNull().alias("_lacking")] if known else []
    first = F.min(F.struct(*lacking, *columns)).alias("_first")
    grouped = dim.groupBy(F.struct(key).alias("_key")).agg(first)
    return grouped.select(f"_key.{key}", *[f"_first.{c}" for c in columns])


def one_row_per_account(dim_account: DataFrame) -> DataFrame:
    """A known owner is shown even if the account also came without one."""
    return one_row_per_key(
        dim_account, "account_id", ["account_pk", "account_owner"], known="account_owner"
    )
