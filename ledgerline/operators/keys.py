"""Dense surrogate keys 1..n without a global sort.

Rows are ordered by (bucket, order). Each bucket is ranked on its own; adding the
number of rows in earlier buckets makes the ranks global. Only that list of
counts, one row per bucket, is summed in one task and broadcast, and the bucket
rule bounds its length whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET, RANK = "_bucket", "_rank"
MAX_HEX_DIGITS = 5  # at most 16**5 = 1,048,576 bucket counts


def bucket_digits(df: DataFrame) -> int:
    """Hex digits that give about 16 buckets or more per shuffle partition.

    The result of :func:`hashed_rank` does not depend on it, only the balance.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digits = 2
    while 16**digits < 16 * partitions and digits < MAX_HEX_DIGITS:
        digits += 1
    return digits


def hashed_rank(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rank in the order (md5 of the keys, keys). ``keys`` must be unique."""
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    # Half as long as bytes, in the same order as the digits.
    hashed = df.withColumn("_digest", F.unhex(F.md5(F.concat_ws("\x1f", *texts))))
    # A bucket is never NULL. If it could be, the join in :func:`dense_key` would filter one of
    # its two readings, by a digest of every row behind ``df``, and nothing would be read once.
    start = F.lower(F.substring(F.hex(F.substring("_digest", 1, 3)), 1, bucket_digits(df)))
    return _rank(hashed, F.coalesce(start, F.lit("")), ["_digest", *keys]).drop("_digest")


def calendar_rank(df: DataFrame, day: str) -> DataFrame:
    """Rank distinct days in calendar order; a bucket is a year (NULL comes first)."""
    year = F.coalesce(F.year(day), F.lit(-1_000_000))
    return _rank(df, year, [day])


def _rank(df: DataFrame, bucket: Column, order: Sequence[str]) -> DataFrame:
    window = Window.partitionBy(BUCKET).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn(BUCKET, bucket).withColumn(RANK, F.row_number().over(window))


def dense_key(ranked: DataFrame, name: str) -> DataFrame:
    """Turn bucket ranks into a global key ``name`` in first position.

    Reads ``ranked`` twice (once only its two rank columns), so a large frame
    should be a written table by now.
    """
    sizes = ranked.groupBy(BUCKET).agg(F.max(RANK).cast("bigint").alias("_size"))
    earlier = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        BUCKET, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    # Bounded by the bucket rule: at most 16**MAX_HEX_DIGITS rows, or one per year.
    keyed = ranked.join(F.broadcast(offsets), BUCKET)
    columns = [c for c in ranked.columns if c not in (BUCKET, RANK)]
    return keyed.select((F.col("_offset") + F.col(RANK)).alias(name), *columns)
