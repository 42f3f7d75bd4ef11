"""Filling missing values. Present values are never changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import stable
from ledgerline.operators.lookups import one_row_per_key
from ledgerline.schemas import BOROUGHS, DEFAULT_COUNTRY, DEFAULT_REGION


def fill_literals(df: DataFrame, values: Mapping[str, str] | None = None) -> DataFrame:
    values = values or {"region": DEFAULT_REGION, "country": DEFAULT_COUNTRY}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def fill_owner(df: DataFrame, owners: Mapping[str, str] | DataFrame) -> DataFrame:
    """Fill ``account_owner`` from ``account_id``; an unknown id stays NULL.

    ``owners`` is a mapping, which becomes one constant of the plan and is searched
    from its start for each record, or a table (account_id, account_owner), which
    is the better form of a long list. The table is reduced to one row per account, so no record is repeated,
    and joined without a hint: Spark broadcasts it when its size allows, else it
    shuffles, and AQE splits the partition of an account that holds a large share
    of the records (the left side of a left join may be split).
    """
    if isinstance(owners, DataFrame):
        known = owners.where("account_owner IS NOT NULL")
        named = one_row_per_key(known, "account_id", ["account_owner"])
        named = named.withColumnRenamed("account_owner", "_owner")
        return (
            df.join(named, "account_id", "left")
            .withColumn("account_owner", F.coalesce("account_owner", "_owner"))
            .select(*df.columns)
        )
    if not owners:
        return df
    pairs = [F.lit(text) for pair in owners.items() for text in pair]
    known = F.create_map(*pairs)
    return df.withColumn("account_owner", F.coalesce("account_owner", known[F.col("account_id")]))


def fill_ids(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fill id columns with a UUID-shaped text that depends on the key and column.

    The digests are columns of their own, so that each is computed once per row,
    and only for rows that lack the value.
    """
    digests = {
        f"_digest_{c}": F.when(F.col(c).isNull(), stable.digest(F.col(key), c)) for c in columns
    }
    filled = {
        c: F.coalesce(F.col(c), stable.uuid_shaped(F.col(f"_digest_{c}"))) for c in columns
    }
    return df.withColumns(digests).withColumns(filled).drop(*digests)


def _stand_ins(key: str, columns: Sequence[str]) -> dict[str, Column]:
    """What :func:`fill_ids` gives each of the columns for a row that lacks it."""
    return {f"_own_{c}": stable.uuid_shaped(stable.digest(F.col(key), c)) for c in columns}


def _side(column: str) -> str:
    return f"_side_{column}"


def leave_ids(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Leave out what :func:`fill_ids` filled in: it follows from the row's key, and digests do not pack.

    A column that holds its stand-in becomes NULL. A small number before it (``_side_``) tells how the
    value compares with the stand-in, so rows of one key sort by the two as they did by the value;
    :func:`restore_ids` gives it back. Any other value stays as it is, a missing one stays missing."""
    lean: list[Column | str] = []
    for c in df.columns:
        if c in columns:
            value, own = F.col(c), F.col(f"_own_{c}")
            side = F.when(value.isNull(), -2).when(value < own, -1).when(value > own, 1).otherwise(0)
            lean += [side.cast("tinyint").alias(_side(c)), F.when(value != own, value).alias(c)]
        else:
            lean.append(c)
    return df.withColumns(_stand_ins(key, columns)).select(*lean)


def restore_ids(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Undo :func:`leave_ids`."""
    own = _stand_ins(key, columns)
    values = {c: F.when(F.col(_side(c)) == 0, own[f"_own_{c}"]).otherwise(F.col(c)) for c in columns}
    return df.withColumns(values).drop(*[_side(c) for c in columns])


def fill_place(
    df: DataFrame, key: str, cells: Sequence[tuple[str, float, float, str]] = BOROUGHS
) -> DataFrame:
    """Fill city, postal code, coordinates and store number.

    All fields of a row come from the same cell, however many of them are
    missing. One digest gives the cell, both coordinate offsets and the number.
    """
    options = F.array(
        *[
            F.struct(
                F.lit(city).alias("city"),
                F.lit(lat).alias("lat"),
                F.lit(lon).alias("lon"),
                F.lit(postal).alias("postal_code"),
            )
            for city, lat, lon, postal in cells
        ]
    )
    digest, cell = F.col("_digest"), F.col("_cell")
    store = F.lpad((stable.choose(digest, 900, word=3) + 100).cast("string"), 3, "0")
    return (
        df.withColumn("_digest", stable.digest(F.col(key), "place"))
        .withColumn("_cell", F.get(options, stable.choose(digest, len(cells)).cast("int")))
        .withColumns(
            {
                "city": F.coalesce("city", cell["city"]),
                "postal_code": F.coalesce("postal_code", cell["postal_code"]),
                "lat": F.coalesce("lat", cell["lat"] + stable.jitter(digest, word=1)),
                "lon": F.coalesce("lon", cell["lon"] + stable.jitter(digest, word=2)),
                "store_number": F.coalesce("store_number", store),
            }
        )
        .drop("_digest", "_cell")
    )
