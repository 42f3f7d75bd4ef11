"""Flat transactions to one fact and four dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import date_parts
from ledgerline.operators.dedupe import dedupe
from ledgerline.operators.fills import leave_ids, restore_ids
from ledgerline.operators.keys import calendar_rank, dense_key, hashed_rank
from ledgerline.operators.lookups import attach_key
from ledgerline.schemas import (
    CATEGORY,
    DATE_PARTS,
    DIM_ACCOUNT,
    DIM_CATEGORY,
    DIM_DATE,
    DIM_LOCATION,
    FACT,
    FILLED_IDS,
    PARTITIONS,
    SOURCE_ID,
)
from ledgerline.sinks.files import Stage

LOCATION_ID = "location_id"
GRAINS = {"primary": CATEGORY[:1], "full": CATEGORY}


def unique_transactions(flat: DataFrame) -> DataFrame:
    return dedupe(flat, SOURCE_ID)


def dim_date(unique: DataFrame) -> DataFrame:
    """Only the day is made distinct; its parts follow from it afterwards."""
    days = dense_key(calendar_rank(unique.select("date").distinct(), "date"), "date_id")
    return days.withColumns(date_parts(F.col("date"))).select(*DIM_DATE)


def dim_account(unique: DataFrame) -> DataFrame:
    pair = DIM_ACCOUNT[1:]
    return dense_key(hashed_rank(unique.select(*pair).distinct(), pair), "account_pk")


def dim_category(unique: DataFrame, grain: str = "primary") -> DataFrame:
    """One row per primary category, which shows its first detail and confidence.

    ``grain="full"`` keeps every combination. Combinations are counted first, by
    hash before the shuffle, so a category with a third of all rows is no burden.
    Taking the count along keeps the optimizer from dropping that step, which would
    leave a sort of all rows; as last field it never decides which row is first.
    """
    keys = GRAINS[grain]
    members = unique.groupBy(*CATEGORY).agg(F.count("*").alias("_n"))
    if keys != CATEGORY:
        members = dedupe(members, *keys)
    return dense_key(hashed_rank(members, keys), "category_id").select(*DIM_CATEGORY)


def ranked_transactions(flat: DataFrame, stage: Stage) -> DataFrame:
    """Unique transactions with their ``location_id``, written once for all readers.

    Only the ids are ranked. Full rows move once, by id to remove duplicates, and
    the numbers come to them there. Date parts stay behind: they follow from the
    date, which comes before them in the order of first rows, and only
    ``dim_date`` needs them again. Ids that were filled in stay behind as well, also in
    the written rows: they follow from the transaction id, and are made again by who reads them.
    """
    ranks = stage.save(hashed_rank(flat.select(SOURCE_ID).distinct(), [SOURCE_ID]), "ranks")
    # As a struct the id is a key that joins a NULL id too, without a null-safe condition,
    # which would move the full rows again. Its hash comes first: sorts compare numbers then,
    # and look into the rows only where two are equal. The rows carry the id in it alone.
    key = [F.xxhash64(SOURCE_ID).alias("_key"), F.struct(SOURCE_ID).alias("_id")]
    numbers = dense_key(ranks, LOCATION_ID).select(*key, LOCATION_ID)
    kept = [c for c in flat.columns if c not in DATE_PARTS]
    ids = [c for c in FILLED_IDS if c in kept]
    lean = leave_ids(flat.select(*kept), SOURCE_ID, ids)
    rest = [c for c in lean.columns if c != SOURCE_ID]
    unique = dedupe(lean.select(*rest, *key), ["_key", "_id"])
    numbered = unique.join(numbers, ["_key", "_id"]).withColumn(SOURCE_ID, F.col("_id")[SOURCE_ID])
    saved = stage.save(numbered.select(*lean.columns, LOCATION_ID), "unique")
    return restore_ids(saved, SOURCE_ID, ids).select(*kept, LOCATION_ID)


def dated(ranked: DataFrame) -> DataFrame:
    """With the columns that loaded tables are partitioned by (0 without a date)."""
    parts = [F.coalesce(part("date"), F.lit(0)) for part in (F.year, F.month)]
    return ranked.withColumns(dict(zip(PARTITIONS, parts)))


def dim_location(ranked: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """One location per transaction, numbered 1..n."""
    return ranked.select(*DIM_LOCATION, *extra)


def fact_transactions(
    ranked: DataFrame,
    dates: DataFrame,
    categories: DataFrame,
    grain: str = "primary",
    extra: Sequence[str] = (),
) -> DataFrame:
    """The fact and :func:`dim_location` project the same numbered frame, so their
    location ids agree without any join by position."""
    fact = attach_key(ranked, dates, ["date"], "date_id")
    fact = attach_key(fact, categories, GRAINS[grain], "category_id")
    return fact.withColumn("transaction_id", F.col(SOURCE_ID)).select(*FACT, *extra)


def build_star(
    flat: DataFrame, stage: Stage, grain: str = "primary", partitioned: bool = False
) -> dict[str, DataFrame]:
    """The five tables. Staged: the unique transactions and the small dimensions.

    ``partitioned`` gives the two large tables their partition columns, at the end."""
    extra = PARTITIONS if partitioned else ()
    ranked = ranked_transactions(flat, stage)
    dims = stage.save_all(
        {
            "dim_account": dim_account(ranked),
            "dim_date": dim_date(ranked),
            "dim_category": dim_category(ranked, grain),
        }
    )
    ranked = dated(ranked) if partitioned else ranked
    fact = fact_transactions(ranked, dims["dim_date"], dims["dim_category"], grain, extra)
    return {**dims, "dim_location": dim_location(ranked, extra), "fact_transactions": fact}
