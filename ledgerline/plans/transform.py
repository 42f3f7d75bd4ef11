"""Raw records to flat, complete, typed transactions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import date_parts, parse_date
from ledgerline.operators.fills import fill_ids, fill_literals, fill_owner, fill_place
from ledgerline.operators.records import (
    drop_unused,
    flatten_category,
    flatten_location,
    rename_fields,
)
from ledgerline.schemas import ACCOUNT_OWNERS, BOROUGHS, FILLED_IDS, SOURCE_ID, TRANSFORMED


def transform(
    raw: DataFrame,
    owners: Mapping[str, str] | DataFrame = ACCOUNT_OWNERS,
    cells: Sequence[tuple[str, float, float, str]] = BOROUGHS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """27 columns per raw record; repeated records stay repeated.

    Map-only, except that a table of owners is joined. Columns of ``keep`` go along.
    """
    flat = rename_fields(flatten_location(flatten_category(drop_unused(raw))))
    filled = fill_literals(fill_place(fill_owner(flat, owners), SOURCE_ID, cells))
    filled = fill_ids(filled, SOURCE_ID, FILLED_IDS)
    typed = filled.withColumns(
        {"date": parse_date(F.col("date")), "amount_usd": rounded(F.col("amount"))}
    )
    return typed.withColumns(date_parts(F.col("date"))).select(*TRANSFORMED, *keep)


def rounded(amount: Column) -> Column:
    """Cents, halves away from zero."""
    return F.round(amount, 2)
