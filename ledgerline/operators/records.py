"""Flattening, renaming and combining raw records. All narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.schemas import LOCATION, SOURCE_ID, UNUSED


def drop_unused(raw: DataFrame) -> DataFrame:
    """Drop the fields no table uses; a field the feed lacks is ignored."""
    return raw.drop(*UNUSED, "merchant_name")


def rename_fields(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed({"transaction_id": SOURCE_ID, "name": "transaction_name"})


def category_fields(struct: str = "personal_finance_category") -> dict[str, Column]:
    source = {
        "category_primary": "primary",
        "category_detail": "detailed",
        "category_confidence": "confidence_level",
    }
    return {name: F.col(f"{struct}.{field}") for name, field in source.items()}


def location_fields(struct: str = "location") -> dict[str, Column]:
    """Location fields; a coordinate that is not a number becomes NULL."""
    fields = {name: F.col(f"{struct}.{name}") for name in LOCATION}
    for name in ("lat", "lon"):
        fields[name] = fields[name].try_cast("double")
    return fields


def flatten_category(raw: DataFrame) -> DataFrame:
    return raw.withColumns(category_fields()).drop("personal_finance_category")


def flatten_location(raw: DataFrame) -> DataFrame:
    return raw.withColumns(location_fields()).drop("location")


def union_records(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of several feeds; a field one feed lacks is NULL there."""
    result = first
    for other in others:
        result = result.unionByName(other, allowMissingColumns=True)
    return result
