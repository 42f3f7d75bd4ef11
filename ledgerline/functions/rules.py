"""Business rules as SQL expression text (see ``functions.text`` for why)."""

from __future__ import annotations

import datetime

from ledgerline.schemas import (
    AMOUNT_TIERS,
    COUNTRY_NAMES,
    INCOME_CATEGORY,
    LARGE_AMOUNT,
    TOP_TIER,
)


def text_sql(value: object) -> str:
    """The value as an SQL text literal, whatever characters it holds."""
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


class Sql(str):
    """SQL text that stands for itself where a plain string would be a value."""


def day_sql(as_of: datetime.date | str | None) -> str:
    """Run day as SQL; ``current_date()`` keeps a persistent view fresh."""
    if isinstance(as_of, Sql):
        return f"({as_of})"
    return "current_date()" if as_of is None else f"DATE {text_sql(as_of)}"


def direction(amount: str) -> str:
    """Sign of the amount; zero and NULL count as money in."""
    return f"if({amount} > 0, 'Debit', 'Credit')"


def country_name(country: str) -> str:
    arms = " ".join(f"WHEN {text_sql(code)} THEN {text_sql(name)}" for code, name in COUNTRY_NAMES.items())
    return f"CASE {country} {arms} ELSE {country} END"


def pending(day: str, as_of: datetime.date | str | None = None) -> str:
    """Transactions dated on the run day are still open."""
    return f"if({day} = {day_sql(as_of)}, 'Yes', 'No')"


def days_since(day: str, as_of: datetime.date | str | None = None) -> str:
    """Age in days, negative for days after the run day."""
    return f"CAST(datediff({day_sql(as_of)}, {day}) AS BIGINT)"


def amount_bucket(amount: str) -> str:
    """Spending tier of the absolute amount; NULL falls in the top tier."""
    arms = " ".join(
        f"WHEN abs({amount}) < {bound} THEN {text_sql(tier)}" for bound, tier in AMOUNT_TIERS
    )
    return f"CASE {arms} ELSE {text_sql(TOP_TIER)} END"


def magnitude(amount: str) -> str:
    """Amounts of the models carry no sign; the direction says it."""
    return f"abs({amount})"


def is_large(amount: str) -> str:
    return f"if(abs({amount}) > {LARGE_AMOUNT}, 'Yes', 'No')"


def income_sign(amount: str, category: str, income: str = INCOME_CATEGORY) -> str:
    """Money coming in is stored as a negative amount."""
    return f"if({category} = {text_sql(income)}, -{amount}, {amount})"
