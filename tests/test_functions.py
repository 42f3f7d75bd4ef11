"""Scalar functions and rules on hand-made rows."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import rules, stable, text
from ledgerline.functions.dates import date_parts, in_last_year, parse_date

DAY = "2024-03-05"


def values(spark, kind, inputs, sql):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(F.expr(sql)).collect()]


def test_direction(spark):
    got = values(spark, "double", [5.0, 0.0, -5.0, None], rules.direction("x"))
    assert got == ["Debit", "Credit", "Credit", "Credit"]


def test_amount_bucket(spark):
    amounts = [9.99, 10.0, 50.0, 100.0, 500.0, -9.99, None]
    assert values(spark, "double", amounts, rules.amount_bucket("x")) == [
        "Under $10",
        "$10 - $50",
        "$50 - $100",
        "$100 - $500",
        "Over $500",
        "Under $10",
        "Over $500",
    ]


def test_large_flag(spark):
    got = values(spark, "double", [1000.0, 1000.01, -1000.01, None], rules.is_large("x"))
    assert got == ["No", "Yes", "Yes", "No"]


def test_country(spark):
    got = values(spark, "string", ["US", "us", "CA", None], rules.country_name("x"))
    assert got == ["USA", "us", "CA", None]


def days(*offsets):
    start = datetime.date.fromisoformat(DAY)
    return [None if o is None else start + datetime.timedelta(o) for o in offsets]


def test_pending_and_age(spark):
    assert values(spark, "date", days(0, -1, None), rules.pending("x", DAY)) == ["Yes", "No", "No"]
    got = values(spark, "date", days(0, -4, 1, None), rules.days_since("x", DAY))
    assert got == [0, 4, -1, None]


def test_run_day_defaults_to_today(spark):
    today = spark.sql("SELECT current_date()").first()[0]
    assert values(spark, "date", [today], rules.pending("x")) == ["Yes"]
    assert values(spark, "date", [today], rules.days_since("x")) == [0]


def test_income_sign(spark):
    rows = spark.createDataFrame([(5.0, "INCOME"), (5.0, "TRAVEL"), (5.0, None)], "a double, c string")
    got = [r[0] for r in rows.select(F.expr(rules.income_sign("a", "c"))).collect()]
    assert sorted(got) == [-5.0, 5.0, 5.0]


def test_clean_name(spark):
    got = values(spark, "string", ["SF**POOL#/\\ x", None, ""], text.clean_name("x"))
    assert got == ["Sfpool X", None, ""]


def test_label(spark):
    inputs = ["FOOD_AND_DRINK", "uber-eats", "McDONALD'S", None, "élan_VITAL", "a\tb"]
    got = values(spark, "string", inputs, text.label("x"))
    assert got == ["Food And Drink", "Uber-Eats", "Mcdonald's", None, "Élan Vital", "A\tB"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=200))
def test_title_case_equals_its_definition(spark, inputs):
    rows = spark.createDataFrame([(t,) for t in inputs], "x string")
    fast, exact = F.expr(text.title_case("x")), F.expr(text.title_case_exact("x"))
    assert rows.where(~fast.eqNullSafe(exact)).count() == 0


def test_title_case_of_every_ascii_pair(spark):
    chars = spark.range(1, 127).select(F.expr("chr(id)").alias("c"))
    pairs = chars.alias("a").join(F.broadcast(chars.alias("b")), F.lit(True))
    texts = pairs.select(F.concat("a.c", "b.c", F.lit("aB")).alias("x"))
    fast, exact = F.expr(text.title_case("x")), F.expr(text.title_case_exact("x"))
    assert texts.where(~fast.eqNullSafe(exact)).count() == 0


def test_dates(spark):
    rows = spark.createDataFrame([(DAY,), ("05/03/2024",), (None,)], "x string")
    parsed = rows.select(parse_date(F.col("x")).alias("d"))
    assert [r.d for r in parsed.where("d IS NOT NULL").collect()] == [datetime.date(2024, 3, 5)]
    assert parsed.where("d IS NULL").count() == 2
    got = parsed.where("d IS NOT NULL").select(*date_parts(F.col("d")).values()).first()
    assert tuple(got) == (2024, 1, "March", 5, "Tuesday")


def test_last_year_has_366_days(spark):
    rows = spark.createDataFrame([(d,) for d in days(1, 0, -365, -366)], "d date")
    assert rows.where(in_last_year(F.col("d"), DAY)).count() == 2


@pytest.mark.parametrize("n", [1, 5, 900])
def test_choices_stay_in_range_and_are_used(spark, n):
    ids = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    chosen = ids.select(stable.choose(stable.digest(F.col("k"), "t"), n).alias("c"))
    low, high, used = chosen.agg(F.min("c"), F.max("c"), F.count_distinct("c")).first()
    assert (low, high, used) == (0, n - 1, n)


def test_uuid_shape_and_jitter(spark):
    row = spark.range(1).select(
        stable.uuid_shaped(stable.digest(F.col("id"), "a")).alias("u"),
        stable.jitter(stable.digest(F.col("id"), "a"), 1).alias("j"),
    )
    got = row.first()
    assert [len(p) for p in got.u.split("-")] == [8, 4, 4, 4, 12]
    assert -0.01 <= got.j < 0.01
    assert row.first() == got
