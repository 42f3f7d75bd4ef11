"""Record and key operators: fills, dedupe, dense keys, lookups, unions."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import fills
from ledgerline.operators.dedupe import dedupe, duplicate_counts
from ledgerline.operators.keys import calendar_rank, dense_key, hashed_rank
from ledgerline.operators.lookups import attach_key, left_lookup, one_row_per_account
from ledgerline.operators.records import drop_unused, location_fields, union_records
from ledgerline.schemas import BOROUGHS


def test_owner_fill(spark):
    rows = [("a", "set"), ("a", None), ("z", None), (None, None)]
    df = spark.createDataFrame(rows, "account_id string, account_owner string")
    want = sorted([("a", "set"), ("a", "Ann"), ("z", None), (None, None)], key=repr)
    table = spark.createDataFrame([("a", "Ann"), ("a", "Zoe"), ("b", "Bob")], df.schema)
    many = {**{f"x{i}": "X" for i in range(5000)}, "a": "Ann", "b": "Bob"}
    for owners in ({"a": "Ann", "b": "Bob"}, many, table):
        got = [tuple(r) for r in fills.fill_owner(df, owners).collect()]
        assert sorted(got, key=repr) == want


def test_place_fill_with_many_cells(spark):
    cells = [(f"c{i}", float(i), -float(i), f"p{i}") for i in range(5000)]
    rows = spark.createDataFrame([(str(i), None, None, None, None, None) for i in range(50)], PLACE)
    for r in fills.fill_place(rows, "id", cells).collect():
        assert r.city[1:] == r.postal_code[1:] and abs(r.lat - float(r.city[1:])) <= 0.0100001


PLACE = "id string, city string, postal_code string, lat double, lon double, store_number string"


def test_location_fill_is_consistent_and_repeatable(spark):
    rows = [(str(i), None, None, None, None, None) for i in range(500)]
    rows += [(f"p{i}", "Oslo", None, None, 1.0, "7") for i in range(500)]
    df = spark.createDataFrame(rows, PLACE)
    first = fills.fill_place(df, "id").orderBy("id").collect()
    again = fills.fill_place(df.repartition(3), "id").orderBy("id").collect()
    assert first == again
    cells = {postal: (city, lat, lon) for city, lat, lon, postal in BOROUGHS}
    seen = set()
    for r in first:
        city, lat, lon = cells[r.postal_code]
        seen.add(city)
        assert abs(r.lat - lat) <= 0.0100001
        if r.id.startswith("p"):
            assert (r.city, r.lon, r.store_number) == ("Oslo", 1.0, "7")
        else:
            assert r.city == city and abs(r.lon - lon) <= 0.0100001
            assert 100 <= int(r.store_number) <= 999
    assert len(seen) == len(BOROUGHS)


def test_id_fill_keeps_values_and_differs_by_column(spark):
    df = spark.createDataFrame([("1", None, None), ("2", "x", None)], "id string, a string, b string")
    one, two = fills.fill_ids(df, "id", ["a", "b"]).orderBy("id").collect()
    assert two.a == "x" and len({one.a, one.b, two.b}) == 3


def test_bad_coordinate_becomes_null(spark):
    raw = spark.sql(
        "SELECT named_struct('address','a','city','c','region','r','postal_code','p',"
        "'country','x','lat','40.5','lon','west','store_number','1') AS location"
    )
    row = raw.select(*[c.alias(n) for n, c in location_fields().items()]).first()
    assert (row.lat, row.lon) == (40.5, None)


def test_drop_ignores_missing_fields(spark):
    assert drop_unused(spark.createDataFrame([(1, 2)], "a int, website int")).columns == ["a"]


def test_union_fills_missing_fields(spark):
    a, b = spark.sql("SELECT 1 AS x, 'p' AS y"), spark.sql("SELECT 2 AS x, 3 AS z")
    got = sorted(tuple(r) for r in union_records(a, b).select("x", "z").collect())
    assert got == [(1, None), (2, 3)]


DUPLICATES = [("a", 2, "x"), ("a", None, "y"), ("a", 1, "z"), ("b", 3, "x"), (None, 1, "p"), (None, 1, "p")]


def test_dedupe_does_not_depend_on_input_order(spark):
    want = {("a", None, "y"), ("b", 3, "x"), (None, 1, "p")}
    for seed in range(3):
        rows = random.Random(seed).sample(DUPLICATES, len(DUPLICATES))
        df = spark.createDataFrame(rows, "k string, n int, t string").repartition(4)
        got = dedupe(df, "k").collect()
        assert {tuple(r) for r in got} == want and len(got) == 3
    by_text = {tuple(r) for r in dedupe(df, "k", ["t"]).collect()}
    assert ("a", 2, "x") in by_text
    assert tuple(duplicate_counts(df, "k").first()) == (6, 3, 3)
    assert tuple(duplicate_counts(df.limit(0), "k").first()) == (0, 0, 0)


def test_dedupe_keeps_columns_named_like_its_helper(spark):
    df = spark.createDataFrame([("a", 2, 9), ("a", 1, 8), ("b", 3, 7)], "k string, _n int, _N_ int")
    assert sorted(tuple(r) for r in dedupe(df, "k").collect()) == [("a", 1, 8), ("b", 3, 7)]


def test_dedupe_limits_keys_before_the_shuffle(spark):
    """A key with a third of all rows leaves each task as one row."""
    rows = spark.range(30000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) AS k", "id AS v")
    df = dedupe(rows, "k")
    assert df.count() == 20001
    assert df.where("k = 'hot'").first().v == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit") and "Partial" in plan


@pytest.mark.parametrize("partitions", ["1", "8", "300"])
def test_dense_keys_are_1_to_n_in_hash_order(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        ids = spark.range(5000).selectExpr("if(id = 0, NULL, concat('k', id)) AS k")
        got = dense_key(hashed_rank(ids, ["k"]), "n").orderBy("n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r.n for r in got] == list(range(1, 5001))
    want = ids.orderBy(F.md5(F.coalesce("k", F.lit(""))), "k").collect()
    assert [r.k for r in got] == [r.k for r in want]


def test_dense_keys_of_days_follow_the_calendar(spark):
    days = spark.sql(
        "SELECT explode(sequence(DATE'2019-11-01', DATE'2021-02-01')) AS d UNION ALL SELECT NULL"
    )
    got = dense_key(calendar_rank(days, "d"), "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, len(got) + 1))
    assert got[0].d is None
    assert [r.d for r in got[1:]] == sorted(r.d for r in got[1:])


def test_key_lookup_matches_null_members(spark):
    fact = spark.createDataFrame([("a",), (None,), ("x",)], "c string")
    dim = spark.createDataFrame([(1, "a"), (2, None)], "id int, c string")
    got = {tuple(r) for r in attach_key(fact, dim, ["c"], "id").collect()}
    assert got == {("a", 1), (None, 2), ("x", None)}


def test_account_with_two_owners_is_joined_once(spark):
    dim = spark.createDataFrame(
        [(2, "a", "Bo"), (1, "a", "Cy"), (0, "a", None), (3, "b", "Di"), (4, "c", None)],
        "account_pk int, account_id string, account_owner string",
    )
    got = {tuple(r) for r in one_row_per_account(dim).collect()}
    assert got == {("a", 1, "Cy"), ("b", 3, "Di"), ("c", 4, None)}


@pytest.fixture()
def too_large_to_broadcast(spark):
    """Thresholds at which the test data behaves like a large cluster's."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    yield
    for key in small:
        spark.conf.unset(key)


def hot_feed(spark, n):
    """A third of the transactions belong to one account."""
    return spark.range(0, n, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('a', id)) AS account_id",
        "CAST(NULL AS STRING) AS account_owner",
        "md5(cast(id AS STRING)) AS payload",
    )


def account_table(spark, n):
    return spark.range(0, n, 1, 8).selectExpr(
        "id AS account_pk",
        "if(id = 0, 'hot', concat('a', id)) AS account_id",
        "concat('owner ', id) AS account_owner",
    )


def assert_split(joined, n):
    rows = joined.collect()
    assert len(rows) == n
    assert sum(r.account_owner == "owner 0" for r in rows) == n // 3
    assert all(r.account_owner is not None for r in rows)
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_account_is_split_when_owners_are_filled(spark, too_large_to_broadcast):
    n = 120000
    owners = account_table(spark, n).drop("account_pk")
    assert_split(fills.fill_owner(hot_feed(spark, n), owners), n)


def test_hot_account_is_split_in_the_view_join(spark, too_large_to_broadcast):
    n = 120000
    fact = hot_feed(spark, n).drop("account_owner")
    accounts = one_row_per_account(account_table(spark, n))
    assert_split(left_lookup(fact, accounts, "account_id", ["account_pk", "account_owner"]), n)


def test_hot_member_is_split_in_a_null_safe_key_lookup(spark, too_large_to_broadcast):
    n = 120000
    fact = hot_feed(spark, n).drop("account_owner")
    joined = attach_key(fact, account_table(spark, n), ["account_id"], "account_owner")
    assert_split(joined, n)
