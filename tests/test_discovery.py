"""Schema discovery and violation samples on hand-made rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.plans import quality
from ledgerline.schemas import RAW_FULL
from ledgerline.sinks.files import write_jsonl
from ledgerline.sources import discovery
from ledgerline.workload.records import nested_full, records

LINES = [
    '{"a":1,"b":{"c":"x","d":null},"e":[]}',
    '{"a":"q","b":{"c":2.5,"n":{"deep":{"er":{"est":1}}}},"e":[{"k":true},{"k":1}],"o":null}',
    "broken", "3", "  ", '{"a":null}', "{}", '{"a":1,"a":2}',
]
SCHEMA = (
    T.StructType().add("a", T.DoubleType()).add("b", T.StructType().add("c", "string").add("d", "string").add("z", "boolean"))
    .add("e", T.ArrayType(T.StructType().add("k", T.BooleanType()).add("m", "string"))).add("gone", "string").add("o", T.StructType().add("p", "string"))
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_value_of_every_line_counts(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string").repartition(3)
    found = discovery.found_fields(lines)
    assert rows(found) == sorted(
        [
            (None, "broken", 3), ("a", "null", 1), ("a", "number", 1), ("a", "string", 1), ("b", "object", 2), ("b.c", "number", 1),
            ("b.c", "string", 1), ("b.d", "null", 1), ("b.n", "object", 1), ("b.n.deep", "object", 1), ("b.n.deep.er", "object", 1),
            ("e", "array", 2), ("e[]", "object", 2), ("e[].k", "boolean", 1), ("e[].k", "number", 1), ("o", "null", 1),
        ],
        key=repr,
    )
    # Fields of an object that never occurs are not called lost, nor are numbers read as text retyped.
    assert rows(discovery.drift(found, SCHEMA)) == sorted(
        [
            (None, "broken", None, "broken", 3), ("a", "retyped", "number", "string", 1), ("b.n", "new", None, "object", 1),
            ("b.n.deep", "new", None, "object", 1), ("b.n.deep.er", "new", None, "object", 1), ("b.z", "lost", "boolean", None, 0),
            ("e[].k", "retyped", "boolean", "number", 1), ("e[].m", "lost", "string", None, 0), ("gone", "lost", "string", None, 0),
        ],
        key=repr,
    )


def test_no_lines_lose_all_top_fields(spark):
    empty = spark.createDataFrame([], "value string")
    assert rows(discovery.found_fields(empty)) == []
    assert {r[0] for r in rows(discovery.drift(discovery.found_fields(empty), SCHEMA))} == {"a", "b", "e", "gone", "o"}


def test_own_feed_has_no_drift(spark, sf_dir, tmp_path):
    write_jsonl(nested_full(records(spark, sf_dir)), f"{tmp_path}/feed")
    assert rows(discovery.drift_report(spark, f"{tmp_path}/feed", RAW_FULL)) == []


def test_discovery_shuffles_counts_only(spark, tmp_path):
    write_jsonl(spark.range(10), f"{tmp_path}/feed")
    plan = discovery.found_fields(spark.read.text(f"{tmp_path}/feed"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("Exchange") == 1 and "Python" not in plan


def test_drift_reads_the_feed_once(spark, tmp_path):
    write_jsonl(spark.range(10), f"{tmp_path}/feed")
    report = discovery.drift_report(spark, f"{tmp_path}/feed", SCHEMA)
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r[:2] for r in rows(report)} == {("id", "new"), ("a", "lost"), ("b", "lost"), ("e", "lost"), ("gone", "lost"), ("o", "lost")}


def test_every_value_is_judged_in_generated_code(spark):
    """A lambda or a map literal per value took most of the time."""
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    plan = discovery.found_fields(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "map(" not in plan and "keys: [" not in plan


def test_objects_are_told_by_their_first_letter(spark):
    data = [' \t\r{"a":1}', '"{"', "[{}]", '{"a":', "{x}", " {} ", '[{"a":2}]']
    found = discovery.found_fields(spark.createDataFrame([(x,) for x in data], "value string"))
    assert rows(found) == sorted([("a", "number", 1), (None, "broken", 5)], key=repr)


def test_violations_come_with_some_of_their_keys(spark):
    data = [(f"k{i}", None if i % 3 == 0 else i, "x") for i in range(90)] + [("k1", 5, None), ("k2", 6, None), (None, None, "y")]
    model = spark.createDataFrame(data, "id string, amount int, other string")
    tests = {"id": [quality.NOT_NULL, quality.UNIQUE], "amount": [quality.NOT_NULL], "other": [quality.NOT_NULL, quality.UNIQUE]}
    report = quality.suite({"m": model}, {"m": tests}, samples=4)
    got = {(r.column, r.test): (r.violations, r.sample.split(",") if r.sample else []) for r in report.collect()}
    assert got["id", "not_null"] == (1, [])
    assert got["id", "unique"] == (2, ["k1", "k2"]) or got["id", "unique"][0] == 2 and set(got["id", "unique"][1]) <= {"k1", "k2"}
    n, sample = got["amount", "not_null"]
    assert n == 31 and 1 < len(sample) <= 4 and all(int(k[1:]) % 3 == 0 for k in sample) and sample == sorted(sample)
    assert got["other", "not_null"][0] == 2 and set(got["other", "not_null"][1]) <= {"k1", "k2"}
    assert got["other", "unique"] == (1, ["x"])
    plain = quality.suite({"m": model}, {"m": tests})
    assert plain.columns == ["model", "column", "test", "violations"]
    assert {(r.column, r.test): r.violations for r in plain.collect()} == {k: v for k, (v, _) in got.items()}
    with pytest.raises(quality.DataTestError, match=r"m.amount not_null: 31 \(for example k"):
        quality.require_clean(report)
    assert [r.sample for r in quality.suite({"m": model}, {"m": {"amount": [quality.NOT_NULL]}}, samples=3).collect()] == [""]
    # One grouping of the model per unique column, samples or not.
    scans = report._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")
    assert scans == plain._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
