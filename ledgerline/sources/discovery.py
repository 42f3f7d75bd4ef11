"""Schema discovery: what a JSON-lines feed holds, and how that differs from a schema.

The feed is read with a fixed schema, which skips unlisted fields and turns values of another
type into NULL. This pass finds both. Each line becomes a variant, whose members are exploded
level by level within the task that read it; only one count per task, path and type is
shuffled. Nothing is inferred from a sample: every value of every line counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import RAW

#: Levels of members below a line; deeper ones count with the object that holds them.
DEPTH = 4
NULL, BROKEN = "null", "broken"
OBJECT, ARRAY, STRING, NUMBER, BOOLEAN = "object", "array", "string", "number", "boolean"
#: Kinds of values that the reader turns into a value of the type (any other becomes NULL).
READABLE = {STRING: (STRING, NUMBER, BOOLEAN), NUMBER: (NUMBER,), BOOLEAN: (BOOLEAN,), OBJECT: (OBJECT,), ARRAY: (ARRAY,)}


def _kind(value: str) -> str:
    """SQL text: kind of a variant, by the first letters of its type. Plain cases, since this runs
    for every value of every line and a map literal would be searched outside generated code."""
    names = {"OBJ": OBJECT, "ARR": ARRAY, "STR": STRING, "BOO": BOOLEAN, "VOI": NULL}
    cases = " ".join(f"WHEN '{start}' THEN '{kind}'" for start, kind in names.items())
    return f"CASE substr(schema_of_variant({value}), 1, 3) {cases} ELSE if({value} IS NULL, NULL, '{NUMBER}') END"


def found_fields(lines: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``path``, ``kind`` and ``n_values`` of everything in ``lines`` (one text column).

    Members are joined by dots; elements of a list are ``[]``. Lines that are no JSON object
    are counted as ``broken`` without a path; blank lines are skipped."""
    value = lines.columns[0]
    text = lines.where(F.trim(F.col(value)) != "")
    # The first letter of what was parsed tells an object; its type would be put together from all members.
    start = F.startswith(F.ltrim(F.col(value), F.lit(" \t\r\n\ufeff")), F.lit("{"))
    parsed = text.select(F.try_parse_json(F.col(value)).alias("v0"), start.alias("braced"))
    is_object = F.col("v0").isNotNull() & F.col("braced")
    level = parsed.select(F.when(is_object, F.col("v0")).alias("v"), F.lit("").alias("path0"), is_object.alias("sound"))
    spark = lines.sparkSession
    for i in range(1, depth + 1):
        # Objects and lists give a row per member, anything else one row without any. Only the
        # member goes on, and its kind is taken before its own members multiply the row.
        kept = ["l.sound", *(f"l.{c}{j}" for j in range(1, i) for c in ("pos", "kind", "path"))]
        level = spark.sql(
            f"SELECT {', '.join(kept)}, m.pos AS pos{i}, m.value AS v, {_kind('m.value')} AS kind{i}, "
            f"CASE WHEN m.pos IS NULL THEN NULL WHEN m.key IS NULL THEN concat(l.path{i - 1}, '[]') "
            f"WHEN l.path{i - 1} = '' THEN m.key ELSE concat(l.path{i - 1}, '.', m.key) END AS path{i} "
            "FROM {level} l, LATERAL variant_explode_outer(l.v) m",
            level=level,
        )
    # A member is counted at the first of the rows that its own members make of it.
    items = [f"CASE WHEN NOT sound THEN struct(CAST(NULL AS STRING) AS path, '{BROKEN}' AS kind) END"]
    for i in range(1, depth + 1):
        first = "".join(f" AND coalesce(pos{j}, 0) = 0" for j in range(i + 1, depth + 1))
        items.append(f"CASE WHEN pos{i} IS NOT NULL{first} THEN struct(path{i} AS path, kind{i} AS kind) END")
    # Empty places are dropped as rows: a filter of the array would be interpreted, row by row.
    found = level.select(F.explode(F.expr(f"array({', '.join(items)})")).alias("f")).where("f IS NOT NULL")
    return found.groupBy("f.path", "f.kind").agg(F.count("*").alias("n_values"))


def expected_fields(schema: T.DataType, path: str = "") -> list[tuple[str, str]]:
    """Path and kind of every field of a schema."""
    if isinstance(schema, T.StructType):
        own = [(path, OBJECT)] if path else []
        return own + [f for c in schema for f in expected_fields(c.dataType, f"{path}.{c.name}" if path else c.name)]
    if isinstance(schema, T.ArrayType):
        return [(path, ARRAY), *expected_fields(schema.elementType, f"{path}[]")]
    if isinstance(schema, T.BooleanType):
        return [(path, BOOLEAN)]
    return [(path, NUMBER if isinstance(schema, T.NumericType) else STRING)]


def _holder(path: str) -> str | None:
    """Path of the object that a field is a member of ('' for the line; None for elements)."""
    return None if path.endswith("[]") else path.rpartition(".")[0]


def drift(found: DataFrame, schema: T.StructType = RAW) -> DataFrame:
    """Differences between :func:`found_fields` and a schema, one row per path and drift.

    ``new``: a field that the schema lacks, with all kinds that it has. ``lost``: a field that
    no object that could hold it has. ``retyped``: values that the schema reads as
    NULL, and how many. ``broken``: lines that are no record. No rows: no drift."""
    fields = found.sparkSession.createDataFrame(
        [(p, k, list(READABLE[k]), _holder(p)) for p, k in expected_fields(schema)],
        "path string, expected string, readable array<string>, holder string",
    )
    # A row comes once for itself, by its holder, and once for its members, by its path, if it is an
    # object. A join of the counts with themselves would read the whole feed twice.
    own = F.struct(F.col("holder").alias("key"), F.lit(False).alias("object"))
    held = F.when(F.col("kind") == OBJECT, F.struct(F.col("path").alias("key"), F.lit(True).alias("object")))
    both = found.join(fields, "path", "full").withColumn("side", F.explode(F.array(own, held))).where("side IS NOT NULL")
    has_object = F.max("side.object").over(Window.partitionBy("side.key"))
    both = both.withColumn("held", (F.col("holder") == "") | has_object).where("NOT side.object")
    kind, expected = F.col("kind"), F.col("expected")
    is_value = kind.isNotNull() & (kind != NULL)
    what = (
        F.when(kind == BROKEN, BROKEN)
        .when(expected.isNull(), "new")
        .when(kind.isNull(), F.when(F.col("held"), "lost"))
        .when(is_value & ~F.array_contains("readable", kind), "retyped")
    )
    named = both.withColumn("drift", what).where("drift IS NOT NULL")
    kinds = F.array_join(F.array_sort(F.collect_set(F.when(is_value, kind))), "|")
    counted = F.sum(F.when(is_value, F.col("n_values")).otherwise(0))
    report = named.groupBy("path", "drift", "expected").agg(kinds.alias("found"), counted.alias("n_values"))
    seen = F.when(F.col("drift") == "lost", None).when(F.col("found") == "", NULL).otherwise(F.col("found"))
    return report.select("path", "drift", "expected", seen.alias("found"), "n_values")


def drift_report(spark: SparkSession, path: str, schema: T.StructType = RAW) -> DataFrame:
    """Drift of the JSON-lines files below ``path``, in one pass."""
    return drift(found_fields(spark.read.text(path)), schema)
