"""Registered queries. Each takes (spark, folder of the tables) and reads them whole."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import rules, stable, text
from ledgerline.functions.dates import date_parts, in_last_year, parse_date
from ledgerline.operators import fills
from ledgerline.operators import records as steps
from ledgerline.operators.dedupe import dedupe, duplicate_counts
from ledgerline.operators.keys import dense_key, hashed_rank
from ledgerline.operators.lookups import attach_key, left_lookup, one_row_per_account
from ledgerline.plans import batch, marts, quality, star
from ledgerline.plans.transform import rounded, transform
from ledgerline.schemas import (
    ACCOUNT_OWNERS,
    CATEGORY,
    DATE_PARTS,
    FACT,
    LOCATION,
    RAW_FULL,
    SOURCE_ID,
    STAR_TABLES,
)
from ledgerline.session import settle
from ledgerline.sinks import files as sinks
from ledgerline.sinks import published as publication
from ledgerline.sinks import tables as catalog
from ledgerline.sources import discovery
from ledgerline.sources import files as sources
from ledgerline.workload.records import NAMES, nested, nested_full, owners, records, table

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-01"
DAY_BEFORE = "2001-07-31"

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def wide_ints(df: DataFrame) -> DataFrame:
    """Integer columns as BIGINT, the type the SQL twins give them."""
    ints = [c for c, kind in df.dtypes if kind == "int"]
    return df.withColumns({c: F.col(c).cast("bigint") for c in ints}) if ints else df


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested(records(spark, sf_dir))


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(raw(settle(spark), sf_dir), owners(spark, sf_dir))


def written_flat(spark: SparkSession, sf_dir: str, stage: sinks.Stage) -> DataFrame:
    """Flat rows as files, made from written records as in a run: the shuffles behind each of
    the two are gone when rows move again."""
    feed = stage.save(raw(settle(spark), sf_dir), "records")
    rows = stage.save(transform(feed, owners(spark, sf_dir)), "transform")
    stage.drop("records")
    return rows


def ranked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, sinks.Stage]:
    stage = sinks.Stage(spark)
    unique = star.ranked_transactions(written_flat(spark, sf_dir, stage), stage)
    stage.drop("transform")
    return unique, stage


def tables(spark: SparkSession, sf_dir: str, partitioned: bool = False) -> dict[str, DataFrame]:
    """The star. Once the unique rows are written, the flat ones are read no more."""
    stage = sinks.Stage(spark)
    built = star.build_star(written_flat(spark, sf_dir, stage), stage, partitioned=partitioned)
    stage.drop("transform")
    return built


def published(spark: SparkSession, sf_dir: str) -> str:
    """Database of the models over loaded, bucketed tables."""
    database = scratch_database(spark)
    built = tables(spark, sf_dir, partitioned=True)
    names = catalog.load_tables(built, database, suffix="__1").names
    publication.point_to(spark, database, "1", AS_OF)
    publication.show_runs(spark, database, {"1": names})
    publication.create_tables(spark, database)
    marts.create_models(spark, database, f"{database}_marts")
    return f"{database}_marts"


def scratch_database(spark: SparkSession) -> str:
    name = f"ledger_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, sinks.new_folder(spark, name))
    return name


# --- sources and sinks ------------------------------------------------------


def unnested(raw_records: DataFrame) -> DataFrame:
    """Raw records with their category and location fields side by side."""
    category = {
        "pfc_primary": F.col("personal_finance_category.primary"),
        "pfc_detailed": F.col("personal_finance_category.detailed"),
        "pfc_confidence_level": F.col("personal_finance_category.confidence_level"),
    }
    location = {f"loc_{name}": col for name, col in steps.location_fields().items()}
    names = [name for name in NAMES if name != "merchant_name"]
    return raw_records.withColumns({**category, **location}).select(*names)


@query
def scan_jsonl(spark, sf_dir):
    path = sinks.new_folder(spark, "jsonl")
    sinks.write_jsonl(nested_full(records(spark, sf_dir)), path)
    return unnested(sources.read_jsonl(spark, path))


@query
def jsonl_roundtrip(spark, sf_dir):
    """Every line holds all 28 keys, whether or not the field has a value."""
    path = sinks.new_folder(spark, "jsonl")
    sinks.write_jsonl(nested_full(records(spark, sf_dir)), path)
    line = F.col("value")
    return spark.read.text(path).select(
        F.get_json_object(line, "$.transaction_id").alias("transaction_id"),
        F.get_json_object(line, "$.location.city").alias("city"),
        F.get_json_object(line, "$.amount").cast("double").alias("amount"),
        F.size(F.json_object_keys(line)).cast("bigint").alias("n_keys"),
    )


def by_channel() -> Column:
    """Two run dates for one feed."""
    return F.when(F.col("payment_channel") == "in store", AS_OF).otherwise(DAY_BEFORE)


@query
def latest_extract(spark, sf_dir):
    stage = sinks.new_folder(spark, "extract")
    feed = nested_full(records(spark, sf_dir))
    for day in (DAY_BEFORE, AS_OF):
        sinks.write_jsonl(feed.where(by_channel() == day), f"{stage}/run_date={day}")
    return unnested(sources.latest_extract(spark, stage))


@query
def newest_delivery(spark, sf_dir):
    """The earlier of two days is delivered again, after the later one."""
    stage = sinks.new_folder(spark, "extract")
    feed = nested_full(records(spark, sf_dir))
    sinks.write_jsonl(feed.where("payment_channel = 'none'"), f"{stage}/run_date={DAY_BEFORE}")
    for day in (AS_OF, DAY_BEFORE):
        sinks.write_jsonl(feed.where(by_channel() == day), f"{stage}/run_date={day}")
    return unnested(sources.latest_extract(spark, stage))


@query
def schema_drift(spark, sf_dir):
    """A feed with amounts as text, a field that nobody knows, one that is gone, and cut lines."""
    feed = nested_full(records(spark, sf_dir))
    fields = [F.col(c) for c in feed.columns if c not in ("amount", "pending")]
    last = F.substring("transaction_id", -1, 1)
    tier = F.when(last == "3", F.struct(F.lit("gold").alias("tier"))).alias("loyalty")
    number = F.to_json(F.struct(*fields, tier, "amount"), {"ignoreNullFields": "false"})
    text_amount = F.col("amount").cast("string").alias("amount")
    as_text = F.to_json(F.struct(*fields, tier, text_amount), {"ignoreNullFields": "false"})
    line = F.when(last == "7", as_text).when(last == "5", F.substring(number, 1, 40)).otherwise(number)
    path = sinks.new_folder(spark, "jsonl")
    sinks.write_lines(feed.select(line), path)
    return discovery.drift_report(spark, path, RAW_FULL)


def channel_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = records(spark, sf_dir, "transaction_id", "amount", "payment_channel")
    return feed.withColumn("run_date", by_channel().cast("date"))


@query
def read_run_date(spark, sf_dir):
    stage = sinks.new_folder(spark, "transform")
    sinks.write_run_dates(channel_days(spark, sf_dir), stage)
    return sources.read_run_date(spark, stage, AS_OF)


@query
def overwrite_idempotent(spark, sf_dir):
    """Both days are written, then one of them again: nothing changes."""
    stage = sinks.new_folder(spark, "transform")
    days = channel_days(spark, sf_dir)
    sinks.write_run_dates(days, stage)
    sinks.write_run_date(days.where(by_channel() == AS_OF).drop("run_date"), stage, AS_OF)
    return sources.read_parts(spark, stage)


@query
def scan_parquet_parts(spark, sf_dir):
    """Two sets of part files, one scan."""
    folder = sinks.new_folder(spark, "parts")
    feed = records(spark, sf_dir, "transaction_id", "account_id", "amount", "payment_channel")
    paths = []
    for day in (DAY_BEFORE, AS_OF):
        paths.append(f"{folder}/{day}")
        sinks.write_parquet(feed.where(by_channel() == day), paths[-1])
    return sources.read_parts(spark, *paths)


@query
def parquet_roundtrip(spark, sf_dir):
    return wide_ints(sinks.Stage(spark).save(flat(spark, sf_dir), "transform"))


@query
def truncate_then_count(spark, sf_dir):
    """Two tables exist and are emptied; the other three are reported missing."""
    unique, stage = ranked(spark, sf_dir)
    database = scratch_database(spark)
    built = {"dim_account": star.dim_account(unique), "dim_date": star.dim_date(unique)}
    before = {}
    for name, df in built.items():
        df.write.saveAsTable(f"{database}.{name}")
        before[name] = spark.table(f"{database}.{name}").count()
    existed = catalog.truncate_tables(spark, database)
    rows = [
        (
            name,
            existed[name],
            before.get(name),
            spark.table(f"{database}.{name}").count() if existed[name] else None,
        )
        for name in STAR_TABLES
    ]
    return spark.createDataFrame(
        rows, "table_name string, existed boolean, rows_before bigint, rows_after bigint"
    )


@query
def load_star_tables(spark, sf_dir):
    """All five tables as loaded; the second load replaces the first."""
    built = tables(spark, sf_dir)
    database = scratch_database(spark)
    for _ in range(2):
        loaded = catalog.load_tables(built, database)
    fact, *dims = (spark.table(loaded.names[t]) for t in reversed(STAR_TABLES))
    for dim, key in zip(dims, ("location_id", "category_id", "date_id", "account_id")):
        fact = fact.join(one_row_per_account(dim) if key == "account_id" else dim, key, "left")
    return wide_ints(fact.select(*FACT, *LOCATION, *CATEGORY, *DATE_PARTS, "date", "account_pk", "account_owner"))


@query
def model_views(spark, sf_dir):
    """The staged model as published, with all of its date, from the other models' views."""
    views = published(spark, sf_dir)
    days = spark.table(f"{views}.dim_date")
    return wide_ints(spark.table(f"{views}.stg_transactions").join(days, "date_id", "left"))


def write_extract(spark: SparkSession, sf_dir: str) -> str:
    """A landing zone with two days; the later one is the whole feed."""
    extract = sinks.new_folder(spark, "extract")
    feed = nested_full(records(spark, sf_dir))
    sinks.write_jsonl(feed.where("payment_channel = 'online'"), f"{extract}/run_date={DAY_BEFORE}")
    sinks.write_jsonl(feed, f"{extract}/run_date={AS_OF}")
    return extract


def run_batch(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Folder and models database of one batch run."""
    out, name = sinks.new_folder(spark, "batch"), f"ledger_{uuid.uuid4().hex}"
    args = {"database": name, "models_database": f"{name}_marts", "as_of": AS_OF}
    batch.run(spark, write_extract(spark, sf_dir), out, owners=owners(spark, sf_dir), **args)
    return out, args["models_database"]


@query
def batch_run(spark, sf_dir):
    """Extract to published view, as one run does it."""
    return wide_ints(spark.table(f"{run_batch(spark, sf_dir)[1]}.analytics_view"))


@query
def load_dump(spark, sf_dir):
    """Rows of the five dumps that a run leaves below ``load``."""
    out, _ = run_batch(spark, sf_dir)
    dumps = {name: spark.read.parquet(f"{out}/load/run_date={AS_OF}/*/{name}") for name in STAR_TABLES}
    fact, place = dumps["fact_transactions"], dumps["dim_location"]
    day, kind = dumps["dim_date"], dumps["dim_category"]
    for dim, key in ((place, "location_id"), (day, "date_id"), (kind, "category_id")):
        fact = fact.join(dim, key, "left")
    named = fact.join(one_row_per_account(dumps["dim_account"]), "account_id", "left")
    return named.select(SOURCE_ID, "city", "date", "category_primary", "account_id", "account_owner")


@query
def reject_broken_lines(spark, sf_dir):
    """A feed in which every line of the seventh position of an order is cut off."""
    lines = records(spark, sf_dir, "transaction_id", "amount")
    cut = F.col("transaction_id").endswith("-7")
    start = F.concat(F.lit('{"transaction_id": "'), "transaction_id", F.lit('"'))
    amount = F.coalesce(F.concat(F.lit(', "amount": '), F.col("amount").cast("string")), F.lit(""))
    path = sinks.new_folder(spark, "jsonl")
    sinks.write_lines(lines.select(F.when(cut, start).otherwise(F.concat(start, amount, F.lit("}")))), path)
    raw_lines = sources.read_jsonl(spark, path, keep_corrupt=True)
    folder = sinks.new_folder(spark, "rejecting")
    sound, counts = batch.write_transformed(
        raw_lines, ACCOUNT_OWNERS, f"{folder}/transform", f"{folder}/rejected"
    )
    if counts["read"] != counts["rejected"] + counts["transformed"]:
        raise ValueError(f"lines were lost: {counts}")
    rejected = spark.read.parquet(f"{folder}/rejected").select(F.lit("rejected").alias("kind"), "line")
    kept = sound.select(F.lit("sound").alias("kind"), F.col(SOURCE_ID).alias("line"))
    return rejected.union(kept)


@query
def dirty_values(spark, sf_dir):
    """Coordinates, dates and names as no feed should hold them."""
    fields = ["transaction_id", "name", "date", "loc_lat", "loc_lon"]
    odd = F.substring("transaction_id", -1, 1).cast("int") % 5
    spoilt = records(spark, sf_dir, *fields).withColumns(
        {
            "lat": F.when(odd == 0, "west").when(odd == 1, "").otherwise(F.col("loc_lat").cast("string")),
            "date": F.when(odd == 1, "2001-13-45").when(odd == 2, "soon").when(odd == 3, None).otherwise(F.col("date")),
            "name": F.when(odd == 2, F.concat(F.lit("élan\\vital ñu "), "name")).when(odd == 4, None).otherwise(F.col("name")),
        }
    )
    place = [F.col("lat") if n == "lat" else F.lit(None).cast("string").alias(n) for n in LOCATION]
    feed = spoilt.select("transaction_id", "name", "date", F.struct(*place).alias("location"))
    typed = feed.select("transaction_id", "name", "date", steps.location_fields()["lat"].alias("lat"))
    cleaned = with_sql(typed, transaction_name=text.clean_name("name"))
    return cleaned.select("transaction_id", "transaction_name", "lat", parse_date(F.col("date")).alias("date"))


@query
def stage_counts(spark, sf_dir):
    stage = sinks.Stage(spark)
    feed, n_read = batch.counted(raw(settle(spark), sf_dir))
    landed = stage.save(feed, "records")
    transformed, n_flat = batch.counted(transform(landed, owners(spark, sf_dir)))
    written = stage.save(transformed, "transform")
    stage.drop("records")
    unique, n_unique = batch.counted(star.unique_transactions(written))
    stage.save(unique, "unique")
    counts = {"read": n_read, "transformed": n_flat, "deduped": n_unique}
    return batch.stage_report(spark, {name: seen.get["n"] for name, seen in counts.items()})


# --- projections ------------------------------------------------------------


@query
def drop_columns(spark, sf_dir):
    kept = steps.drop_unused(nested_full(records(spark, sf_dir)))
    return kept.drop("personal_finance_category", "location", "no_such_field")


@query
def rename_columns(spark, sf_dir):
    return steps.rename_fields(records(spark, sf_dir, "transaction_id", "name"))


@query
def flatten_category(spark, sf_dir):
    flattened = steps.flatten_category(raw(spark, sf_dir))
    return flattened.select("transaction_id", *CATEGORY)


@query
def flatten_location(spark, sf_dir):
    """Coordinates arrive as text here."""
    coordinates = {c: F.col(c).cast("string") for c in ("loc_lat", "loc_lon")}
    feed = nested(records(spark, sf_dir).withColumns(coordinates))
    flattened = steps.flatten_location(feed)
    return flattened.select("transaction_id", *LOCATION)


@query
def transformed(spark, sf_dir):
    return wide_ints(flat(spark, sf_dir))


@query
def union_sources(spark, sf_dir):
    """Order lines and whole orders as two feeds with different fields."""
    lines = records(spark, sf_dir, "transaction_id", "account_id", "amount", "date", "name")
    orders = table(spark, sf_dir, "orders").selectExpr(
        "concat('order-', o_orderkey) AS transaction_id",
        "concat('acct-', o_custkey) AS account_id",
        "-floor(o_totalprice) / 1e2 AS amount",
        "CAST(CAST(o_orderdate AS DATE) AS STRING) AS date",
        "'other' AS payment_channel",
    )
    return steps.union_records(lines, orders)


@query
def assign_account(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id")
    ids = stable.assign(F.col("transaction_id"), list(ACCOUNT_OWNERS))
    owned = feed.withColumns({"account_id": ids, "account_owner": F.lit(None).cast("string")})
    return fills.fill_owner(owned, ACCOUNT_OWNERS)


@query
def rolling_365d(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "date")
    dated = feed.withColumn("date", parse_date(F.col("date")))
    return dated.where(in_last_year(F.col("date"), AS_OF))


# --- fills ------------------------------------------------------------------


@query
def fill_literal(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "loc_region", "loc_country")
    named = feed.withColumnsRenamed({"loc_region": "region", "loc_country": "country"})
    return fills.fill_literals(named)


@query
def fill_owner(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "account_id", "account_owner")
    return fills.fill_owner(feed, owners(spark, sf_dir))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["city", "postal_code", "lat", "lon", "store_number", "address"]
    feed = records(spark, sf_dir, "transaction_id", *[f"loc_{f}" for f in fields])
    return feed.withColumnsRenamed({f"loc_{f}": f for f in fields})


@query
def fill_location(spark, sf_dir):
    filled = fills.fill_place(places(spark, sf_dir), "transaction_id")
    return filled.select("transaction_id", "city", "postal_code", "lat", "lon")


@query
def fill_store_number(spark, sf_dir):
    filled = fills.fill_place(places(spark, sf_dir), "transaction_id")
    return filled.select("transaction_id", "store_number")


@query
def fill_address(spark, sf_dir):
    filled = fills.fill_ids(places(spark, sf_dir), "transaction_id", ["address"])
    return filled.select("transaction_id", "address")


@query
def fill_merchant_id(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "merchant_entity_id")
    return fills.fill_ids(feed, "transaction_id", ["merchant_entity_id"])


# --- scalar functions and rules --------------------------------------------


def with_sql(feed: DataFrame, **columns: str) -> DataFrame:
    return feed.withColumns({name: F.expr(sql) for name, sql in columns.items()})


@query
def fn_initcap(spark, sf_dir):
    return with_sql(records(spark, sf_dir, "transaction_id", "name"), title=text.title_case("name"))


@query
def fn_clean_name(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "name")
    return with_sql(feed, transaction_name=text.clean_name("name"))


@query
def fn_label(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "pfc_detailed", "payment_channel")
    return with_sql(
        feed,
        category_label=text.label("pfc_detailed"),
        channel_label=text.label("payment_channel"),
    )


@query
def fn_abs_amount(spark, sf_dir):
    return with_sql(records(spark, sf_dir, "transaction_id", "amount"), amount_usd=rules.magnitude("amount"))


@query
def fn_round_amount(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "amount")
    return feed.withColumn("amount_usd", rounded(F.col("amount")))


@query
def fn_parse_date(spark, sf_dir):
    """A field that holds dates and one that holds none."""
    feed = records(spark, sf_dir, "transaction_id", "date", "payment_channel")
    return feed.select(
        "transaction_id",
        parse_date(F.col("date")).alias("parsed"),
        parse_date(F.col("payment_channel")).alias("not_a_date"),
    )


@query
def date_parts_query(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "date")
    dated = feed.withColumn("date", parse_date(F.col("date")))
    return wide_ints(dated.withColumns(date_parts(F.col("date"))))


QUERIES["date_parts"] = QUERIES.pop("date_parts_query")


@query
def rule_direction(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "amount")
    return with_sql(feed, transaction_direction=rules.direction("amount"))


@query
def rule_country(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "loc_country")
    return with_sql(feed, country=rules.country_name("loc_country"))


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = records(spark, sf_dir, "transaction_id", "date")
    return feed.withColumn("date", parse_date(F.col("date")))


@query
def rule_pending(spark, sf_dir):
    return with_sql(dated(spark, sf_dir), pending=rules.pending("date", AS_OF))


@query
def rule_days_since(spark, sf_dir):
    return with_sql(
        dated(spark, sf_dir), days_since_transaction=rules.days_since("date", AS_OF)
    )


@query
def rule_amount_bucket(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "amount")
    return with_sql(feed, amount_bucket=rules.amount_bucket("amount"))


@query
def rule_large(spark, sf_dir):
    feed = records(spark, sf_dir, "transaction_id", "amount")
    return with_sql(feed, is_large_transaction=rules.is_large("amount"))


@query
def rule_income_sign(spark, sf_dir):
    """One of the categories plays the income category."""
    feed = records(spark, sf_dir, "transaction_id", "amount", "pfc_primary")
    return with_sql(feed, signed=rules.income_sign("amount", "pfc_primary", "PROMO_GOODS"))


# --- dedupe and star --------------------------------------------------------


@query
def dedupe_transactions(spark, sf_dir):
    return wide_ints(star.unique_transactions(flat(spark, sf_dir)))


@query
def dedupe_metrics(spark, sf_dir):
    return duplicate_counts(records(spark, sf_dir, "transaction_id"), "transaction_id")


@query
def surrogate_key_dense(spark, sf_dir):
    ids = records(spark, sf_dir, "transaction_id").distinct()
    return dense_key(
        sinks.Stage(spark).save(hashed_rank(ids, ["transaction_id"]), "ranked"), "row_id"
    )


@query
def build_dim_date(spark, sf_dir):
    return wide_ints(star.dim_date(ranked(spark, sf_dir)[0]))


@query
def build_dim_account(spark, sf_dir):
    return star.dim_account(ranked(spark, sf_dir)[0])


@query
def build_dim_category(spark, sf_dir):
    return star.dim_category(ranked(spark, sf_dir)[0])


@query
def build_dim_category_full(spark, sf_dir):
    return star.dim_category(ranked(spark, sf_dir)[0], grain="full")


@query
def build_dim_location(spark, sf_dir):
    return star.dim_location(ranked(spark, sf_dir)[0])


@query
def build_fact(spark, sf_dir):
    return tables(spark, sf_dir)["fact_transactions"]


@query
def lookup_date_id(spark, sf_dir):
    unique, stage = ranked(spark, sf_dir)
    dates = stage.save(star.dim_date(unique), "dim_date")
    return attach_key(unique.select(SOURCE_ID, "date"), dates, ["date"], "date_id")


@query
def lookup_category_id(spark, sf_dir):
    unique, stage = ranked(spark, sf_dir)
    categories = stage.save(star.dim_category(unique), "dim_category")
    feed = unique.select(SOURCE_ID, "category_primary")
    return attach_key(feed, categories, ["category_primary"], "category_id")


# --- models -----------------------------------------------------------------


@query
def join_date(spark, sf_dir):
    built = tables(spark, sf_dir)
    fact = built["fact_transactions"].select("transaction_id", "date_id")
    return wide_ints(left_lookup(fact, built["dim_date"], "date_id", ["date", *DATE_PARTS]))


@query
def join_category(spark, sf_dir):
    built = tables(spark, sf_dir)
    fact = built["fact_transactions"].select("transaction_id", "category_id")
    return left_lookup(fact, built["dim_category"], "category_id", CATEGORY)


@query
def join_location(spark, sf_dir):
    built = tables(spark, sf_dir)
    fact = built["fact_transactions"].select("transaction_id", "location_id")
    return left_lookup(fact, built["dim_location"], "location_id", LOCATION)


@query
def join_account(spark, sf_dir):
    built = tables(spark, sf_dir)
    fact = built["fact_transactions"].select("transaction_id", "account_id")
    accounts = one_row_per_account(built["dim_account"])
    return left_lookup(fact, accounts, "account_id", ["account_pk", "account_owner"])


@query
def mart_fact(spark, sf_dir):
    return spark.table(f"{published(spark, sf_dir)}.fact_transactions")


@query
def mart_dim_account(spark, sf_dir):
    return spark.table(f"{published(spark, sf_dir)}.dim_account")


@query
def mart_dim_category(spark, sf_dir):
    return spark.table(f"{published(spark, sf_dir)}.dim_category")


@query
def mart_dim_date(spark, sf_dir):
    return wide_ints(spark.table(f"{published(spark, sf_dir)}.dim_date"))


@query
def mart_dim_location(spark, sf_dir):
    return spark.table(f"{published(spark, sf_dir)}.dim_location")


@query
def analytics_view(spark, sf_dir):
    return wide_ints(spark.table(f"{published(spark, sf_dir)}.analytics_view"))


# --- data tests -------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    """On raw records, where fields are missing."""
    columns = ["transaction_id", "account_owner", "amount", "merchant_entity_id", "loc_city"]
    return quality.not_null(records(spark, sf_dir, *columns), "raw", columns)


@query
def dq_unique(spark, sf_dir):
    """On raw records, where ids repeat."""
    feed = records(spark, sf_dir, "transaction_id", "merchant_entity_id")
    return steps.union_records(
        quality.unique(feed, "raw", "transaction_id"),
        quality.unique(feed, "raw", "merchant_entity_id"),
    )


@query
def dq_violations(spark, sf_dir):
    """On raw records: what breaks a rule, with some of its keys, all in one grouping."""
    feed = records(spark, sf_dir, "transaction_id", "amount", "merchant_entity_id")
    rules_of = {"transaction_id": [quality.NOT_NULL, quality.UNIQUE], "amount": [quality.NOT_NULL], "merchant_entity_id": [quality.NOT_NULL]}
    return quality.suite({"raw": feed}, {"raw": rules_of}, samples=8)


@query
def dq_suite(spark, sf_dir):
    """On the models, where nothing may be wrong."""
    return quality.suite(marts.models(tables(spark, sf_dir), AS_OF))
