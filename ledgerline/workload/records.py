"""Transaction records derived from the given order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.schemas import (
    LOCATION_STRUCT,
    RAW,
    RAW_FULL,
    UNUSED_NESTED,
    UNUSED_TEXT,
)
from ledgerline.sources.files import spread

# Setting with the number of partitions of the order lines; without it they are as scanned.
SCAN_PARTITIONS = "ledgerline.scan.partitions"

# Record fields by the table they come from. Fields of a lookup table are computed
# there, before the join: once per order, part or supplier instead of once per line.
FIELDS = {
    "lineitem": {
        "transaction_id": "concat(l_orderkey, '-', l_linenumber)",
        "amount": "if(l_partkey % 97 = 0, NULL, "
        "if(l_returnflag = 'R', -1, 1) * floor(l_extendedprice) / 1e2)",
        "date": "CAST(CAST(l_shipdate AS DATE) AS STRING)",
        "iso_currency_code": "'USD'",
        "merchant_entity_id": "if(l_suppkey % 2 = 0, NULL, concat('m-', l_suppkey))",
        "payment_channel": "if(l_linestatus = 'O', 'in store', 'online')",
        "pending": "false",
        "transaction_type": "if(l_returnflag = 'A', 'special', 'place')",
        "loc_postal_code": "if(l_suppkey % 4 = 0, NULL, concat('9', l_suppkey))",
        "loc_address": "CAST(NULL AS STRING)",
        "loc_store_number": "if(l_suppkey % 6 = 0, CAST(l_suppkey AS STRING), NULL)",
    },
    "orders": {
        "account_id": "concat('acct-', o_custkey)",
        "pfc_confidence_level": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'VERY_HIGH' "
        "WHEN '2' THEN 'HIGH' WHEN '3' THEN 'MEDIUM' ELSE 'LOW' END",
    },
    "customer": {"account_owner": "if(o_custkey % 5 = 0, NULL, c_name)"},
    "part": {
        "merchant_name": "p_name",
        "name": "concat(p_name, ' *', p_brand, '/', lower(p_type), '-shop')",
        "pfc_primary": "concat(p_type, '_GOODS')",
        "pfc_detailed": "concat(p_type, '_GOODS_', upper(replace(p_brand, '#', '_')))",
    },
    "nation": {
        "loc_city": "n_name",
        "loc_region": "concat('R', n_regionkey)",
        "loc_country": "CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'US' ELSE 'CA' END",
        "loc_lat": "CAST(n_nationkey AS DOUBLE) + 0.5D",
        "loc_lon": "-CAST(n_nationkey AS DOUBLE) - 0.5D",
    },
}
# Fields that a third of the suppliers lack.
SPARSE = {"loc_city", "loc_region", "loc_lat", "loc_lon"}
NAMES = [
    "transaction_id",
    "account_id",
    "account_owner",
    "amount",
    "date",
    "iso_currency_code",
    "merchant_entity_id",
    "merchant_name",
    "name",
    "payment_channel",
    "pending",
    "transaction_type",
    "pfc_primary",
    "pfc_detailed",
    "pfc_confidence_level",
    "loc_city",
    "loc_region",
    "loc_postal_code",
    "loc_country",
    "loc_lat",
    "loc_lon",
    "loc_address",
    "loc_store_number",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Flat records, one per order line, with the named fields (default: all).

    Only the lookup tables that those fields need are joined. Customers are joined
    to the orders, so the lines move once for both. Left joins: a missing lookup
    costs values, not the record. No hints: file sizes decide what is broadcast.
    """
    wanted = list(fields) or NAMES

    def pick(df: DataFrame, source: str, *keys: str) -> DataFrame:
        own = [f"{sql} AS {f}" for f, sql in FIELDS[source].items() if f in wanted]
        return df.selectExpr(*keys, *own)

    def needs(*sources: str) -> bool:
        return any(f in wanted for source in sources for f in FIELDS[source])

    parts = spark.conf.get(SCAN_PARTITIONS, None)
    lines = spread(table(spark, sf_dir, "lineitem"), int(parts) if parts else None, "l_orderkey")
    if needs("orders", "customer"):
        orders = table(spark, sf_dir, "orders")
        side = pick(orders, "orders", "o_orderkey", "o_custkey")
        if needs("customer"):
            customer = table(spark, sf_dir, "customer")
            side = side.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            kept = [f for f in FIELDS["orders"] if f in wanted]
            side = pick(side, "customer", "o_orderkey", *kept)
        lines = lines.join(side, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if needs("part"):
        side = pick(table(spark, sf_dir, "part"), "part", "p_partkey")
        lines = lines.join(side, F.col("l_partkey") == F.col("p_partkey"), "left")
    if needs("nation"):
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        side = pick(table(spark, sf_dir, "nation"), "nation", "n_nationkey")
        lines = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        lines = lines.join(side, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    own = {f: f"{sql} AS {f}" for f, sql in FIELDS["lineitem"].items()}
    own.update({f: f"if(l_suppkey % 3 = 0, NULL, {f}) AS {f}" for f in SPARSE})
    return lines.selectExpr(*[own.get(f, f) for f in wanted])


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('acct-', c_custkey) AS account_id", "c_name AS account_owner"
    )


def nested(flat: DataFrame) -> DataFrame:
    """Records in the layout of the raw feed, with the fields the jobs use."""
    structs = {
        "personal_finance_category": F.struct(
            F.col("pfc_confidence_level").alias("confidence_level"),
            F.col("pfc_detailed").alias("detailed"),
            F.col("pfc_primary").alias("primary"),
            F.lit("v2").alias("version"),
        ),
        "location": F.struct(
            *[F.col(f"loc_{f}").alias(f) for f in LOCATION_STRUCT.names]
        ),
    }
    return flat.withColumns(structs).select(*RAW.names)


def nested_full(flat: DataFrame) -> DataFrame:
    """Records with every field of the raw feed, the unused ones empty."""
    base = nested(flat)
    unused = {name: F.lit(None).cast("string") for name in UNUSED_TEXT}
    unused.update({name: F.lit(None).cast(kind) for name, kind in UNUSED_NESTED.items()})
    unused["counterparties"] = F.array().cast(UNUSED_NESTED["counterparties"])
    return base.withColumns({"merchant_name": F.col("name"), **unused}).select(*RAW_FULL.names)

