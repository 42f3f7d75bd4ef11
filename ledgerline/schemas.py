"""Record and table layouts, and the fixed values the rules work with."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They decide results, so they are stated here and nowhere else.

# Name of the source transaction id in every output table.
SOURCE_ID = "plaid_transaction_id"

# Fields that get an id made of the transaction id where they are missing.
FILLED_IDS = ["merchant_entity_id", "address"]

# Cells that stand in for a missing location, in index order.
BOROUGHS = [
    # city, latitude, longitude, postal code
    ("Manhattan", 40.7831, -73.9712, "10001"),
    ("Brooklyn", 40.6782, -73.9442, "11201"),
    ("Queens", 40.7282, -73.7949, "11354"),
    ("The Bronx", 40.8448, -73.8648, "10451"),
    ("Staten Island", 40.5795, -74.1502, "10301"),
]
DEFAULT_REGION = "NY"
DEFAULT_COUNTRY = "US"

# Account owners of the default feed.
ACCOUNT_OWNERS = {
    "oM4wKDvbaDUwBAZEz17eSkqElAjJMXToM1q5x": "John Doe",
    "LLvqdaJMXaSqMpjnJ96eSyZ5LJa9ArCkQqjKd": "Sarah Johnson",
    "p1NWrDvg4Did3BLV7DmjcE8W4ky9rpcprbojm": "Marcus Williams",
    "MpvKa4JlX4UBNgGWEDXmFKVr7vyDJACLlN6pm": "Emily Chen",
    "1bd9oVQJ8VU8XjWeGkN9SdvLNyA1m3upKNjXV": "David Rodriguez",
}

# Spending tiers: upper bound (exclusive) of the absolute amount, and label.
AMOUNT_TIERS = [(10, "Under $10"), (50, "$10 - $50"), (100, "$50 - $100"), (500, "$100 - $500")]
TOP_TIER = "Over $500"
LARGE_AMOUNT = 1000
COUNTRY_NAMES = {"US": "USA"}
INCOME_CATEGORY = "INCOME"

# Characters removed from transaction names.
NAME_NOISE = "*#/\\"

# ---------------------------------------------------------------------------
# Raw record, one JSON object per line.


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


CATEGORY_STRUCT = T.StructType(_strings("confidence_level", "detailed", "primary", "version"))
LOCATION_STRUCT = T.StructType(
    _strings("address", "city", "region", "postal_code", "country")
    # Read as text, so that a malformed coordinate costs its own value only.
    + _strings("lat", "lon", "store_number")
)

CORRUPT = "_corrupt_record"

# Fields the jobs use. The reader skips every other field of the record.
RAW = T.StructType(
    _strings("transaction_id", "account_id", "account_owner")
    + [T.StructField("amount", T.DoubleType())]
    + _strings("date", "iso_currency_code", "merchant_entity_id", "name", "payment_channel")
    + [T.StructField("pending", T.BooleanType())]
    + _strings("transaction_type")
    + [
        T.StructField("personal_finance_category", CATEGORY_STRUCT),
        T.StructField("location", LOCATION_STRUCT),
    ]
)

# Fields of the record that are dropped after reading it whole.
UNUSED_TEXT = [
    "authorized_date",
    "authorized_datetime",
    "category_id",
    "check_number",
    "datetime",
    "logo_url",
    "pending_transaction_id",
    "personal_finance_category_icon_url",
    "transaction_code",
    "unofficial_currency_code",
    "website",
]
UNUSED_NESTED = {
    "category": T.ArrayType(T.StringType()),
    "counterparties": T.ArrayType(T.StructType(_strings("name"))),
    "payment_meta": T.StructType(
        _strings(
            "reference_number",
            "ppd_id",
            "payee",
            "by_order_of",
            "payer",
            "payment_method",
            "payment_processor",
            "reason",
        )
    ),
}
UNUSED = [*UNUSED_TEXT, *UNUSED_NESTED]

# The record with every field, for feeds that are written in full.
RAW_FULL = T.StructType(
    RAW.fields
    + _strings("merchant_name", *UNUSED_TEXT)
    + [T.StructField(name, kind) for name, kind in UNUSED_NESTED.items()]
)

# ---------------------------------------------------------------------------
# Output columns, in contract order.

DATE_PARTS = ["year", "quarter", "month", "day_of_month", "day_of_week"]
CATEGORY = ["category_primary", "category_detail", "category_confidence"]
LOCATION = ["address", "city", "region", "postal_code", "country", "lat", "lon", "store_number"]

TRANSFORMED = [
    SOURCE_ID,
    "account_id",
    "account_owner",
    "transaction_name",
    "amount_usd",
    "date",
    "iso_currency_code",
    "payment_channel",
    "pending",
    "transaction_type",
    "merchant_entity_id",
    *CATEGORY,
    *LOCATION,
    *DATE_PARTS,
]

DIM_DATE = ["date_id", "date", *DATE_PARTS]
DIM_LOCATION = ["location_id", *LOCATION]
DIM_CATEGORY = ["category_id", *CATEGORY]
DIM_ACCOUNT = ["account_pk", "account_id", "account_owner"]
FACT = [
    "transaction_id",
    SOURCE_ID,
    "account_id",
    "date_id",
    "location_id",
    "category_id",
    "amount_usd",
    "transaction_name",
    "iso_currency_code",
    "payment_channel",
    "pending",
    "transaction_type",
    "merchant_entity_id",
]

MART_FACT = [
    "transaction_id",
    SOURCE_ID,
    "account_id",
    "date_id",
    "location_id",
    "category_id",
    "transaction_name",
    "amount_usd",
    "transaction_direction",
    "payment_channel",
    "transaction_type",
    "iso_currency_code",
    "merchant_entity_id",
    *CATEGORY,
    "country",
    "pending",
    "days_since_transaction",
    "amount_bucket",
    "is_large_transaction",
]

ANALYTICS_VIEW = [
    "transaction_id",
    SOURCE_ID,
    "account_id",
    "account_owner",
    "account_pk",
    "date",
    *DATE_PARTS,
    *CATEGORY,
    *LOCATION,
    "transaction_name",
    "amount_usd",
    "transaction_direction",
    "payment_channel",
    "transaction_type",
    "iso_currency_code",
    "merchant_entity_id",
    "pending",
    "is_large_transaction",
    "days_since_transaction",
    "amount_bucket",
]

# Partitions of the loaded fact and location tables: of the transaction's date, 0 without one.
PARTITIONS = ["date_year", "date_month"]
STAR_TABLES = ["dim_account", "dim_date", "dim_category", "dim_location", "fact_transactions"]
STAR_COLUMNS = {
    "dim_account": DIM_ACCOUNT,
    "dim_date": DIM_DATE,
    "dim_category": DIM_CATEGORY,
    "dim_location": DIM_LOCATION,
    "fact_transactions": FACT,
}
