"""SQL twins of the registered queries, for DuckDB over the same tables.

Written independently of the Spark expressions. Shared steps are named CTEs; a
query lists only the ones it needs.
"""

from __future__ import annotations

from ledgerline.schemas import (
    ANALYTICS_VIEW,
    CATEGORY,
    DATE_PARTS,
    DIM_ACCOUNT,
    DIM_CATEGORY,
    DIM_DATE,
    DIM_LOCATION,
    FACT,
    LOCATION,
    MART_FACT,
    SOURCE_ID,
    TRANSFORMED,
)

AS_OF = "DATE '2001-08-01'"


def cols(names: list[str], prefix: str = "") -> str:
    return ", ".join(prefix + n for n in names)


def title(x: str) -> str:
    delimiters = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""
    words = f"regexp_extract_all({x}, '[^{delimiters}]+|[{delimiters}]+')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), '')"


def label(x: str) -> str:
    return title(f"replace({x}, '_', ' ')")


def cleaned(x: str) -> str:
    return title(rf"regexp_replace({x}, '[*#/\\]', '', 'g')")


def word(digest: str, n: int) -> str:
    return f"CAST('0x' || substr({digest}, {1 + 8 * n}, 8) AS BIGINT)"


def uuid_of(digest: str) -> str:
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return "concat_ws('-', " + ", ".join(f"substr({digest}, {a}, {n})" for a, n in parts) + ")"


# Fixed values of the rules: tiers and their bounds, the large amount, country names.
def tier(a: str) -> str:
    return (
        f"CASE WHEN {a} IS NULL OR abs({a}) >= 500 THEN 'Over $500' "
        f"WHEN abs({a}) >= 100 THEN '$100 - $500' WHEN abs({a}) >= 50 THEN '$50 - $100' "
        f"WHEN abs({a}) >= 10 THEN '$10 - $50' ELSE 'Under $10' END"
    )


def large(a: str) -> str:
    return f"CASE WHEN abs({a}) > 1000 THEN 'Yes' ELSE 'No' END"


def direction(a: str) -> str:
    return f"CASE WHEN {a} > 0 THEN 'Debit' ELSE 'Credit' END"


def country(c: str) -> str:
    return f"CASE WHEN {c} = 'US' THEN 'USA' ELSE {c} END"


def open_flag(d: str) -> str:
    return f"CASE WHEN {d} IS NOT DISTINCT FROM {AS_OF} THEN 'Yes' ELSE 'No' END"


def age(d: str) -> str:
    return f"CAST({AS_OF} - {d} AS BIGINT)"


def parts(d: str) -> str:
    return (
        f"CAST(year({d}) AS BIGINT) AS year, CAST(quarter({d}) AS BIGINT) AS quarter, "
        f"monthname({d}) AS month, CAST(day({d}) AS BIGINT) AS day_of_month, "
        f"dayname({d}) AS day_of_week"
    )


def hashed_order(keys: list[str]) -> str:
    texts = ", ".join(f"coalesce({k}, '')" for k in keys)
    nulls_first = ", ".join(f"{k} NULLS FIRST" for k in keys)
    return f"md5(concat_ws(chr(31), {texts})), {nulls_first}"


def numbered(keys: list[str], name: str) -> str:
    return f"row_number() OVER (ORDER BY {hashed_order(keys)}) AS {name}"


REST = [c for c in TRANSFORMED if c != SOURCE_ID]

# CTE name -> (names of CTEs it reads, text)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw": (
        (),
        """
SELECT
  concat(l.l_orderkey, '-', l.l_linenumber) AS transaction_id,
  concat('acct-', o.o_custkey) AS account_id,
  CASE WHEN o.o_custkey % 5 = 0 THEN NULL ELSE c.c_name END AS account_owner,
  CASE WHEN l.l_partkey % 97 = 0 THEN NULL
       ELSE (CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END)
            * floor(l.l_extendedprice) / 1e2 END AS amount,
  CAST(CAST(l.l_shipdate AS DATE) AS STRING) AS date,
  'USD' AS iso_currency_code,
  CASE WHEN l.l_suppkey % 2 = 0 THEN NULL ELSE concat('m-', l.l_suppkey) END AS merchant_entity_id,
  p.p_name AS merchant_name,
  concat(p.p_name, ' *', p.p_brand, '/', lower(p.p_type), '-shop') AS name,
  CASE WHEN l.l_linestatus = 'O' THEN 'in store' ELSE 'online' END AS payment_channel,
  false AS pending,
  CASE WHEN l.l_returnflag = 'A' THEN 'special' ELSE 'place' END AS transaction_type,
  concat(p.p_type, '_GOODS') AS pfc_primary,
  concat(p.p_type, '_GOODS_', upper(replace(p.p_brand, '#', '_'))) AS pfc_detailed,
  CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 'VERY_HIGH' WHEN '2' THEN 'HIGH'
       WHEN '3' THEN 'MEDIUM' ELSE 'LOW' END AS pfc_confidence_level,
  CASE WHEN l.l_suppkey % 3 = 0 THEN NULL ELSE n.n_name END AS loc_city,
  CASE WHEN l.l_suppkey % 3 = 0 THEN NULL ELSE concat('R', n.n_regionkey) END AS loc_region,
  CASE WHEN l.l_suppkey % 4 = 0 THEN NULL ELSE concat('9', l.l_suppkey) END AS loc_postal_code,
  CASE WHEN n.n_nationkey % 4 = 0 THEN NULL WHEN n.n_nationkey % 4 = 1 THEN 'US' ELSE 'CA' END
    AS loc_country,
  CASE WHEN l.l_suppkey % 3 = 0 THEN NULL ELSE CAST(n.n_nationkey AS DOUBLE) + 0.5 END AS loc_lat,
  CASE WHEN l.l_suppkey % 3 = 0 THEN NULL ELSE -CAST(n.n_nationkey AS DOUBLE) - 0.5 END AS loc_lon,
  CAST(NULL AS STRING) AS loc_address,
  CASE WHEN l.l_suppkey % 6 = 0 THEN CAST(l.l_suppkey AS STRING) END AS loc_store_number
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    ),
    "owners": (
        (),
        "SELECT concat('acct-', c_custkey) AS account_id, c_name AS owner FROM customer",
    ),
    # The cells of the place fill.
    "cells": (
        (),
        """
SELECT * FROM (VALUES
  (0, 'Manhattan', 40.7831::DOUBLE, -73.9712::DOUBLE, '10001'),
  (1, 'Brooklyn', 40.6782::DOUBLE, -73.9442::DOUBLE, '11201'),
  (2, 'Queens', 40.7282::DOUBLE, -73.7949::DOUBLE, '11354'),
  (3, 'The Bronx', 40.8448::DOUBLE, -73.8648::DOUBLE, '10451'),
  (4, 'Staten Island', 40.5795::DOUBLE, -74.1502::DOUBLE, '10301')
) AS v(cell, cell_city, cell_lat, cell_lon, cell_postal)""",
    ),
    "hashed": (
        ("raw",),
        """
SELECT *, md5(transaction_id || ':place') AS h, md5(transaction_id || ':address') AS h_address,
  md5(transaction_id || ':merchant_entity_id') AS h_merchant FROM raw""",
    ),
    "placed": (
        ("hashed", "cells"),
        f"""
SELECT r.*, coalesce(loc_city, cell_city) AS city, coalesce(loc_postal_code, cell_postal) AS postal_code,
  coalesce(loc_lat, cell_lat + (CAST({word('h', 1)} % 20000 AS DOUBLE) / 1e6 - 1e-2)) AS lat,
  coalesce(loc_lon, cell_lon + (CAST({word('h', 2)} % 20000 AS DOUBLE) / 1e6 - 1e-2)) AS lon,
  coalesce(loc_store_number, CAST({word('h', 3)} % 900 + 100 AS VARCHAR)) AS store_number,
  coalesce(loc_address, {uuid_of('h_address')}) AS address,
  coalesce(loc_region, 'NY') AS region, coalesce(loc_country, 'US') AS country
FROM hashed r JOIN cells ON cell = {word('h', 0)} % 5""",
    ),
    "transformed": (
        ("placed", "owners"),
        f"""
SELECT transaction_id AS {SOURCE_ID}, r.account_id, coalesce(r.account_owner, o.owner) AS account_owner,
  name AS transaction_name, round(amount, 2) AS amount_usd, CAST(date AS DATE) AS date,
  iso_currency_code, payment_channel, pending, transaction_type,
  coalesce(merchant_entity_id, {uuid_of('h_merchant')}) AS merchant_entity_id,
  pfc_primary AS category_primary, pfc_detailed AS category_detail,
  pfc_confidence_level AS category_confidence, {cols(LOCATION)}, {parts('CAST(date AS DATE)')}
FROM placed r LEFT JOIN owners o ON r.account_id = o.account_id""",
    ),
    "deduped": (
        ("transformed",),
        f"""
SELECT {cols(TRANSFORMED)} FROM transformed
QUALIFY row_number() OVER (PARTITION BY {SOURCE_ID}
  ORDER BY {', '.join(c + ' NULLS FIRST' for c in REST)}) = 1""",
    ),
    "located": (
        ("deduped",),
        f"SELECT {numbered([SOURCE_ID], 'location_id')}, * FROM deduped",
    ),
    "dim_location": (("located",), f"SELECT {cols(DIM_LOCATION)} FROM located"),
    "dim_date": (
        ("deduped",),
        f"""
SELECT row_number() OVER (ORDER BY date NULLS FIRST) AS date_id, *
FROM (SELECT DISTINCT date, {cols(DATE_PARTS)} FROM deduped)""",
    ),
    "dim_account": (
        ("deduped",),
        f"""
SELECT {numbered(DIM_ACCOUNT[1:], 'account_pk')}, *
FROM (SELECT DISTINCT account_id, account_owner FROM deduped)""",
    ),
    "dim_category": (
        ("deduped",),
        f"""
SELECT {numbered(['category_primary'], 'category_id')}, {cols(CATEGORY)} FROM (
  SELECT {cols(CATEGORY)} FROM deduped
  QUALIFY row_number() OVER (PARTITION BY category_primary
    ORDER BY category_detail NULLS FIRST, category_confidence NULLS FIRST) = 1)""",
    ),
    "dim_category_full": (
        ("deduped",),
        f"""
SELECT {numbered(CATEGORY, 'category_id')}, * FROM (SELECT DISTINCT {cols(CATEGORY)} FROM deduped)""",
    ),
    "fact": (
        ("located", "dim_date", "dim_category"),
        f"""
SELECT {cols([f't.{SOURCE_ID} AS transaction_id' if c == 'transaction_id' else c if c in ('date_id', 'category_id') else 't.' + c for c in FACT])}
FROM located t
LEFT JOIN dim_date d ON t.date IS NOT DISTINCT FROM d.date
LEFT JOIN dim_category c ON t.category_primary IS NOT DISTINCT FROM c.category_primary""",
    ),
    "mart_category": (
        ("dim_category",),
        f"SELECT category_id, {', '.join(f'{label(c)} AS {c}' for c in CATEGORY)} FROM dim_category",
    ),
    "mart_fact": (
        ("fact", "dim_date", "dim_location", "mart_category"),
        f"""
SELECT t.transaction_id, t.{SOURCE_ID}, t.account_id, t.date_id, t.location_id, t.category_id,
  {cleaned('t.transaction_name')} AS transaction_name, abs(t.amount_usd) AS amount_usd,
  {direction('t.amount_usd')} AS transaction_direction, {label('t.payment_channel')} AS payment_channel,
  {label('t.transaction_type')} AS transaction_type, t.iso_currency_code, t.merchant_entity_id,
  {cols(CATEGORY, 'm.')}, {country('l.country')} AS country, {open_flag('d.date')} AS pending,
  {age('d.date')} AS days_since_transaction, {tier('t.amount_usd')} AS amount_bucket,
  {large('t.amount_usd')} AS is_large_transaction
FROM fact t
LEFT JOIN dim_date d USING (date_id)
LEFT JOIN mart_category m USING (category_id)
LEFT JOIN dim_location l USING (location_id)""",
    ),
    "analytics": (
        ("mart_fact", "dim_account", "dim_date", "dim_location"),
        "SELECT "
        + ", ".join(
            f"a.{c}"
            if c in ("account_owner", "account_pk")
            else f"d.{c}"
            if c in ("date", *DATE_PARTS)
            else f"l.{c}"
            if c in LOCATION and c != "country"
            else f"m.{c}"
            for c in ANALYTICS_VIEW
        )
        + """
FROM mart_fact m
LEFT JOIN dim_account a ON m.account_id = a.account_id
LEFT JOIN dim_date d ON m.date_id = d.date_id
LEFT JOIN dim_location l ON m.location_id = l.location_id""",
    ),
}


def sql(select: str, *needs: str) -> str:
    """``select`` behind the CTEs it needs, in order of dependency."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in CTES[name][0]:
            visit(other)
        if name not in order:
            order.append(name)

    for need in needs:
        visit(need)
    head = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order)
    return f"WITH {head}\n{select}" if head else select


def from_raw(columns: str, tail: str = "") -> str:
    return sql(f"SELECT {columns} FROM raw {tail}", "raw")


def null_test(model: str, column: str, source: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", 'not_null' AS test, "
        f"count(*) FILTER (WHERE {column} IS NULL) AS violations FROM {source}"
    )


def unique_test(model: str, column: str, source: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", 'unique' AS test, "
        f"(SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)) AS violations"
    )


FLAT_FIELDS = (
    "transaction_id, account_id, account_owner, amount, date, iso_currency_code, "
    "merchant_entity_id, name, payment_channel, pending, transaction_type, pfc_primary, "
    "pfc_detailed, pfc_confidence_level, loc_city, loc_region, loc_postal_code, loc_country, "
    "loc_lat, loc_lon, loc_address, loc_store_number"
)
RUN_DATES = (
    "CASE payment_channel WHEN 'in store' THEN DATE '2001-08-01' "
    "ELSE DATE '2001-07-31' END AS run_date"
)
# Accounts and their owners.
ACCOUNTS = (
    "[{'id': 'oM4wKDvbaDUwBAZEz17eSkqElAjJMXToM1q5x', 'owner': 'John Doe'}, "
    "{'id': 'LLvqdaJMXaSqMpjnJ96eSyZ5LJa9ArCkQqjKd', 'owner': 'Sarah Johnson'}, "
    "{'id': 'p1NWrDvg4Did3BLV7DmjcE8W4ky9rpcprbojm', 'owner': 'Marcus Williams'}, "
    "{'id': 'MpvKa4JlX4UBNgGWEDXmFKVr7vyDJACLlN6pm', 'owner': 'Emily Chen'}, "
    "{'id': '1bd9oVQJ8VU8XjWeGkN9SdvLNyA1m3upKNjXV', 'owner': 'David Rodriguez'}]"
)
ACCOUNT_AT = word("md5(transaction_id || ':account')", 0) + " % 5 + 1"


def _counts(kind: str, sources: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {kind}, count(*) AS n_rows FROM {source}"
        for name, source in sources.items()
    )


VIEWS = {
    "stg_transactions": "mart_fact",
    "fact_transactions": "mart_fact",
    "dim_account": "dim_account",
    "dim_category": "mart_category",
    "dim_date": "dim_date",
    "dim_location": "dim_location",
    "analytics_view": "analytics",
}
SUITE = [
    null_test("fact_transactions", SOURCE_ID, "mart_fact"),
    null_test("fact_transactions", "account_id", "mart_fact"),
    null_test("fact_transactions", "transaction_id", "mart_fact"),
    unique_test("fact_transactions", SOURCE_ID, "mart_fact"),
    null_test("dim_account", "account_id", "dim_account"),
    unique_test("dim_account", "account_id", "dim_account"),
    null_test("dim_date", "date_id", "dim_date"),
    unique_test("dim_date", "date_id", "dim_date"),
    null_test("dim_category", "category_id", "mart_category"),
    unique_test("dim_category", "category_id", "mart_category"),
    null_test("dim_location", "location_id", "dim_location"),
    unique_test("dim_location", "location_id", "dim_location"),
]
DATE = "CAST(date AS DATE)"
ODD = "(CAST(right(transaction_id, 1) AS INTEGER) % 5)"

PER_KEY = (
    "(SELECT transaction_id, count(*) AS n, count(*) FILTER (WHERE amount IS NULL) AS no_amount, "
    "count(*) FILTER (WHERE merchant_entity_id IS NULL) AS no_merchant, "
    "('0x' || substr(md5(transaction_id), 1, 7))::BIGINT % 8 AS part FROM raw GROUP BY transaction_id) AS per_key"
)

ORACLE: dict[str, str] = {
    # sources and sinks
    "scan_jsonl": from_raw(FLAT_FIELDS),
    "jsonl_roundtrip": from_raw(
        "transaction_id, loc_city AS city, amount, CAST(28 AS BIGINT) AS n_keys"
    ),
    "latest_extract": from_raw(FLAT_FIELDS, "WHERE payment_channel = 'in store'"),
    "read_run_date": from_raw(
        f"transaction_id, amount, payment_channel, {RUN_DATES}", "WHERE payment_channel = 'in store'"
    ),
    "overwrite_idempotent": from_raw(f"transaction_id, amount, payment_channel, {RUN_DATES}"),
    "scan_parquet_parts": from_raw("transaction_id, account_id, amount, payment_channel"),
    "parquet_roundtrip": sql(f"SELECT {cols(TRANSFORMED)} FROM transformed", "transformed"),
    "truncate_then_count": sql(
        "SELECT 'dim_account' AS table_name, true AS existed, count(*) AS rows_before, "
        "CAST(0 AS BIGINT) AS rows_after FROM dim_account UNION ALL "
        "SELECT 'dim_date', true, count(*), 0 FROM dim_date UNION ALL "
        "SELECT t, false, NULL, NULL FROM (VALUES ('dim_category'), ('dim_location'), "
        "('fact_transactions')) v(t)",
        "dim_account",
        "dim_date",
    ),
    "newest_delivery": from_raw(FLAT_FIELDS, "WHERE payment_channel = 'online'"),
    "schema_drift": sql(
        "SELECT CAST(NULL AS VARCHAR) AS path, 'broken' AS drift, CAST(NULL AS VARCHAR) AS expected, 'broken' AS found, count(*) AS n_values "
        "FROM raw WHERE transaction_id LIKE '%5' "
        "UNION ALL SELECT 'pending', 'lost', 'boolean', NULL, 0 "
        "UNION ALL SELECT 'amount', 'retyped', 'number', 'string', count(*) FROM raw WHERE transaction_id LIKE '%7' AND amount IS NOT NULL "
        "UNION ALL SELECT 'loyalty', 'new', NULL, 'object', count(*) FROM raw WHERE transaction_id LIKE '%3' "
        "UNION ALL SELECT 'loyalty.tier', 'new', NULL, 'string', count(*) FROM raw WHERE transaction_id LIKE '%3'",
        "raw",
    ),
    "load_star_tables": sql(
        f"SELECT {cols(FACT, 'f.')}, {cols(LOCATION, 'l.')}, {cols(CATEGORY, 'c.')}, {cols(DATE_PARTS, 'd.')}, d.date, "
        "a.account_pk, a.account_owner FROM fact f LEFT JOIN dim_location l ON f.location_id = l.location_id "
        "LEFT JOIN dim_category c ON f.category_id = c.category_id LEFT JOIN dim_date d ON f.date_id = d.date_id "
        "LEFT JOIN dim_account a ON f.account_id = a.account_id",
        "fact",
        "dim_location",
        "dim_category",
        "dim_date",
        "dim_account",
    ),
    "model_views": sql(
        f"SELECT {cols(MART_FACT, 'm.')}, {cols(DIM_DATE[1:], 'd.')} FROM mart_fact m LEFT JOIN dim_date d ON m.date_id = d.date_id",
        "mart_fact",
        "dim_date",
    ),
    "batch_run": sql(f"SELECT {cols(ANALYTICS_VIEW)} FROM analytics", "analytics"),
    "load_dump": sql(
        f"SELECT f.{SOURCE_ID}, l.city, d.date, c.category_primary, f.account_id, a.account_owner FROM fact f "
        "LEFT JOIN dim_location l USING (location_id) LEFT JOIN dim_date d USING (date_id) "
        "LEFT JOIN dim_category c USING (category_id) LEFT JOIN dim_account a USING (account_id)",
        "fact",
        "dim_location",
        "dim_date",
        "dim_category",
        "dim_account",
    ),
    "reject_broken_lines": from_raw(
        "CASE WHEN transaction_id LIKE '%-7' THEN 'rejected' ELSE 'sound' END AS kind, "
        "CASE WHEN transaction_id LIKE '%-7' "
        """THEN '{"transaction_id": "' || transaction_id || '"' ELSE transaction_id END AS line"""
    ),
    "dirty_values": from_raw(
        f"transaction_id, CASE {ODD} WHEN 4 THEN NULL "
        f"WHEN 2 THEN {cleaned("('élan' || chr(92) || 'vital ñu ' || name)")} "
        f"ELSE {cleaned('name')} END AS transaction_name, "
        f"CASE WHEN {ODD} IN (0, 1) THEN NULL ELSE loc_lat END AS lat, "
        f"CASE WHEN {ODD} IN (1, 2, 3) THEN NULL ELSE CAST(date AS DATE) END AS date"
    ),
    "stage_counts": sql(
        _counts("stage", {"read": "raw", "transformed": "transformed", "deduped": "deduped"}),
        "raw",
        "transformed",
        "deduped",
    ),
    # projections
    "drop_columns": from_raw(
        "transaction_id, account_id, account_owner, amount, date, iso_currency_code, "
        "merchant_entity_id, name, payment_channel, pending, transaction_type"
    ),
    "rename_columns": from_raw(f"transaction_id AS {SOURCE_ID}, name AS transaction_name"),
    "flatten_category": from_raw(
        "transaction_id, pfc_primary AS category_primary, pfc_detailed AS category_detail, "
        "pfc_confidence_level AS category_confidence"
    ),
    "flatten_location": from_raw(
        "transaction_id, " + ", ".join(f"loc_{c} AS {c}" for c in LOCATION)
    ),
    "transformed": sql(f"SELECT {cols(TRANSFORMED)} FROM transformed", "transformed"),
    "union_sources": sql(
        "SELECT transaction_id, account_id, amount, date, name, "
        "CAST(NULL AS VARCHAR) AS payment_channel FROM raw UNION ALL "
        "SELECT concat('order-', o_orderkey), concat('acct-', o_custkey), "
        "-floor(o_totalprice) / 1e2, CAST(CAST(o_orderdate AS DATE) AS VARCHAR), NULL, 'other' "
        "FROM orders",
        "raw",
    ),
    "assign_account": from_raw(
        f"transaction_id, ({ACCOUNTS}[{ACCOUNT_AT}]).id AS account_id, "
        f"({ACCOUNTS}[{ACCOUNT_AT}]).owner AS account_owner"
    ),
    "rolling_365d": from_raw(
        f"transaction_id, {DATE} AS date",
        f"WHERE {DATE} >= {AS_OF} - INTERVAL 365 DAY AND {DATE} <= {AS_OF}",
    ),
    # fills
    "fill_literal": from_raw(
        "transaction_id, coalesce(loc_region, 'NY') AS region, coalesce(loc_country, 'US') AS country"
    ),
    "fill_owner": sql(
        "SELECT transaction_id, r.account_id, coalesce(account_owner, owner) AS account_owner "
        "FROM raw r LEFT JOIN owners o ON r.account_id = o.account_id",
        "raw",
        "owners",
    ),
    "fill_location": sql(
        "SELECT transaction_id, city, postal_code, lat, lon FROM placed", "placed"
    ),
    "fill_store_number": sql("SELECT transaction_id, store_number FROM placed", "placed"),
    "fill_address": sql("SELECT transaction_id, address FROM placed", "placed"),
    "fill_merchant_id": sql(
        f"SELECT transaction_id, coalesce(merchant_entity_id, {uuid_of('h_merchant')}) "
        "AS merchant_entity_id FROM hashed",
        "hashed",
    ),
    # scalar functions and rules
    "fn_initcap": from_raw(f"transaction_id, name, {title('name')} AS title"),
    "fn_clean_name": from_raw(f"transaction_id, name, {cleaned('name')} AS transaction_name"),
    "fn_label": from_raw(
        f"transaction_id, pfc_detailed, payment_channel, {label('pfc_detailed')} AS category_label, "
        f"{label('payment_channel')} AS channel_label"
    ),
    "fn_abs_amount": from_raw("transaction_id, amount, abs(amount) AS amount_usd"),
    "fn_round_amount": from_raw("transaction_id, amount, round(amount, 2) AS amount_usd"),
    "fn_parse_date": from_raw(
        f"transaction_id, {DATE} AS parsed, TRY_CAST(payment_channel AS DATE) AS not_a_date"
    ),
    "date_parts": from_raw(f"transaction_id, {DATE} AS date, {parts(DATE)}"),
    "rule_direction": from_raw(
        f"transaction_id, amount, {direction('amount')} AS transaction_direction"
    ),
    "rule_country": from_raw(f"transaction_id, loc_country, {country('loc_country')} AS country"),
    "rule_pending": from_raw(f"transaction_id, {DATE} AS date, {open_flag(DATE)} AS pending"),
    "rule_days_since": from_raw(
        f"transaction_id, {DATE} AS date, {age(DATE)} AS days_since_transaction"
    ),
    "rule_amount_bucket": from_raw(f"transaction_id, amount, {tier('amount')} AS amount_bucket"),
    "rule_large": from_raw(f"transaction_id, amount, {large('amount')} AS is_large_transaction"),
    "rule_income_sign": from_raw(
        "transaction_id, amount, pfc_primary, "
        "CASE WHEN pfc_primary = 'PROMO_GOODS' THEN -amount ELSE amount END AS signed"
    ),
    # dedupe and star
    "dedupe_transactions": sql(f"SELECT {cols(TRANSFORMED)} FROM deduped", "deduped"),
    "dedupe_metrics": from_raw(
        "count(*) AS rows_before, count(DISTINCT transaction_id) AS rows_after, "
        "count(*) - count(DISTINCT transaction_id) AS duplicates"
    ),
    "surrogate_key_dense": sql(
        f"SELECT {numbered(['transaction_id'], 'row_id')}, transaction_id "
        "FROM (SELECT DISTINCT transaction_id FROM raw)",
        "raw",
    ),
    "build_dim_date": sql(f"SELECT {cols(DIM_DATE)} FROM dim_date", "dim_date"),
    "build_dim_account": sql(f"SELECT {cols(DIM_ACCOUNT)} FROM dim_account", "dim_account"),
    "build_dim_category": sql(f"SELECT {cols(DIM_CATEGORY)} FROM dim_category", "dim_category"),
    "build_dim_category_full": sql(
        f"SELECT {cols(DIM_CATEGORY)} FROM dim_category_full", "dim_category_full"
    ),
    "build_dim_location": sql(f"SELECT {cols(DIM_LOCATION)} FROM dim_location", "dim_location"),
    "build_fact": sql(f"SELECT {cols(FACT)} FROM fact", "fact"),
    "lookup_date_id": sql(
        f"SELECT t.{SOURCE_ID}, t.date, d.date_id FROM deduped t "
        "LEFT JOIN dim_date d ON t.date IS NOT DISTINCT FROM d.date",
        "dim_date",
    ),
    "lookup_category_id": sql(
        f"SELECT t.{SOURCE_ID}, t.category_primary, c.category_id FROM deduped t LEFT JOIN "
        "dim_category c ON t.category_primary IS NOT DISTINCT FROM c.category_primary",
        "dim_category",
    ),
    # models
    "join_date": sql(
        f"SELECT transaction_id, date_id, date, {cols(DATE_PARTS)} "
        "FROM fact LEFT JOIN dim_date USING (date_id)",
        "fact",
        "dim_date",
    ),
    "join_category": sql(
        f"SELECT transaction_id, category_id, {cols(CATEGORY)} "
        "FROM fact LEFT JOIN dim_category USING (category_id)",
        "fact",
        "dim_category",
    ),
    "join_location": sql(
        f"SELECT transaction_id, location_id, {cols(LOCATION)} "
        "FROM fact LEFT JOIN dim_location USING (location_id)",
        "fact",
        "dim_location",
    ),
    "join_account": sql(
        "SELECT transaction_id, account_id, account_pk, account_owner "
        "FROM fact LEFT JOIN dim_account USING (account_id)",
        "fact",
        "dim_account",
    ),
    "mart_fact": sql(f"SELECT {cols(MART_FACT)} FROM mart_fact", "mart_fact"),
    "mart_dim_account": sql(f"SELECT {cols(DIM_ACCOUNT)} FROM dim_account", "dim_account"),
    "mart_dim_category": sql(f"SELECT {cols(DIM_CATEGORY)} FROM mart_category", "mart_category"),
    "mart_dim_date": sql(f"SELECT {cols(DIM_DATE)} FROM dim_date", "dim_date"),
    "mart_dim_location": sql(f"SELECT {cols(DIM_LOCATION)} FROM dim_location", "dim_location"),
    "analytics_view": sql(f"SELECT {cols(ANALYTICS_VIEW)} FROM analytics", "analytics"),
    # data tests
    "dq_not_null": sql(
        " UNION ALL ".join(
            null_test("raw", c, "raw")
            for c in ("transaction_id", "account_owner", "amount", "merchant_entity_id", "loc_city")
        ),
        "raw",
    ),
    "dq_unique": sql(
        " UNION ALL ".join(unique_test("raw", c, "raw") for c in ("transaction_id", "merchant_entity_id")),
        "raw",
    ),
    "dq_violations": sql(
        " UNION ALL ".join(
            f"SELECT 'raw' AS model, '{column}' AS \"column\", '{test}' AS test, "
            f"coalesce((SELECT {total} FROM {PER_KEY} WHERE {broken}), 0)::BIGINT AS violations, "
            f"coalesce((SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT min(transaction_id) AS k FROM {PER_KEY} "
            f"WHERE {broken} GROUP BY part)), '') AS sample"
            for column, test, broken, total in (
                ("transaction_id", "not_null", "transaction_id IS NULL", "sum(n)"),
                ("transaction_id", "unique", "n > 1", "count(*)"),
                ("amount", "not_null", "no_amount > 0", "sum(no_amount)"),
                ("merchant_entity_id", "not_null", "no_merchant > 0", "sum(no_merchant)"),
            )
        ),
        "raw",
    ),
    "dq_suite": sql(" UNION ALL ".join(SUITE), *VIEWS.values()),
}
