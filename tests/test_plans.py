"""Composite jobs: transform, star, models, data tests, storage and the batch run."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import rules
from ledgerline.plans import batch, marts, quality, star
from ledgerline.plans.transform import transform
from ledgerline.schemas import (
    ACCOUNT_OWNERS,
    ANALYTICS_VIEW,
    CORRUPT,
    DIM_LOCATION,
    FACT,
    MART_FACT,
    PARTITIONS,
    SOURCE_ID,
    STAR_TABLES,
    TRANSFORMED,
)
from ledgerline.sinks import journal, published
from ledgerline.sinks import tables as catalog
from ledgerline.sinks.files import Stage, new_folder, write_jsonl
from ledgerline.sources.files import latest_run_date, read_jsonl, spread
from ledgerline.workload.records import nested_full, owners, records

DAY = "2001-08-01"


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return nested_full(records(spark, sf_dir))


@pytest.fixture(scope="module")
def flat(spark, sf_dir, raw):
    return Stage(spark).save(transform(raw, owners(spark, sf_dir)), "flat")


@pytest.fixture(scope="module")
def built(spark, flat):
    return star.build_star(flat, Stage(spark))


def test_transform_keeps_every_record(raw, flat):
    assert flat.columns == TRANSFORMED
    assert flat.count() == raw.count()
    filled = ["merchant_entity_id", "address", "city", "postal_code", "lat", "lon", "store_number"]
    assert flat.where(" OR ".join(f"{c} IS NULL" for c in [*filled, "region", "country"])).count() == 0


def test_transform_stays_map_only_and_compiled(spark, sf_dir, raw, tmp_path):
    """No shuffle for a literal owner list, and a method small enough to compile."""
    path = f"{tmp_path}/raw"
    write_jsonl(raw, path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        flat = transform(read_jsonl(spark, path))
        plan = flat._jdf.queryExecution().executedPlan()
        assert "Exchange" not in plan.toString()
        debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
        code = getattr(debug, "MODULE$").codegenString(plan)
        sizes = [int(part.split(";")[0]) for part in code.split("maxMethodCodeSize:")[1:]]
        assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rerun_gives_the_same_tables(spark, flat, built):
    again = star.build_star(flat.repartition(5), Stage(spark))
    for table in STAR_TABLES:
        assert built[table].exceptAll(again[table]).count() == 0
        assert again[table].exceptAll(built[table]).count() == 0


def test_star_keys_resolve(built, flat):
    fact = built["fact_transactions"]
    n = flat.select(SOURCE_ID).distinct().count()
    assert fact.columns == FACT and fact.count() == n
    assert built["dim_location"].columns == DIM_LOCATION
    for table, key in [("dim_location", "location_id"), ("dim_date", "date_id"), ("dim_category", "category_id")]:
        dim = built[table]
        low, high, rows, used = dim.agg(
            F.min(key), F.max(key), F.count("*"), F.count_distinct(key)
        ).first()
        assert (low, high, used) == (1, rows, rows)
        assert fact.join(dim, key, "left_anti").count() == 0


def test_full_category_grain(spark, flat):
    full = star.build_star(flat, Stage(spark), grain="full")
    fact, dim = full["fact_transactions"], full["dim_category"]
    assert dim.count() > 6 and fact.count() == flat.select(SOURCE_ID).distinct().count()
    assert fact.where("category_id IS NULL").count() == 0


def test_models_keep_the_row_count(spark, built):
    n = built["fact_transactions"].count()
    fact, view = marts.mart_fact(built, DAY), marts.analytics_view(built, DAY)
    assert fact.columns == MART_FACT and fact.count() == n
    assert view.columns == ANALYTICS_VIEW and view.count() == n
    two = built["dim_account"].withColumn("account_owner", F.lit("second")).withColumn(
        "account_pk", F.col("account_pk") + 10_000_000
    )
    doubled = {**built, "dim_account": built["dim_account"].unionByName(two)}
    assert marts.analytics_view(doubled, DAY).count() == n


def test_suite_is_clean_and_finds_planted_faults(spark, built):
    models = marts.models(built, DAY)
    report = quality.suite(models)
    assert report.count() == 12
    quality.require_clean(report)
    dates = models["dim_date"]
    bad = dates.unionByName(dates).unionByName(dates.withColumn("date_id", F.lit(None).cast("bigint")))
    found = {
        (r.model, r.column, r.test): r.violations
        for r in quality.suite({**models, "dim_date": bad}).where("violations > 0").collect()
    }
    n = dates.count()
    assert found == {
        ("dim_date", "date_id", "not_null"): n,
        ("dim_date", "date_id", "unique"): n,
    }
    with pytest.raises(quality.DataTestError, match="dim_date.date_id"):
        quality.require_clean(quality.suite({**models, "dim_date": bad}))


def test_broken_line_keeps_its_text(spark, tmp_path):
    path = tmp_path / "lines"
    path.mkdir()
    good = {"transaction_id": "1", "amount": 2.5, "location": {"lat": 1.5}, "website": "ignored"}
    (path / "a.jsonl").write_text(json.dumps(good) + "\n{broken\n")
    rows = read_jsonl(spark, str(path), keep_corrupt=True).cache()
    assert rows.where(F.col(CORRUPT).isNotNull()).first()[CORRUPT] == "{broken"
    kept = rows.where(F.col(CORRUPT).isNull()).first()
    assert (kept.transaction_id, kept.amount, kept.location.lat) == ("1", 2.5, "1.5")


def test_views_over_bucketed_tables_join_without_a_shuffle(spark, flat, built):
    """Fact and location dimension are both large: neither moves when joined."""
    partitioned = star.build_star(flat, Stage(spark), partitioned=True)
    name = "ledger_bucketed"
    catalog.create_database(spark, name, new_folder(spark, name))
    loaded = catalog.load_tables(partitioned, name, "__1", buckets=2)
    names = loaded.names
    assert loaded.counts == {table: built[table].count() for table in STAR_TABLES}
    published.point_to(spark, name, "1", DAY)
    published.show_runs(spark, name, {"1": names})
    published.create_tables(spark, name)
    marts.create_models(spark, name, f"{name}_marts")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        # The plain join, and the one that the views make.
        for key in (["location_id"], ["location_id", *PARTITIONS]):
            joined = spark.table(names["fact_transactions"]).join(
                spark.table(names["dim_location"]), key, "left"
            )
            joined.write.format("noop").mode("overwrite").save()
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in keys:
            spark.conf.unset(key)
    view = spark.table(f"{name}_marts.analytics_view")
    assert view.columns == ANALYTICS_VIEW
    want = marts.analytics_view(built, DAY)
    assert view.exceptAll(want).count() == 0 and view.count() == want.count()


def test_truncate_tolerates_missing_tables(spark, built):
    name = "ledger_truncate"
    catalog.create_database(spark, name, new_folder(spark, name))
    built["dim_date"].write.saveAsTable(f"{name}.dim_date")
    done = catalog.truncate_tables(spark, name)
    assert done == {t: t == "dim_date" for t in STAR_TABLES}
    assert spark.table(f"{name}.dim_date").count() == 0


def test_scan_is_dealt_out_only_on_request(spark, sf_dir):
    scan = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert spread(scan, None, "l_orderkey") is scan
    assert "REPARTITION_BY_NUM" in spread(scan, 5, "l_orderkey")._jdf.queryExecution().toString()


def test_full_rows_move_once_in_the_star_build(spark, flat):
    """One exchange carries the columns of the transactions; ids are ranked by themselves."""
    plans = []
    stage = Stage(spark)
    save = stage.save
    stage.save = lambda df, name: (plans.append((name, df)), save(df, name))[1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star.ranked_transactions(flat, stage)
        plan = dict(plans)["unique"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One for the rows (to remove duplicates, and as they then lie, to join), one for the ids.
    assert plan.count("Exchange hashpartitioning(_key") == 2
    assert "SortMergeJoin" in plan and SOURCE_ID not in plan.split("hashpartitioning(")[1].split(")")[0]


def test_run_dates_are_listed_without_their_files(spark, tmp_path):
    for day in ("2001-08-02", "2001-08-10", "2001-08-01"):
        (tmp_path / f"run_date={day}").mkdir()
    (tmp_path / "run_date=2001-08-01" / "late.jsonl").write_text("{}")
    assert str(latest_run_date(spark, str(tmp_path))) == "2001-08-10"
    with pytest.raises(FileNotFoundError):
        latest_run_date(spark, str(tmp_path / "none"))
    backfill = read_jsonl(spark, f"{tmp_path}/run_date=2001-08-01")
    assert backfill.count() == 1


def test_apostrophes_in_labels(spark, monkeypatch):
    monkeypatch.setattr(rules, "COUNTRY_NAMES", {"CI": "Cote d'Ivoire", "X": "a\\b"})
    sql = rules.country_name("c")
    rows = spark.sql("SELECT * FROM VALUES ('CI'), ('X'), ('Y') AS t(c)").selectExpr(f"{sql} AS n").collect()
    assert [r.n for r in rows] == ["Cote d'Ivoire", "a\\b", "Y"]


@pytest.fixture()
def extracts(raw, tmp_path):
    stage = f"{tmp_path}/extract"
    for day in ("2001-07-31", DAY):
        write_jsonl(raw, f"{stage}/run_date={day}")
    return stage


def test_batch_run(spark, sf_dir, extracts, tmp_path, flat):
    assert str(latest_run_date(spark, extracts)) == DAY
    out, args = f"{tmp_path}/out", {"database": "ledger_run", "models_database": "ledger_run_marts"}
    people = owners(spark, sf_dir)
    first = batch.run(spark, extracts, out, owners=people, as_of=DAY, **args)
    counts = {r.stage: r.n_rows for r in first.counts.collect()}
    unique = flat.select(SOURCE_ID).distinct().count()
    assert counts["read"] == counts["transformed"] == flat.count()
    assert counts["fact_transactions"] == counts["dim_location"] == unique
    view = spark.table("ledger_run_marts.analytics_view")
    rows = sorted(view.collect(), key=repr)
    assert len(rows) == unique
    want = marts.analytics_view(star.build_star(flat, Stage(spark)), DAY)
    assert rows == sorted(want.collect(), key=repr)

    for _ in range(2):
        batch.run(spark, extracts, out, owners=people, as_of=DAY, buckets=3, **args)
        assert sorted(spark.table("ledger_run_marts.analytics_view").collect(), key=repr) == rows
    # Only the last run is left, and everything of it lies below ``out``.
    assert len(batch.runs(spark, out)) == 1 and len(journal.entries(spark, out)) == 3
    stored = [t.name for t in spark.catalog.listTables("ledger_run") if t.tableType == "MANAGED"]
    assert len(stored) == len(STAR_TABLES)
    for name in stored:
        detail = spark.sql(f"DESCRIBE EXTENDED ledger_run.{name}").where("col_name = 'Location'").first()
        assert f"{out}/tables" in detail.data_type
    load = next((tmp_path / "out" / "load" / f"run_date={DAY}").iterdir())
    assert set(STAR_TABLES) <= {p.name for p in load.iterdir()}


def test_a_run_keeps_dumps_but_no_steps(spark, extracts, tmp_path):
    """What only led to the dumps is deleted before the tables are loaded from them."""
    batch.run(spark, extracts, f"{tmp_path}/out", database="ledger_lean", models_database="ledger_lean_marts", as_of=DAY, buckets=1)
    load = next((tmp_path / "out" / "load" / f"run_date={DAY}").iterdir())
    assert {p.name for p in load.iterdir()} == set(STAR_TABLES)


def test_broken_lines_are_kept_and_counted(spark, sf_dir, extracts, tmp_path, flat):
    (tmp_path / "extract" / f"run_date={DAY}" / "broken.json").write_text('{broken\n{"transaction_id": 1, "amount": "x"}\n')
    out, args = f"{tmp_path}/out", {"database": "ledger_broken", "models_database": "ledger_broken_marts"}
    done = batch.run(spark, extracts, out, owners=owners(spark, sf_dir), as_of=DAY, **args)
    counts = {r.stage: r.n_rows for r in done.counts.collect()}
    assert counts["rejected"] == 2 and counts["read"] == counts["transformed"] + 2 == flat.count() + 2
    lines = spark.read.parquet(f"{out}/rejected").select("line").collect()
    assert sorted(r.line for r in lines) == ['{"transaction_id": 1, "amount": "x"}', "{broken"]
    assert spark.table("ledger_broken_marts.fact_transactions").count() == counts["fact_transactions"]


def test_failed_run_leaves_the_published_views(spark, extracts, tmp_path, sf_dir, raw):
    args = {"database": "ledger_fail", "models_database": "ledger_fail_marts", "as_of": DAY}
    batch.run(spark, extracts, f"{tmp_path}/out", owners=owners(spark, sf_dir), **args)
    before = spark.table("ledger_fail_marts.fact_transactions").count()
    bad = raw.withColumn("account_id", F.lit(None).cast("string"))
    write_jsonl(bad, f"{extracts}/run_date=2001-08-02")
    with pytest.raises(quality.DataTestError, match="account_id not_null"):
        batch.run(spark, extracts, f"{tmp_path}/out", owners=ACCOUNT_OWNERS, **args)
    assert len(batch.runs(spark, f"{tmp_path}/out")) == 1
    assert not any("2001_08_02" in t.name for t in spark.catalog.listTables("ledger_fail"))
    table = spark.table("ledger_fail_marts.fact_transactions")
    assert table.count() == before and table.where("account_id IS NULL").count() == 0
