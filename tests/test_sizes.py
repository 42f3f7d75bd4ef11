"""What the jobs write, move and open."""

import time
from pathlib import Path
from types import SimpleNamespace

from pyspark.sql import functions as F

from ledgerline.sinks import files as sinks
from ledgerline.sources.files import read_jsonl
from ledgerline.workload.records import nested, nested_full, records


def test_feeds_are_packed(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setitem(sinks.FEED_FILES, "maxRecordsPerFile", "1000")
    feed = nested_full(records(spark, sf_dir)).coalesce(1)
    sinks.write_jsonl(feed, f"{tmp_path}/feed")
    files = [f for f in Path(f"{tmp_path}/feed").iterdir() if f.name.startswith("part-")]
    lines = spark.read.text(f"{tmp_path}/feed")
    n_chars = lines.selectExpr("sum(length(value))").first()[0]
    assert n_chars > 5 * sum(f.stat().st_size for f in files)
    assert len(files) == -(-feed.count() // 1000) == len(lines.inputFiles())
    back, raw = read_jsonl(spark, f"{tmp_path}/feed"), nested(records(spark, sf_dir))
    ids = [df.selectExpr("sum(cast(xxhash64(transaction_id, amount, name) AS decimal(38, 0)))").first()[0] for df in (back, raw)]
    assert ids[0] == ids[1]


def test_drift_feed_is_packed(spark, sf_dir, monkeypatch):
    from ledgerline.workload import queries

    folders = []
    monkeypatch.setattr(sinks, "new_folder", lambda s, name, make=sinks.new_folder: folders.append(make(s, name)) or folders[-1])
    queries.schema_drift(spark, sf_dir)
    files = [f for f in Path(folders[0]).iterdir() if f.name.startswith("part-")]
    n_chars = spark.read.text(folders[0]).selectExpr("sum(length(value))").first()[0]
    assert n_chars > 5 * sum(f.stat().st_size for f in files)


def test_plans_settle_a_foreign_session(spark):
    """Settings that the plans rely on reach a session that others made, but not over their choice."""
    from ledgerline.session import PLAN_SETTINGS, settle

    for key in PLAN_SETTINGS:
        spark.conf.set(key, "true" if key.endswith("CoPartition") else "64m")
    none_chosen = SimpleNamespace(getConf=lambda: SimpleNamespace(contains=lambda key: False))
    settle(SimpleNamespace(conf=spark.conf, sparkContext=none_chosen))
    assert {k: spark.conf.get(k) for k in PLAN_SETTINGS} == PLAN_SETTINGS
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    settle(spark)  # this one was built with a choice of its own
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "64m"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")


def test_stage_sorts_by_numbers_and_packs_digests(spark, sf_dir):
    """The rows are sorted by the hash of their id first; tables are written with zstd."""
    from ledgerline.plans import star
    from ledgerline.workload import queries

    stage, plans = sinks.Stage(spark), {}
    save = stage.save
    stage.save = lambda df, name: (plans.update({name: df}), save(df, name))[1]
    star.ranked_transactions(queries.flat(spark, sf_dir), stage)
    plan = plans["unique"]._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [_key" in line]
    assert sorts and all("_id" in line for line in sorts)
    files = [f for f in Path(f"{stage.folder}/unique").iterdir() if f.name.startswith("part-")]
    assert files and all(".zstd." in f.name for f in files)
    stage.remove()


def test_buckets_follow_the_rows(spark, sf_dir):
    """Small tables are not cut into a file per month and shuffle partition."""
    from ledgerline.plans import star
    from ledgerline.schemas import SOURCE_ID
    from ledgerline.sinks import tables as catalog
    from ledgerline.workload import queries

    cores = spark.sparkContext.defaultParallelism
    flat = queries.flat(spark, sf_dir).where("date BETWEEN '1998-03-01' AND '1998-03-31'")
    built = star.build_star(flat, sinks.Stage(spark), partitioned=True)
    database = queries.scratch_database(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert [catalog.bucket_count(spark, n) for n in (0, 10_000_001, 10**9)] == [min(cores, 40), 21, 40]
        names = catalog.load_tables(built, database).names
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for table in ("fact_transactions", "dim_location"):
        assert len(spark.table(names[table]).inputFiles()) <= cores
        assert spark.table(names[table]).count() == flat.select(SOURCE_ID).distinct().count()


def test_dimensions_read_the_rows_once(spark, sf_dir):
    from ledgerline.plans import star
    from ledgerline.workload import queries

    unique, stage = queries.ranked(spark, sf_dir)
    for build in (star.dim_account, star.dim_category, lambda df: star.dim_category(df, grain="full"), star.dim_date):
        dim = build(unique)
        dim.collect()
        plan = dim._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    stage.remove()


def test_whole_records_are_packed_tighter_than_fast(spark, sf_dir, tmp_path):
    feed = nested_full(records(spark, sf_dir)).coalesce(1)
    sinks.write_jsonl(feed, f"{tmp_path}/feed")
    feed.write.options(**sinks.FEED_FILES).option("ignoreNullFields", "false").json(f"{tmp_path}/fast")
    tight, fast = (sum(f.stat().st_size for f in Path(f"{tmp_path}/{name}").glob("part-*")) for name in ("feed", "fast"))
    assert tight < 0.8 * fast
    assert spark.read.text(f"{tmp_path}/feed").exceptAll(spark.read.text(f"{tmp_path}/fast")).isEmpty()


def test_rows_carry_their_id_once(spark, sf_dir):
    from ledgerline.plans import star
    from ledgerline.schemas import DATE_PARTS, LOCATION, SOURCE_ID
    from ledgerline.workload import queries

    stage, plans = sinks.Stage(spark), {}
    save = stage.save
    stage.save = lambda df, name: (plans.update({name: df}), save(df, name))[1]
    flat = queries.flat(spark, sf_dir)
    unique = star.ranked_transactions(flat, stage)
    plan = plans["unique"]._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [_key" in line and LOCATION[0] in line]
    assert sorts and not any(SOURCE_ID in line for line in sorts)
    assert unique.columns == [*[c for c in flat.columns if c not in DATE_PARTS], "location_id"]
    stage.remove()


def test_transformed_lines_are_not_sorted(spark, sf_dir, tmp_path):
    """Broken lines have no folder of their own, by which all rows would be sorted (and spilled)."""
    from ledgerline.plans import batch
    from ledgerline.schemas import ACCOUNT_OWNERS

    (tmp_path / "feed").mkdir()
    lines = ['{"transaction_id": "a", "amount": 1.5}', "{broken", '{"transaction_id": "b"}']
    (tmp_path / "feed" / "a.json").write_text("\n".join(lines) + "\n")
    raw = read_jsonl(spark, f"{tmp_path}/feed", keep_corrupt=True)
    sound, counts = batch.write_transformed(raw, ACCOUNT_OWNERS, f"{tmp_path}/flat", f"{tmp_path}/rejected")
    assert not [f for f in Path(f"{tmp_path}/flat").iterdir() if f.is_dir()]
    assert counts == {"read": 3, "rejected": 1, "transformed": 2} and sound.count() == 2
    assert [r.line for r in spark.read.parquet(f"{tmp_path}/rejected").collect()] == ["{broken"]


def shuffle_files(spark) -> int:
    """Files of shuffles that the local session holds at the moment."""
    jvm = spark.sparkContext._jvm
    folders = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(1 for folder in folders for _ in Path(folder).rglob("shuffle_*.data"))


def test_written_frames_leave_no_shuffles_behind(spark, sf_dir, tmp_path):
    from ledgerline.plans import quality
    from ledgerline.workload import queries

    def freed(build) -> bool:
        """Whether the shuffles of what ``build`` does are gone soon after it (they go in the background)."""
        held = shuffle_files(spark)
        result = build()
        deadline = time.time() + 20
        while shuffle_files(spark) > held and time.time() < deadline:
            time.sleep(0.1)
        assert result is not None
        return shuffle_files(spark) <= held

    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert not freed(lambda: (counts.write.parquet(f"{tmp_path}/plain"), 1))
    assert freed(lambda: sinks.Stage(spark).save(counts, "counts"))
    assert freed(lambda: sinks.Stage(spark).save_all({"a": counts, "b": counts}))
    assert freed(lambda: (sinks.write_jsonl(counts, f"{tmp_path}/feed"), 1))
    assert freed(lambda: (quality.require_clean(quality.suite({"m": counts}, {"m": {"k": ["unique"]}})), 1))
    assert spark.conf.get(sinks.FREED) == "false"
    unique, stage = queries.ranked(spark, sf_dir)
    assert not Path(f"{stage.folder}/transform").exists() and unique.count() == unique.select("location_id").distinct().count()
    stage.remove()


def test_star_is_built_from_written_rows(spark, sf_dir, monkeypatch):
    """The rows of the star come from files, so no shuffle of the transform is held while they move."""
    from ledgerline.plans import star
    from ledgerline.workload import queries

    seen, build = [], star.build_star
    monkeypatch.setattr(star, "build_star", lambda flat, *args, **more: (seen.append(flat), build(flat, *args, **more))[1])
    fact = queries.tables(spark, sf_dir)["fact_transactions"]
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and fact.select("location_id").distinct().count() == fact.count()


def test_filled_ids_stay_behind(spark, sf_dir):
    """Ids made of the transaction id are neither moved nor written with the rows, and all come back."""
    from ledgerline.operators.dedupe import dedupe
    from ledgerline.plans import star
    from ledgerline.schemas import DATE_PARTS, FILLED_IDS, SOURCE_ID
    from ledgerline.workload import queries

    stage = sinks.Stage(spark)
    flat = stage.save(queries.flat(spark, sf_dir), "flat")
    # Rows of one id whose merchants come before, at and after the stand-in, and one without any.
    first = flat.orderBy(SOURCE_ID).limit(40)
    odd = [F.lit(""), F.lit("~"), F.concat("address", F.lit("x")), F.lit(None).cast("string")]
    for i, value in enumerate(odd):
        changed = first.where(F.pmod(F.crc32(SOURCE_ID), F.lit(5)) >= i)
        flat = flat.union(changed.withColumns({c: value for c in FILLED_IDS}).withColumn("lat", F.lit(1.0)))
    flat = stage.save(flat, "odd").repartition(3)
    unique = star.ranked_transactions(flat, stage)
    kept = [c for c in flat.columns if c not in DATE_PARTS]
    want = dedupe(flat.select(*kept), SOURCE_ID)
    assert unique.drop("location_id").exceptAll(want).isEmpty() and unique.count() == want.count()
    written = spark.read.parquet(f"{stage.folder}/unique")
    made = F.col("address").rlike("^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$")
    assert want.where(made).count() > 1000 and written.where(made).isEmpty()
    stage.remove()
