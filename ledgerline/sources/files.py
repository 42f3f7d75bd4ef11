"""JSON-lines and Parquet scans, and the choice of run date."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import CORRUPT, RAW

RUN_DATE = "run_date"
#: Run dates, from the highest down, whose files are looked at for the newest delivery.
DELIVERY_DAYS = 31


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType = RAW, keep_corrupt: bool = False
) -> DataFrame:
    """Scan JSON lines with a fixed schema: one pass, and unlisted fields are skipped.

    With ``keep_corrupt`` a broken line becomes a row with its text in
    ``_corrupt_record``; without it such a row has NULL in every field.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_parts(
    spark: SparkSession, *paths: str, schema: T.StructType | None = None
) -> DataFrame:
    """All part files below the paths in one parallel scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_run_date(
    spark: SparkSession, stage: str, day: datetime.date | str, schema: T.StructType | None = None
) -> DataFrame:
    """One day of a stage written by ``run_date``; other days are pruned unread."""
    return read_parts(spark, stage, schema=schema).where(
        F.col(RUN_DATE) == F.lit(str(day)).cast("date")
    )


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the path as it takes it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def folders(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Folders that match a glob pattern, with their modification times."""
    system, where = file_system(spark, pattern)
    found = system.globStatus(where)
    return [(f.getPath().toString(), f.getModificationTime()) for f in found or [] if f.isDirectory()]


def run_dates(spark: SparkSession, stage: str) -> list[str]:
    """Run dates below ``stage`` in order. Only their folders are listed, none of the files."""
    dated = f"{stage}/{RUN_DATE}=[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
    return sorted(path.rsplit("=", 1)[1] for path, _ in folders(spark, dated))


def latest_run_date(spark: SparkSession, stage: str) -> datetime.date:
    """Highest run date below ``stage``, whenever it was delivered."""
    dates = run_dates(spark, stage)
    if not dates:
        raise FileNotFoundError(f"no extract below {stage}")
    return datetime.date.fromisoformat(dates[-1])


def deliveries(spark: SparkSession, stage: str, last: int = DELIVERY_DAYS) -> DataFrame:
    """``run_date``, ``delivered`` (time of its newest file), ``n_files`` and ``n_bytes`` of the
    highest ``last`` run dates below ``stage``. Files are listed, not opened; hidden ones and
    the markers of writers do not count, and a folder without files is no delivery."""
    paths = [f"{stage}/{RUN_DATE}={day}" for day in run_dates(spark, stage)[-last:]]
    if not paths:
        raise FileNotFoundError(f"no extract below {stage}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    day = F.regexp_extract("path", f"/{RUN_DATE}=([0-9-]{{10}})/", 1).cast("date")
    return files.groupBy(day.alias(RUN_DATE)).agg(
        F.max("modificationTime").alias("delivered"),
        F.count("*").alias("n_files"),
        F.sum("length").alias("n_bytes"),
    )


def newest_delivery(
    spark: SparkSession, stage: str, last: int = DELIVERY_DAYS
) -> datetime.date:
    """Run date that was delivered last, the higher one of two at the same time.

    A day that is delivered again is the newest then, if it is among the highest ``last``
    run dates; files of older ones are not looked at."""
    newest = deliveries(spark, stage, last).agg(F.max(F.struct("delivered", RUN_DATE)).alias("m"))
    found = newest.select(f"m.{RUN_DATE}").first()[0]
    if found is None:
        raise FileNotFoundError(f"no files in the extracts below {stage}")
    return found


def latest_extract(spark: SparkSession, stage: str, schema: T.StructType = RAW) -> DataFrame:
    """Records of the extract that was delivered last."""
    return read_jsonl(spark, f"{stage}/{RUN_DATE}={newest_delivery(spark, stage)}", schema)


def spread(df: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """Deal a scan into ``partitions``, if the caller names a number; else leave it.

    For small tables in a single file, which would be one task.
    """
    return df.repartition(partitions, *keys) if partitions else df
