"""File sinks. Executors write straight to any Hadoop file system."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import shared_dir
from ledgerline.sources.files import RUN_DATE, file_system


#: Feeds are text with every key in every line, so they are packed, the fast way. A packed file is
#: read by one task from its start, so none holds more than so many lines.
FEED_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "200000"}


#: Spark's own switch: a job that ends leaves no shuffle files behind.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs within delete their shuffle files as they end, unless the session's owner chose otherwise.

    For jobs that write: who needs the result reads the files. Else shuffles stay until the driver
    happens to collect garbage, and the disk holds those of all steps of a run at once.
    """
    chosen = spark.sparkContext.getConf().contains(FREED) or spark.conf.get(FREED) == "true"
    if not chosen:
        spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if not chosen:
            spark.conf.unset(FREED)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object per line; missing values are written as explicit nulls."""
    packed = {**FEED_FILES, "zlib.compress.level": "DEFAULT_COMPRESSION"}  # a third smaller for whole records
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").options(**packed).option("ignoreNullFields", "false").json(path)


def write_lines(df: DataFrame, path: str) -> None:
    """Lines of text (one column) as they are."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").options(**FEED_FILES).text(path)


#: Tables hold many digests and ids, which the default codec leaves as long as they are.
CODEC = "zstd"


def write_parquet(df: DataFrame, path: str) -> None:
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def write_run_dates(df: DataFrame, stage: str) -> None:
    """Replace the run dates present in ``df``; keep every other date of the stage.

    Writing the same data twice leaves the stage as it was after the first time.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RUN_DATE)
        .parquet(stage)
    )


def write_run_date(df: DataFrame, stage: str, day: datetime.date | str) -> None:
    write_run_dates(df.withColumn(RUN_DATE, F.lit(str(day)).cast("date")), stage)


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/ledgerline/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is below it; nothing happens if it does not exist."""
    system, where = file_system(spark, path)
    system.delete(where, True)


class Stage:
    """Cuts a plan where its result feeds several outputs.

    ``save`` writes the frame as Parquet to the shared folder and reads it back.
    The work behind it then runs once, the readers prune columns, a lost executor
    costs no recomputation, and the planner knows the true size of what it joins.
    Whoever makes a stage calls ``remove`` once nothing reads it any more.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or new_folder(spark, "stage")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        write_parquet(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_all(self, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Save small frames at the same time: their jobs share the executors.

        The threads inherit the job group and tags of the caller.
        """
        saved: dict[str, DataFrame] = {}
        failed: list[Exception] = []

        def keep(name: str) -> None:
            try:
                saved[name] = self.save(frames[name], name)
            except Exception as error:
                failed.append(error)

        threads = [InheritableThread(keep, args=(name,), session=self.spark) for name in frames]
        with shuffles_freed(self.spark):
            for thread in threads:
                thread.start()
            for thread in threads:
                thread.join()
        if failed:
            raise failed[0]
        return {name: saved[name] for name in frames}

    def drop(self, *names: str) -> None:
        """Delete saved frames that nothing reads any more."""
        for name in names:
            remove_folder(self.spark, f"{self.folder}/{name}")

    def remove(self) -> None:
        remove_folder(self.spark, self.folder)
