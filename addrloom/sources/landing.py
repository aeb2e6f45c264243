"""Incremental landing: which files are new since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_COLUMNS = ("path", "length", "modificationTime")


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below ``path`` without their content: column pruning keeps it unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.option("pathGlobFilter", pattern).load(path).select(*FILE_COLUMNS)


def new_files(found: DataFrame, ingest_log: DataFrame) -> DataFrame:
    """Found files that the log does not name yet."""
    return found.join(ingest_log.select("path").distinct(), "path", "left_anti")


def log_entries(found: DataFrame, ingest_log: DataFrame) -> DataFrame:
    """All found files with ``skipped``: a known file is reported with its size, not read again."""
    known = ingest_log.select("path", F.lit(True).alias("known")).distinct()
    return found.join(known, "path", "left").select(
        *FILE_COLUMNS, F.coalesce("known", F.lit(False)).alias("skipped")
    )


def record_ingested(new: DataFrame, log_path: str) -> None:
    new.select(*FILE_COLUMNS).write.mode("append").parquet(log_path)
