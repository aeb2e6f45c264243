"""The job manifest: which feature files exist and which place each one covers."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.functions.text import null_if_empty
from addrloom.sources.geojson import variant_text

log = logging.getLogger(__name__)

# Default layer, and the job count from which a run without a limit is reported.
DEFAULT_LAYER = "addresses"
MANY_JOBS = 500

ENTRY = "STRUCT<job: VARIANT, source: VARIANT, layer: STRING>"


def manifest_entries(spark: SparkSession, path: str) -> DataFrame:
    """``(entry, position)`` of every entry of manifest files, in any JSON layout.

    A file is one array, one object, or one object per line; arrays and objects may be indented. A
    manifest file is read as one text, its entries are counted within it, and ``position`` is the file
    with that number, so the order is the manifest's and not that of the scan. A line that is no
    JSON object is left out.
    """
    files = spark.read.format("text").option("wholetext", True).load(path)
    text = F.trim(F.regexp_replace("value", r"^\x{FEFF}|^\s+|\s+$", ""))
    lines = F.filter(F.split("text", r"\r?\n"), lambda line: F.trim(line) != "")
    array = F.from_json("text", f"ARRAY<{ENTRY}>")
    single = F.from_json(F.concat(F.lit("["), F.col("text"), F.lit("]")), f"ARRAY<{ENTRY}>")
    each = F.transform("lines", lambda line: F.from_json(line, ENTRY))
    # An object that is complete before the last line is one of several, one per line.
    indented = (F.size("lines") > 1) & ~F.trim(F.get("lines", F.lit(0))).endswith("}")
    entries = (
        F.when(F.col("text").startswith("["), array).when(indented, single).otherwise(each)
    )
    return (
        files.select(F.col("_metadata.file_path").alias("file"), text.alias("text"))
        .withColumn("lines", lines)
        .select("file", F.posexplode(entries).alias("nth", "entry"))
        .where("entry IS NOT NULL")
        .select("entry", F.struct("file", "nth").alias("position"))
    )


def read_manifest(
    spark: SparkSession,
    path: str,
    *,
    source: str | None = None,
    layer: str | None = DEFAULT_LAYER,
    jobs_limit: int | None = None,
) -> DataFrame:
    """``(job_id, source_name, position)`` of the wanted jobs; entries without job or source drop.

    ``source`` selects one place (``us/ca``) and everything below it.
    """
    entries = manifest_entries(spark, path)
    jobs = entries.select(
        variant_text("entry.job").alias("job_id"),
        variant_text("entry.source").alias("source_name"),
        F.col("entry.layer").alias("layer"),
        "position",
    ).where("job_id IS NOT NULL AND source_name IS NOT NULL")
    if layer is not None:
        jobs = jobs.where(F.col("layer") == layer)
    if source is not None:
        name = F.col("source_name")
        jobs = jobs.where((name == source) | name.startswith(source.rstrip("/") + "/"))
    return limit_jobs(jobs.select("job_id", "source_name", "position"), jobs_limit)


def limit_jobs(
    jobs: DataFrame, jobs_limit: int | None, *, position: str = "position"
) -> DataFrame:
    """The first jobs in manifest order; ``None`` keeps all, ``0`` none."""
    return jobs if jobs_limit is None else jobs.orderBy(position).limit(jobs_limit)


def count_jobs(jobs: DataFrame, jobs_limit: int | None = None) -> int:
    """Number of selected jobs; a long unlimited run is reported."""
    count = jobs.count()
    if jobs_limit is None and count > MANY_JOBS:
        log.warning("%d jobs selected without a limit, this may take long", count)
    return count


def split_source_name(jobs: DataFrame) -> DataFrame:
    """Add ``job_country, job_region, job_city``; names without exactly three parts drop."""
    parts = F.split("source_name", "/")
    named = jobs.withColumn("_parts", parts).where(F.size("_parts") == 3)
    return named.select(
        *jobs.columns,
        *[
            F.get("_parts", F.lit(i)).alias(name)
            for i, name in enumerate(("job_country", "job_region", "job_city"))
        ],
    )


def rejected_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs whose name has not exactly three parts; their features are not read."""
    return jobs.where(F.size(F.split("source_name", "/")) != 3)


def city_from_job(job_city: str = "job_city"):
    """Readable city of a job name: ``city_of_san_diego`` gives ``san diego``."""
    plain = F.replace(F.col(job_city), F.lit("city_of_"), F.lit(""))
    return null_if_empty(F.replace(plain, F.lit("_"), F.lit(" ")))
