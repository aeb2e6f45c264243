"""Line-delimited GeoJSON address features, plain or gzipped, batch or stream.

One JSON document per line. Property values keep the JSON rule for "missing": null, absent, ``""``,
``0``, ``false``, ``[]`` and ``{}`` all read as SQL null, everything else as text. ``"0"`` (text) is
a value, ``0`` (number) is not, so the parser reads properties as VARIANT first.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrloom.functions.text import ColumnOrName, as_column

# The feature properties that are used, and those that must be text when used.
PROPERTIES = (
    "number", "street", "street_name", "unit", "city", "locality", "district", "region", "state",
    "postcode", "country",
)
TEXT_CHAINS = (("street", "street_name"), ("city", "locality"), ("country",))

# JSON texts that count as missing.
MISSING_JSON = ("null", '""', "0", "0.0", "-0.0", "false", "[]", "{}")

JOB_ID_PATTERN = r"([^/]+?)(?:/source)?\.geojson(?:\.gz)?$"

PIECE_BYTES = 1 << 20

_BAG = "STRUCT<" + ", ".join(f"{name}: VARIANT" for name in PROPERTIES) + ">"
_DOCUMENT = (
    f"STRUCT<type: STRING, properties: {_BAG}, features: ARRAY<STRUCT<properties: {_BAG}>>>"
)
_JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
_BLANK = r"[ \t\n\r\x0B\x0C]*"


def variant_text(value: ColumnOrName) -> Column:
    """Text of a JSON value, null where JSON counts it as missing."""
    value = as_column(value)
    json = F.to_json(value)
    whole_float = F.schema_of_variant(value).rlike(r"^DECIMAL\((\d|1[0-8]),0\)$")
    return (
        F.when(json.isNull() | json.isin(*MISSING_JSON), F.lit(None).cast("string"))
        .when(json.startswith('"'), value.cast("string"))
        .when(json == "true", F.lit("True"))
        .when(whole_float, F.concat(json, F.lit(".0")))
        .otherwise(json)
    )


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    *,
    skip_cut_files: bool = False,
    job_pattern: str = JOB_ID_PATTERN,
) -> DataFrame:
    """Raw lines with their file. A gzip file is one task; ``spread`` evens that out later.

    A broken file fails the read. ``skip_cut_files`` keeps the rows before the broken spot and goes on
    with the other files; ``cut_files`` tells which those are.
    """
    reader = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", skip_cut_files)
    return with_file_columns(reader.format("text").load(path), job_pattern).withColumn(
        "line_id", F.monotonically_increasing_id()
    )


def stream_lines(
    spark: SparkSession, path: str, *, max_files: int | None = None, skip_cut_files: bool = False
) -> DataFrame:
    """The same lines as a stream, with ``file_time``; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.option("lineSep", "\n").option("ignoreCorruptFiles", skip_cut_files)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_file_columns(
        reader.format("text").load(path), file_time=F.col("_metadata.file_modification_time")
    )


def files_of_jobs(
    spark: SparkSession, path: str | list[str], jobs: DataFrame, job_pattern: str = JOB_ID_PATTERN
) -> list[str]:
    """Files below ``path`` whose name carries a ``job_id`` of ``jobs``, without reading their content.

    The list is what Spark's own file index would hold on the driver for these files.
    """
    listed = spark.read.format("binaryFile").load(path).select("path")
    named = listed.withColumn("job_id", F.regexp_extract("path", job_pattern, 1))
    chosen = named.join(jobs.select("job_id").distinct(), "job_id", "left_semi")
    return sorted(row["path"] for row in chosen.select("path").collect())


def cut_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file_path, problem`` of the gzip files below ``path`` that end early or are broken.

    A task holds one compressed file at a time and unpacks it piece by piece.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            problems = [gzip_problem(content.as_buffer()) for content in batch.column("content")]
            found = pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(problems, pa.string())], ["file_path", "problem"]
            )
            yield found.filter(found.column("problem").is_valid())

    files = spark.read.format("binaryFile").load(path).where(F.col("path").endswith(".gz"))
    return files.select("path", "content").mapInArrow(check, "file_path string, problem string")


def gzip_problem(content: bytes | pa.Buffer) -> str | None:
    """Why gzip data cannot be read to its end, or ``None``."""
    try:
        with gzip.GzipFile(fileobj=io.BytesIO(content)) as stream:
            while stream.read(PIECE_BYTES):
                pass
    except (OSError, EOFError, zlib.error) as error:
        return str(error)
    return None


def with_file_columns(
    lines: DataFrame, job_pattern: str = JOB_ID_PATTERN, **more: Column
) -> DataFrame:
    file = F.col("_metadata.file_path")
    return lines.select(
        "value",
        F.regexp_extract(file, job_pattern, 1).alias("job_id"),
        file.alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        *[column.alias(name) for name, column in more.items()],
    )


def spread(rows: DataFrame, partitions: int | None = None, *, key: str = "line_id") -> DataFrame:
    """Even out few large unsplittable files before the parsing work.

    Without a number this only shuffles when the scan has fewer tasks than the cluster has cores, so
    a scan of many files is left alone. ``key`` is a row's position or id: a re-run task sends every
    row to the same place, and no value can gather many rows.
    """
    if partitions is None:
        cores = rows.sparkSession.sparkContext.defaultParallelism
        if rows.rdd.getNumPartitions() >= cores:
            return rows
        partitions = 2 * cores
    return rows.repartition(partitions, key)


def parse(lines: DataFrame) -> DataFrame:
    """Add ``document`` (null where the line is not one JSON object); blank lines are dropped.

    The line is parsed as the only member of an array, so text after the object is noticed.
    """
    value = F.col("value")
    trimmed = F.regexp_replace(value, f"^{_BLANK}(?:\\x1E+{_BLANK})?|{_BLANK}$", "")
    text = F.when(value.startswith("{") & value.endswith("}"), value).otherwise(trimmed)
    members = F.from_json(
        F.concat(F.lit("["), F.col("line"), F.lit("]")), f"ARRAY<{_DOCUMENT}>", _JSON_OPTIONS
    )
    framed = F.col("line").startswith("{") & F.col("line").endswith("}")
    single = framed & (F.size(F.col("members")) == 1)
    return (
        lines.withColumn("line", text)
        .where("line <> ''")
        .withColumn("members", members)
        .withColumn("document", F.when(single, F.get(F.col("members"), F.lit(0))))
        .drop("members", "value")
    )


def malformed(parsed: DataFrame) -> DataFrame:
    """Lines that could not be read as a JSON object."""
    return parsed.where("document IS NULL").drop("document")


def features(parsed: DataFrame) -> DataFrame:
    """One row per feature: file columns, ``item`` (place in its line), the properties as text.

    ``not_text`` marks rows whose street, city or country is used but is no JSON string.
    Null members of a feature collection are dropped; null properties give an empty feature.
    """
    document = F.col("document")
    collection = F.filter(document.getField("features"), lambda feature: feature.isNotNull())
    bags = (
        F.when(document.getField("type") == "Feature", F.array(document.getField("properties")))
        .when(
            document.getField("type") == "FeatureCollection", collection.getField("properties")
        )
        .when(document.getField("properties").isNotNull(), F.array(document.getField("properties")))
    )
    kept = [name for name in parsed.columns if name not in ("document", "line")]
    exploded = parsed.select(*kept, F.posexplode(bags).alias("item", "bag"))
    bag = F.col("bag")
    text = {name: variant_text(bag.getField(name)) for name in PROPERTIES}

    def chain_not_text(chain: tuple[str, ...]) -> Column:
        used = F.coalesce(*[F.when(text[n].isNotNull(), F.to_json(bag.getField(n))) for n in chain])
        return F.coalesce(~used.startswith('"'), F.lit(False))

    broken = F.lit(False)
    for chain in TEXT_CHAINS:
        broken = broken | chain_not_text(chain)
    return exploded.select(
        *kept,
        "item",
        *[column.alias(name) for name, column in text.items()],
        broken.alias("not_text"),
    )


def read_features(
    spark: SparkSession,
    path: str | list[str],
    *,
    skip_cut_files: bool = False,
    partitions: int | None = None,
    jobs: DataFrame | None = None,
    job_pattern: str = JOB_ID_PATTERN,
) -> DataFrame:
    """Features of all files below ``path``, or only of the files of ``jobs``: the others are not opened."""
    if jobs is not None:
        path = files_of_jobs(spark, path, jobs, job_pattern)
    lines = read_lines(spark, path, skip_cut_files=skip_cut_files, job_pattern=job_pattern)
    return features(parse(spread(lines, partitions)))


def stream_features(
    spark: SparkSession, path: str, *, max_files: int | None = None, skip_cut_files: bool = False
) -> DataFrame:
    return features(
        parse(stream_lines(spark, path, max_files=max_files, skip_cut_files=skip_cut_files))
    )
