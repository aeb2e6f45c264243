"""Sinks and table upkeep: CSV, staging, insert-if-absent, layouts, name-aligned loads."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrloom.functions.text import ColumnOrName, as_column
from addrloom.functions.tokens import tokens

# Output column, bucket count and column order of the address table.
OUTPUT_COLUMN = "address_norm"
ADDRESS_BUCKETS = 64
ADDRESS_COLUMNS = (
    "uuid", "country_code", "postal_code", "admin_area_1", "admin_area_2", "locality",
    "dependent_locality", "thoroughfare", "premise", "sub_premise", "address_norm",
    "search_vector",
)
ADDRESS_SCHEMA = ", ".join(
    f"{name} {'ARRAY<STRING>' if name == 'search_vector' else 'STRING'}" for name in ADDRESS_COLUMNS
)

Sink = Callable[[DataFrame], None]


# --- output -----------------------------------------------------------------------------------


def output_rows(records: DataFrame) -> DataFrame:
    """The one output column: the canonical string."""
    return records.select(OUTPUT_COLUMN)


def write_csv(rows: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Gzip CSV parts with header, CRLF line ends, quotes only where needed and doubled inside."""
    (
        rows.write.mode(mode)
        .option("header", True)
        .option("compression", "gzip")
        .option("quote", '"')
        .option("escape", '"')
        .option("lineSep", "\r\n")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: str = f"{OUTPUT_COLUMN} STRING") -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    return reader.option("lineSep", "\r\n").csv(path)


def write_one(spark: SparkSession, address_norm: str, path: str) -> None:
    """Append a single canonical string to a CSV folder."""
    row = spark.createDataFrame([(address_norm,)], f"{OUTPUT_COLUMN} STRING")
    write_csv(row, path, mode="append")


def sink_for(*, csv_path: str | None = None, table_path: str | None = None) -> Sink:
    """Choose the sink: a CSV path wins over a table; one of them must be given."""
    if csv_path:
        return lambda records: write_csv(output_rows(records), csv_path)
    if table_path:
        return partial(load_addresses, table_path=table_path)
    raise ValueError("give a CSV path or a table path")


# --- address table ----------------------------------------------------------------------------


def stable_uuid(key: ColumnOrName) -> Column:
    """UUID-shaped digest of a key: re-run tasks give the same value, equal keys the same id."""
    digest = F.sha2(as_column(key), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in cuts])


def random_uuid() -> Column:
    """A fresh random id per row and attempt."""
    return F.uuid()


def address_rows(records: DataFrame, *, uuid: Column | None = None) -> DataFrame:
    """All columns of the address table, with id and stored word tokens."""
    missing = {
        name: F.lit(None).cast("string")
        for name in ADDRESS_COLUMNS
        if name not in records.columns and name not in ("uuid", "search_vector")
    }
    filled = records.withColumns(missing) if missing else records
    return filled.withColumns(
        {
            "uuid": stable_uuid(OUTPUT_COLUMN) if uuid is None else uuid,
            "search_vector": tokens(OUTPUT_COLUMN),
        }
    ).select(*ADDRESS_COLUMNS)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stage(rows: DataFrame, staging_path: str, batch_id: int | str = 0) -> None:
    """Write one batch to staging. A batch that runs again replaces its own rows."""
    rows.write.mode("overwrite").parquet(f"{staging_path}/batch_id={batch_id}")


def read_staging(spark: SparkSession, staging_path: str, schema: T.StructType) -> DataFrame:
    return read_or_empty(spark, staging_path, schema)


def absent_rows(staged: DataFrame, base: DataFrame, key: str = OUTPUT_COLUMN) -> DataFrame:
    """Staged rows, one per key, whose key the base table does not hold."""
    others = [name for name in staged.columns if name != key]
    one_per_key = staged.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")) if others else None
    if one_per_key is None:
        unique = staged.distinct()
    else:
        restored = {name: F.col(f"_row.{name}") for name in others}
        unique = one_per_key.select(
            *[restored.get(name, F.col(name)).alias(name) for name in staged.columns]
        )
    return unique.join(base.select(key), key, "left_anti").select(*staged.columns)


def merge_absent(
    spark: SparkSession, staging_path: str, base_path: str, schema: T.StructType, *,
    key: str | None = OUTPUT_COLUMN,
) -> None:
    """Append staged rows whose key is new, then empty the staging area.

    The emptying comes last: a run that stops in between is repeated and adds nothing twice.
    ``key=None`` appends every staged row.
    """
    # Reading adds the folder's batch number as a column; the base table has none.
    staged = read_staging(spark, staging_path, schema).select(*schema.names)
    rows = staged
    if key is not None:
        rows = absent_rows(staged, read_or_empty(spark, base_path, schema), key)
    rows.write.mode("append").parquet(base_path)
    empty_staging(spark, staging_path, schema)


def empty_staging(spark: SparkSession, staging_path: str, schema: T.StructType) -> None:
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(staging_path)


def load_addresses(
    records: DataFrame, table_path: str, *, key: str | None = OUTPUT_COLUMN
) -> None:
    """Stage all address columns next to the table, then merge the new ones.

    Each run has a staging folder of its own, so loads at the same time, or a load after one that
    broke, neither replace nor merge rows of another.
    """
    rows = address_rows(records)
    staging = f"{table_path.rstrip('/')}_staging/run={uuid.uuid4().hex}"
    stage(rows, staging)
    merge_absent(records.sparkSession, staging, table_path, rows.schema, key=key)


# --- address table by area --------------------------------------------------------------------

# Parts of a table by area, and characters of the segment before the country that tell areas apart.
AREA_PARTS = 4096
AREA_CHARACTERS = 3
PART_COLUMN = "part"


def area_part(key: ColumnOrName = OUTPUT_COLUMN, parts: int = AREA_PARTS) -> Column:
    """The part that a canonical string belongs to: by its last segment, the country, and the beginning of
    the one before it, which is the postal code where there is one.

    It depends on the string alone, so equal strings share a part, and addresses of one area share few.
    """
    segments = F.split(as_column(key), ", ")
    country, area = F.try_element_at(segments, F.lit(-1)), F.try_element_at(segments, F.lit(-2))
    named = F.concat_ws(" ", country, F.substring(area, 1, AREA_CHARACTERS))
    return F.pmod(F.xxhash64(named), F.lit(parts)).cast("int")


def read_parts(spark: SparkSession, table_path: str, staged: DataFrame, schema: T.StructType) -> DataFrame:
    """The stored rows of the parts that ``staged`` falls into; the folders of others are not listed."""
    # At most as many numbers as there are parts.
    touched = [row[0] for row in staged.select(PART_COLUMN).distinct().collect()]
    return read_or_empty(spark, table_path, schema).where(F.col(PART_COLUMN).isin(touched))


def load_addresses_by_area(
    records: DataFrame, table_path: str, *, key: str | None = OUTPUT_COLUMN, parts: int = AREA_PARTS
) -> None:
    """As ``load_addresses``, into a table in parts by area: a load reads only the parts it touches.

    A job's addresses are of one area, so the cost of a load follows its own area and not the table.
    The number of parts belongs to the table: all loads into it use the same one. Loads of different
    areas may run at the same time; of two that bring the same string, neither sees the other's.
    """
    spark = records.sparkSession
    rows = address_rows(records).withColumn(PART_COLUMN, area_part(OUTPUT_COLUMN, parts))
    staging = f"{table_path.rstrip('/')}_staging/run={uuid.uuid4().hex}"
    stage(rows, staging)
    staged = read_staging(spark, staging, rows.schema).select(*rows.columns)
    new = staged
    if key is not None:
        new = absent_rows(staged, read_parts(spark, table_path, staged, rows.schema), key)
    # One part may hold most of a load: its rows are spread over several files. A folder for each load
    # keeps the committers of loads at the same time apart.
    spread = new.hint("rebalance", PART_COLUMN).write.partitionBy(PART_COLUMN)
    spread.parquet(f"{table_path.rstrip('/')}/load={uuid.uuid4().hex}")
    empty_staging(spark, staging, rows.schema)


def read_addresses(spark: SparkSession, table_path: str) -> DataFrame:
    """The address table in its own columns, whatever its layout."""
    return read_or_empty(spark, table_path, T.StructType.fromDDL(ADDRESS_SCHEMA)).select(*ADDRESS_COLUMNS)


# --- catalog tables ---------------------------------------------------------------------------


def write_bucketed(
    rows: DataFrame, table: str, path: str, *, buckets: int = ADDRESS_BUCKETS, key: str = "uuid",
    mode: str = "overwrite",
) -> None:
    """Catalog table hashed and sorted by its key: joins on the key then read it unshuffled.

    Rows go to their bucket before the write, so every bucket is one file instead of one per task.
    """
    (
        rows.repartition(buckets, key)
        .write.mode(mode)
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )


def write_search_layout(rows: DataFrame, path: str, *, column: str = "thoroughfare") -> None:
    """Files sorted for prefix search. The id in the range key splits streets that are very common."""
    order = [column, "uuid"] if "uuid" in rows.columns else [column, OUTPUT_COLUMN]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(
        path
    )


def insert_absent(
    staged: DataFrame, table: str, path: str, *, key: str = "uuid", buckets: int = ADDRESS_BUCKETS
) -> None:
    """Insert-if-absent into a table of ``write_bucketed``: only the staged rows are shuffled."""
    new = absent_rows(staged, staged.sparkSession.table(table), key)
    write_bucketed(new, table, path, buckets=buckets, key=key, mode="append")


def create_if_missing(spark: SparkSession, table: str, columns: str, path: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{path}'")


def replace_staging(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def align_by_name(staged: DataFrame, target: T.StructType) -> DataFrame:
    """Staged rows in the target's shape: names match in any case, extra columns are dropped,
    absent ones are null, values take the target type. Names equal but for case are refused."""
    by_name = {name.lower(): name for name in staged.columns}
    if len(by_name) < len(staged.columns):
        raise ValueError(f"column names differ only by case: {staged.columns}")
    return staged.select(
        *[
            (
                F.col(by_name[field.name.lower()])
                if field.name.lower() in by_name
                else F.lit(None)
            )
            .cast(field.dataType)
            .alias(field.name)
            for field in target.fields
        ]
    )


def parent_view(parent: DataFrame, *children: DataFrame) -> DataFrame:
    """Reading a parent table reads its children too, in the parent's columns."""
    rows = parent
    for child in children:
        by_name = {name.lower(): name for name in child.columns}
        shared = [
            F.col(by_name[name.lower()]).alias(name)
            for name in parent.columns
            if name.lower() in by_name
        ]
        rows = rows.unionByName(child.select(*shared), allowMissingColumns=True)
    return rows
