"""Boundary load jobs: states, counties with their look-up, maintenance after the load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from addrloom.operators.lookup import county_lookup, county_rows
from addrloom.operators.quality import (
    COUNTY_KEYS,
    COUNTY_LOOKUP_KEYS,
    STATE_KEYS,
    analyze_table,
    analyze_tables,
    assert_keys,
    present_keys,
)
from addrloom.operators.tables import align_by_name, replace_staging
from addrloom.session import shared_path
from addrloom.sources.boundaries import COUNTY_MEMBER, STATE_MEMBER, read_boundaries


def staged(spark: SparkSession, path: str, member: str, name: str) -> DataFrame:
    """Decode the archives once into a staging table and read that."""
    staging_path = shared_path(spark, name)
    rows = read_boundaries(spark, path, member)
    replace_staging(rows, staging_path)
    return spark.read.schema(rows.schema).parquet(staging_path)


def save(spark: SparkSession, rows: DataFrame, target: str | None, path: str | None) -> DataFrame:
    """Write to a catalog table (statistics refreshed) or to a path; give the stored rows back."""
    if target is not None:
        writer = rows.write.mode("overwrite").format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(target)
        analyze_table(spark, target)
        return spark.table(target)
    if path is None:
        raise ValueError("give a table name or a path")
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def load_states(
    spark: SparkSession,
    archive_path: str,
    *,
    table: str | None = None,
    path: str | None = None,
    target_schema: T.StructType | None = None,
) -> DataFrame:
    """Archives to the state table; the declared keys must hold."""
    rows = staged(spark, archive_path, STATE_MEMBER, "state")
    if target_schema is not None:
        rows = align_by_name(rows, target_schema)
    return save(spark, assert_keys(rows, *present_keys(rows, STATE_KEYS)), table, path)


def load_counties(
    spark: SparkSession,
    archive_path: str,
    states: DataFrame,
    *,
    table: str | None = None,
    path: str | None = None,
    lookup_table: str | None = None,
    lookup_path: str | None = None,
    target_schema: T.StructType | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Archives to the county table and, joined with ``states (statefp, abbrev)``, the look-up.

    Both are replaced, so a second run leaves the same tables.
    """
    rows = county_rows(staged(spark, archive_path, COUNTY_MEMBER, "county"))
    if target_schema is not None:
        rows = align_by_name(rows, target_schema)
    counties = save(spark, assert_keys(rows, *present_keys(rows, COUNTY_KEYS)), table, path)
    found = county_lookup(counties, states)
    lookup = save(spark, assert_keys(found, *COUNTY_LOOKUP_KEYS), lookup_table, lookup_path)
    return counties, lookup


def post_load_maintenance(spark: SparkSession, database: str | None = None) -> None:
    analyze_tables(spark, database)
