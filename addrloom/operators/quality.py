"""Data quality: keys, column rules, table statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class KeyViolationError(ValueError):
    """A declared key does not hold."""


@dataclass(frozen=True)
class Key:
    """A declared key. A primary key is unique and never null; a unique key ignores nulls."""

    name: str
    columns: tuple[str, ...]
    primary: bool = False


# Keys of the boundary and address tables; the columns are fixed values, the names are own ones.
STATE_KEYS = (
    Key("pk_state_all", ("statefp",), primary=True),
    Key("uidx_state_all_stusps", ("stusps",)),
    Key("uidx_state_all_gid", ("gid",)),
)
COUNTY_KEYS = (
    Key("pk_county_all", ("cntyidfp",), primary=True),
    Key("uidx_county_all_gid", ("gid",)),
    Key("uidx_county_all_statefp_countyfp", ("statefp", "countyfp")),
)
COUNTY_LOOKUP_KEYS = (Key("pk_county_all_lookup", ("st_code", "co_code"), primary=True),)
ADDRESS_KEYS = (Key("pk_addresses", ("uuid",), primary=True),)


def key_violations(df: DataFrame, *keys: Key) -> DataFrame:
    """``(key_name, problem, key_value, rows)``: duplicated key values and null primary keys."""
    found = None
    for key in keys:
        has_null = F.lit(False)
        for name in key.columns:
            has_null = has_null | F.col(name).isNull()
        groups = df.groupBy(*key.columns).agg(F.count("*").alias("rows"))
        problem = F.when(has_null, F.lit("null") if key.primary else F.lit(None)).when(
            F.col("rows") > 1, F.lit("duplicate")
        )
        shown = F.concat_ws(
            "|", *[F.coalesce(F.col(name).cast("string"), F.lit("NULL")) for name in key.columns]
        )
        rows = groups.select(
            F.lit(key.name).alias("key_name"),
            problem.alias("problem"),
            shown.alias("key_value"),
            "rows",
        ).where("problem IS NOT NULL")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        raise ValueError("no keys given")
    return found


def present_keys(df: DataFrame, keys: Sequence[Key]) -> list[Key]:
    """Keys whose columns the table has (``gid`` is not a field of the boundary files)."""
    return [key for key in keys if set(key.columns) <= set(df.columns)]


def assert_keys(df: DataFrame, *keys: Key) -> DataFrame:
    """Raise with a few examples when a key does not hold; otherwise give the table back."""
    examples = key_violations(df, *keys).limit(5).collect()
    if examples:
        raise KeyViolationError(
            "; ".join(f"{e.key_name}: {e.problem} {e.key_value} ({e.rows} rows)" for e in examples)
        )
    return df


@dataclass(frozen=True)
class ColumnRule:
    max_length: int | None = None
    not_null: bool = False


# Column rules of the address table.
ADDRESS_RULES = {
    "country_code": ColumnRule(2, not_null=True),
    "postal_code": ColumnRule(20),
    "admin_area_1": ColumnRule(80),
    "admin_area_2": ColumnRule(80),
    "locality": ColumnRule(120),
    "dependent_locality": ColumnRule(120),
    "thoroughfare": ColumnRule(160),
    "premise": ColumnRule(60),
    "sub_premise": ColumnRule(30),
    "address_norm": ColumnRule(not_null=True),
}


def rows_from_columns(one_row: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per mapping."""
    items = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*items)))


def column_violations(df: DataFrame, rules: Mapping[str, ColumnRule] = ADDRESS_RULES) -> DataFrame:
    """``(column_name, rule, rows)`` for every rule, counted in one pass."""
    counts, labels = [], []
    for name, rule in rules.items():
        if rule.not_null:
            labels.append((name, "not_null"))
            counts.append(F.count_if(F.col(name).isNull()))
        if rule.max_length is not None:
            labels.append((name, "max_length"))
            counts.append(F.count_if(F.length(name) > rule.max_length))
    one_row = df.agg(*[count.alias(f"c{i}") for i, count in enumerate(counts)])
    return rows_from_columns(
        one_row,
        [
            {"column_name": F.lit(name), "rule": F.lit(rule), "rows": F.col(f"c{i}")}
            for i, (name, rule) in enumerate(labels)
        ],
    )


def table_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, nulls, least and greatest value as text, estimated distinct values.

    One aggregate without a distinct step, so it stays a single pass at any size.
    """
    columns = list(columns or df.columns)
    wanted = []
    for i, name in enumerate(columns):
        wanted += [
            F.count_if(F.col(name).isNull()).alias(f"nulls{i}"),
            F.min(name).cast("string").alias(f"least{i}"),
            F.max(name).cast("string").alias(f"greatest{i}"),
            F.approx_count_distinct(name).alias(f"distinct{i}"),
        ]
    one_row = df.agg(F.count("*").alias("rows"), *wanted)
    return rows_from_columns(
        one_row,
        [
            {
                "column_name": F.lit(name),
                "rows": F.col("rows"),
                "nulls": F.col(f"nulls{i}"),
                "min_value": F.col(f"least{i}"),
                "max_value": F.col(f"greatest{i}"),
                "distinct_estimate": F.col(f"distinct{i}"),
            }
            for i, name in enumerate(columns)
        ],
    )


def analyze_table(spark: SparkSession, table: str) -> None:
    """Refresh the statistics that the optimizer reads, for the table and its plain columns.

    Spark keeps none for arrays, maps and structs, such as the stored word tokens.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    plain = [f.name for f in spark.table(table).schema if not isinstance(f.dataType, nested)]
    columns = ", ".join(f"`{name}`" for name in plain)
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {columns}")


def analyze_tables(spark: SparkSession, database: str | None = None) -> None:
    """Refresh row counts and sizes of every table of a database."""
    where = f" IN {database}" if database else ""
    spark.sql(f"ANALYZE TABLES{where} COMPUTE STATISTICS")
