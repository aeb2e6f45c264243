"""County and state boundary tables and their look-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.operators.joins import lookup_join

# The county file's key column and its name in the county table.
COUNTY_FILE_KEY = "geoid"
COUNTY_TABLE_KEY = "cntyidfp"


def county_rows(staged: DataFrame) -> DataFrame:
    return staged.withColumnRenamed(COUNTY_FILE_KEY, COUNTY_TABLE_KEY)


def county_lookup(counties: DataFrame, states: DataFrame) -> DataFrame:
    """``(st_code, state, co_code, name)`` of every county with a known state.

    Codes are cast strictly: a code that is no number fails the job.
    """
    county = counties.select("statefp", "countyfp", F.col("name").alias("county_name"))
    state = states.select("statefp", "abbrev")
    return lookup_join(county, state, ["statefp"]).select(
        F.col("statefp").cast("int").alias("st_code"),
        F.col("abbrev").alias("state"),
        F.col("countyfp").cast("int").alias("co_code"),
        F.col("county_name").alias("name"),
    )
