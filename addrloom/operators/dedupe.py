"""Duplicate removal on the canonical string, whole-run or per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows per batch by default, and the least that is used.
BATCH_ROWS = 10_000
LEAST_BATCH_ROWS = 1_000

# Rows of one job that are numbered together; bounds the largest window group.
CHUNK_ROWS = 65_536


def with_places(
    df: DataFrame,
    *,
    job: str = "job_id",
    position: str | Sequence[str] = ("line_id", "item"),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``_place``: the number of a row within its job, from 0, in order of ``position``.

    ``position`` is unique within a job; its first column is a whole number. Rows are ranked inside
    chunks of that number's range; a table of chunk sizes, one row per chunk, gives each chunk its
    offset. So a job with a third of all rows is still cut into many small groups. The features of
    one line stay in one chunk, as they came from one parsed document.
    """
    position = [position] if isinstance(position, str) else list(position)
    chunked = df.withColumn("_chunk", F.floor(F.col(position[0]) / F.lit(chunk_rows)))
    earlier = (
        Window.partitionBy(job).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        chunked.groupBy(job, "_chunk")
        .agg(F.count("*").alias("_rows"))
        .select(job, "_chunk", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
        # Same partitioning as the ranked rows: they must not be brought together by job alone.
        .repartition(job, "_chunk")
    )
    within = Window.partitionBy(job, "_chunk").orderBy(*position)
    ranked = chunked.withColumn("_rank", F.row_number().over(within))
    return (
        ranked.join(offsets, [job, "_chunk"])
        .withColumn("_place", F.col("_before") + F.col("_rank") - 1)
        .drop("_chunk", "_rank", "_before")
    )


def number_batches(
    df: DataFrame,
    *,
    job: str = "job_id",
    position: str | Sequence[str] = ("line_id", "item"),
    batch_rows: int = BATCH_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add ``batch_id``: the running number of ``batch_rows`` rows within each job.

    Every row counts, duplicates included; ``batches.unique_batches`` counts the rows that stay.
    """
    batch_rows = max(LEAST_BATCH_ROWS, batch_rows)
    placed = with_places(df, job=job, position=position, chunk_rows=chunk_rows)
    return placed.withColumn("batch_id", F.floor(F.col("_place") / F.lit(batch_rows))).drop("_place")


def dedupe(
    records: DataFrame, scope: str | None = "global", *, key: str = "address_norm"
) -> DataFrame:
    """One row per key (``global``), per job, batch and key (``batch``), or all rows (``None``).

    Batches are numbered within their job, so a batch is named by both.

    With the key as the only column this is a plain distinct, a hash aggregate. With more columns
    the least row of a key survives, so re-run tasks agree. Both combine before the shuffle, so a
    key with a third of all rows costs no more than any other.
    """
    if scope is None:
        return records
    if scope not in ("global", "batch"):
        raise ValueError(f"unknown scope: {scope}")
    keys = [key] if scope == "global" else ["job_id", "batch_id", key]
    others = [name for name in records.columns if name not in keys]
    if not others:
        return records.select(*keys).distinct()
    survivor = F.min(F.struct(*others)).alias("_row")
    chosen = records.groupBy(*keys).agg(survivor)
    restored = {name: F.col(f"_row.{name}") for name in others}
    return chosen.select(
        *[restored.get(name, F.col(name)).alias(name) for name in records.columns]
    )
