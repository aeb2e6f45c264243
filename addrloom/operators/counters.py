"""Run counters and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

MIB = 1024 * 1024


def observe_checked(checked: DataFrame) -> tuple[DataFrame, Observation]:
    """Count processed and invalid rows while they pass. After lost executors re-run tasks count
    again; ``run_counters`` is the exact query."""
    watch = Observation("checked")
    return (
        checked.observe(
            watch,
            F.count(F.lit(1)).alias("processed"),
            F.count_if(F.col("reason").isNotNull()).alias("invalids"),
        ),
        watch,
    )


def observe_written(rows: DataFrame) -> tuple[DataFrame, Observation]:
    watch = Observation("written")
    return rows.observe(watch, F.count(F.lit(1)).alias("written")), watch


def run_counters(checked: DataFrame, scope: str | None = "global") -> DataFrame:
    """``processed, written, deduped, invalids`` of checked records with ``address_norm``.

    Always ``processed = written + deduped + invalids``.
    """
    valid = F.col("reason").isNull()
    keys = [F.when(valid, F.col("address_norm")).alias("_key")]
    if scope == "batch":
        keys.append(F.when(valid, F.struct("job_id", "batch_id")).alias("_batch"))
    keyed = checked.select(*keys, valid.alias("_valid")).groupBy(
        *["_key", "_batch"][: len(keys)], "_valid"
    )
    groups = keyed.agg(F.count("*").alias("_rows"))
    kept = F.lit(1) if scope else F.col("_rows")

    def total(value: Column, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")

    is_valid = F.col("_valid")
    return groups.agg(
        total(F.col("_rows"), F.lit(True)).alias("processed"),
        total(kept, is_valid).alias("written"),
        total(F.col("_rows") - kept, is_valid).alias("deduped"),
        total(F.col("_rows"), ~is_valid).alias("invalids"),
    )


def rate(count: int | float, seconds: float) -> float:
    return count / seconds if seconds > 0 else 0.0


def per_second(name: str, seconds: float) -> Column:
    """The rule of ``rate`` for a column."""
    return F.col(name) / F.lit(float(seconds)) if seconds > 0 else F.lit(0.0)


def with_rates(counters: DataFrame, seconds: float) -> DataFrame:
    """Rows per second in and out of a finished run."""
    return counters.withColumns(
        {
            "rate_in": per_second("processed", seconds),
            "rate_out": per_second("written", seconds),
        }
    )


def features_per_job(features: DataFrame, seconds: float | None = None) -> DataFrame:
    """Features of every job before any filter; with the run time also their rate."""
    counted = features.groupBy("job_id").agg(F.count("*").alias("features"))
    if seconds is None:
        return counted
    return counted.withColumn("rate", per_second("features", seconds))


def bytes_per_job(files: DataFrame, seconds: float | None = None) -> DataFrame:
    """File bytes and MiB of every job from ``(job_id, file_path, file_size)`` rows."""
    sizes = (
        files.groupBy("job_id", "file_path")
        .agg(F.max("file_size").alias("file_size"))
        .groupBy("job_id")
        .agg(F.sum("file_size").alias("bytes"))
        .withColumn("mib", F.col("bytes") / F.lit(float(MIB)))
    )
    if seconds is None:
        return sizes
    return sizes.withColumn("mib_per_second", per_second("mib", seconds))
