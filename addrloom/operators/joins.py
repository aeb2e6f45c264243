"""Joins of a large table with a table that is usually, but not surely, small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes up to which a look-up side is sent to every executor.
BROADCAST_BYTES = 32 << 20


def measured_bytes(df: DataFrame) -> int:
    """Size of all rows as text, summed up per task before one number per task is brought together."""
    size = F.length(F.to_json(F.struct("*"))).cast("bigint")
    return df.agg(F.sum(size)).first()[0] or 0


def lookup_join(
    large: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    *,
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join on equal keys: broadcast where the measured size allows, else left to Spark.

    Beyond the bound this is a plain join, whose hot keys adaptive execution splits; the result does
    not depend on the size. Joins that keep unmatched look-up rows are not look-ups.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"not a look-up: {how}")
    if measured_bytes(small) <= max_bytes:
        small = F.broadcast(small)
    return large.join(small, list(keys), how)


def top_k(df: DataFrame, group: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """The first ``k`` rows of every group in ``order``.

    Up to the optimizer's rank limit Spark keeps only ``k`` rows per group and task before the
    shuffle. Beyond it a first ranking within each input task does the same.
    """
    from pyspark.sql import Window

    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        local = Window.partitionBy(*group, "_task").orderBy(*order)
        df = (
            df.withColumn("_task", F.spark_partition_id())
            .withColumn("_rank", F.row_number().over(local))
            .where(F.col("_rank") <= k)
            .drop("_task", "_rank")
        )
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("_rank") <= k).drop("_rank")
