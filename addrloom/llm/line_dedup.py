"""Lines that many sites share: sketched per line, counted exactly where the sketch proves nothing, removed.

A sketch is a HyperLogLog in relational form: per line and register the largest rank and the rows, which
the usual hash aggregation merges before and after the shuffle. A line is taken as common when its estimate
is three standard errors above the threshold and as many registers are used, and as rare only when it has
fewer rows than sites are asked for. All others are counted exactly, so no estimate decides alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.session import materialise

REGISTER_BITS = 8
REGISTERS = 1 << REGISTER_BITS
ERROR = 1.04 / math.sqrt(REGISTERS)
MIN_SITES = 5


def sketch_registers(lines: DataFrame) -> DataFrame:
    """``line, register, rank, n_rows`` of (``line``, ``site``) rows; the largest rank stands for all."""
    digest = F.xxhash64(F.coalesce(F.col("site").cast("string"), F.lit("")), F.col("site").isNull())
    rest = F.shiftrightunsigned(digest, REGISTER_BITS)
    # The rank is the place of the lowest bit set, counted from 1.
    rank = F.when(rest == 0, F.lit(64 - REGISTER_BITS + 1)).otherwise(
        F.log2(rest.bitwiseAND(-rest).cast("double")).cast("int") + 1
    )
    return (
        lines.select(
            "line",
            digest.bitwiseAND(F.lit(REGISTERS - 1)).cast("int").alias("register"),
            rank.alias("rank"),
        )
        .groupBy("line", "register")
        .agg(F.max("rank").alias("rank"), F.count("*").alias("n_rows"))
    )


def estimates(registers: DataFrame) -> DataFrame:
    """``line, used, n_rows, sites``: registers used, rows, and the HyperLogLog estimate.

    The estimate is by linear counting where registers are empty.
    """
    m = float(REGISTERS)
    alpha = 0.7213 / (1 + 1.079 / m)
    summed = registers.groupBy("line").agg(
        F.count("*").alias("used"),
        F.sum(F.pow(F.lit(2.0), -F.col("rank"))).alias("power"),
        F.sum("n_rows").alias("n_rows"),
    )
    raw = F.lit(alpha * m * m) / (F.lit(m) - F.col("used") + F.col("power"))
    empty = F.lit(m) - F.col("used")
    linear = F.lit(m) * F.log(F.lit(m) / empty)
    return summed.select(
        "line", "used", "n_rows", F.when((raw <= 2.5 * m) & (empty > 0), linear).otherwise(raw).alias("sites")
    )


def common_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """The ``line`` digests found on at least ``min_sites`` different sites."""
    band = 3 * ERROR * min_sites + 1
    guessed = materialise(
        # A line has no more sites than rows.
        estimates(sketch_registers(lines)).where(F.col("n_rows") >= min_sites), "line-sites"
    )
    # Nor has it fewer sites than registers used.
    clear = (F.col("sites") > min_sites + band) & (F.col("used") >= min_sites)
    near = guessed.where(~clear).select("line")
    exact = (
        lines.join(near, "line", "left_semi")
        .select("line", "site")
        .distinct()
        .groupBy("line")
        .agg(F.count("*").alias("sites"))
    )
    return (
        guessed.where(clear)
        .select("line")
        .unionAll(exact.where(F.col("sites") >= min_sites).select("line"))
    )


def remove_common_lines(
    docs: DataFrame,
    *,
    min_sites: int = MIN_SITES,
    site: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: id, ``n_lines``, ``n_removed`` and ``kept_text`` without lines of ``min_sites`` or more sites.

    Lines end with a line feed and are compared unchanged. Blank lines are never removed. A missing site
    is one site; a null text is empty and has no lines. Equal rows and repeated lines count once per
    site. An empty table gives no rows.
    """
    site = F.col("source") if site is None else site
    rows = docs.select(
        F.col(id_column).alias("id"),
        site.alias("site"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    ).withColumn("digest", F.xxhash64("text"))
    split = F.split("text", "\n", -1)
    lines = rows.select(
        "id", "digest", "site", F.posexplode(F.transform(split, lambda x: F.when(F.trim(x) != "", F.xxhash64(x))))
    ).where(F.col("col").isNotNull())
    lines = materialise(
        lines.select("id", "digest", "site", "pos", F.col("col").alias("line")), "lines"
    )
    common = materialise(common_lines(lines.select("line", "site"), min_sites), "common-lines")
    # By id and text, so that equal rows, which lose the same lines, share an entry.
    gone = materialise(
        lines.join(common, "line", "left_semi")
        .groupBy("id", "digest")
        .agg(F.collect_set("pos").alias("gone")),
        "removed-lines",
    )
    joined = rows.join(
        gone.withColumnRenamed("id", "gone_id").withColumnRenamed("digest", "gone_digest"),
        F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("digest") == F.col("gone_digest")),
        "left",
    )
    kept = F.filter(split, lambda x, i: ~F.array_contains(F.col("gone"), i))
    return joined.select(
        F.col("id").alias(id_column),
        F.when(F.col("text") == "", 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
    )
