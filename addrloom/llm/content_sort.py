"""Exact duplicates by sorting contents.

Sampled splitters deal the rows over range partitions of (content, id), where the content's first bytes
and a digest of all of it give the order; each partition is sorted outside of memory where needed, and
neighbours are compared in full. A group of copies of any size is
cut by the id within the key, so it never meets in one task; the runs at partition edges are then
compared with each other, which takes two short rows per partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrloom.session import materialise

INNER, FIRST, LAST, ONLY = 0, 1, 2, 3
HEAD_BYTES = 24


def _find_runs(keep_rows: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Mark runs of equal contents in one sorted partition; the run's last row is the one that stays."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []  # the rows of the run that is still open
        started = False

        def close(end: bool) -> Iterator[pa.RecordBatch]:
            nonlocal started
            table = pa.Table.from_batches(held).combine_chunks()
            content = table["content"]
            n = len(table)
            new = np.ones(n, dtype=bool)
            if n > 1:
                same = pc.equal(content.slice(1), content.slice(0, n - 1))
                new[1:] = ~same.combine_chunks().to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(new)
            sizes = np.diff(np.append(heads, n))
            tails = heads + sizes - 1
            edges = np.full(len(heads), INNER, dtype=np.int32)
            if not started:
                edges[0] = FIRST
            if end:
                edges[-1] = ONLY if edges[-1] == FIRST else LAST
            started = True
            run = np.repeat(np.arange(len(heads)), sizes)
            kept = np.zeros(n, dtype=bool)
            kept[tails] = True
            hidden = ~(kept & (edges[run] != INNER))
            columns = {
                "row": table["row"],
                "keep_id": table["id"].take(pa.array(tails[run])),
                "group_size": pa.array(sizes[run], pa.int64()),
                "kept": pa.array(kept),
                "part": pa.array(np.full(n, part, dtype=np.int32)),
                "edge": pa.array(edges[run]),
                "content": content.take(pa.array(np.arange(n), mask=hidden)),
            }
            found = pa.table(columns)
            if keep_rows:
                found = found.filter(pa.array(kept))
            yield from found.to_batches()

        for batch in batches:
            if batch.num_rows == 0:
                continue
            content = batch.column("content")
            n = batch.num_rows
            new = np.zeros(n, dtype=bool)
            if held:
                last = held[-1].column("content")[-1]
                new[0] = not last.equals(content[0])
            if n > 1:
                new[1:] = ~pc.equal(content.slice(1), content.slice(0, n - 1)).to_numpy(False)
            starts = np.flatnonzero(new)
            if len(starts) == 0:
                held.append(batch)
                continue
            if starts[-1] > 0:
                held.append(batch.slice(0, starts[-1]))
            yield from close(end=False)
            held = [batch.slice(starts[-1])]
        if held:
            yield from close(end=True)

    return runs


def _marked(
    docs: DataFrame, row: Column, id_column: str, content: Column, keep: str, keep_rows: bool
) -> DataFrame:
    """Rows with their run, and the runs at partition edges joined into whole groups."""
    last = F.col("id").asc_nulls_first() if keep == "largest" else F.col("id").desc_nulls_first()
    rows = docs.select(
        row.alias("row"),
        F.col(id_column).alias("id"),
        F.coalesce(content, F.lit("")).cast("binary").alias("content"),
    )
    kinds = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType(
        [
            T.StructField("row", kinds["row"]),
            T.StructField("keep_id", kinds["id"]),
            T.StructField("group_size", T.LongType()),
            T.StructField("kept", T.BooleanType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("edge", T.IntegerType()),
            T.StructField("content", T.BinaryType()),
        ]
    )
    # Splitters are short, as samples of them pass through the driver: a first part and a digest.
    rows = rows.withColumns(
        {"head": F.substring("content", 1, HEAD_BYTES), "digest": F.xxhash64("content")}
    )
    dealt = (
        rows.repartitionByRange("head", "digest", last)
        .sortWithinPartitions("head", "digest", "content", last)
        .drop("head", "digest")
    )
    runs = materialise(dealt.mapInArrow(_find_runs(keep_rows), schema), "content-sort")

    # One or two entries per partition; only their numbers meet in one task, contents are joined.
    ends = runs.where((F.col("edge") != INNER) & F.col("kept"))
    order = Window.orderBy("part", "edge")
    before = ends.select(
        "part", "edge", F.lag("part").over(order).alias("p"), F.lag("edge").over(order).alias("e")
    )
    texts = ends.select("part", "edge", "content")
    same = (
        before.join(texts, ["part", "edge"])
        .join(
            texts.select(
                F.col("part").alias("p"), F.col("edge").alias("e"), F.col("content").alias("other")
            ),
            ["p", "e"],
        )
        .where(F.col("content") == F.col("other"))
        .select("part", "edge", F.lit(0).alias("new"))
    )
    chain = F.sum(F.coalesce("new", F.lit(1))).over(order)
    linked = ends.select("part", "edge", "keep_id", "group_size").join(
        same, ["part", "edge"], "left"
    )
    of_chain = Window.partitionBy("chain").orderBy("part", "edge")
    whole = of_chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chains = linked.withColumn("chain", chain).select(
        "part",
        "edge",
        F.last("keep_id").over(whole).alias("chain_id"),
        F.sum("group_size").over(whole).alias("chain_size"),
        (F.row_number().over(of_chain) == F.count("*").over(whole)).alias("chain_kept"),
    )
    edge = F.col("edge") != INNER
    return runs.join(chains, ["part", "edge"], "left").select(
        "row",
        F.when(edge, F.col("chain_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(edge, F.col("chain_size")).otherwise(F.col("group_size")).alias("group_size"),
        (F.col("kept") & F.when(edge, F.col("chain_kept")).otherwise(F.lit(True))).alias("kept"),
    )


def duplicate_groups(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text: Column | None = None,
    keep: str = "smallest",
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    ``text`` is the normalised text to compare (default: column ``text`` unchanged). A null text is
    empty, so null and empty texts are one group. The row with the smallest (or largest) id stays; a
    null id stays only where the group has no other. Of rows equal in text and id one stays. An empty
    table gives an empty result; other columns of ``docs`` are not touched, whatever their names.
    """
    text = F.coalesce(F.col("text") if text is None else text, F.lit(""))
    row = F.struct(F.col(id_column).alias("id"), F.sha2(text.cast("binary"), 256).alias("sha"))
    found = _marked(docs, row, id_column, text, keep, keep_rows=False)
    return found.select(
        F.col("row.id").alias(id_column),
        "keep_id",
        "group_size",
        "kept",
        F.col("row.sha").alias("text_sha256"),
    )


def drop_duplicates(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text: Column | None = None,
    keep: str = "smallest",
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rules as in ``duplicate_groups``."""
    text = F.col("text") if text is None else text
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = _marked(docs, row, id_column, text, keep, keep_rows=True).where("kept")
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
