"""Batches that close at a number of unique rows, without reading rows one after the other.

A batch starts empty, takes the rows whose key it does not hold yet, and closes with its
``batch_rows``-th row; the next one starts behind it. Where a batch ends depends on where it started,
so the rows of a job form one chain. It is cut into chunks all the same:

1. A row is kept by a batch that started at ``s`` if its key's previous row lies before ``s``. Per key
   and chunk the first and last place are enough to know this across chunks.
2. A batch that starts in a chunk closes at the latest with the ``batch_rows``-th new key behind the
   chunk. Each chunk gets these keys' first rows, so it can tell for each of its rows where a batch
   from there would close, and follow the chain until it leaves the chunk: a step function from the
   place of entry to the place of the next chunk's entry.
3. The step functions are composed by doubling: after n rounds the chain is known for 2^n chunks.
4. With the place of entry, and the batch that is open before it, each chunk marks its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrloom.operators.dedupe import BATCH_ROWS, CHUNK_ROWS, LEAST_BATCH_ROWS, with_places
from addrloom.operators.joins import lookup_join, top_k
from addrloom.session import materialise

NONE = -1


def batch_ends(previous: np.ndarray, size: int, limit: int) -> np.ndarray:
    """For a batch from each of the first ``size`` rows: the index behind its last row, or ``NONE``.

    ``previous`` holds each row's previous index of the same key, or ``NONE``. One sweep: both ends of
    the batch only move forward.
    """
    following = np.full(len(previous), len(previous))
    repeated = np.flatnonzero(previous != NONE)
    following[previous[repeated]] = repeated
    before, after = previous.tolist(), following.tolist()
    ends, end, kept = [NONE] * size, 0, 0
    for start in range(size):
        while kept < limit and end < len(before):
            kept += before[end] < start
            end += 1
        if kept < limit:
            break
        ends[start] = end
        # The first row leaves; its key stays if it comes again before the end.
        kept -= after[start] >= end
    return np.array(ends, dtype=np.int64)


def chain_steps(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From each row of a chunk, along ``ends``: the first end outside, the batches until then, and the
    start of the last of them."""
    size = len(ends)
    leaves = ends.tolist()
    steps, last = [1] * size, list(range(size))
    for start in range(size - 1, -1, -1):
        end = leaves[start]
        if NONE < end < size:
            leaves[start], steps[start], last[start] = leaves[end], steps[end] + 1, last[end]
    return np.array(leaves, dtype=np.int64), np.array(steps, dtype=np.int64), np.array(last, dtype=np.int64)


def _by_place(table: pa.Table) -> pa.Table:
    return table.sort_by("_place").combine_chunks()


def _key_codes(table: pa.Table) -> np.ndarray:
    if len(table) == 0:
        return np.empty(0, dtype=np.int64)
    codes = table["_key"].combine_chunks().dictionary_encode(null_encoding="encode")
    return codes.indices.to_numpy().astype(np.int64)


def _previous(codes: np.ndarray) -> np.ndarray:
    """Index of the previous row with the same code, or ``NONE``."""
    order = np.argsort(codes, kind="stable")
    previous = np.full(len(codes), NONE)
    same = codes[order[1:]] == codes[order[:-1]]
    previous[order[1:][same]] = order[:-1][same]
    return previous


def _step_function(limit: int):
    def steps(rows: pa.Table, ahead: pa.Table) -> pa.Table:
        """One row per chunk: for a batch from each of its rows, where the chain leaves the chunk."""
        if len(rows) == 0:
            return pa.table(
                {
                    "_job": pa.array([], rows.schema.field("_job").type),
                    "_chunk": pa.array([], pa.int64()),
                    "_first": pa.array([], pa.int64()),
                    "leave": pa.array([], pa.list_(pa.int64())),
                    "steps": pa.array([], pa.list_(pa.int64())),
                    "last": pa.array([], pa.list_(pa.int64())),
                    "furthest": pa.array([], pa.int64()),
                }
            )
        rows, ahead = _by_place(rows), _by_place(ahead)
        first, size = rows["_place"][0].as_py(), len(rows)
        outside = np.maximum(ahead["_before"].to_numpy() - first, NONE)
        previous = np.concatenate([_previous(_key_codes(rows)), outside])
        ends = batch_ends(previous, size, limit)
        leave, count, last = chain_steps(ends)
        places = np.concatenate([first + np.arange(size + 1), ahead["_place"].to_numpy() + 1])

        def at(index: np.ndarray) -> np.ndarray:
            return np.where(index == NONE, NONE, places[index])

        return pa.table(
            {
                "_job": rows["_job"].slice(0, 1),
                "_chunk": rows["_chunk"].slice(0, 1),
                "_first": pa.array([first], pa.int64()),
                "leave": pa.array([at(leave)], pa.list_(pa.int64())),
                "steps": pa.array([count], pa.list_(pa.int64())),
                "last": pa.array([last + first], pa.list_(pa.int64())),
                "furthest": pa.array([at(ends)[-1]], pa.int64()),
            }
        )

    return steps


def _marker(limit: int, columns: Sequence[str]):
    def mark(rows: pa.Table, known: pa.Table) -> pa.Table:
        """The batch of each row of a chunk and whether it is kept, by the plain rule from the entry on."""
        rows = _by_place(rows)
        size = len(rows)
        kept, batch = np.zeros(size, dtype=bool), np.zeros(size, dtype=np.int64)
        if size:
            first = rows["_place"][0].as_py()
            entry, number = known["entry"][0].as_py(), known["entry_batch"][0].as_py()
            open_batch, fresh = known["open_batch"][0].as_py(), known["fresh"][0].as_py()
            begin = size if entry is None else entry - first
            if begin:
                batch[:begin] = open_batch
                fresh = np.array(fresh or [], dtype=np.int64) - first
                kept[fresh[fresh < begin]] = True
            seen: set[int] = set()
            codes = _key_codes(rows).tolist()
            for i in range(begin, size):
                batch[i] = number
                if codes[i] not in seen:
                    seen.add(codes[i])
                    kept[i] = True
                    if len(seen) >= limit:
                        number += 1
                        seen.clear()
        return pa.table(
            [rows[c] for c in columns] + [pa.array(batch, pa.int64()), pa.array(kept)],
            names=[*columns, "batch_id", "kept"],
        )

    return mark


def _new_keys_ahead(spans: DataFrame, limit: int, chunk_rows: int) -> DataFrame:
    """``(_job, _chunk, _place, _before)``: the first ``limit`` rows behind each chunk whose key was not met
    between the chunk's end and them; ``_before`` is the key's place before that.

    The chunk behind gives its keys' first rows. Where these are too few, the list of the chunk behind
    them is appended, then the list twice as far, and so on: the number of rounds is the logarithm of
    the longest run of chunks that hold too few keys, none where every chunk has enough.
    """
    order = ["_place"]
    window = ["_job", "_chunk"]
    behind = spans.where("_chunk > 0").select(
        "_job",
        (F.col("_chunk") - 1).alias("_chunk"),
        F.col("_from").alias("_place"),
        F.coalesce("_before", F.lit(NONE)).alias("_before"),
    )
    lists = materialise(top_k(behind, window, order, limit), "keys-ahead")
    chunks = materialise(spans.select("_job", "_chunk").distinct(), "chunks")
    distance = 1
    while True:
        sizes = lists.groupBy("_job", "_chunk").agg(F.count("*").alias("_n"))
        short = (
            chunks.join(sizes, window, "left")
            .where(F.coalesce("_n", F.lit(0)) < limit)
            .select("_job", "_chunk")
            .join(
                chunks.select("_job", (F.col("_chunk") - distance - 1).alias("_chunk")), window, "left_semi"
            )
        )
        if short.isEmpty():
            return lists
        further = lists.select("_job", (F.col("_chunk") - distance).alias("_chunk"), "_place", "_before")
        # A key that the nearer list has was met in between: its place before is behind the chunk.
        more = further.join(short, window, "left_semi").where(
            F.col("_before") < (F.col("_chunk") + 1) * chunk_rows
        )
        lists = materialise(top_k(lists.unionByName(more), window, order, limit), "keys-ahead")
        distance *= 2


def _entries(steps: DataFrame) -> DataFrame:
    """``(_job, _chunk, entry, batch, last, last_batch)`` for every chunk that a batch starts in."""
    # No earlier start ends behind the batch from the last row before a chunk, so entries lie up to there.
    ahead = Window.partitionBy("_job").orderBy("_chunk")
    reach = steps.select("_job", "_chunk", F.lag("furthest").over(ahead).alias("_until"))
    zone = (
        F.when(F.col("_chunk") == 0, F.lit(1))
        .when(F.col("_until") == NONE, F.size("leave"))
        .otherwise(F.least(F.size("leave"), F.greatest(F.lit(0), F.col("_until") - F.col("_first") + 1)))
        .cast("int")
    )
    starts = materialise(
        lookup_join(steps, reach, ["_job", "_chunk"])
        .select(
            "_job",
            "_chunk",
            "_first",
            F.posexplode(F.slice(F.arrays_zip("leave", "steps", "last"), F.lit(1), zone)).alias("_at", "_step"),
        )
        .select(
            "_job",
            "_chunk",
            (F.col("_first") + F.col("_at")).alias("entry"),
            "_step.leave",
            "_step.steps",
            "_step.last",
        ),
        "batch-starts",
    )
    chain = steps.where("_chunk = 0").select(
        "_job", F.lit(0).cast("bigint").alias("entry"), F.lit(0).cast("bigint").alias("batch")
    )
    chain = materialise(chain, "chain")
    jumps, found = starts.select("_job", "entry", "leave", "steps"), chain.count()
    while True:
        further = chain.join(jumps, ["_job", "entry"]).select(
            "_job", F.col("leave").alias("entry"), (F.col("batch") + F.col("steps")).alias("batch")
        )
        chain = materialise(chain.unionByName(further.where(f"entry <> {NONE}")).distinct(), "chain")
        now = chain.count()
        if now == found:
            break
        found = now
        onward = jumps.select(
            "_job", F.col("entry").alias("leave"), F.col("leave").alias("_to"), F.col("steps").alias("_more")
        )
        jumps = materialise(
            jumps.join(onward, ["_job", "leave"]).select(
                "_job", "entry", F.col("_to").alias("leave"), (F.col("steps") + F.col("_more")).alias("steps")
            ),
            "jumps",
        )
    return chain.join(starts, ["_job", "entry"]).select(
        "_job",
        "_chunk",
        "entry",
        "batch",
        "last",
        (F.col("batch") + F.col("steps") - 1).alias("last_batch"),
    )


def unique_batches(
    df: DataFrame,
    *,
    key: str = "address_norm",
    job: str | None = "job_id",
    position: str | Sequence[str] = ("line_id", "item"),
    batch_rows: int = BATCH_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    least_rows: int = LEAST_BATCH_ROWS,
) -> DataFrame:
    """Add ``batch_id`` and ``kept``: whether a row is the first of its key within its batch.

    A batch closes with its ``batch_rows``-th kept row; rows are taken in order of ``position``, which
    is unique within a job and starts with a whole number. Batches are counted within each job, or
    over all rows with ``job=None``. A dropped row has the number of the batch that dropped it. Null
    keys are one key.

    Rows are handled in chunks of ``chunk_rows``: neither a job nor a key with a third of all rows
    comes together in one task. Beside the rows, at most ``batch_rows`` key rows per chunk are moved.
    """
    limit = max(least_rows, batch_rows)
    names = df.columns
    lead = F.lit("") if job is None else F.col(job)
    placed = with_places(
        df.withColumn("_job", lead), job="_job", position=position, chunk_rows=chunk_rows
    )
    rows = materialise(
        placed.withColumns(
            {"_chunk": F.floor(F.col("_place") / F.lit(chunk_rows)), "_key": F.col(key)}
        ),
        "placed-rows",
    )
    in_order = Window.partitionBy("_job", "_key").orderBy("_chunk")
    spans = materialise(
        rows.groupBy("_job", "_key", "_chunk")
        .agg(F.min("_place").alias("_from"), F.max("_place").alias("_to"))
        .withColumn("_before", F.lag("_to").over(in_order)),
        "key-spans",
    )
    kind = rows.schema["_job"].dataType.simpleString()
    steps = materialise(
        rows.select("_job", "_chunk", "_place", "_key")
        .groupBy("_job", "_chunk")
        .cogroup(_new_keys_ahead(spans, limit, chunk_rows).groupBy("_job", "_chunk"))
        .applyInArrow(
            _step_function(limit),
            f"_job {kind}, _chunk bigint, _first bigint, leave array<bigint>, steps array<bigint>, "
            "last array<bigint>, furthest bigint",
        ),
        "batch-steps",
    )
    earlier = Window.partitionBy("_job").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    known = materialise(
        steps.select("_job", "_chunk")
        .join(_entries(steps), ["_job", "_chunk"], "left")
        .select(
            "_job",
            "_chunk",
            "entry",
            F.col("batch").alias("entry_batch"),
            F.last("last", ignorenulls=True).over(earlier).alias("open_start"),
            F.last("last_batch", ignorenulls=True).over(earlier).alias("open_batch"),
        ),
        "chunk-batches",
    )
    # First rows in a chunk of keys that the batch open before it does not hold.
    fresh = (
        lookup_join(spans, known, ["_job", "_chunk"])
        .where(F.coalesce("_before", F.lit(NONE)) < F.col("open_start"))
        .groupBy("_job", "_chunk")
        .agg(F.collect_list("_from").alias("fresh"))
    )
    # The entry's chunk is known by its job and number, one row for each.
    told = known.drop("open_start").join(fresh, ["_job", "_chunk"], "left")
    marked = (
        rows.groupBy("_job", "_chunk")
        .cogroup(told.groupBy("_job", "_chunk"))
        .applyInArrow(
            _marker(limit, names),
            ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
            + ", batch_id bigint, kept boolean",
        )
    )
    return marked
