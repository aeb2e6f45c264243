"""Exact top-k search by inner product: a Voronoi join of query and data vectors.

Queries and data are grouped by their nearest pivot. Summaries of the groups, and the data vectors next
to the pivots, give each query group a radius and a score that all its queries reach k times over. A
data vector is sent to a query group only if its bound reaches that score, and every group is solved
where its queries and its share of the data meet.

Bounds for a query q within R of the group's pivot p, and a data vector s: ``q.s <= p.s + R |s|``, and
from ``|q - s| >= |p - s| - R`` also ``q.s <= (|q|^2 + |s|^2 - max(0, |p - s| - R)^2) / 2``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrloom.operators.joins import top_k
from addrloom.session import materialise

K = 10
SCALE = 1024
# Pivots, and numbers held for them and their nearest data vectors: what a task gets is bounded.
MAX_PIVOTS = 1024
PIVOT_NUMBERS = 4 << 20
# Queries, and numbers of data vectors, that are solved at once.
QUERY_BLOCK = 4096
DATA_NUMBERS = 2 << 20
STEP_NUMBERS = 4 << 20

LONG_MAX = (1 << 63) - 1


def usable(column: str) -> Column:
    """A vector that is not null and holds finite numbers only."""
    finite = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(math.inf))
    )
    return F.col(column).isNotNull() & F.coalesce(finite, F.lit(False))


def scaled(column: str, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component in double precision; beyond 64 bits the nearest of these."""
    return F.transform(column, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy()
    sizes = column.value_lengths().to_numpy()
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all of ``b``; beyond 64 bits the nearest of these."""
    most = [max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0 for x in (a, b)]
    largest = most[0] * most[1] * max(1, a.shape[1])
    if largest < 1 << 53:
        # Whole numbers of this size are exact in double precision.
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if largest <= LONG_MAX:
        return a @ b.T
    wide = a.astype(object) @ b.astype(object).T
    return np.clip(wide, -LONG_MAX, LONG_MAX).astype(np.int64)


def kth_score(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest score per row, or the least number where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -math.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k].astype(np.float64)


def best_columns(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest scores of each row; of equal ones the first columns."""
    rows, columns = [], []
    for r, own in enumerate(scores):
        if len(own) > k:
            near = np.flatnonzero(own >= np.partition(own, len(own) - k)[-k])
        else:
            near = np.arange(len(own))
        best = near[np.argsort(-own[near], kind="stable")][:k]
        rows.append(np.full(len(best), r))
        columns.append(best)
    none = [np.empty(0, dtype=np.int64)]
    return np.concatenate(none + rows), np.concatenate(none + columns)


def nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of each row and the distance to it."""
    x = x.astype(np.float64)
    cell = ((pivots**2).sum(axis=1) - 2 * (x @ pivots.T)).argmin(axis=1)
    return cell, np.linalg.norm(x - pivots[cell], axis=1)


class Groups:
    """The query groups: pivots, radii, largest norms, scores to reach, and the blocks they are solved in."""

    def __init__(self, pivots: np.ndarray, summaries: list, block: int) -> None:
        # Groups with near pivots share a block, and a group beyond a block's size has several.
        order = np.argsort(pivots @ pivots[0])
        known = {s["cell"]: s for s in summaries}
        ordered = [known[c] for c in order if c in known]
        self.cells = np.array([s["cell"] for s in ordered], dtype=np.int64)
        self.pivots = pivots[self.cells]
        self.radius = np.array([s["radius"] for s in ordered])
        self.norm = np.array([s["norm"] for s in ordered])
        self.reach = np.array([s["reach"] for s in ordered])
        self.first_block, self.blocks = [], []
        at, filled = -1, block
        for s in ordered:
            several = -(-s["queries"] // block)
            if several > 1 or filled + s["queries"] > block:
                at, filled = at + 1, 0
            self.first_block.append(at)
            self.blocks.append(several)
            at += several - 1
            filled = block if several > 1 else filled + s["queries"]
        self.block_count = at + 1

    def needs(self, s: np.ndarray) -> np.ndarray:
        """Which groups (columns) a data vector (rows) may be among the best of; never wrongly no."""
        s = s.astype(np.float64)
        size = np.linalg.norm(s, axis=1)
        dot = s @ self.pivots.T
        gap2 = (size**2)[:, None] + (self.pivots**2).sum(axis=1) - 2 * dot
        beyond = np.maximum(0, np.sqrt(np.maximum(0, gap2)) - self.radius)
        by_norm = dot + self.radius * size[:, None]
        by_distance = (self.norm**2 + (size**2)[:, None] - beyond**2) / 2
        # Room for rounding of all the terms above.
        room = 1e-9 * ((self.norm + self.radius) ** 2 + (size**2)[:, None] + (self.pivots**2).sum(axis=1) + 1)
        return np.minimum(by_norm, by_distance) + room >= self.reach


def _assign(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot and the distance to it."""
    width = pivots.shape[1]
    kept = rows.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = nearest(matrix(batch.column("vector"), width), pivots)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell, pa.int32()), pa.array(far, pa.float64())],
                names=[*kept, "cell", "far"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(assign, f"{schema}, cell int, far double")


def _query_summaries(queries: DataFrame, witnesses: np.ndarray, k: int) -> list:
    """Per cell: queries, radius, largest norm, and the least of its queries' k-th best scores so far."""
    width = witnesses.shape[1]

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, STEP_NUMBERS // max(1, len(witnesses)))
        for batch in batches:
            x = matrix(batch.column("vector"), width)
            found = [kth_score(products(x[i : i + step], witnesses), k) for i in range(0, len(x), step)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("cell"),
                    batch.column("far"),
                    pa.array(np.linalg.norm(x.astype(np.float64), axis=1)),
                    pa.array(np.concatenate([np.empty(0), *found])),
                ],
                names=["cell", "far", "norm", "reach"],
            )

    reached = queries.select("vector", "cell", "far").mapInArrow(
        reach, "cell int, far double, norm double, reach double"
    )
    # At most MAX_PIVOTS rows.
    return (
        reached.groupBy("cell")
        .agg(
            F.count("*").alias("queries"),
            F.max("far").alias("radius"),
            F.max("norm").alias("norm"),
            F.min("reach").alias("reach"),
        )
        .collect()
    )


def _solver(groups: Groups, width: int, k: int):
    def solve(queries: pa.Table, data: pa.Table) -> pa.Table:
        """The best ``k`` data rows of each query in this block and share of the data."""
        # Ties go to the smaller id, null ids last, so rows in this order are in order of preference.
        order = np.lexsort(
            (
                data["row"].to_numpy(),
                data["id"].fill_null(0).to_numpy(),
                data["id"].is_null().to_numpy(zero_copy_only=False),
            )
        )
        data = data.take(pa.array(order)).combine_chunks()
        vectors, asked = matrix(data["vector"], width), matrix(queries["vector"], width)
        cell = queries["cell"].to_numpy()
        query, found, score = [], [], []
        needed = groups.needs(vectors)
        for g in np.flatnonzero(np.isin(groups.cells, cell)):
            own, near = np.flatnonzero(cell == groups.cells[g]), np.flatnonzero(needed[:, g])
            step = max(1, STEP_NUMBERS // max(1, len(near)))
            for i in range(0, len(own), step):
                part = own[i : i + step]
                scores = products(asked[part], vectors[near])
                r, c = best_columns(scores, k)
                query.append(part[r])
                found.append(near[c])
                score.append(scores[r, c])
        none = [np.empty(0, dtype=np.int64)]
        query, found = np.concatenate(none + query), np.concatenate(none + found)
        return pa.table(
            {
                "query": queries["query"].take(pa.array(query)),
                "row": data["row"].take(pa.array(found)),
                "id": data["id"].take(pa.array(found)),
                "score": pa.array(np.concatenate(none + score), pa.int64()),
            }
        )

    return solve


def top_products(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    max_pivots: int = MAX_PIVOTS,
    query_block: int = QUERY_BLOCK,
    data_numbers: int = DATA_NUMBERS,
) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` best rows for every row where ``is_query`` holds.

    Scores are inner products of ``floor(1024 x)``, whole numbers. A row is no candidate for itself; all
    other rows are, also those with an equal id or an equal vector. Ties go to the smaller id (whole
    numbers), null ids last. Pivots are a sample of at most ``max_pivots`` distinct vectors; they decide
    how the work is cut and never what is found.

    Vectors that are null or hold a null, NaN or infinite component take no part, neither as queries
    nor as candidates. Shorter vectors count as filled up with zeros; components and scores beyond 64
    bits are the nearest number of 64 bits. Repeated rows are candidates of their own. Fewer than ``k``
    candidates give fewer rows, an empty table none. Only the two columns named and those of
    ``is_query`` are read, so further columns may have any name.
    """
    spark = vectors.sparkSession
    points = materialise(
        vectors.where(usable(vector_column)).select(
            F.col(id_column).cast("bigint").alias("id"),
            scaled(vector_column).alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "points",
    )
    own = points.where("asks").select(F.col("row").alias("own_row"), F.col("id").alias("query_id"), "vector")
    result = "query_id bigint, rank int, id bigint, score bigint"
    width = points.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return spark.createDataFrame([], result).withColumnRenamed("id", id_column)
    width = max(1, width)
    # Of equal vectors only the first k + 1 by id can be found, and one search serves all queries.
    preference = [F.col("id").asc_nulls_last(), F.col("row").asc()]
    data = materialise(
        top_k(points.select("vector", "id", "row"), ["vector"], preference, k + 1), "candidates"
    )
    asked = materialise(
        own.groupBy("vector").agg(F.min("own_row").alias("query")), "asked"
    )
    n_queries = asked.count()
    if n_queries == 0:
        return spark.createDataFrame([], result).withColumnRenamed("id", id_column)
    wanted = max(1, min(max_pivots, PIVOT_NUMBERS // ((k + 2) * width), math.isqrt(max(0, n_queries - 1)) + 1))
    # A sample by digest; equal vectors have equal digests, so each has one row per digest.
    sample = (
        data.groupBy(F.xxhash64("vector").alias("digest"))
        .agg(F.min("vector").alias("vector"))
        .orderBy("digest")
        .limit(wanted)
        .select("vector")
        .toArrow()
    )
    pivots = matrix(sample["vector"], width).astype(np.float64)
    placed = materialise(_assign(data, pivots), "placed-data")
    # The k + 1 rows next to each pivot: a bounded table whose exact scores bound all others from below.
    near = top_k(
        placed.select("cell", "far", "row", "vector"), ["cell"], [F.col("far"), F.col("row")], k + 1
    )
    witnesses = matrix(near.select("vector").toArrow()["vector"], width)
    grouped = materialise(_assign(asked, pivots), "placed-queries")
    groups = Groups(pivots, _query_summaries(grouped, witnesses, k + 1), query_block)
    shares = max(1, -(-placed.count() * width // data_numbers))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, STEP_NUMBERS // max(1, width, len(groups.cells)))
        for whole in batches:
            for i in range(0, whole.num_rows, step):
                batch = whole.slice(i, step)
                needed = groups.needs(matrix(batch.column("vector"), width))
                to = np.zeros((batch.num_rows, groups.block_count), dtype=bool)
                for g, (first, several) in enumerate(zip(groups.first_block, groups.blocks)):
                    to[:, first : first + several] |= needed[:, g : g + 1]
                row, block = np.nonzero(to)
                if len(row):
                    sent = batch.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block, pa.int32()), *sent.columns], names=["block", *sent.schema.names]
                    )

    kind = "block int, share int, row bigint, id bigint, vector array<bigint>"
    sent = placed.select(
        F.pmod(F.xxhash64("row"), F.lit(shares)).cast("int").alias("share"), "row", "id", "vector"
    ).mapInArrow(send, kind)
    first, several = np.array(groups.first_block), np.array(groups.blocks)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.argsort(groups.cells)[
                np.searchsorted(np.sort(groups.cells), batch.column("cell").to_numpy())
            ]
            block = first[group] + batch.column("query").to_numpy() % several[group]
            for share in range(shares):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block, pa.int32()),
                        pa.array(np.full(len(block), share), pa.int32()),
                        *[batch.column(c) for c in ("query", "cell", "vector")],
                    ],
                    names=["block", "share", "query", "cell", "vector"],
                )

    blocks = grouped.mapInArrow(
        ask, "block int, share int, query bigint, cell int, vector array<bigint>"
    )
    solved = (
        blocks.groupBy("block", "share")
        .cogroup(sent.groupBy("block", "share"))
        .applyInArrow(_solver(groups, width, k + 1), "query bigint, row bigint, id bigint, score bigint")
    )
    order = [F.col("score").desc(), *preference]
    best = (
        top_k(solved, ["query"], order, k + 1)
        .groupBy("query")
        .agg(F.collect_list(F.struct("row", "id", "score")).alias("found"))
    )
    # One row per distinct query vector meets all rows that ask with it; adaptive execution splits a
    # vector that very many ask with.
    answers = (
        own.join(asked.join(best, "query"), "vector")
        .select("own_row", "query_id", F.explode("found").alias("f"))
        .select("own_row", "query_id", "f.row", "f.id", "f.score")
        .where("own_row <> row")
    )
    rank = F.row_number().over(Window.partitionBy("own_row").orderBy(*order))
    return (
        answers.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_column), "score")
    )
