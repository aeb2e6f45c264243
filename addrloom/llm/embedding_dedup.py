"""Near-duplicate embeddings by randomly rotated binary codes.

A code holds the signs of the rotated unit vector, and beside it the code's own inner product with that
vector. Dividing by this factor makes the inner product of a code and another vector an unbiased
estimate of the cosine, with a bound on its error; only pairs whose bound reaches the threshold are
computed exactly, in double precision. Runs of code bits serve as bucket keys that decide which
vectors meet; enough tables are used that a pair at the threshold is missed with ``MISS``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.llm.components import connected_components
from addrloom.session import materialise

THRESHOLD = 0.98
# Chance to miss a pair at the threshold: no table has it in one bucket, or it lies beyond the bound.
MISS = 1e-4
BOUND = 4.5
BUCKET_VECTORS = 512
BLOCK = 512
SEED = 7


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Rows under a random rotation: three rounds of random signs and a Hadamard transform."""
    n, d = x.shape
    size = 1 << max(3, (d - 1).bit_length())
    out = np.zeros((n, size))
    out[:, :d] = x
    signs = np.random.default_rng(seed).integers(0, 2, (3, size)) * 2.0 - 1
    for k in range(3):
        out *= signs[k]
        h = 1
        while h < size:
            out = out.reshape(n, size // (2 * h), 2, h)
            a, b = out[:, :, 0], out[:, :, 1]
            out = np.stack([a + b, a - b], axis=2)
            h *= 2
        out = out.reshape(n, size) / math.sqrt(size)
    return out


def units(column: pa.Array, d: int) -> np.ndarray:
    """Unit vectors in double precision, whatever finite length they have."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)
    # By a power of two, which rounds nothing: squares of very large or small numbers are out of range.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def table_plan(vectors: int, threshold: float) -> tuple[int, int]:
    """Bits per key and number of tables."""
    bits = int(np.clip(math.log2(max(1, vectors) / BUCKET_VECTORS), 3, 24))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISS) / math.log(1 - same)))


def bucket_keys(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """One key per row and table, from as many rotations as have enough bits."""
    signs, seed = [], SEED
    while sum(s.shape[1] for s in signs) < bits * tables:
        signs.append(rotate(x, seed) > 0)
        seed += 1
    wanted = np.concatenate(signs, axis=1)[:, : bits * tables].reshape(len(x), tables, bits)
    return wanted @ (1 << np.arange(bits, dtype=np.int64))


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated unit vectors, and each code's inner product with its vector."""
    rotated = rotate(x, SEED)
    return np.packbits(rotated > 0, axis=1), np.abs(rotated).sum(axis=1) / math.sqrt(rotated.shape[1])


def may_link(codes: np.ndarray, factors: np.ndarray, x: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs of (code, vector) whose estimated cosine and error bound reach the threshold."""
    rotated = rotate(x, SEED).astype(np.float32)
    size = rotated.shape[1]
    signs = (np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1) / math.sqrt(size)
    estimate = (signs @ rotated.T) / factors[:, None]
    error = BOUND * np.sqrt(np.maximum(0, 1 - factors**2)) / factors / math.sqrt(size - 1)
    return estimate >= threshold - 1e-5 - error[:, None]


def _local_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable by the links (a, b) among n nodes."""
    roots = np.arange(n)
    while True:
        low = np.minimum(roots[a], roots[b])
        new = roots.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def _block_links(threshold: float):
    def links(table: pa.Table) -> pa.Table:
        """Links within a block, or between two blocks of a bucket: sums per vector, not pairs."""
        table = table.combine_chunks()
        empty = pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        d = table["d"][0].as_py()
        column = table["embedding"].chunk(0)
        x = units(column, d)
        node = table["node"].to_numpy()
        copies = table["copies"].to_numpy()
        keys = np.stack(table["keys"].to_numpy(zero_copy_only=False))
        nth = table["nth"][0].as_py()
        side = table["block"].to_numpy()
        codes = np.frombuffer(b"".join(table["code"].to_pylist()), dtype=np.uint8).reshape(len(x), -1)
        factors = table["factor"].to_numpy()
        first = np.flatnonzero(side == table["low"][0].as_py())
        second = np.flatnonzero(side == table["high"][0].as_py())
        if len(first) == 0 or len(second) == 0:
            return empty
        i, j = np.nonzero(may_link(codes[first], factors[first], x[second], threshold))
        i, j = first[i], second[j]
        # Within a block each pair is met from both sides; one of them may be beyond its bound.
        low, high = np.minimum(i, j), np.maximum(i, j)
        pairs = np.unique(np.stack([low, high])[:, low < high], axis=1)
        i, j = pairs
        # Exact recomputation, a slice at a time.
        keep = np.zeros(len(i), dtype=bool)
        for s in range(0, len(i), 65536):
            p = slice(s, s + 65536)
            keep[p] = np.einsum("ij,ij->i", x[i[p]], x[j[p]]) >= threshold
        i, j = i[keep], j[keep]
        # A pair counts in the first table that brings it together.
        counted = ~(keys[i, :nth] == keys[j, :nth]).any(axis=1)
        links = np.bincount(i[counted], weights=copies[j[counted]], minlength=len(x))
        links += np.bincount(j[counted], weights=copies[i[counted]], minlength=len(x))
        roots = _local_roots(i, j, len(x))
        shown = np.flatnonzero((links > 0) | (roots != np.arange(len(x))))
        return pa.table(
            {
                "node": pa.array(node[shown]),
                "links": pa.array(links[shown].astype(np.int64)),
                "root": pa.array(node[roots[shown]]),
            }
        )

    return links


def embedding_classes(
    vectors: DataFrame,
    *,
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Per vector: id, ``n_links``, ``component_id`` and ``kept`` (the id is the class's smallest).

    Vectors of equal labels link at a cosine of ``threshold`` or more. A null, empty or zero vector, one
    with null or non-finite components, or one without a label links with nothing. Vectors of different
    lengths do not link. Equal vectors are compared once and each of them is counted. A null id is
    the smallest only where its class has no other. An empty table gives no rows.
    """
    vector = F.col(vector_column).cast("array<double>")
    usable = (
        F.col(label_column).isNotNull()
        & F.coalesce(F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists(vector, lambda v: v != 0), F.lit(False))
    )
    rows = materialise(
        vectors.select(
            F.col(id_column).alias("id"),
            F.when(usable, F.xxhash64(F.col(label_column), vector)).alias("node"),
            F.when(usable, F.col(label_column)).alias("label"),
            F.when(usable, vector).alias("embedding"),
        ),
        "vectors",
    )
    classes = materialise(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.count("*").alias("copies"),
            F.min("id").alias("id"),
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
        )
        .withColumn("d", F.size("embedding")),
        "vector-classes",
    )
    bits, tables = table_plan(classes.count(), threshold)
    label_type = classes.schema["label"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("d").to_numpy()
            for d in np.unique(sizes):
                part = batch.filter(pa.array(sizes == d))
                x = units(part.column("embedding"), int(d))
                keys = bucket_keys(x, bits, tables)
                codes, factors = encode(x)
                rows = pa.array(np.repeat(np.arange(len(x)), tables))
                columns = ["node", "copies", "label", "embedding", "d"]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c).take(rows) for c in columns],
                        pa.array(list(keys), pa.list_(pa.int64())).take(rows),
                        pa.array([c.tobytes() for c in codes], pa.binary()).take(rows),
                        pa.array(factors).take(rows),
                        pa.array(np.tile(np.arange(tables), len(x)), pa.int32()),
                        pa.array(keys.ravel()),
                    ],
                    names=[*columns, "keys", "code", "factor", "nth", "key"],
                )

    coded = materialise(
        classes.mapInArrow(
            code,
            f"node bigint, copies bigint, label {label_type}, embedding array<double>, d int, "
            "keys array<bigint>, code binary, factor double, nth int, key bigint",
        ),
        "vector-codes",
    )
    bucket = ["label", "d", "nth", "key"]
    counts = materialise(
        coded.groupBy(bucket)
        .agg(F.count("*").alias("members"))
        .where("members > 1")
        .withColumn("blocks", F.expr(f"(members + {BLOCK - 1}) div {BLOCK}")),
        "buckets",
    )
    # Each block meets each block of its bucket; a bucket of any size is split over tasks.
    meetings = (
        coded.join(counts, bucket)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("members", "blocks", "other")
    )
    found = materialise(
        meetings.groupBy(*bucket, "low", "high").applyInArrow(
            _block_links(threshold), "node bigint, links bigint, root bigint"
        ),
        "vector-links",
    )
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = connected_components(
        found.select(F.col("node").alias("a"), F.col("root").alias("b"))
    )
    named = materialise(
        classes.select("node", "copies", "id")
        .join(components, "node", "left")
        .join(sums, "node", "left")
        .select(
            "node",
            "id",
            F.coalesce("component", "node").alias("component"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "vector-components",
    )
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    by_node = materialise(
        named.join(smallest, "component").select("node", "n_links", "component_id"), "vector-results"
    )
    linked = rows.where("node IS NOT NULL").select("id", "node").join(by_node, "node")
    single = rows.where("node IS NULL").select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    both = linked.select("id", "n_links", "component_id").unionAll(single)
    return both.select(
        F.col("id").alias(id_column),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
