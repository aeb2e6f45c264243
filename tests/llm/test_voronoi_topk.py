from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from addrloom.llm import voronoi_topk
from addrloom.llm.voronoi_topk import top_products

SCHEMA = "vec_id bigint, embedding array<double>, label int, row string, cell string, vector string"


def as_whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [max(-(2**63), min(2**63 - 1, math.floor(1024 * x) if abs(x) < 1e300 else int(x) * 1024)) for x in v]


def expected(rows, k=10, every=100):
    points = [(i, w) for i, v in rows if (w := as_whole(v)) is not None]
    out = []
    for at, (q, x) in enumerate(points):
        if q is None or q % every:
            continue
        scored = []
        for other, (i, y) in enumerate(points):
            if other != at:
                score = sum(a * b for a, b in zip(x, y))
                score = max(-(2**63) + 1, min(2**63 - 1, score))
                scored.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(scored)[:k], 1):
            out.append((q, rank, None if none else i, -score))
    return Counter(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "r", "c", "v") for i, v in rows], SCHEMA).repartition(4)


def clustered(rng, n, d, spread):
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    return [
        (i, [c + rng.gauss(0, spread) for c in centres[0 if i % 3 == 0 else rng.randrange(6)]])
        for i in range(n)
    ]


@pytest.mark.parametrize(
    "options",
    [{}, {"query_block": 3, "data_numbers": 800}, {"max_pivots": 1}, {"k": 3, "query_block": 7}],
)
@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_against_brute_force(spark, options, spread):
    rows = clustered(random.Random(2), 700, 8, spread)
    found = top_products(frame(spark, rows), F.col("vec_id") % 10 == 0, **options)
    assert Counter(map(tuple, found.collect())) == expected(rows, options.get("k", 10), 10)


def test_copies_ties_nulls_and_odd_vectors(spark):
    rng = random.Random(4)
    same = [rng.gauss(0, 1) for _ in range(5)]
    rows = [(i, list(same)) for i in range(0, 300)]
    rows += [(100, list(same)), (100, None), (None, list(same)), (None, [1.0]), (200, [0.0] * 5)]
    rows += [(400, [math.nan] * 5), (401, [1.0, None]), (402, [math.inf, 0.0]), (403, []), (500, [])]
    rows += [(600, [1.0, 2.0]), (601, [-3.0, 2.0, 1.0, 0.5]), (700, [0.0] * 5)]
    rows += [(800 + i, [float(i % 3), 1.0, 0.0, -1.0, 0.25]) for i in range(120)]
    found = top_products(frame(spark, rows), F.col("vec_id") % 100 == 0, data_numbers=200)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, found.collect())) == expected(rows)


def test_numbers_beyond_64_bits(spark):
    big = [(0, [1e300, 1.0]), (1, [1e300, 2.0]), (2, [-1e300, 0.0]), (100, [3e9, 3e9]), (3, [4e9, -4e9])]
    big += [(200, [-2.5, 1e7]), (4, [0.1, 0.2])]
    found = top_products(frame(spark, big), F.col("vec_id") % 100 == 0)
    assert Counter(map(tuple, found.collect())) == expected(big)


def test_empty_tables(spark):
    none = frame(spark, [(1, [1.0])]).limit(0)
    assert top_products(none, F.col("vec_id") % 100 == 0).count() == 0
    one = frame(spark, [(0, [1.0])])
    assert top_products(one, F.col("vec_id") % 100 == 0).count() == 0
    unasked = frame(spark, [(1, [1.0]), (2, None)])
    assert top_products(unasked, F.col("vec_id") % 100 == 0).count() == 0


def test_bounds_prune_but_never_wrongly():
    """Distant groups are not sent to, and every vector among a query's best is."""
    rng = np.random.default_rng(1)
    centres = np.array([[4000.0, 0, 0], [0, 4000.0, 0], [0, 0, 4000.0]])
    data = np.concatenate([c + rng.normal(0, 50, (200, 3)) for c in centres]).astype(np.int64)
    queries = data[::10]
    cell, far = voronoi_topk.nearest(queries, centres)
    scores = voronoi_topk.products(queries, data)
    reach = voronoi_topk.kth_score(scores, 11)
    summaries = [
        {
            "cell": c,
            "queries": int((cell == c).sum()),
            "radius": far[cell == c].max(),
            "norm": np.linalg.norm(queries[cell == c], axis=1).max(),
            "reach": reach[cell == c].min(),
        }
        for c in range(3)
    ]
    groups = voronoi_topk.Groups(centres, summaries, 4096)
    needed = groups.needs(data)
    assert needed.sum() <= 600
    for g, c in enumerate(groups.cells):
        best = (scores[cell == c] >= reach[cell == c][:, None]).any(axis=0)
        assert needed[best, g].all()


def test_groups_share_or_split_blocks():
    sizes = [5, 1, 1, 9, 2]
    summaries = [
        {"cell": c, "queries": n, "radius": 1.0, "norm": 1.0, "reach": 0.0} for c, n in enumerate(sizes)
    ]
    pivots = np.array([[float(c)] for c in range(5)]) + 1
    groups = voronoi_topk.Groups(pivots, summaries, 4)
    assert groups.block_count == max(f + b for f, b in zip(groups.first_block, groups.blocks))
    assert list(groups.blocks) == [2, 1, 1, 3, 1]
    assert list(groups.first_block) == [0, 2, 2, 3, 6]
