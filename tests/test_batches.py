from __future__ import annotations

import random

import numpy as np
import pytest

from addrloom.operators.batches import batch_ends, chain_steps, unique_batches


def loop(keys, limit):
    """(batch, kept) of each row, one row after the other."""
    seen, batch, out = set(), 0, []
    for k in keys:
        new = k not in seen
        out.append((batch, new))
        if new:
            seen.add(k)
            if len(seen) >= limit:
                batch += 1
                seen = set()
    return out


def stream(kind, n, rng):
    if kind == "few":
        return [f"k{rng.randrange(9)}" for _ in range(n)]
    if kind == "hot":
        return ["hot" if i % 3 == 0 else f"k{rng.randrange(400)}" for i in range(n)]
    if kind == "late":
        # Too few keys for a batch over many chunks, then all new ones.
        return [f"k{i % 7}" if i < n * 3 // 4 else f"n{i}" for i in range(n)]
    if kind == "unique":
        return [f"k{i}" for i in range(n)]
    return [None if rng.random() < 0.05 else f"k{int(rng.paretovariate(0.6))}" for _ in range(n)]


KINDS = ["few", "hot", "late", "unique", "heavy"]


@pytest.mark.parametrize("limit,chunk_rows", [(10, 32), (25, 8), (7, 1000), (1, 16)])
def test_against_the_loop(spark, limit, chunk_rows):
    rng = random.Random(limit)
    rows = []
    for job, kind in enumerate(KINDS):
        keys = stream(kind, 300, rng)
        rows += [(f"j{job}", 3 * i, k, "x") for i, k in enumerate(keys)]
    rows.append(("one", 5, "k", "x"))
    df = spark.createDataFrame(rows, "job_id string, line_id bigint, address_norm string, _note string")
    found = unique_batches(
        df.repartition(4), position="line_id", batch_rows=limit, chunk_rows=chunk_rows, least_rows=1
    )
    assert found.columns == [*df.columns, "batch_id", "kept"]
    got = {(r.job_id, r.line_id): (r.batch_id, r.kept) for r in found.collect()}
    assert len(got) == len(rows)
    for job in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == job]
        assert [got[job, r[1]] for r in own] == loop([r[2] for r in own], limit), job


def test_over_all_jobs_and_no_rows(spark):
    rng = random.Random(0)
    keys = stream("heavy", 500, rng)
    df = spark.createDataFrame(
        [(i, f"j{i % 3}", k) for i, k in enumerate(keys)], "line_id bigint, job_id string, address_norm string"
    )
    found = unique_batches(df, job=None, position="line_id", batch_rows=12, chunk_rows=40, least_rows=1)
    got = {r.line_id: (r.batch_id, r.kept) for r in found.collect()}
    assert [got[i] for i in range(500)] == loop(keys, 12)
    assert unique_batches(df.limit(0), position="line_id").count() == 0


def test_least_batch(spark):
    df = spark.createDataFrame([(i, "j", f"k{i}") for i in range(1500)], "line_id bigint, job_id string, address_norm string")
    found = unique_batches(df, position="line_id", batch_rows=5)
    assert {(r.line_id // 1000 == r.batch_id) for r in found.collect()} == {True}


def test_sweep_and_chain():
    rng = random.Random(3)
    codes = [rng.randrange(12) for _ in range(200)]
    previous = [max([j for j in range(i) if codes[j] == codes[i]], default=-1) for i in range(200)]
    ends = batch_ends(np.array(previous), 150, 5)
    for s in range(150):
        seen, wanted = set(), -1
        for i in range(s, 200):
            seen.add(codes[i])
            if len(seen) == 5:
                wanted = i + 1
                break
        assert ends[s] == wanted
    leave, steps, last = chain_steps(ends)
    for s in range(150):
        at, n, start = s, 0, s
        while True:
            start, at, n = at, ends[at], n + 1
            if at == -1 or at >= 150:
                break
        assert (leave[s], steps[s], last[s]) == (at, n, start)
