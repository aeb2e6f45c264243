from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

from addrloom.llm import content_sort, line_dedup


def groups(tricky):
    by_text = defaultdict(list)
    for i, _, t in tricky:
        by_text[t or ""].append(i)
    return by_text


@pytest.mark.parametrize("keep,aqe", [("largest", "true"), ("smallest", "false")])
def test_duplicate_groups(spark, documents, tricky, keep, aqe):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    # Without adaptive execution there are as many partitions as set, and groups over their edges.
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        rows = content_sort.duplicate_groups(documents, keep=keep).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    best = max if keep == "largest" else min
    expected, kept = Counter(), 0
    for text, ids in groups(tricky).items():
        known = [i for i in ids if i is not None]
        stays = best(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected.update((i, stays, len(ids), sha) for i in ids)
        kept += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == expected
    assert sum(r.kept for r in rows) == kept
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_groups_over_many_partitions(spark):
    rows = [(i, "same" if i % 3 else f"text {i % 11}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(7)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = content_sort.duplicate_groups(docs).collect()
        kept = content_sort.drop_duplicates(docs).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = Counter(t for _, t in rows)
    first = {}
    for i, t in rows:
        first.setdefault(t, i)
    text = dict(rows)
    assert all(r.group_size == sizes[text[r.doc_id]] and r.keep_id == first[text[r.doc_id]] for r in found)
    assert sorted(r.doc_id for r in found if r.kept) == sorted(first.values())
    assert sorted(r.doc_id for r in kept) == sorted(first.values())


def test_drop_duplicates_keeps_all_columns(documents, no_documents, tricky):
    kept = content_sort.drop_duplicates(documents)
    assert kept.columns == documents.columns
    rows = kept.collect()
    assert len(rows) == len(groups(tricky))
    assert all(r["content"] == "content" and r["row"] == "row" for r in rows)
    assert content_sort.drop_duplicates(no_documents).count() == 0
    assert content_sort.duplicate_groups(no_documents).count() == 0


def test_lines(spark, documents, no_documents, tricky):
    # Besides the given rows: a line on 5 sites, one on 4, one repeated on a single site.
    extra = [(1000 + k, f"site{k}", f"five\nown {k}\n{'four' if k else 'x'}\n\nonce\n") for k in range(5)]
    extra += [(1010, None, "six\n"), (1011, "q", None)] + [(1020 + k, f"t{k}", "six") for k in range(30)]
    docs = documents.select("doc_id", "source", "text", "id", "key").unionByName(
        spark.createDataFrame(
            [(*r, "a", "b") for r in extra], "doc_id bigint, source string, text string, id string, key string"
        )
    )
    everything = [*tricky, *extra]
    sites = defaultdict(set)
    for _, s, t in everything:
        for line in (t or "").split("\n"):
            if line.strip(" "):
                sites[line].add(s)
    expected = Counter()
    for i, _, t in everything:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(sites.get(x, ())) < 5]
        expected[(i, len(lines) if t else 0, len(lines) - len(kept), "\n".join(kept))] += 1
    found = line_dedup.remove_common_lines(docs).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.kept_text) for r in found) == expected
    assert line_dedup.remove_common_lines(no_documents).count() == 0


def test_line_estimates(spark):
    rows = [(line, f"site {k}") for line, n in enumerate([1, 3, 40, 400, 4000]) for k in range(n)]
    lines = spark.createDataFrame(rows + rows[:500], "line int, site string")
    registers = line_dedup.sketch_registers(lines)
    found = {r.line: r.sites for r in line_dedup.estimates(registers).collect()}
    for line, n in enumerate([1, 3, 40, 400, 4000]):
        assert abs(found[line] - n) <= 4 * line_dedup.ERROR * n + 1


def test_lines_on_sites_that_share_registers(spark):
    """src17 and src24 share a register, and so do src26 and src47: five sites in three registers."""
    five = [f"src{k}" for k in (17, 24, 26, 47, 1)]
    lines = [(1, s) for s in five] + [(2, s) for s in five[:4] * 9] + [(3, "src1")] * 40
    lines += [(4, f"s{k}") for k in range(60)]
    frame = spark.createDataFrame(lines, "line bigint, site string")
    used = {r.line: r.used for r in line_dedup.estimates(line_dedup.sketch_registers(frame)).collect()}
    assert used[1] == 3
    assert {r.line for r in line_dedup.common_lines(frame, 5).collect()} == {1, 4}
    # A sketch of 256 registers proves nothing about larger thresholds.
    many = spark.range(4 * 299).selectExpr("id % 4 AS line", "concat('m', id div 4) AS site")
    many = many.where("line = 0 OR site <> 'm0'").unionAll(many.where("line = 1 AND site = 'm1'"))
    assert {r.line for r in line_dedup.common_lines(many, 299).collect()} == {0}
