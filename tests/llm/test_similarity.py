from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
from llm_cases import Components, sentence, words

from addrloom.llm import embedding_dedup, ngram_join, substring_dedup
from addrloom.llm.components import connected_components
from addrloom.llm.fm_index import FmIndex


def shingles(text):
    w = words(text, lower=True)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def expected_classes(rows):
    """Class of each row index by brute force over all pairs."""
    sets = [shingles(t) for _, _, t in rows]
    parts = Components(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    parts.link(a, b)
    ids = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            root = parts.find(k)
            ids[root] = min(ids.get(root, i), i)
    return [
        (i, len(sets[k]), ids.get(parts.find(k)) if sets[k] else i) for k, (i, _, _) in enumerate(rows)
    ]


def test_ngram_classes(documents, no_documents, tricky):
    found = ngram_join.ngram_classes(documents).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(
        expected_classes(tricky)
    )
    assert ngram_join.ngram_classes(no_documents).count() == 0


def test_ngram_chain_without_a_common_start(spark):
    """Neighbours in a chain link, its ends do not; and a star whose centre is not the smallest."""
    rng = random.Random(3)
    chain = sentence(rng, 100).split()
    rows = []
    for k in range(12):
        chain = chain[4:] + sentence(rng, 4).split()
        rows.append((k, None, " ".join(chain)))
    centre = sentence(rng, 100).split()
    for k in range(40):
        own = list(centre)
        own[rng.randrange(0, 50)], own[rng.randrange(50, 100)] = f"n{k}", f"m{k}"
        rows.append((100 + k, None, " ".join(own)))
    rows.append((500, None, " ".join(centre)))
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.ngram_classes(docs).collect()}
    assert found == {i: c for i, _, c in expected_classes(rows)}


def test_ngram_groups_of_many_blocks(spark, monkeypatch):
    """The second meeting alone: small blocks, chains in which only neighbours link, one passage in all."""
    rng = random.Random(8)
    passage, rows = sentence(rng, 30), []
    for chain in range(3):
        own = sentence(rng, 70).split()
        for k in range(24):
            rows.append((100 * chain + k, None, " ".join(own) + " " + passage))
            own = own[3:] + sentence(rng, 3).split()
    rows += [(900 + k, None, sentence(rng, rng.choice([5, 20])) + " " + passage) for k in range(20)]
    rng.shuffle(rows)
    # As if no tree had shown a link: all must come from the walk through blocks.
    monkeypatch.setattr(ngram_join, "TREE_SETS", 1)
    monkeypatch.setattr(
        ngram_join, "_join_by_head", lambda *_: spark.createDataFrame([], "a bigint, b bigint")
    )
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in ngram_join.ngram_classes(docs).collect()}
    assert found == {i: c for i, _, c in expected_classes(rows)}


def test_one_per_class(documents, no_documents, tricky):
    kept = ngram_join.one_per_class(documents)
    assert kept.columns == documents.columns
    expected = Counter(i for i, _, c in expected_classes(tricky) if i == c)
    # A row with the id of another, dropped, row goes with it.
    dropped = {i for i, _, c in expected_classes(tricky) if i != c}
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        {i: n for i, n in expected.items() if i not in dropped}
    )
    assert ngram_join.one_per_class(no_documents).count() == 0


def test_one_per_class_with_null_and_repeated_ids(spark):
    """Each class keeps one row, whatever ids its rows share with others."""
    rng = random.Random(6)
    a, b, c, d, e = (sentence(rng, 60) for _ in range(5))
    rows = [
        (0, 1, a), (1, None, a + " tail"), (2, None, b), (3, None, c), (4, None, c + " end"),
        (5, 7, d), (6, 1, d + " more"), (7, 9, e), (8, 9, e), (9, None, None), (10, 9, ""), (11, None, ""),
        (12, 1, sentence(rng, 60)),
    ]
    docs = spark.createDataFrame(rows, "row bigint, doc_id bigint, text string").repartition(4)
    kept = ngram_join.one_per_class(docs).collect()
    labels = Counter(r.row for r in kept)
    assert max(labels.values()) == 1
    assert len(labels & Counter([3, 4])) == len(labels & Counter([7, 8])) == 1
    assert set(labels) - {3, 4, 7, 8} == {0, 2, 6, 9, 10, 11, 12}


def test_prefix_tree_against_all_pairs():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 10_000, 300).astype(np.uint64))
    sets = []
    for _ in range(60):
        keep = base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.3])]
        sets.append(np.unique(np.append(keep, rng.integers(0, 10_000, 10).astype(np.uint64))))
    tree = ngram_join.PrefixTree()
    for k, s in enumerate(sets):
        expected = {
            j
            for j in range(k)
            if ngram_join.linked(len(np.intersect1d(s, sets[j])), len(s), len(sets[j]))
        }
        assert set(tree.probe(s)) == expected
        tree.insert(k, s)


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(k, k + 1) for k in range(1000, 1040)] + [(7, 7)]
    parts = Components({n for link in links for n in link})
    for a, b in links:
        parts.link(a, b)
    found = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in found} == {n: parts.find(n) for n in linked}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def expected_removals(rows):
    low = {}
    for i, _, t in rows:
        w = words(t)
        if i is not None:
            for k in range(len(w) - 12):
                key = tuple(w[k : k + 13])
                low[key] = min(low.get(key, i), i)
    out = Counter()
    for i, _, t in rows:
        w = words(t)
        keep = [True] * len(w)
        if i is not None:
            for k in range(len(w) - 12):
                if low[tuple(w[k : k + 13])] < i:
                    keep[k : k + 13] = [False] * 13
        left = [x for x, y in zip(w, keep, strict=True) if y]
        out[(i, len(w), len(w) - len(left), hashlib.sha256(b" ".join(left)).hexdigest())] += 1
    return out


def test_substrings(spark, documents, no_documents, tricky):
    loop = [(900, None, "a b " * 40), (901, None, "b a " * 30 + "c"), (902, None, "a " * 13), (903, None, "a " * 12)]
    docs = documents.select("doc_id", "text", "key", "row").unionByName(
        spark.createDataFrame([(i, t, "", "") for i, _, t in loop], "doc_id bigint, text string, key string, row string")
    )
    found = substring_dedup.remove_repeats(docs).collect()
    assert Counter(
        (r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found
    ) == expected_removals([*tricky, *loop])
    assert substring_dedup.remove_repeats(no_documents).count() == 0


def test_fm_index_counts():
    rng = np.random.default_rng(4)
    sizes = rng.integers(6, 30, 80)
    text = rng.integers(0, 4, sizes.sum()).astype(np.uint32)
    index = FmIndex(text, sizes, depth=5)
    cuts = np.cumsum(sizes)[:-1]
    pieces = np.split(text, cuts)
    grams = Counter(tuple(p[i : i + 5]) for p in pieces for i in range(len(p) - 4))
    begins = np.cumsum(sizes + 1) - sizes - 1
    for k, piece in enumerate(pieces):
        ends = begins[k] + np.arange(5, len(piece) + 1)
        low, high, size = index.matches(ends, 5)
        for j in range(len(ends)):
            n = grams[tuple(piece[j : j + 5])]
            assert (size[j] == 5) == (n > 1)
            if n > 1:
                assert high[j] - low[j] == n


def vectors():
    rng = np.random.default_rng(9)
    rows = []
    base = rng.normal(size=(60, 24))
    for k in range(400):
        v = base[k % 60] + rng.normal(size=24) * rng.choice([0.0, 0.08, 0.2, 0.5])
        rows.append((k, [float(x) for x in v], [1, 1, 2, None][k % 4]))
    rows += [
        (1000, None, 1), (1001, [], 1), (1002, [0.0] * 24, 1), (1003, [math.nan] * 24, 1),
        (1004, [math.inf] + [1.0] * 23, 1), (1005, [None] + [1.0] * 23, 1), (None, rows[0][1], 1),
        (1, rows[1][1], rows[1][2]), (1006, rows[0][1][:12], 1), (1007, [2 * x for x in rows[0][1]], 1),
    ]
    return rows


def test_embeddings(spark):
    rows = vectors()
    frame = spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "vec_id bigint, embedding array<double>, label int, node string, id string"
    )
    found = embedding_dedup.embedding_classes(frame).collect()
    parts, links = Components(range(len(rows))), Counter()
    usable = [
        lab is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for _, v, lab in rows
    ]
    for a in range(len(rows)):
        for b in range(a):
            p, q = rows[a], rows[b]
            if usable[a] and usable[b] and p[2] == q[2] and len(p[1]) == len(q[1]):
                x, y = np.array(p[1]), np.array(q[1])
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                    parts.link(a, b)
                    links.update([a, b])
    ids = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            ids[parts.find(k)] = min(ids.get(parts.find(k), i), i)
    expected = Counter((r[0], links[k], ids.get(parts.find(k))) for k, r in enumerate(rows))
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in found)
    assert got == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert embedding_dedup.embedding_classes(frame.limit(0)).count() == 0


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + rng.normal(size=x.shape) * 0.02
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    codes, factors = embedding_dedup.encode(x)
    rotated = embedding_dedup.rotate(y, embedding_dedup.SEED)
    signs = (np.unpackbits(codes, axis=1) * 2.0 - 1) / 8
    estimate = np.einsum("ij,ij->i", signs, rotated) / factors
    assert abs((estimate - np.einsum("ij,ij->i", x, y)).mean()) < 0.01
    near = np.einsum("ij,ij->i", x, y) >= 0.98
    assert embedding_dedup.may_link(codes, factors, y, 0.98).diagonal()[near].all()
    assert np.allclose(np.linalg.norm(rotated, axis=1), 1)


def test_words_with_half_a_digest_in_common(spark):
    """Texts that differ in one word stay whole, also where the words' digests are half the same."""
    from addrloom.llm.words import chunk_keys

    names = [f"v{k}" for k in range(300_000)]
    data = " ".join(names).encode()
    keys, _ = chunk_keys(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]), lower=False)
    rows, k = [], 0
    for half in (keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)):
        order = np.argsort(half, kind="stable")
        same = np.flatnonzero(half[order[1:]] == half[order[:-1]])
        for at in same[:4].tolist():
            start = " ".join(f"t{k}w{i}" for i in range(12))
            rows += [(2 * k, f"{start} {names[order[at]]}"), (2 * k + 1, f"{start} {names[order[at + 1]]}")]
            k += 1
    rows += [(1000, rows[0][1]), (1001, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs).collect()}
    assert found == {i: 13 * (i >= 1000) for i, _ in rows}


def test_links_of_very_long_and_very_short_vectors(spark):
    base = [0.3, -0.4, 0.5, 0.1]
    rows = [(k, [x * s for x in base], 1) for k, s in enumerate([1.0, 1e200, 1e-200, 5e307, 1e-300, -1.0])]
    rows += [(10, [1e200, 2e200, 0.0, 1.0], 2), (11, [1e200, 2e200, 0.0, 2.0], 2), (12, [1.0, 2.0, 0.0, 0.0], 2)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_classes(vectors).collect()}
    assert found == {**{k: (4, 0) for k in range(5)}, 5: (0, 5), **{k: (2, 10) for k in (10, 11, 12)}}


def test_substrings_keep_one_copy_of_the_runs_on_disk(spark, tricky):
    """The runs are read off the kept texts, not written beside them; the texts are kept compressed."""
    import glob

    import pyarrow.parquet as pq

    from addrloom.session import shared_root

    loop = [(900 + k, f"{'x y z ' * 9} tail{k} " + "p q r s t u v w " * 3) for k in range(6)]
    docs = spark.createDataFrame(loop, "doc_id bigint, text string")
    root = shared_root(spark) + "/addrloom"
    before = set(glob.glob(root + "/*"))
    found = substring_dedup.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == expected_removals(
        [(i, None, t) for i, t in loop]
    )
    made = set(glob.glob(root + "/*")) - before
    assert not [p for p in made if p.rsplit("/", 1)[1].startswith("runs-")]
    texts = [p for p in made if p.rsplit("/", 1)[1].startswith("open-texts-")]
    assert len(texts) == 1
    parts = glob.glob(texts[0] + "/*.parquet")
    assert parts and all(
        pq.ParquetFile(p).metadata.row_group(0).column(0).compression == "ZSTD"
        for p in parts
        if pq.ParquetFile(p).metadata.num_row_groups
    )
