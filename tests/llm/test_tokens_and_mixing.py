from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import words
from tokenizers import Tokenizer

from addrloom.llm import mixing, packing, token_output
from addrloom.llm.token_ids import default_tokenizer, texts_ids


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


ODD_TEXTS = [
    None, "", " ", "Don't stop, it's 12:30... (really)!", "ΑΣ ΟΔΟΣ Σ. abc", "á ́x é,", "x<|endoftext|>y <|ENDOFTEXT|> z.",
    "a b c \x1c d\x85e", "\x00a", "İstanbul ﬁ İ.", "日本語。 テスト　x", "a.b. C., ).! 3. é. ..", "KELVIN K.",
]


def test_word_wise_ids_equal_whole_text_ids(tokenizer):
    texts = [*ODD_TEXTS, *[random.Random(k).choice(ODD_TEXTS[3:]) * 3 for k in range(20)]]
    found = dict(texts_ids(default_tokenizer(), pa.array(texts)))
    assert [found[k].tolist() for k in range(len(texts))] == [ids_of(tokenizer, t) for t in texts]


def check_packing(rows, expected_pieces, capacity):
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == expected_pieces
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_pack_documents(spark, documents, no_documents, tricky, tokenizer):
    odd = [(2000 + k, t) for k, t in enumerate(ODD_TEXTS)]
    docs = documents.select("doc_id", "text", "row", "set").unionByName(
        spark.createDataFrame([(*r, "", "") for r in odd], "doc_id bigint, text string, row string, set string")
    )
    expected, total = Counter(), 0
    for i, text in [*[(i, t) for i, _, t in tricky], *odd]:
        ids = np.array(ids_of(tokenizer, text), dtype="<u4")
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected[(i, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    rows = packing.pack_documents(docs).collect()
    used = check_packing(rows, expected, 2048)
    assert used <= -(-total // 2048) + 1
    assert packing.pack_documents(no_documents).count() == 0


def fewest(sizes, capacity):
    """Fewest bins, by trying all ways."""
    best = [len(sizes)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + sizes[k] <= capacity:
                bins[b] += sizes[k]
                place(k + 1, bins)
                bins[b] -= sizes[k]
        place(k + 1, [*bins, sizes[k]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(25))
def test_pack_counts_is_optimal_on_small_cases(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randrange(5, 60) for _ in range(rng.randrange(1, 11))), reverse=True)
    packed = packing.pack_counts(dict(Counter(sizes)), 100)
    held = Counter()
    for bins, filling in packed:
        assert sum(s * n for s, n in filling.items()) <= 100
        held.update({s: n * bins for s, n in filling.items()})
    assert held == Counter(sizes)
    assert sum(bins for bins, _ in packed) == fewest(sizes, 100)


def test_pack_counts_beats_best_fit():
    # Best-fit decreasing needs one more sequence here.
    counts = {6: 2, 5: 2, 4: 2, 3: 2, 2: 2}
    bins = sum(n for n, _ in packing.pack_counts(counts, 10))
    assert bins == 4 <= sum(n for n, _ in packing.best_fit(counts, 10))
    assert packing.pack_counts({}, 10) == []


@pytest.mark.parametrize("total", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_permutation(total):
    slots = token_output.feistel_slots(np.arange(total), total, key=99)
    assert sorted(slots.tolist()) == list(range(total))
    if total >= 1000:
        assert slots.tolist() != token_output.feistel_slots(np.arange(total), total, key=98).tolist()
        assert abs(np.corrcoef(np.arange(total), slots)[0, 1]) < 0.1


def test_training_order_round_trip(documents, no_documents, tricky, tokenizer, tmp_path):
    folder = str(tmp_path / "shards")
    options = {"seq_len": 64, "shard_sequences": 50}
    manifest = token_output.write_training_order(documents, folder, **options)
    rows = manifest.collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    expected = Counter()
    for i, _, text in tricky:
        ids = ids_of(tokenizer, text)
        expected.update((i, k, tuple(ids[s : s + 64])) for k, s in enumerate(range(0, len(ids), 64)))
    shards = {}
    for shard in {r.shard for r in rows}:
        shards[shard] = list(token_output.read_sequences(folder, shard))
        assert len(shards[shard]) == min(50, len(rows) - 50 * shard)
    got = Counter()
    for r in rows:
        ids = shards[r.shard][r.slot % 50]
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        got[(r.doc_id, r.piece, tuple(ids.tolist()))] += 1
    assert got == expected
    # From the middle, and again over what is already there.
    resumed = list(token_output.read_sequences(folder, 0, start=7, count=3))
    assert [x.tolist() for x in resumed] == [x.tolist() for x in shards[0][7:10]]
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "shards").iterdir()}
    assert manifest.count() == len(rows)
    assert before == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "shards").iterdir()}
    assert token_output.write_training_order(no_documents, str(tmp_path / "none")).count() == 0


def test_training_order_of_continuous_sequences(documents, no_documents, tricky, tokenizer, tmp_path):
    """Pieces of a document, put together by number, give its ids; only last sequences are not full."""
    folder = str(tmp_path / "shards")
    options = {"seq_len": 64, "shard_sequences": 20, "continuous": True}
    rows = token_output.write_training_order(documents, folder, **options).collect()
    shards = {s: list(token_output.read_sequences(folder, s)) for s in {r.shard for r in rows}}
    pieces, covered, head = [], Counter(), None
    for r in rows:
        ids = shards[r.shard][r.slot % 20][r.offset : r.offset + r.length]
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        with open(token_output.shard_path(folder, r.shard), "rb") as stream:
            stream.seek(r.byte_offset + 4 + 2 * r.offset)
            assert stream.read(2 * r.length) == ids.tobytes()
        pieces.append((r.doc_id, r.piece, tuple(ids.tolist())))
        covered[r.slot] += r.length
    sizes = Counter(covered.values())
    assert sum(sizes.values()) - sizes[64] <= documents.rdd.getNumPartitions()
    # Ids are shared by rows, so whole texts are put together greedily from pieces of one id.
    whole = Counter()
    for i, _, text in tricky:
        whole[i] += len(ids_of(tokenizer, text))
    held = Counter()
    for i, _, ids in pieces:
        held[i] += len(ids)
    assert held == whole
    alone = Counter(i for i, _, _ in tricky)
    for i, _, text in tricky:
        if alone[i] == 1:
            own = sorted((p, ids) for j, p, ids in pieces if j == i)
            assert [x for _, ids in own for x in ids] == ids_of(tokenizer, text)
            assert [p for p, _ in own] == list(range(len(own)))
    assert token_output.write_training_order(no_documents, str(tmp_path / "none"), continuous=True).count() == 0


def test_another_table_into_the_same_folder(spark, tokenizer, tmp_path):
    """Shards of the same size with other content are replaced, surplus ones and left-overs removed."""
    folder, options = tmp_path / "shards", {"seq_len": 16, "shard_sequences": 8}
    tables = [[(i, f"{word} {i}") for i in range(n)] for word, n in (("red", 40), ("sea", 40), ("sky", 20))]
    for rows in tables:
        folder.mkdir(exist_ok=True)
        (folder / "_writing-00000001-lost").write_bytes(b"part")
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        manifest = token_output.write_training_order(docs, str(folder), **options).collect()
        texts = dict(rows)
        for r in manifest:
            found = list(token_output.read_sequences(str(folder), r.shard))[r.slot % 8]
            assert found.tolist() == ids_of(tokenizer, texts[r.doc_id])
        names = {p.name for p in folder.iterdir() if not p.name.startswith(".")}
        assert names == {f"shard-{k:08d}.bin" for k in range(-(-len(rows) // 8))}


def filled(sizes):
    """Targets by repeated sharing, as a plain loop."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, target, left = 1.5 * sum(sizes.values()), {}, set(order)
    while left:
        rest, all_weights = total - sum(target.values()), sum(weight[s] for s in left)
        over = [s for s in left if rest * weight[s] / all_weights > 2 * sizes[s]]
        if not over:
            target.update({s: rest * weight[s] / all_weights for s in left})
            break
        target.update({s: 2 * sizes[s] for s in over})
        left -= set(over)
    return target


def test_taken_words(documents, no_documents, tricky):
    rows = mixing.taken_words(documents.drop("row").withColumnRenamed("taken", "size")).collect()
    sizes, expected = Counter(), Counter()
    for i, s, t in tricky:
        sizes[s] += len(words(t))
        expected[(i, len(words(t)))] += 1
    assert Counter((r.doc_id, r["size"]) for r in rows) == expected
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    target = filled(sizes)
    source_of = {(i, len(words(t))): s for i, s, t in tricky}
    taken, wanted = Counter(), {}
    for r in rows:
        s = source_of[(r.doc_id, r["size"])]
        taken[s] += r.taken
        wanted[s] = r.target
        assert r.source_size == sizes[s]
    for s, t in target.items():
        assert wanted[s] == pytest.approx(t)
        assert abs(taken[s] - t) <= 0.51
    again = mixing.taken_words(documents).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in rows)
    assert mixing.taken_words(no_documents).count() == 0


def test_mixed_documents(documents, no_documents, tricky):
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == documents.columns
    rows = mixed.collect()
    whole = Counter((i, tuple(words(t))) for i, _, t in tricky)
    by_id = defaultdict(list)
    for i, _, t in tricky:
        by_id[i].append(words(t))
    got, sizes = Counter(), Counter()
    for _, s, t in tricky:
        sizes[s] += len(words(t))
    for r in rows:
        own = words(r.text)
        got[r.source] += len(own)
        # The words taken appear in order in a text of the row's id.
        assert any(in_order(own, t) for t in by_id[r.doc_id])
        assert r["row"] == "row" and r["content"] == "content"
    for s, t in filled(sizes).items():
        assert abs(got[s] - t) <= 0.51
    assert sum(1 for r in rows if not words(r.text)) == sum(n for (_, w), n in whole.items() if not w)
    assert mixing.mixed_documents(no_documents).count() == 0


def in_order(part, text):
    rest = iter(text)
    return all(any(x == y for y in rest) for x in part)


@pytest.mark.parametrize("n", [1, 2, 7, 100])
def test_permutation_and_its_inverse(spark, n):
    rows = (
        spark.range(n)
        .selectExpr("id AS x", f"CAST({n} AS BIGINT) AS n", "CAST(5 AS BIGINT) AS seed")
        .withColumn("y", mixing.permuted("x", "n", "seed"))
        .withColumn("back", mixing.permuted("y", "n", "seed", inverse=True))
        .collect()
    )
    assert sorted(r.y for r in rows) == list(range(n))
    assert all(r.back == r.x for r in rows)


def test_mixing_is_native(documents):
    plan = mixing.taken_words(documents)._jdf.queryExecution().toString()
    assert not any(name in plan for name in ("Python", "Pandas", "Arrow"))
