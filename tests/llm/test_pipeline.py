from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from llm_cases import sentence as numbered
from llm_cases import words
from pyspark.sql import functions as F
from test_similarity import expected_classes
from test_tokens_and_mixing import check_packing, filled, ids_of, tokenizer  # noqa: F401

import __spark_entry__

LETTERS = str.maketrans("0123456789", "abcdefghij")


def sentence(rng: random.Random, n: int) -> str:
    """Words of letters, as the toxicity grammar tells words by letters."""
    return numbered(rng, n).translate(LETTERS)


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean and toxic texts, exact and near copies, and empty ones, with labels for most."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(420):
        text = sentence(rng, rng.randrange(20, 80))
        if i % 6 == 0:
            parts = text.split()
            for _ in range(3):
                parts.insert(rng.randrange(len(parts)), rng.choice(["grunkle", "spleeny"]))
            text = " ".join(parts)
        rows.append((i, text, f"s{i % 5}"))
        if i % 5:
            labels.append((i, int(i % 6 == 0)))
    base = sentence(rng, 150)
    rows += [(500 + k, rows[k * 7 + 1][1], "s1") for k in range(30)]
    rows += [(600 + k, base + f" end {k}", None) for k in range(12)]
    rows += [(700, None, "s0"), (701, "", "s0"), (702, sentence(rng, 9_000), "s2")]
    folder = tmp_path_factory.mktemp("corpus")
    documents = [(i, t, None, s, len(t or "")) for i, t, s in rows]
    spark.createDataFrame(documents, DOCUMENTS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows


def test_stages_against_plain_versions(spark, corpus, tokenizer, tmp_path):  # noqa: F811
    folder, rows = corpus
    docs, outputs = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        outputs[name] = docs.collect()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    toxic = {i for i, t, _ in rows if {"grunkle", "spleeny"} & set((t or "").split())}
    kept = {i: (s, t) for i, t, s in rows if i not in toxic}
    assert {r.doc_id for r in outputs["toxicity"]} == set(kept)

    first = {}
    for i in sorted(kept):
        first.setdefault(kept[i][1] or "", i)
    kept = {i: kept[i] for i in first.values()}
    assert {r.doc_id for r in outputs["exact dedup"]} == set(kept)

    classes = expected_classes([(i, s, t) for i, (s, t) in kept.items()])
    kept = {i: kept[i] for i, _, c in classes if i == c}
    near = outputs["n-gram Jaccard join"]
    assert {(r.doc_id, r.text) for r in near} == {(i, t) for i, (_, t) in kept.items()}

    sizes, mixed = Counter(), Counter()
    for s, t in kept.values():
        sizes[s] += len(words(t))
    for r in outputs["mixing"]:
        mixed[r.source] += len(words(r.text))
        assert r.n_chars == len(r.text or "") and set(words(r.text)) <= set(words(kept[r.doc_id][1]))
    for s, target in filled(sizes).items():
        assert abs(mixed[s] - target) <= 0.51

    pieces, total = Counter(), 0
    for r in outputs["mixing"]:
        ids = np.array(ids_of(tokenizer, r.text), dtype="<u4")
        total += len(ids)
        import zlib

        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            pieces[(r.doc_id, piece, start, len(part), zlib.crc32(part.tobytes()))] += 1
    used = check_packing(outputs["best-fit packing"], pieces, 2048)
    assert used <= -(-total // 2048) + 1


def test_run_applies_all_stages(spark, corpus):
    folder, _ = corpus
    rows = corpus_pipeline.run(spark, folder)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    by_sequence = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert by_sequence.where("n > 2048").count() == 0 and rows.count() > 0


def test_registered_queries():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert {"op1_line_dedup", "op8_exact_dedup", "op9_mixing"} <= set(__spark_entry__.oracle_sql())
