from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import words
from pyspark.sql import functions as F

from addrloom.llm import gated_lm, toxicity

INSULTS = ["blorgo", "snarfle", "quenched"]


@pytest.fixture(scope="module")
def labelled(spark):
    """Texts of common words; toxic ones hold two insults, or words with a stem of their own."""
    rng = random.Random(8)
    common = [f"{a}{b}" for a in ("ta", "mo", "li", "re") for b in ("n", "r", "st", "lo", "ke")]
    docs, labels = [], []
    for i in range(700):
        toxic = i % 7 == 0
        text = [rng.choice(common) for _ in range(rng.randrange(10, 60))]
        if toxic:
            for _ in range(2):
                word = rng.choice(INSULTS) if i % 2 else "zwibb" + rng.choice(["a", "ung", "on", "erst", "ik"])
                text.insert(rng.randrange(len(text)), word)
        docs.append((i, " ".join(text).capitalize() + ".", "x", "y"))
        if i % 3:
            labels.append((i, int(toxic)))
    docs += [(None, None, "x", "y"), (9000, "", "x", "y"), (9001, "ta mo " * 50_000 + "blorgo snarfle.", "x", "y")]
    labels += [(None, 1), (9000, None), (9000, 5), (1, 0), (424242, 1)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, score string, row string"),
        spark.createDataFrame(labels, "doc_id bigint, toxic int"),
    )


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    usable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    scores = {r.doc_id: r.score for r in toxicity.score_documents(docs, labels, usable=usable).collect()}
    assert len(scores) == docs.count()
    assert all(0 <= s <= 1 for s in scores.values())
    held = [i for i in range(700) if zlib.crc32(str(i).encode()) % 5 == 0]
    wrong = [i for i in held if (scores[i] >= 0.5) != (i % 7 == 0)]
    assert len(wrong) <= 0.02 * len(held)
    assert scores[None] < 0.5 and scores[9000] < 0.5 and scores[9001] >= 0.5


def test_toxicity_keeps_columns_and_clean_rows(labelled):
    docs, labels = labelled
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    clean = {i for i in range(700) if i % 7}
    assert len(clean - set(ids)) <= 5 and len(set(ids) - clean - {None, 9000}) <= 3
    assert toxicity.accepted(docs.limit(0), labels).count() == 0
    unlabelled = toxicity.score_documents(docs, labels.limit(0)).collect()
    assert len(unlabelled) == docs.count() and all(r.score == 0 for r in unlabelled)


def test_grammar_composition():
    lexicon = {"fool": 2.0, "scoundr*": 3.0}

    def kinds(text):
        found, targeted = toxicity.clause_matches(text.split(), lexicon)
        return [(toxicity.KINDS[k], w) for _, k, w in found], targeted

    assert kinds("you are a fool") == ([("plain", 2.0)], True)
    assert kinds("you are not a fool") == ([("negated", 2.0)], True)
    assert kinds("not one two three fool") == ([("plain", 2.0)], False)
    assert kinds("he said you fool and scoundrels") == ([("reported", 2.0), ("reported", 3.0)], True)
    assert kinds("a nice day") == ([], False)
    assert toxicity.clause_matches(["kill"], lexicon)[0][0][0] == toxicity.THREAT


def test_clause_features_follow_the_grammar():
    lexicon = {"fool": 2.0, "scoundr*": 3.0}
    reader = toxicity.ClauseReader(lexicon)
    import pyarrow as pa

    x = reader.of_column(pa.array(["Fool! A day, you scoundrelly one.", None, "fool", "a" * 10_000, "foolish"]))
    named = dict(zip(toxicity.FEATURES, x[0], strict=True))
    assert named["insult_plain"] == pytest.approx(math.log1p(5))
    assert named["targeted"] == pytest.approx(math.log1p(3))
    assert named["clauses"] == pytest.approx(math.log1p(2))
    assert not x[1].any() and x[2].any() and not x[3].any() and not x[4].any()


# --- language model ---------------------------------------------------------------------------------------------


def numeric_gradient(loss, params, name, at, step=1e-3):
    saved = params[name][at]
    params[name][at] = saved + step
    high = loss()
    params[name][at] = saved - step
    low = loss()
    params[name][at] = saved
    return (high - low) / (2 * step)


def test_backpropagation_against_differences():
    rng = np.random.default_rng(0)
    n = 300
    vocabulary = gated_lm.Vocabulary(
        rng.integers(1, 2**60, n).astype(np.uint64), np.sort(rng.integers(1, 500, n))[::-1],
        np.full(gated_lm.TAIL_CLASSES, 3.0), np.full(gated_lm.TAIL_CLASSES, 5.0),
    )
    params = {k: v.astype(np.float64) for k, v in vocabulary.start().items()}
    params["U"] += rng.normal(0, 0.2, params["U"].shape)
    params["Wc"] += rng.normal(0, 0.2, params["Wc"].shape)
    ids = rng.integers(0, n + gated_lm.TAIL_CLASSES, 60)
    first = np.array([0, 13, 20, 41, 60])
    texts = gated_lm.longest_first(ids, first)
    _, targets, inputs, resets, _, valid = next(gated_lm._windows(texts, n + gated_lm.TAIL_CLASSES))
    ok = valid.ravel()
    h0 = np.zeros((targets.shape[1], gated_lm.HIDDEN))

    def loss():
        states, *_ = gated_lm._forward(params, inputs, resets, h0, keep=False)
        flat = states.reshape(-1, gated_lm.HIDDEN)[ok]
        return -gated_lm._outputs(params, vocabulary, flat, targets.ravel()[ok], False).mean()

    trainer = gated_lm.Trainer(vocabulary, params, 0.0)
    seen = {}
    trainer._step = lambda name, grad, where=slice(None): seen.setdefault(name, []).append((where, grad))
    trainer.window(targets, inputs, resets, valid, h0)
    for name in ("Wh", "Wx", "b", "Wc", "bc", "E", "U", "u"):
        full = np.zeros_like(params[name])
        for where, grad in seen[name]:
            full[where] += grad
        places = np.argwhere(np.abs(full) > np.abs(full).max() * 0.3)[:4]
        for at in map(tuple, places):
            assert numeric_gradient(loss, params, name, at) == pytest.approx(full[at], rel=0.05, abs=2e-5)


def test_state_runs_through_whole_texts():
    """A text scores the same alone and among others, whatever the windows."""
    rng = np.random.default_rng(1)
    vocabulary = gated_lm.Vocabulary(
        np.arange(1, 201, dtype=np.uint64), np.sort(rng.integers(1, 90, 200))[::-1],
        np.full(gated_lm.TAIL_CLASSES, 2.0), np.full(gated_lm.TAIL_CLASSES, 2.0),
    )
    params = vocabulary.start()
    params["Wc"] = rng.normal(0, 0.5, params["Wc"].shape).astype(np.float32)
    sizes = [1, 3, 200, 31, 32, 33, 64, 500]
    ids = rng.integers(0, 200, sum(sizes))
    first = np.concatenate([[0], np.cumsum(sizes)])
    def score(ids, first):
        return gated_lm.score_texts(vocabulary, params, gated_lm.longest_first(ids, first), len(first) - 1)

    together = score(ids, first)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(gated_lm, "LANES", 3)
        assert score(ids, first) == pytest.approx(together, rel=1e-4)
    for k, n in enumerate(sizes):
        own = ids[first[k] : first[k + 1]]
        alone = score(own, np.array([0, n]))
        assert alone[0] == pytest.approx(together[k], rel=1e-4)


def test_scores_and_base(spark, documents, no_documents, tricky, monkeypatch):
    monkeypatch.setattr(gated_lm, "HEAD_WORDS", 100)  # so that many words are in the tail
    monkeypatch.setattr(gated_lm, "LEARNED_WORDS", 60)
    texts = spark.createDataFrame(
        [(3000 + k, ("red green blue " if k % 2 else "un deux trois ") * (5 + k % 9)) for k in range(200)],
        "doc_id bigint, text string",
    )
    docs = documents.select("doc_id", "text", "key", "row").unionByName(texts, allowMissingColumns=True)
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    found = gated_lm.score_documents(docs, train=train).collect()
    rows = [(i, t) for i, _, t in tricky] + [(r.doc_id, r.text) for r in texts.collect()]
    tokens = [[*words(t, lower=True), None] for _, t in rows]
    trained = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    counts = Counter(w for ws, use in zip(tokens, trained, strict=True) if use for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = Counter(
        (i, use, len(ws), sum(counts[w] > 0 for w in ws), n,
         round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 4))
        for (i, _), ws, use in zip(rows, tokens, trained, strict=True)
    )
    got = Counter(
        (r.doc_id, r.trained, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found
    )
    assert got == expected
    held = [r for r in found if r.doc_id and r.doc_id >= 3000 and not r.trained]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    nothing = gated_lm.score_documents(texts, train=F.lit(False)).collect()
    assert len(nothing) == 200 and all(r.n_known == 0 and math.isfinite(r.score) for r in nothing)
    assert gated_lm.score_documents(no_documents).count() == 0


def test_end_token_of_few_long_texts(spark, monkeypatch):
    """The end token counts where more words than are collected are commoner."""
    monkeypatch.setattr(gated_lm, "HEAD_WORDS", 50)
    text = " ".join(f"w{k}" for k in range(300) for _ in range(3))
    docs = spark.createDataFrame([(1, text), (2, "w1 w2 other")], "doc_id bigint, text string")
    rows = gated_lm.score_documents(docs, train=F.col("doc_id") == 1).collect()
    found = {r.doc_id: r for r in rows}
    base = math.log10(901 + 302)
    assert found[1].n_known == 901 and found[2].n_known == 3
    assert found[1].base_score == pytest.approx(900 * math.log10(4) + math.log10(2) - 901 * base)
    assert found[2].base_score == pytest.approx(2 * math.log10(4) + math.log10(2) - 4 * base)
