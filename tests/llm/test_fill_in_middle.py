from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from addrloom.llm.fill_in_middle import ExceptionIndex, fill_in_middle, restored

LETTERS = "aZ \n\nß€𝄞é<>PSM\0 \r"


def expected(i, text, unit="line", key="7", rate=100, suffix_first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    digest = hashlib.sha256(f"{key}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return i, n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < suffix_first:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def mixed_texts():
    rng = random.Random(11)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["<P>", "a<S>b", "<M", "<P", "<", "\n", "\n\n", "é", "a\n", "a\nb", "<<S<P\n>P>\n<M<\n"]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(
    "options", [{}, {"unit": "char"}, {"rate": 40, "suffix_first": 90, "key": "x"}]
)
def test_against_a_plain_version(spark, options):
    rows = mixed_texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = fill_in_middle(docs, **options).withColumn("back", restored()).collect()
    assert Counter(tuple(r)[:6] for r in found) == Counter(expected(i, t, **options) for i, t in rows)
    texts = dict(rows)
    assert all(r.back == texts[r.doc_id] for r in found)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_nulls_repeats_long_texts_and_clashing_names(documents, no_documents, tricky):
    made = fill_in_middle(documents)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = made.withColumn("back", restored()).collect()
    assert Counter(tuple(r)[:6] for r in found) == Counter(expected(i, t) for i, _, t in tricky)
    assert Counter((r.doc_id, r.back) for r in found) == Counter((i, t or "") for i, _, t in tricky)
    assert fill_in_middle(no_documents).count() == 0
    with pytest.raises(ValueError):
        fill_in_middle(documents, unit="word")


def test_other_columns(spark):
    docs = spark.createDataFrame([("k", "one\ntwo", "form")], "name string, body string, form string")
    made = fill_in_middle(docs, id_column="name", text_column="body")
    assert tuple(made.first()) == expected("k", "one\ntwo")


def test_index_converts_both_ways():
    text = "".join(t for _, t in mixed_texts())
    index = ExceptionIndex(np.frombuffer(text.encode(), dtype=np.uint8))
    chars = np.arange(len(text) + 1)
    positions = np.array([len(text[:k].encode()) for k in chars])
    assert np.array_equal(index.bytes(chars), positions)
    assert np.array_equal(index.chars(positions), chars)


def test_query_over_whole_table(spark, sf_dir):
    import __spark_entry__

    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    wanted = Counter()
    for r in rows:
        i, n, form, p, m, out = expected(r.doc_id, r.text)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (out, r.text or "")]
        wanted[(i, n, form, p, m, *digests)] += 1
    found = __spark_entry__.queries()["op11_fill_in_middle"](spark, sf_dir)
    assert Counter(map(tuple, found.collect())) == wanted
    assert found.where(F.col("form") != "plain").count() > 0
