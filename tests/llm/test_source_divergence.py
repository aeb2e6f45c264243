from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from addrloom.llm.source_divergence import audit_sources

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def expected(rows, least=30, top=50):
    """(lang, source, text) rows; the definition, with Python's whole numbers."""
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = TERM.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        counts[lang, source].update(found)
        documents[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in documents[lang].items() if n >= least]
        v = len(kept)

        def chances(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * v) for t in kept}

        q = chances(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: chances(counts[lang, s]) for s in sources}

        def ranked(source, part, values, limit=None):
            order = sorted(values, key=lambda x: (-x[1], x[0].encode()))[:limit]
            out.extend((lang, source, part, i, n, k) for k, (i, n) in enumerate(order, 1))

        for s in sources:
            ranked(s, "pair", [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources - {s}])
            over = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            ranked(s, "term", over, top)
    return Counter(out)


def corpus():
    rng = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in "abÉk" for b in "oü字" for c in ("n", "x'", "Z", "é")]
    rows = []
    for _ in range(900):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = rng.choice(["hot"] * 6 + [f"s{k}" for k in range(25)] + [None, "", "é", "z\U0001d11e"])
        skew = len(source or "") % 5
        words = rng.choices(vocabulary, [1 + (k * skew) % 7 for k in range(len(vocabulary))], k=rng.randrange(30))
        rows.append((lang, source, " 1".join(words)))
    rows += [("fr", f"s{k}", "zu wenig Texte") for k in range(9)]
    rows += [("xx", "only", None), ("yy", None, ""), ("yy", "b", "12 34 _ \x7f"), (None, None, None)]
    rows += [("en", "long", "Boxx " * 80_000 + "aon")] + [("en", "s1", "the same row")] * 40
    return rows


SCHEMA = "lang string, source string, text string, term string, n int, p string, group_id string"


@pytest.mark.parametrize(
    "options", [{}, {"group_block": 4, "term_block": 5}, {"group_block": 1, "term_block": 1, "top": 3}]
)
def test_against_a_plain_version(spark, options):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "t", 1, "p", "g") for r in rows], SCHEMA).repartition(4)
    found = audit_sources(docs, **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, found.collect())) == expected(rows, top=options.get("top", 50))


def test_empty_table(no_documents):
    assert audit_sources(no_documents).count() == 0


def test_tricky_documents(documents, tricky):
    found = audit_sources(documents, least_documents=2)
    assert Counter(map(tuple, found.collect())) == expected([(None, s, t) for _, s, t in tricky], least=2)
