"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon of abusive words and word stems is learned from labelled rows. Small transducers for insult,
threat, target, negation and reported speech are composed into one table; it runs over the clauses
that hold a lexicon entry or a threat and gives each match its kind (plain, negated, reported) and
each clause whether it names a target. A logistic model turns the weights by kind into a score.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.llm.words import LOWER, find_words, text_chunks, word_keys
from addrloom.session import materialise

# Bounds of learning: labelled rows read, and entries of the lexicon.
TRAIN_ROWS = 20_000
LEXICON_ENTRIES = 4_000
STEM_BYTES = (4, 5, 6, 7, 8)
LEAST_CONTEXTS = 6
LEAST_LOG_ODDS = 2.5

# Fixed word lists in English, German, French and Spanish.
TARGETS = """you your yours yourself he she they him her them his their this these those people
du dich dir dein deine ihr euch sie er diese dieser tu te toi ton ta vous votre il elle ils elles ce cette ces
usted ustedes tus su sus ellos ellas este esta estos estas""".split()
NEGATIONS = """not no never nor without isn't aren't wasn't don't nicht kein keine nie niemals ohne
ne pas jamais sans aucun nunca jamás ni sin""".split()
REPORTS = """said says say told wrote writes called claimed quoted reported alleged sagte sagt schrieb
nannte behauptete dit disait écrit appelé dijo dice escribió llamó""".split()
THREATS = """kill hurt destroy beat shoot stab burn murder töten umbringen schlagen tuer frapper brûler
matar golpear quemar""".split()

_LETTER_GAPS = np.ones(256, dtype=bool)
_LETTER_GAPS[ord("a") : ord("z") + 1] = False
_LETTER_GAPS[ord("A") : ord("Z") + 1] = False
_LETTER_GAPS[ord("'")] = False
_LETTER_GAPS[0x80:] = False
_CLAUSE_END = np.zeros(256, dtype=bool)
_CLAUSE_END[[ord(c) for c in ".,;:!?\n\r|()"]] = True

# --- the grammar ------------------------------------------------------------------------------------

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
KINDS = ("plain", "negated", "reported")


@dataclass(frozen=True)
class Transducer:
    """States 0..n-1, 0 first; ``step(state, symbol)`` gives the next state."""

    states: int
    step: dict[tuple[int, int], int]


def _transducer(states: int, rule) -> Transducer:
    return Transducer(states, {(s, x): rule(s, x) for s in range(states) for x in range(6)})


# A negation reaches the next three words; reported speech and a target hold to the clause's end.
NEGATED = _transducer(4, lambda s, x: 3 if x == NEGATION else max(0, s - 1))
REPORTED = _transducer(2, lambda s, x: 1 if x == REPORT else s)
TARGETED = _transducer(2, lambda s, x: 1 if x == TARGET else s)


@dataclass(frozen=True)
class Grammar:
    """The product of the transducers: next state, kind of a match met in a state, target seen."""

    next: list[list[int]]
    kind: list[int]
    targeted: list[bool]


def compose(negated: Transducer, reported: Transducer, targeted: Transducer) -> Grammar:
    parts = (negated, reported, targeted)
    names = list(itertools.product(*[range(p.states) for p in parts]))
    number = {name: k for k, name in enumerate(names)}
    step = [
        [number[tuple(p.step[s, x] for p, s in zip(parts, name, strict=True))] for x in range(6)]
        for name in names
    ]
    kind = [2 if r else 1 if n else 0 for n, r, _ in names]
    return Grammar(step, kind, [bool(t) for _, _, t in names])


GRAMMAR = compose(NEGATED, REPORTED, TARGETED)
_CLASS = {
    **dict.fromkeys(THREATS, THREAT),
    **dict.fromkeys(TARGETS, TARGET),
    **dict.fromkeys(NEGATIONS, NEGATION),
    **dict.fromkeys(REPORTS, REPORT),
}
FEATURES = [f"{a}_{b}" for a in ("insult", "threat") for b in KINDS] + [
    "targeted", "clauses", "matches", "any",
]


def clause_matches(words: list[str], lexicon: dict[str, float]) -> tuple[list[tuple[int, int, float]], bool]:
    """Matches of one clause as (symbol, kind, weight), and whether the clause names a target."""
    state, found = 0, []
    for word in words:
        weight = lexicon.get(word)
        if weight is None:
            for k in STEM_BYTES:
                weight = lexicon.get(_stem(word, k))
                if weight is not None:
                    break
        symbol = INSULT if weight is not None else _CLASS.get(word, OTHER)
        if symbol in (INSULT, THREAT):
            found.append((symbol, GRAMMAR.kind[state], weight or 1.0))
        state = GRAMMAR.next[state][symbol]
    return found, GRAMMAR.targeted[state]


def _stem(word: str, k: int) -> str:
    """Name of the stem of ``k`` bytes of a longer word, or of no entry."""
    raw = word.encode()
    return raw[:k].decode("utf-8", "ignore") + "*" if len(raw) > k else ""


# --- features of whole texts ----------------------------------------------------------------------------


class ClauseReader:
    """Finds the clauses with lexicon entries or threats, and the features of their matches."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        whole = [w for w in lexicon if not w.endswith("*")]
        stems = defaultdict(list)
        for w in lexicon:
            if w.endswith("*"):
                stems[len(w.encode()) - 1].append(w[:-1])
        self.whole = self._keys([*whole, *THREATS])
        self.stems = {k: self._keys(v) for k, v in stems.items()}

    @staticmethod
    def _keys(words: list[str]) -> np.ndarray:
        raw = [w.encode() for w in words]
        sizes = np.cumsum([0, *map(len, raw)])
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        return np.sort(word_keys(data, sizes[:-1], sizes[1:]))

    @staticmethod
    def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if len(wanted) == 0:
            return np.zeros(len(keys), dtype=bool)
        place = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
        return wanted[place] == keys

    def of_chunk(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        data = LOWER[data]
        starts, ends, _ = find_words(data, offsets, _LETTER_GAPS)
        hit = self._among(word_keys(data, starts, ends), self.whole)
        for k, wanted in self.stems.items():
            longer = np.flatnonzero(ends - starts > k)
            keys = word_keys(data, starts[longer], starts[longer] + k)
            hit[longer[self._among(keys, wanted)]] = True
        rows = len(offsets) - 1
        sums = np.zeros((rows, len(FEATURES)))
        hits = np.flatnonzero(hit)
        if len(hits) == 0:
            return sums
        stops = np.flatnonzero(_CLAUSE_END[data])
        row = np.searchsorted(offsets, starts[hits], side="right") - 1
        after = np.searchsorted(stops, starts[hits])
        bounded = np.concatenate([[-1], stops, [len(data)]])
        left = np.maximum(bounded[after] + 1, offsets[row])
        right = np.minimum(bounded[after + 1], offsets[row + 1])
        raw = data.tobytes()
        for r, a, b in dict.fromkeys(zip(row.tolist(), left.tolist(), right.tolist(), strict=True)):
            clause = np.frombuffer(raw, dtype=np.uint8, count=b - a, offset=a)
            s, e, _ = find_words(clause, np.array([0, b - a]), _LETTER_GAPS)
            words = [
                raw[a + x : a + y].decode("utf-8", "replace")
                for x, y in zip(s.tolist(), e.tolist(), strict=True)
            ]
            found, targeted = clause_matches(words, self.lexicon)
            for symbol, kind, weight in found:
                sums[r, (symbol == THREAT) * len(KINDS) + kind] += weight
                sums[r, 6] += weight * targeted
            insults = sum(symbol == INSULT for symbol, *_ in found)
            sums[r, 7] += insults > 0
            sums[r, 8] += insults
        out = np.log1p(sums)
        out[:, 9] = sums[:, 8] > 0
        return out

    def of_column(self, column: pa.Array) -> np.ndarray:
        parts = [self.of_chunk(data, offsets) for _, data, offsets in text_chunks(column)]
        return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


# --- learning ---------------------------------------------------------------------------------------------


def training_rows(
    docs: DataFrame, labels: DataFrame, usable: Column, *, id_column: str, text_column: str
) -> DataFrame:
    """Texts and labels of at most ``TRAIN_ROWS`` labelled rows, chosen by a digest of the id."""
    known = (
        labels.where(usable & F.col("toxic").isin(0, 1) & F.col(id_column).isNotNull())
        .select(F.col(id_column).alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .distinct()
        .orderBy(F.xxhash64("id"), "id", "toxic")
        .limit(TRAIN_ROWS)
    )
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # The bound on the rows bounds what is sent to the executors.
    return texts.join(F.broadcast(known), "id").select("toxic", "text")


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and stems of texts, each with a digest of its neighbours, so that copies count once."""
    for batch in batches:
        seen: set[tuple[str, int]] = set()
        for _, data, offsets in text_chunks(batch.column("text")):
            data = LOWER[data]
            starts, ends, first = find_words(data, offsets, _LETTER_GAPS)
            keys = word_keys(data, starts, ends).view(np.int64)
            raw = data.tobytes()
            for r in range(len(offsets) - 1):
                for k in range(first[r], first[r + 1]):
                    raw_word = raw[starts[k] : ends[k]]
                    if len(raw_word) > 40:
                        continue
                    near = int(keys[k - 1]) if k > first[r] else 0
                    word = raw_word.decode("utf-8", "replace")
                    seen.add((word, near))
                    seen.update((_stem(word, n), near) for n in STEM_BYTES if len(raw_word) > n)
        if seen:
            names, near = zip(*seen, strict=True)
            yield pa.RecordBatch.from_pydict(
                {"entry": pa.array(names), "near": pa.array(near, pa.int64())}
            )


def _document_counts(entries: set[str]):
    """Documents per entry, counted per task before they are summed up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column("text")):
                raw = LOWER[data].tobytes()
                starts, ends, first = find_words(LOWER[data], offsets, _LETTER_GAPS)
                for r in range(len(offsets) - 1):
                    words = {raw[starts[k] : ends[k]] for k in range(first[r], first[r + 1])}
                    names: set[str] = set()
                    for w in words:
                        word = w.decode("utf-8", "replace")
                        names.add(word)
                        names.update(_stem(word, n) for n in STEM_BYTES if len(w) > n)
                    found.update(names & entries)
        if found:
            yield pa.RecordBatch.from_pydict(
                {"entry": pa.array(list(found)), "docs": pa.array(list(found.values()), pa.int64())}
            )

    return count


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Entry -> log odds of the label, for words and stems (``abc*``) typical of label 1."""
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    positive, negative = sizes.get(1, 0), sizes.get(0, 0)
    if positive == 0 or negative == 0:
        return {}
    contexts = (
        rows.where("toxic = 1")
        .select("text")
        .mapInArrow(_candidates, "entry string, near bigint")
        .distinct()
        .groupBy("entry")
        .agg(F.count("*").alias("contexts"))
        .where(F.col("contexts") >= LEAST_CONTEXTS)
        .orderBy(F.desc("contexts"), "entry")
    )
    # Bounded by the training rows; very common entries cannot be typical of one label.
    entries = {r["entry"]: r["contexts"] for r in contexts.collect()}
    counts = {}
    for label in (0, 1):
        counted = (
            rows.where(F.col("toxic") == label)
            .select("text")
            .mapInArrow(_document_counts(set(entries)), "entry string, docs bigint")
            .groupBy("entry")
            .agg(F.sum("docs").alias("docs"))
        )
        counts[label] = {r["entry"]: r["docs"] for r in counted.collect()}
    scored = {}
    for entry in entries:
        with_1, with_0 = counts[1].get(entry, 0), counts[0].get(entry, 0)
        odds = math.log((with_1 + 0.5) / (positive + 1)) - math.log((with_0 + 0.5) / (negative + 1))
        if odds >= LEAST_LOG_ODDS:
            scored[entry] = odds * min(1.0, with_1 / LEAST_CONTEXTS)
    best = sorted(scored, key=lambda e: (-scored[e], e))[:LEXICON_ENTRIES]
    return {e: scored[e] for e in best}


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights (constant last) by Newton steps on the penalised likelihood."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: np.ndarray | None


def learn(rows: DataFrame) -> Model:
    """Lexicon and weights from (``toxic``, ``text``) rows, at most ``TRAIN_ROWS`` of them."""
    lexicon = learn_lexicon(rows)
    names = ", ".join(f"f{k} double" for k in range(len(FEATURES)))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ClauseReader(lexicon)
        for batch in batches:
            x = reader.of_column(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), *[pa.array(x[:, k]) for k in range(x.shape[1])]],
                names=["toxic", *[f"f{k}" for k in range(x.shape[1])]],
            )

    found = rows.mapInArrow(features, f"toxic int, {names}").toPandas().to_numpy(dtype=float)
    if len(found) == 0:
        return Model(lexicon, None)
    return Model(lexicon, fit_logistic(found[:, 1:], found[:, 0]))


def _scored(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    names: list[str],
    *,
    id_column: str,
    text_column: str,
) -> DataFrame:
    """``row`` (the named columns) and ``score`` of each row of ``docs``."""
    rows = training_rows(docs, labels, usable, id_column=id_column, text_column=text_column)
    model = learn(materialise(rows, "toxicity-training"))
    kept = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.col(f"`{text_column}`").alias("text"),
    )
    kind = kept.schema["row"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ClauseReader(model.lexicon)
        for batch in batches:
            x = reader.of_column(batch.column("text"))
            if model.weights is None:
                p = np.zeros(len(x))
            else:
                z = x @ model.weights[:-1] + model.weights[-1]
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(p)], ["row", "score"])

    return kept.mapInArrow(score, f"row {kind}, score double")


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    *,
    usable: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row of ``docs``: id and ``score`` (0 to 1).

    ``labels`` holds the id and ``toxic``; only rows where ``usable`` holds are learned from, rows with
    null or other labels or without an id never. The score uses the text alone: a null or empty text
    scores as one without matches. Without any labelled row every score is 0; an empty table gives
    no rows.
    """
    usable = F.lit(True) if usable is None else usable
    scored = _scored(
        docs, labels, usable, [id_column], id_column=id_column, text_column=text_column
    )
    return scored.select(F.col("row").getField(id_column).alias(id_column), "score")


def accepted(
    docs: DataFrame,
    labels: DataFrame,
    *,
    threshold: float = 0.5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``threshold``."""
    scored = _scored(
        docs, labels, F.lit(True), docs.columns, id_column=id_column, text_column=text_column
    )
    kept = scored.where(F.col("score") < threshold)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
