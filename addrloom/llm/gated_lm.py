"""Log-likelihood of whole documents under a gated recurrent language model, in numpy.

The output softmax is factored: first a class of words, then the word within its class. The commonest
``LEARNED_WORDS`` have weights of their own; each other word belongs to a class by its last letters and
has its count's share of that class, so the vocabulary is never cut. Counts of ``HEAD_WORDS`` words are
sent to the tasks, those of the rest are joined. The state runs through a document from
its first word to its end; training cuts only the gradient, at ``WINDOW`` steps.

Word counts cover all training rows. A first model is trained in one task on ``WARM_ROWS`` rows, then
every task trains it on all of its own training rows and the tasks' models are averaged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.llm.words import LOWER, find_words, text_chunks, word_keys
from addrloom.session import materialise

HEAD_WORDS = 32_768
LEARNED_WORDS = 2_048
HEAD_CLASSES = 48
TAIL_CLASSES = 32
HIDDEN = 16
EMBED = 16
LANES = 512
COUNT_STEPS = 16
WINDOW = 32
WARM_ROWS = 1_500
CHUNK = 4 << 20
AVERAGED_PARTS = 64

END_KEY = np.uint64(0x2545F4914F6CDD1D)
LOG10 = np.log(10.0)
Params = dict[str, np.ndarray]


# --- tokens -------------------------------------------------------------------------------------------------


def chunk_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and tail classes of all tokens, each text closed by the end token; first token per text."""
    data = LOWER[data]
    starts, ends, first = find_words(data, offsets)
    keys = word_keys(data, starts, ends)
    last, second = data[ends - 1], data[np.maximum(ends - 2, starts)]
    classes = (last.astype(np.int64) * 31 + second) % TAIL_CLASSES
    keys = np.insert(keys, first[1:], END_KEY)
    classes = np.insert(classes, first[1:], 0)
    return keys, classes, first + np.arange(len(first))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the task's training tokens, summed up before they leave the task."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merge() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, classes, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        keys, first, back = np.unique(keys, return_index=True, return_inverse=True)
        return keys, classes[first], np.bincount(back, weights=counts).astype(np.int64)

    for batch in batches:
        batch = batch.filter(batch.column("train"))
        for _, data, offsets in text_chunks(batch.column("text"), CHUNK):
            keys, classes, _ = chunk_tokens(data, offsets)
            held.append((keys, classes, np.ones(len(keys), dtype=np.int64)))
            held[-1:] = [merge_one(held[-1])]
            if len(held) == 16:
                held[:] = [merge()]
    if held:
        keys, classes, counts = merge()
        yield pa.RecordBatch.from_pydict(
            {
                "key": pa.array(keys.view(np.int64)),
                "class": pa.array(classes, pa.int32()),
                "count": pa.array(counts),
            }
        )


def merge_one(part: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, first, counts = np.unique(part[0], return_index=True, return_counts=True)
    return keys, part[1][first], counts


class Vocabulary:
    """The words with counts at hand, commonest first; the model's words are the first of them.

    ``tail_words`` and ``tail_tokens`` are sizes of the classes of all words without own weights.
    """

    def __init__(
        self, keys: np.ndarray, counts: np.ndarray, tail_words: np.ndarray, tail_tokens: np.ndarray
    ):
        self.keys, self.counts = keys, counts.astype(np.float64)
        self.by_key = np.argsort(self.keys)
        self.sorted_keys = self.keys[self.by_key]
        self.learned = min(LEARNED_WORDS, len(keys))
        own = self.counts[: self.learned] + 1
        share = np.cumsum(np.sqrt(own))
        self.head_class = np.minimum(
            (share / share[-1] * HEAD_CLASSES).astype(np.int64), HEAD_CLASSES - 1
        )
        # Words of one class are neighbours, as both follow the counts.
        self.class_at = np.searchsorted(self.head_class, np.arange(HEAD_CLASSES + 1))
        self.tail_size = tail_words + tail_tokens + 1.0
        self.tail_tokens = tail_tokens

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each word with a count at hand, -1 for others."""
        place = np.minimum(np.searchsorted(self.sorted_keys, keys), len(self.keys) - 1)
        return np.where(self.sorted_keys[place] == keys, self.by_key[place], -1)

    def ids(self, places: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The model's symbols: words with own weights by rank, then classes of the others."""
        own = (places >= 0) & (places < self.learned)
        return np.where(own, places, self.learned + classes)

    def start(self) -> Params:
        """Weights with which the model is the unigram model."""
        rng = np.random.default_rng(11)
        f = np.float32
        own = self.counts[: self.learned] + 1
        head = np.bincount(self.head_class, weights=own, minlength=HEAD_CLASSES)
        mass = np.concatenate([head + 1e-3, self.tail_tokens + 1])
        return {
            "E": rng.normal(0, 0.3, (self.learned + TAIL_CLASSES + 1, EMBED)).astype(f),
            "Wx": rng.normal(0, 0.3, (EMBED, 3 * HIDDEN)).astype(f),
            "Wh": rng.normal(0, 0.2, (HIDDEN, 3 * HIDDEN)).astype(f),
            "b": np.concatenate([np.full(HIDDEN, 1.0), np.zeros(2 * HIDDEN)]).astype(f),
            "Wc": np.zeros((HIDDEN, HEAD_CLASSES + TAIL_CLASSES), f),
            "bc": np.log(mass / mass.sum()).astype(f),
            "U": np.zeros((self.learned, HIDDEN), f),
            "u": np.log(own).astype(f),
        }


def vocabulary_of(
    head: list[tuple[int, int, int]], class_words: np.ndarray, class_tokens: np.ndarray, ends: int
) -> Vocabulary:
    """From the commonest words as (key, count, class), all words and tokens of each class, and the end
    token's count, which may be too small for the commonest words."""
    keys = np.array([k for k, *_ in head], dtype=np.int64).view(np.uint64)
    counts = np.array([c for _, c, _ in head], dtype=np.int64)
    classes = np.array([c for *_, c in head], dtype=np.int64)
    if END_KEY not in keys[:LEARNED_WORDS]:
        # Few and long training rows, or none: the end token needs weights of its own all the same.
        known = keys == END_KEY
        keys = np.insert(keys[~known], 0, END_KEY)
        counts = np.insert(counts[~known], 0, ends)
        classes = np.insert(classes[~known], 0, 0)
    own = slice(0, min(LEARNED_WORDS, len(keys)))
    learned_words = np.bincount(classes[own], weights=counts[own] > 0, minlength=TAIL_CLASSES)
    learned_tokens = np.bincount(classes[own], weights=counts[own], minlength=TAIL_CLASSES)
    return Vocabulary(keys, counts, class_words - learned_words, class_tokens - learned_tokens)


# --- the network --------------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _windows(texts: Iterator[tuple[int, np.ndarray]], start_id: int):
    """Texts (number, ids) side by side in lanes; a lane takes the next text where one has ended.

    Yields the numbers of the lanes that go on from the last window (at first, from ``LANES``), then
    targets, inputs, resets and text numbers as (step, lane) arrays, with a mask of the places in use.
    Lanes are left out once there are no more texts for them.
    """
    lanes: list[list] = [[None, 0, 0] for _ in range(LANES)]  # ids, next place, text number
    more = True
    while True:
        n = len(lanes)
        targets = np.zeros((n, WINDOW), dtype=np.int64)
        inputs = np.full((n, WINDOW), start_id, dtype=np.int64)
        resets = np.zeros((n, WINDOW), dtype=bool)
        numbers = np.full((n, WINDOW), -1, dtype=np.int64)
        for k, lane in enumerate(lanes):
            at = 0
            while at < WINDOW:
                ids, place, number = lane
                if ids is None:
                    number, ids = next(texts, (0, None)) if more else (0, None)
                    if ids is None:
                        more = False
                        break
                    place = 0
                end = min(at + len(ids) - place, WINDOW)
                stop = place + end - at
                targets[k, at:end] = ids[place:stop]
                if place:
                    inputs[k, at:end] = ids[place - 1 : stop - 1]
                else:
                    inputs[k, at + 1 : end] = ids[: stop - 1]
                    resets[k, at] = True
                numbers[k, at:end] = number
                lane[:] = (None, 0, 0) if stop == len(ids) else (ids, stop, number)
                at = end
        valid = numbers >= 0
        used = np.flatnonzero(valid[:, 0])
        if len(used) == 0:
            return
        yield used, *(np.ascontiguousarray(x[used].T) for x in (targets, inputs, resets, numbers, valid))
        lanes = [lanes[k] for k in used]


def _input_table(p: Params) -> np.ndarray:
    """What each symbol adds to the gates: there are far fewer symbols than places in a window."""
    return p["E"] @ p["Wx"] + p["b"]


def _forward(
    p: Params, inputs: np.ndarray, resets: np.ndarray, h: np.ndarray, keep: bool, table: np.ndarray | None = None
):
    """States after each step, and what the backward pass needs."""
    steps, lanes = inputs.shape
    xg = (_input_table(p) if table is None else table)[inputs]
    states = np.empty((steps, lanes, HIDDEN), np.float32)
    kept = []
    H = HIDDEN
    for t in range(steps):
        if resets[t].any():
            h = np.where(resets[t][:, None], np.float32(0), h)
        hg = h @ p["Wh"]
        zr = _sigmoid(xg[t, :, : 2 * H] + hg[:, : 2 * H])
        z, r = zr[:, :H], zr[:, H:]
        n = np.tanh(xg[t, :, 2 * H :] + r * hg[:, 2 * H :])
        new = n + z * (h - n)
        if keep:
            kept.append((h, z, r, n, hg[:, 2 * H :]))
        states[t] = h = new
    return states, h, kept


def _exp_rows(states: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(states @ weights) and its row sums; shifted by the row's maximum only where needed."""
    out = states @ weights
    ones = np.ones(out.shape[1], out.dtype)
    with np.errstate(over="ignore"):
        e = np.exp(out)
    sums = e @ ones
    if not (np.isfinite(sums).all() and sums.min() > 1e-30):
        e = np.exp(out - out.max(axis=1, keepdims=True))
        sums = e @ ones
    return e, sums


def _outputs(p: Params, vocabulary: Vocabulary, states: np.ndarray, targets: np.ndarray, learn: bool):
    """Natural log probability of each target; with ``learn`` the gradients, too."""
    head = targets < vocabulary.learned
    classes = np.where(
        head,
        vocabulary.head_class[np.where(head, targets, 0)],
        HEAD_CLASSES + targets - vocabulary.learned,
    )
    # Words in order, so that those of one class are neighbours.
    order = np.argsort(classes.astype(np.int16), kind="stable")
    classes, words = classes[order], targets[order]
    # The last column stands for the bias.
    wide = np.empty((len(order), HIDDEN + 1), states.dtype)
    wide[:, :HIDDEN], wide[:, HIDDEN] = states[order], 1
    e, sums = _exp_rows(wide, np.vstack([p["Wc"], p["bc"]]))
    rows = np.arange(len(order))
    found = np.log(np.maximum(e[rows, classes], 1e-30) / sums).astype(np.float64)
    if learn:
        e /= sums[:, None]
        e[rows, classes] -= 1
        d_wide = wide.T @ e
        grads = {"Wc": d_wide[:HIDDEN], "bc": d_wide[HIDDEN]}
        d_states = e @ p["Wc"].T
        inner = []
    cuts = np.searchsorted(classes, np.arange(HEAD_CLASSES + 1))
    inside = np.column_stack([p["U"], p["u"]])
    for c in range(HEAD_CLASSES):
        mine = slice(cuts[c], cuts[c + 1])
        a, b = vocabulary.class_at[c], vocabulary.class_at[c + 1]
        if cuts[c] == cuts[c + 1] or b - a == 1:
            continue
        own = wide[mine]
        e, sums = _exp_rows(own, inside[a:b].T)
        k, word = np.arange(len(own)), words[mine] - a
        found[mine] += np.log(np.maximum(e[k, word], 1e-30) / sums)
        if learn:
            e /= sums[:, None]
            e[k, word] -= 1
            d_states[mine] += e @ p["U"][a:b]
            inner.append((a, b, e.T @ own))
    result = np.empty_like(found)
    result[order] = found
    if learn:
        back = np.empty_like(d_states)
        back[order] = d_states
        return result, back, grads, inner
    return result


class Trainer:
    """Adagrad on windows of truncated backpropagation."""

    def __init__(self, vocabulary: Vocabulary, params: Params, rate: float):
        self.vocabulary, self.rate = vocabulary, rate
        self.p = {k: v.copy() for k, v in params.items()}
        self.seen = {k: np.full_like(v, 1e-6) for k, v in params.items()}

    def _step(self, name: str, grad: np.ndarray, where=slice(None)) -> None:
        seen = self.seen[name]
        seen[where] += grad * grad
        self.p[name][where] -= self.rate * grad / np.sqrt(seen[where])

    def window(self, targets, inputs, resets, valid, h):
        p, H = self.p, HIDDEN
        states, h, kept = _forward(p, inputs, resets, h, keep=True)
        ok = valid.ravel()
        n = max(1, int(ok.sum()))
        _, d_out, grads, inner = _outputs(
            p, self.vocabulary, states.reshape(-1, H)[ok], targets.ravel()[ok], learn=True
        )
        d_states = np.zeros((states.shape[0] * states.shape[1], H), np.float32)
        d_states[ok] = d_out / n
        d_states = d_states.reshape(states.shape)
        steps, lanes = inputs.shape
        d_xg = np.empty((steps, lanes, 3 * H), np.float32)
        d_hg = np.empty((steps, lanes, 3 * H), np.float32)
        back = np.zeros((lanes, H), np.float32)
        for t in range(steps - 1, -1, -1):
            before, z, r, new, hn = kept[t]
            back += d_states[t]
            d_x_t, d_h_t = d_xg[t], d_hg[t]
            rest = 1 - z
            d_new = d_x_t[:, 2 * H :]
            np.multiply(back, rest, out=d_new)
            d_new *= 1 - new * new
            rest *= z
            rest *= before - new
            np.multiply(back, rest, out=d_x_t[:, :H])
            np.multiply(d_new * hn, r * (1 - r), out=d_x_t[:, H : 2 * H])
            d_h_t[:, : 2 * H] = d_x_t[:, : 2 * H]
            np.multiply(d_new, r, out=d_h_t[:, 2 * H :])
            back *= z
            back += d_h_t @ p["Wh"].T
            if resets[t].any():
                back[resets[t]] = 0
        before = np.stack([k[0] for k in kept]).reshape(-1, H)
        flat = d_xg.reshape(-1, 3 * H)
        words = inputs.ravel()
        order = np.argsort(words.astype(np.int16), kind="stable")
        ids, heads = np.unique(words[order], return_index=True)
        by_word = np.add.reduceat(flat[order], heads, axis=0)
        d_embed, d_input = by_word @ p["Wx"].T, p["E"][ids].T @ by_word
        self._step("Wh", before.T @ d_hg.reshape(-1, 3 * H))
        self._step("Wx", d_input)
        self._step("b", by_word.sum(axis=0))
        self._step("E", d_embed, ids)
        for name, grad in grads.items():
            self._step(name, grad / n)
        for a, b, d_u in inner:
            self._step("U", d_u[:, :H] / n, slice(a, b))
            self._step("u", d_u[:, H] / n, slice(a, b))
        return h

    def texts(self, texts: Iterator[tuple[int, np.ndarray]]) -> None:
        h = np.zeros((LANES, HIDDEN), np.float32)
        for lanes, targets, inputs, resets, _, valid in _windows(
            texts, self.vocabulary.learned + TAIL_CLASSES
        ):
            h = self.window(targets, inputs, resets, valid, h[lanes])


def score_texts(
    vocabulary: Vocabulary, params: Params, texts: Iterator[tuple[int, np.ndarray]], count: int
) -> np.ndarray:
    """Natural log probability of texts 0..count-1, without the shares of words in their tail classes."""
    sums = np.zeros(count)
    h = np.zeros((LANES, HIDDEN), np.float32)
    table = _input_table(params)
    for lanes, targets, inputs, resets, numbers, valid in _windows(
        texts, vocabulary.learned + TAIL_CLASSES
    ):
        states, h, _ = _forward(params, inputs, resets, h[lanes], False, table)
        found = _outputs(params, vocabulary, states[valid], targets[valid], learn=False)
        sums += np.bincount(numbers[valid], weights=found, minlength=count)
    return sums


def longest_first(ids: np.ndarray, first: np.ndarray, base: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """The texts of a chunk, numbered from ``base``."""
    for k in np.argsort(-np.diff(first), kind="stable").tolist():
        yield base + k, ids[first[k] : first[k + 1]]


# --- jobs -----------------------------------------------------------------------------------------------------


def _flat(params: Params) -> np.ndarray:
    return np.concatenate([params[k].ravel() for k in sorted(params)]).astype(np.float32)


def _shaped(flat: np.ndarray, like: Params) -> Params:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _train_task(vocabulary, params, rate: float):
    """Train on the task's rows; the weights leave the task in parts, each with its token count."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        trainer = Trainer(v, params.value, rate)
        tokens = 0

        def texts() -> Iterator[tuple[int, np.ndarray]]:
            nonlocal tokens
            for batch in batches:
                batch = batch.filter(batch.column("train"))
                for _, data, offsets in text_chunks(batch.column("text"), CHUNK):
                    keys, classes, first = chunk_tokens(data, offsets)
                    tokens += len(keys)
                    yield from longest_first(v.ids(v.places(keys), classes), first)

        trainer.texts(texts())
        if tokens:
            parts = np.array_split(_flat(trainer.p), AVERAGED_PARTS)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(range(AVERAGED_PARTS), pa.int32()),
                    "tokens": pa.array([tokens] * AVERAGED_PARTS, pa.int64()),
                    "weights": pa.array([p.tobytes() for p in parts], pa.binary()),
                }
            )

    return train


def _average(table: pa.Table) -> pa.Table:
    total, weights = 0, 0.0
    for tokens, blob in zip(table["tokens"].to_pylist(), table["weights"], strict=True):
        total += tokens
        weights = weights + tokens * np.frombuffer(blob.as_py(), dtype=np.float32).astype(np.float64)
    mean = (weights / total).astype(np.float32)
    return pa.table({"part": table["part"].slice(0, 1), "weights": pa.array([mean.tobytes()])})


def _trained(rows: DataFrame, vocabulary, params: Params, rate: float) -> Params:
    """The average of the models that the tasks train, which has a fixed size."""
    shared = rows.sparkSession.sparkContext.broadcast(params)
    parts = (
        rows.mapInArrow(
            _train_task(vocabulary, shared, rate), "part int, tokens bigint, weights binary"
        )
        .groupBy("part")
        .applyInArrow(_average, "part int, weights binary")
        .collect()
    )
    if not parts:
        return params
    flat = np.concatenate(
        [np.frombuffer(r["weights"], np.float32) for r in sorted(parts, key=lambda r: r["part"])]
    )
    return _shaped(flat, params)


def _score_task(vocabulary, params):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        v, p = vocabulary.value, params.value
        share = np.log10(v.tail_size)
        for batch in batches:
            n = batch.num_rows
            n_tokens, known = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            base, shares = np.zeros(n), np.zeros(n)
            tail_keys: list[np.ndarray] = []
            tail_counts: list[np.ndarray] = []

            def texts(batch=batch) -> Iterator[tuple[int, np.ndarray]]:
                for start, data, offsets in text_chunks(batch.column("text"), CHUNK):
                    keys, classes, first = chunk_tokens(data, offsets)
                    places = v.places(keys)
                    ids = v.ids(places, classes)
                    size = len(first) - 1
                    rows = slice(start, start + size)
                    text = np.repeat(np.arange(size), np.diff(first))
                    counts = np.where(places >= 0, v.counts[np.where(places >= 0, places, 0)], 0)
                    logs = np.log10(counts + 1)
                    n_tokens[rows] = np.diff(first)
                    base[rows] = np.bincount(text, weights=logs, minlength=size)
                    known[rows] = np.bincount(text, weights=counts > 0, minlength=size)
                    # A word of a class has its count's share; counts not at hand are joined later.
                    rest = ids >= v.learned
                    shares[rows] = np.bincount(
                        text[rest], weights=(logs - share[classes])[rest], minlength=size
                    )
                    rest = np.flatnonzero(places < 0)
                    order = rest[np.lexsort((keys[rest], text[rest]))]
                    new = np.ones(len(order), dtype=bool)
                    new[1:] = (keys[order][1:] != keys[order][:-1]) | (
                        text[order][1:] != text[order][:-1]
                    )
                    heads = np.flatnonzero(new)
                    repeats = np.diff(np.append(heads, len(order))).astype(np.int32)
                    cuts = np.searchsorted(text[order[heads]], np.arange(size + 1))
                    distinct = keys[order[heads]].view(np.int64)
                    tail_keys.extend(distinct[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True))
                    tail_counts.extend(repeats[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True))
                    yield from longest_first(ids, first, start)

            found = score_texts(v, p, texts(), n) / LOG10 + shares
            if n == 0:
                continue
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array((np.int64(part) << 33) + np.arange(nth, nth + n)),
                    "id": batch.column("id"),
                    "train": batch.column("train"),
                    "n_tokens": pa.array(n_tokens),
                    "base": pa.array(base),
                    "known": pa.array(known),
                    "score": pa.array(found),
                    "tail_keys": pa.array(tail_keys, pa.list_(pa.int64())),
                    "tail_counts": pa.array(tail_counts, pa.list_(pa.int32())),
                }
            )
            nth += n

    return score


def score_documents(
    docs: DataFrame,
    *,
    train: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: id, ``trained`` (learned from), ``n_tokens, n_known, train_tokens, base_score, score``.

    Scores are log10 probabilities of the lower-cased (A-Z) words and the end token: ``base_score`` under
    the smoothed unigram model of the training rows, ``score`` under the network. A null or empty text is
    the end token alone; ``train`` being null means not trained on. Without training rows both models
    know no word. Equal rows are trained on and scored one by one; an empty table gives no rows.
    """
    spark = docs.sparkSession
    train = F.lit(True) if train is None else train
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(train, F.lit(False)).alias("train"),
        F.col(text_column).alias("text"),
    )
    texts = rows.select("train", "text")
    words = materialise(
        texts.mapInArrow(_count_words, "key bigint, class int, count bigint")
        .groupBy("key")
        .agg(F.sum("count").alias("count"), F.first("class").alias("class")),
        "word-counts",
    )
    sums = words.agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = sums["n"] or 0, sums["v"]
    # By size class of the counts, so that only a few hundred sums, then at most HEAD_WORDS words and
    # TAIL_CLASSES sums, come to the driver.
    step = F.floor(F.log2("count") * COUNT_STEPS)
    steps = {r["s"]: r["v"] for r in words.groupBy(step.alias("s")).agg(F.count("*").alias("v")).collect()}
    least, room = max(steps, default=0) + 1, HEAD_WORDS
    for k in sorted(steps, reverse=True):
        room -= steps[k]
        if room < 0:
            break
        least = k
    head = words.where(step >= least).orderBy(F.desc("count"), "key").select("key", "count", "class")
    class_words, class_tokens = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    by_class = words.groupBy("class").agg(F.count("*").alias("v"), F.sum("count").alias("n"))
    for r in by_class.collect():
        class_words[r["class"]], class_tokens[r["class"]] = r["v"], r["n"]
    end_key = int(np.array([END_KEY]).view(np.int64)[0])
    ends = words.where(F.col("key") == end_key).agg(F.sum("count")).first()[0] or 0
    vocabulary = spark.sparkContext.broadcast(
        vocabulary_of([tuple(r) for r in head.collect()], class_words, class_tokens, ends)
    )

    params = vocabulary.value.start()
    if tokens:
        order = F.xxhash64(F.col("id").cast("string"), F.lit(5))
        first = rows.where("train").select("id", order.alias("o")).orderBy("o").limit(WARM_ROWS)
        last = first.agg(F.max("o")).first()[0]
        warm = rows.where(F.col("train") & (order <= F.lit(last))).select("train", "text")
        params = _trained(warm.limit(WARM_ROWS).coalesce(1), vocabulary, params, rate=0.1)
        params = _trained(texts, vocabulary, params, rate=0.03)
    model = spark.sparkContext.broadcast(params)

    kind = rows.schema["id"].dataType.simpleString()
    scored = materialise(
        rows.mapInArrow(
            _score_task(vocabulary, model),
            f"row bigint, id {kind}, train boolean, n_tokens bigint, base double, known bigint, "
            "score double, tail_keys array<bigint>, tail_counts array<int>",
        ),
        "scored",
    )
    rest = (
        scored.select("row", F.explode(F.arrays_zip("tail_keys", "tail_counts")).alias("t"))
        .select("row", F.col("t.tail_keys").alias("key"), F.col("t.tail_counts").alias("times"))
        .join(words.select("key", "count"), "key")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("count") + 1)).alias("rest"),
            F.sum("times").alias("rest_known"),
        )
    )
    rest_sum = F.coalesce("rest", F.lit(0.0))
    return (
        scored.drop("tail_keys", "tail_counts")
        .join(rest, "row", "left")
        .select(
            F.col("id").alias(id_column),
            F.col("train").alias("trained"),
            "n_tokens",
            (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
            F.lit(tokens).cast("bigint").alias("train_tokens"),
            (
                F.col("base") + rest_sum
                - F.col("n_tokens") * F.log10(F.lit(float(tokens + distinct + 1)))
            ).alias("base_score"),
            (F.col("score") + rest_sum).alias("score"),
        )
    )
