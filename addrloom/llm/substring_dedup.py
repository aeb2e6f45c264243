"""Passages that an earlier document holds too, found with FM-indexes.

Each window of ``WINDOW`` words has an anchor, the ``GRAM`` words in it of least digest, so equal windows have
equal anchors. A first scan finds the anchors that different texts share. Of the texts that have such
anchors, the runs of windows around each are dealt over shards by anchor; equal runs are sent once. A
shard builds an FM-index of its runs and streams the runs against it: backward search gives each
window's matching statistics, and of those matched in full the smallest document id in the interval.

Texts of equal words are one text throughout; of a group of copies only the smallest id is searched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.llm.fm_index import FmIndex
from addrloom.llm.words import find_words, mix, text_chunks, window_keys, word_keys
from addrloom.session import materialise

WINDOW = 13
GRAM = 6
BUCKET_ANCHORS = 200_000
SHARD_WORDS = 1_000_000


def _digest_rows(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A digest of each row's word sequence."""
    place = np.arange(len(keys)) - np.repeat(first[:-1], np.diff(first))
    placed = mix(keys + mix(place.astype(np.uint64) + np.uint64(1)))
    total = np.concatenate([[np.uint64(0)], np.cumsum(placed, dtype=np.uint64)])
    sums = total[first[1:]] - total[first[:-1]]
    return mix(sums + mix(np.diff(first).astype(np.uint64))).view(np.int64)


def anchor_runs(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: row, first window, end, anchor; windows by their first word."""
    span = WINDOW - GRAM + 1
    grams = window_keys(keys, GRAM)
    n = len(keys) - WINDOW + 1
    if n <= 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.view(np.uint64)
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, span):
        other = grams[j : j + n]
        less = other < best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + j
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
    windows = np.flatnonzero(np.arange(n) + WINDOW <= first[row + 1])
    if len(windows) == 0:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.view(np.uint64)
    new = np.ones(len(windows), dtype=bool)
    a, b = windows[1:], windows[:-1]
    new[1:] = (at[a] != at[b]) | (row[a] != row[b])
    heads = np.flatnonzero(new)
    starts = windows[heads]
    sizes = np.diff(np.append(heads, len(windows)))
    return row[starts], starts, starts + sizes, mix(best[starts])


def _chunk(data: np.ndarray, offsets: np.ndarray):
    starts, ends, first = find_words(data, offsets)
    return starts, ends, first, word_keys(data, starts, ends)


def _kept_digest(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> str:
    words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return hashlib.sha256(b" ".join(words)).hexdigest()


# --- which anchors different texts share ---------------------------------------------------------------


def _name_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts, digests = [], [], []
        for _, data, offsets in text_chunks(batch.column("text")):
            starts, ends, first, keys = _chunk(data, offsets)
            raw = data.tobytes()
            texts.append(_digest_rows(keys, first))
            counts.append(np.diff(first))
            digests += [
                _kept_digest(raw, starts[a:b], ends[a:b])
                for a, b in zip(first[:-1], first[1:], strict=True)
            ]
        if digests:
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "text_name": pa.array(np.concatenate(texts)),
                    "n_words": pa.array(np.concatenate(counts), pa.int64()),
                    "sha": pa.array(digests),
                }
            )


def _blobs(group: np.ndarray, columns: dict[str, np.ndarray]) -> dict[str, pa.Array]:
    """Columns cut by the ascending ``group`` into one blob per group."""
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))[: len(group)]
    ends = np.append(cuts[1:], len(group))[: len(cuts)]
    spans = list(zip(cuts.tolist(), ends.tolist(), strict=True))
    return {
        "group": pa.array(group[cuts]),
        **{k: pa.array([v[a:b].tobytes() for a, b in spans], pa.binary()) for k, v in columns.items()},
    }


def _scale(keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of each 64-bit key, by range."""
    return ((keys.view(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _deal_anchors(buckets: int):
    """Anchors with their texts by bucket; of one that several texts of a batch have, only one is sent.

    ``lone`` tells the others apart; for those the texts are known to share it and go along as ``shared``.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, owners = [], []
            for _, data, offsets in text_chunks(batch.column("text")):
                _, _, first, keys = _chunk(data, offsets)
                row, _, _, anchor = anchor_runs(keys, first)
                tokens.append(anchor)
                owners.append(_digest_rows(keys, first)[row])
            if not tokens or not sum(map(len, tokens)):
                continue
            tokens, owners = np.concatenate(tokens), np.concatenate(owners)
            order = np.lexsort((owners, tokens))
            tokens, owners = tokens[order], owners[order]
            fresh = np.ones(len(tokens), dtype=bool)
            fresh[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
            tokens, owners = tokens[fresh], owners[fresh]
            heads = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
            sizes = np.diff(np.append(heads, len(tokens)))
            # Ascending tokens have ascending buckets.
            sent = _blobs(
                _scale(tokens[heads], buckets),
                {
                    "tokens": tokens[heads].astype(np.uint32),
                    "owners": owners[heads],
                    "lone": (sizes == 1),
                },
            )
            several = np.repeat(sizes > 1, sizes)
            own = _blobs(
                _scale(tokens[several], buckets),
                {"shared_tokens": tokens[several].astype(np.uint32), "shared_owners": owners[several]},
            )
            for part in (sent, own):
                n = len(part["group"])
                if n:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "bucket": part["group"],
                            **{
                                k: part.get(k, pa.nulls(n, pa.binary()))
                                for k in ("tokens", "owners", "lone", "shared_tokens", "shared_owners")
                            },
                        }
                    )

    return deal


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.concatenate(
        [np.empty(0, dtype=kind), *[np.frombuffer(b.as_py(), dtype=kind) for b in column.drop_null()]]
    )


def _shared_anchors(homes: int):
    """Of one bucket: each text with its anchors that another text has too, by range of text names."""

    def shared(table: pa.Table) -> pa.Table:
        tokens = _joined(table["tokens"], np.uint32)
        owners = _joined(table["owners"], np.int64)
        lone = _joined(table["lone"], bool)
        order = np.lexsort((owners, tokens))
        tokens, owners, lone = tokens[order], owners[order], lone[order]
        new = np.append(True, tokens[1:] != tokens[:-1])
        group = np.cumsum(new) - 1
        pairs = new | np.append(True, owners[1:] != owners[:-1])
        several = (np.bincount(group, weights=pairs) > 1) | (np.bincount(group, weights=~lone) > 0)
        mine = pairs & several[group]
        tokens = np.concatenate([tokens[mine], _joined(table["shared_tokens"], np.uint32)])
        owners = np.concatenate([owners[mine], _joined(table["shared_owners"], np.int64)])
        home = _scale(owners, homes)
        order = np.argsort(home, kind="stable")
        return pa.table(_blobs(home[order], {"tokens": tokens[order], "owners": owners[order]}))

    return shared


def _by_text(table: pa.Table) -> pa.Table:
    """One row per text: its shared anchors."""
    tokens, owners = _joined(table["tokens"], np.uint32), _joined(table["owners"], np.int64)
    order = np.lexsort((tokens, owners))
    blobs = _blobs(owners[order], {"anchors": tokens[order]})
    return pa.table({"text_name": blobs["group"], "anchors": blobs["anchors"]})


# --- runs and shards -------------------------------------------------------------------------------------


def _make_runs(shards: int, part: str):
    """Runs of windows at shared anchors: who has which (``members``), or each different run once per
    batch with its words (``codes``)."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            names = batch.column("text_name").to_numpy()
            for start, data, offsets in text_chunks(batch.column("text")):
                _, _, first, keys = _chunk(data, offsets)
                row, a, b, anchor = anchor_runs(keys, first)
                mine = np.zeros(len(row), dtype=bool)
                cuts = np.searchsorted(row, np.arange(len(first)))
                for r in range(len(first) - 1):
                    wanted = np.frombuffer(batch.column("anchors")[start + r].as_py(), np.uint32)
                    s = slice(cuts[r], cuts[r + 1])
                    mine[s] = np.isin(anchor[s].astype(np.uint32), wanted)
                row, a, b, anchor = row[mine], a[mine], b[mine], anchor[mine]
                if len(row) == 0:
                    continue
                wide = window_keys(keys, WINDOW)
                # A run's first and last window cover all of it.
                run = mix(wide[a] + mix(wide[b - 1] + (b - a).astype(np.uint64))).view(np.int64)
                owner = ids[start + row]
                member = {
                    "run": pa.array(run),
                    "text_name": pa.array(names[start + row]),
                    "id": pa.array(owner),
                    "at": pa.array(a - first[row], pa.int64()),
                    "windows": pa.array(b - a, pa.int64()),
                }
                if part == "members":
                    yield pa.RecordBatch.from_pydict(member)
                    continue
                order = np.lexsort((owner, run))
                one = order[np.append(True, run[order][1:] != run[order][:-1])]
                yield pa.RecordBatch.from_pydict(
                    {
                        "run": pa.array(run[one]),
                        "id": pa.array(owner[one]),
                        "shard": pa.array(_scale(anchor[one], shards)),
                        "codes": pa.array(
                            [keys[a[k] : b[k] + WINDOW - 1].tobytes() for k in one.tolist()], pa.binary()
                        ),
                    }
                )

    return runs


def _search_shard(table: pa.Table) -> pa.Table:
    """Index the shard's runs, stream them against it, and mark windows that a smaller id has too."""
    ids = table["id"].to_numpy()
    blobs = [b.as_py() for b in table["codes"]]
    sizes = np.fromiter((len(b) // 8 for b in blobs), dtype=np.int64, count=len(blobs))
    index = FmIndex(np.frombuffer(b"".join(blobs), dtype=np.uint64), sizes, depth=WINDOW)
    windows = sizes - WINDOW + 1
    piece = np.repeat(np.arange(len(sizes)), windows)
    nth = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    begins = np.cumsum(sizes + 1) - sizes - 1
    low, high, size = index.matches(begins[piece] + nth + WINDOW, WINDOW)
    full = np.flatnonzero(size == WINDOW)
    # Intervals of texts of one length are equal or apart, so one pass over them gives the smallest ids.
    bounds, back = np.unique(low[full], return_inverse=True)
    marked = np.zeros(len(piece), dtype=bool)
    if len(full):
        ends = np.zeros(len(bounds), dtype=np.int64)
        ends[back] = high[full]
        owners = np.append(ids[index.piece[index.order]], np.iinfo(np.int64).max)
        cuts = np.stack([bounds, ends], axis=1).ravel()
        smallest = np.minimum.reduceat(owners, cuts)[::2]
        marked[full] = smallest[back] < ids[piece[full]]
    at = np.cumsum(windows) - windows
    masks = np.add.reduceat(marked.astype(np.int64) << nth, at)
    return pa.table(
        {"run": table["run"], "low_id": table["id"], "mask": pa.array(masks, pa.int64())}
    )


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words left of each text once the words of its marked windows are gone."""
    for batch in batches:
        removed, digests = [], []
        for start, data, offsets in text_chunks(batch.column("text")):
            starts, ends, first = find_words(data, offsets)
            raw = data.tobytes()
            for r in range(len(first) - 1):
                a, b = int(first[r]), int(first[r + 1])
                marks = np.asarray(batch.column("marks")[start + r].as_py(), dtype=np.int64).reshape(-1, 2)
                change = np.zeros(b - a + 1, dtype=np.int64)
                for at, mask in marks.tolist():
                    while mask:
                        k = (mask & -mask).bit_length() - 1
                        change[at + k] += 1
                        change[at + k + WINDOW] -= 1
                        mask &= mask - 1
                keep = np.cumsum(change[:-1]) == 0
                removed.append(int((~keep).sum()))
                digests.append(_kept_digest(raw, starts[a:b][keep], ends[a:b][keep]))
        if digests:
            yield pa.RecordBatch.from_pydict(
                {
                    "text_name": batch.column("text_name"),
                    "n_removed": pa.array(removed, pa.int64()),
                    "left_sha": pa.array(digests),
                }
            )


def remove_repeats(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``n_words, n_removed, kept_sha256`` (of the kept words joined by one space).

    A word goes if a window of 13 words that covers it also starts in a row with a smaller id. Ids are
    whole numbers; a row with a null id loses nothing and takes nothing away, and rows with equal ids do
    not touch each other. A null or empty text has no words; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    named = materialise(
        rows.mapInArrow(_name_texts, "id bigint, text_name bigint, n_words bigint, sha string"),
        "texts",
    )
    anchors = named.agg(F.sum("n_words")).first()[0] or 0
    anchors = anchors * 2 // (WINDOW - GRAM + 2)
    buckets = max(1, anchors // BUCKET_ANCHORS)
    identified = rows.where("id IS NOT NULL").select("text")
    shared = (
        identified.mapInArrow(
            _deal_anchors(buckets),
            "bucket bigint, tokens binary, owners binary, lone binary, shared_tokens binary, "
            "shared_owners binary",
        )
        .groupBy("bucket")
        .applyInArrow(
            _shared_anchors(max(1, buckets // 4)), "group bigint, tokens binary, owners binary"
        )
        .groupBy("group")
        .applyInArrow(_by_text, "text_name bigint, anchors binary")
    )
    lowest = materialise(
        named.where("id IS NOT NULL").groupBy("text_name").agg(F.min("id").alias("low_id")), "lowest"
    )
    wanted = materialise(shared.join(lowest, "text_name"), "wanted")
    # The text comes by its smallest id; rows that share the id but not the words are told apart by name.
    texts = rows.join(wanted, F.col("id") == F.col("low_id")).select("id", "text", "text_name", "anchors")
    # The one copy of the texts that is kept; the runs are read off it twice rather than kept beside it.
    open_texts = materialise(texts.mapInArrow(_own_text, texts.schema), "open-texts", compression="zstd")
    words = open_texts.agg(F.sum(F.length("anchors")).alias("n")).first()[0] or 0
    shards = max(1, int(words // 4 * (2 * WINDOW - GRAM)) // SHARD_WORDS)
    members = open_texts.mapInArrow(
        _make_runs(shards, "members"), "run bigint, text_name bigint, id bigint, at bigint, windows bigint"
    )
    different = (
        open_texts.mapInArrow(_make_runs(shards, "codes"), "run bigint, id bigint, shard bigint, codes binary")
        .groupBy("run")
        .agg(F.min("id").alias("id"), F.first("shard").alias("shard"), F.first("codes").alias("codes"))
    )
    searched = materialise(
        different.groupBy("shard").applyInArrow(
            _search_shard, "run bigint, low_id bigint, mask bigint"
        ),
        "searched",
    )
    every = F.expr("shiftleft(1L, CAST(windows AS INT)) - 1")
    marks = (
        members.join(searched, "run")
        .withColumn("mask", F.when(F.col("id") > F.col("low_id"), every).otherwise(F.col("mask")))
        .where("mask <> 0")
        .groupBy("text_name")
        .agg(F.collect_set(F.array("at", "mask")).alias("marks"))
    )
    marked = open_texts.select("text_name", "text").dropDuplicates(["text_name"]).join(marks, "text_name")
    left = materialise(
        marked.mapInArrow(_remove, "text_name bigint, n_removed bigint, left_sha string"), "left"
    )
    by_text = materialise(lowest.join(left, "text_name", "left"), "by-text")
    whole = F.col("id") > F.col("low_id")
    gone = whole & (F.col("n_words") >= WINDOW)
    return named.join(by_text, "text_name", "left").select(
        F.col("id").alias(id_column),
        "n_words",
        F.when(gone, F.col("n_words"))
        .when(F.col("id") == F.col("low_id"), F.coalesce("n_removed", F.lit(0)))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("n_removed"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest()))
        .when((F.col("id") == F.col("low_id")) & F.col("left_sha").isNotNull(), F.col("left_sha"))
        .otherwise(F.col("sha"))
        .alias("kept_sha256"),
    )


def _own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose words are the text that they were joined with."""
    for batch in batches:
        names = [np.empty(0, dtype=np.int64)]
        for _, data, offsets in text_chunks(batch.column("text")):
            _, _, first, keys = _chunk(data, offsets)
            names.append(_digest_rows(keys, first))
        same = np.concatenate(names) == batch.column("text_name").to_numpy()
        yield batch.filter(pa.array(same))
