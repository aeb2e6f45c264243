"""Best-fit packing of token pieces into sequences by bin completion.

Pieces of one length are interchangeable, so the search works on the counts per length, at most
``capacity`` numbers however large the corpus. It fills the sequence of the largest piece left with the
undominated filling of least waste, uses that filling as often as the counts allow, and branches where
the bound on waste leaves room for fewer sequences. Best-fit decreasing gives the first incumbent. The
pieces then get their places by their rank within their length, as a distributed step.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrloom.llm.token_ids import default_tokenizer, texts_ids
from addrloom.session import materialise

CAPACITY = 2048
# Bounds of the search: fillings looked at per sequence, fillings kept, sequences tried in all.
FILLING_NODES = 3000
BRANCHES = 3
SEARCH_NODES = 20_000

Filling = dict[int, int]
Packing = list[tuple[int, Filling]]


def best_fit(counts: Filling, capacity: int) -> Packing:
    """Best-fit decreasing on counts: each piece goes where the least room stays."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, items: tuple[int, ...], n: int) -> None:
        if room not in open_bins:
            bisect.insort(rooms, room)
            open_bins[room] = []
        open_bins[room].append((items, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            k = bisect.bisect_left(rooms, size)
            if k == len(rooms):
                per = min(capacity // size, left)
                n = left // per
                put(capacity - per * size, (size,) * per, n)
                left -= n * per
                continue
            room = rooms[k]
            items, n = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[k]
            use = min(n, left)
            if use < n:
                put(room, items, n - use)
            put(room - size, (*items, size), use)
            left -= use
    return [(n, dict(Counter(items))) for bins in open_bins.values() for items, n in bins]


def fillings(counts: Filling, sizes: list[int], room: int) -> list[Filling]:
    """Undominated ways to fill ``room``, least waste first, fewest pieces first among equals.

    ``sizes`` are the lengths left, ascending. The first leaf is the best-fit filling; a branch is
    left when no piece fits or when a filling without waste is known that needs no more pieces.
    """
    found: dict[tuple[int, ...], int] = {}
    best = [room + 1]
    nodes = [0]

    def search(room: int, limit: int, items: tuple[int, ...]) -> None:
        nodes[0] += 1
        top = bisect.bisect_right(sizes, room, 0, limit) - 1
        fits = False
        k = top
        while k >= 0 and nodes[0] < FILLING_NODES:
            size = sizes[k]
            if items.count(size) < counts[size]:
                fits = True
                search(room - size, k + 1, (*items, size))
                if best[0] == 0 and len(found) >= BRANCHES:
                    return
                # A smaller piece here and nothing after it wastes more: it is dominated.
                if room - size < sizes[0] and room - size >= best[0]:
                    break
            k -= 1
        if not fits:
            found[items] = room
            best[0] = min(best[0], room)

    search(room, len(sizes), ())
    ordered = sorted(found, key=lambda items: (found[items], len(items)))
    return [dict(Counter(items)) for items in ordered[:BRANCHES]]


def pack_counts(counts: Filling, capacity: int = CAPACITY) -> Packing:
    """(number of sequences, filling) pairs that hold all pieces in as few sequences as found."""
    best = best_fit(counts, capacity)
    best_bins = sum(n for n, _ in best)
    bound = -(-sum(s * n for s, n in counts.items()) // capacity)
    left = dict(counts)
    room_left = sum(s * n for s, n in counts.items())
    used, path = 0, []  # path: [filling, times, other fillings]
    nodes = 0
    dive = True
    while nodes < SEARCH_NODES and best_bins > bound:
        sizes = sorted(s for s, n in left.items() if n)
        if dive and not sizes:
            if used < best_bins:
                best_bins, best = used, [(times, dict(filling)) for filling, times, _ in path]
            dive = False
        if dive and used + -(-room_left // capacity) >= best_bins:
            dive = False
        if dive:
            nodes += 1
            largest = sizes[-1]
            left[largest] -= 1
            options = fillings(left, [s for s in sizes if left[s]], capacity - largest)
            left[largest] += 1
            options = [dict(Counter(o) + Counter({largest: 1})) for o in options or [{}]]
        else:
            while path and not path[-1][2]:
                filling, times, _ = path.pop()
                used -= times
                for s, n in filling.items():
                    left[s] += n * times
                    room_left += s * n * times
            if not path:
                break
            filling, times, options = path.pop()
            used -= times
            for s, n in filling.items():
                left[s] += n * times
                room_left += s * n * times
            dive = True
        filling, *others = options
        times = min(left[s] // n for s, n in filling.items())
        used += times
        for s, n in filling.items():
            left[s] -= n * times
            room_left -= s * n * times
        path.append((filling, times, others))
    return best


def token_pieces(
    docs: DataFrame, *, id_column: str, text_column: str, capacity: int, tokenizer: str
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every text's ids, cut only beyond ``capacity``."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int, int]] = []
            for row, ids in texts_ids(tokenizer, batch.column("text")):
                ids = ids.astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    out.append((row, piece, start, len(part), zlib.crc32(part.tobytes())))
            if out:
                row, piece, start, length, crc = (np.array(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").take(pa.array(row)),
                        "piece": pa.array(piece, pa.int32()),
                        "start": pa.array(start, pa.int64()),
                        "length": pa.array(length, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return rows.mapInArrow(cut, schema)


def _ranked(pieces: DataFrame) -> DataFrame:
    """Pieces with ``rank``, from 0 within their length; no task sees all pieces of one length."""
    chunks = max(1, int(pieces.count() ** 0.5))
    fields = ["doc_id", "piece", "start", "ids_crc32"]
    chunked = pieces.withColumn("chunk", F.pmod(F.xxhash64(*fields), F.lit(chunks)))
    order = Window.partitionBy("length", "chunk").orderBy(*fields)
    sizes = chunked.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("chunk")
    bases = sizes.select("length", "chunk", (F.sum("n").over(before) - F.col("n")).alias("base"))
    return (
        chunked.withColumn("nth", F.row_number().over(order) - 1)
        .join(bases, ["length", "chunk"])
        .withColumn("rank", F.col("base") + F.col("nth"))
    )


def pack_documents(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
) -> DataFrame:
    """Each piece of each document with its place in a sequence of at most ``capacity`` ids.

    Columns: id, ``piece, start, length, ids_crc32, sequence_id, offset``. A null or empty text is the end id
    alone. Equal rows are packed one by one; a null id stays null. An empty table gives no rows.
    """
    path = tokenizer or default_tokenizer()
    pieces = materialise(
        token_pieces(
            docs, id_column=id_column, text_column=text_column, capacity=capacity, tokenizer=path
        ),
        "pieces",
    )
    # At most ``capacity`` rows come to the driver.
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    keys, starts, bases, times, offsets = [], [], [], [], []
    next_rank: Counter[int] = Counter()
    sequence = 0
    for bins, filling in pack_counts(counts, capacity):
        offset = 0
        for size, n in sorted(filling.items(), reverse=True):
            keys.append((size, next_rank[size]))
            starts.append(next_rank[size])
            bases.append(sequence)
            times.append(n)
            offsets.append(offset)
            next_rank[size] += bins * n
            offset += size * n
        sequence += bins
    order = sorted(range(len(keys)), key=keys.__getitem__)
    lengths = np.array([keys[k][0] for k in order], dtype=np.int64)
    starts, bases, times, offsets = (
        np.array([x[k] for k in order], dtype=np.int64) for x in (starts, bases, times, offsets)
    )
    # One sorted number per (length, first rank); ranks stay below 2**50.
    places = lengths * 2**50 + starts

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            k = np.searchsorted(places, length * 2**50 + rank, side="right") - 1
            nth = rank - starts[k]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(bases[k] + nth // times[k]),
                    pa.array(offsets[k] + nth % times[k] * length),
                ],
                names=[*names, "sequence_id", "offset"],
            )

    ranked = _ranked(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    kind = ranked.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint"
    )
    return ranked.mapInArrow(place, schema).withColumnRenamed("doc_id", id_column)
