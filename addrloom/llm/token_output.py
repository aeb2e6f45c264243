"""Token ids in training order: fixed-stride binary shards that can be read, and written, from any point.

Every sequence gets a global slot by a keyed Feistel permutation of its number, walking on from results
beyond the last number. Shards hold equal ranges of slots. A task holds a range of shards, gets its
sequences sorted by slot, and writes shard after shard: each beside its place, then moved there, so a
lost or repeated task leaves no part of one.

A shard is a header (``HEADER``) and records of one size: the sequence's length as an unsigned 32-bit
number, then ``seq_len`` unsigned 16-bit ids, zeros after the last. All numbers are little-endian.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from addrloom.llm.token_ids import default_tokenizer, texts_ids
from addrloom.llm.words import mix
from addrloom.session import materialise

SEQ_LEN = 1024
SHARD_SEQUENCES = 2048
# Magic, version, seq_len, first slot, number of records, CRC-32 of the records.
HEADER = "<8sIIQQQ"
VERSION = 2
MAGIC = b"TOKSHARD"
# Shards not yet complete.
WRITING = "_writing-"
ROUNDS = 6
FLUSH_SEQUENCES = 1024
# Shards that one task writes, one after the other, once there are more than tasks to keep cores busy.
TASK_SHARDS = 32


def feistel_slots(numbers: np.ndarray, total: int, key: int) -> np.ndarray:
    """A permutation of 0..total-1 selected by ``key``, applied to ``numbers``."""
    half = max(1, (max(1, total - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64((key << 8) % (1 << 64) | 1))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        return (left << np.uint64(half)) | right

    slots = once(numbers.astype(np.uint64))
    beyond = np.flatnonzero(slots >= total)
    while len(beyond):
        slots[beyond] = once(slots[beyond])
        beyond = beyond[slots[beyond] >= total]
    return slots.astype(np.int64)


def _sequences(rows: DataFrame, seq_len: int, tokenizer: str, continuous: bool) -> DataFrame:
    """``(part, nth, docs, ids)``: sequences numbered within their task, and the pieces each is made of."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    docs_type = pa.list_(
        pa.struct(
            [("doc_id", to_arrow_type(rows.schema["doc_id"].dataType)), ("piece", pa.int32()), ("length", pa.int32())]
        )
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        # The sequence that is being filled: its ids, its pieces and the ids that it still takes.
        held: list[np.ndarray] = []
        own: list[dict] = []
        space = seq_len
        done_docs: list[list[dict]] = []
        done_ids: list[bytes] = []

        def close() -> None:
            nonlocal held, own, space
            if own:
                done_docs.append(own)
                done_ids.append(np.concatenate(held).tobytes())
            held, own, space = [], [], seq_len

        def flush() -> pa.RecordBatch:
            nonlocal nth
            count = len(done_ids)
            batch = pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(count, part), pa.int32()),
                    "nth": pa.array(np.arange(nth, nth + count), pa.int64()),
                    "docs": pa.array(done_docs, docs_type),
                    "ids": pa.array(done_ids, pa.binary()),
                }
            )
            nth += count
            done_docs.clear()
            done_ids.clear()
            return batch

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for r, ids in texts_ids(tokenizer, batch.column("text")):
                if ids.max() > 65535:
                    raise ValueError("the tokenizer has ids beyond 16 bits")
                ids = ids.astype("<u2")
                start = piece = 0
                while start < len(ids):
                    taken = ids[start : start + space]
                    held.append(taken)
                    own.append({"doc_id": names[r], "piece": piece, "length": len(taken)})
                    start, piece, space = start + len(taken), piece + 1, space - len(taken)
                    if space == 0 or not continuous:
                        close()
                if len(done_ids) >= FLUSH_SEQUENCES:
                    yield flush()
        close()
        if done_ids:
            yield flush()

    return rows.mapInArrow(
        cut,
        f"part int, nth bigint, docs array<struct<doc_id: {kind}, piece: int, length: int>>, ids binary",
    )


def shard_path(folder: str, shard: int) -> str:
    return f"{folder.rstrip('/')}/shard-{shard:08d}.bin"


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _store_shard(files, base: str, shard: int, content: bytes, header: bytes) -> None:
    """Write a shard unless the very same one is there: header, which names the content, and size."""
    path = shard_path(base, shard)
    known = files.get_file_info(path)
    if known.is_file and known.size == len(header) + len(content):
        with files.open_input_file(path) as stream:
            if stream.read(len(header)) == header:
                return
    beside = f"{base.rstrip('/')}/{WRITING}{shard:08d}-{uuid.uuid4().hex}"
    with files.open_output_stream(beside) as stream:
        stream.write(header)
        stream.write(content)
    files.move(beside, path)


def _clear_left_overs(folder: str, n_shards: int) -> None:
    """Remove what lost tasks of earlier runs left, and shards beyond the last one of this run."""
    from pyarrow import fs

    files, base = _file_system(folder)
    files.create_dir(base, recursive=True)
    last = shard_path(base, n_shards - 1).rsplit("/", 1)[1] if n_shards else ""
    for info in files.get_file_info(fs.FileSelector(base)):
        beyond = info.base_name.startswith("shard-") and (
            (len(info.base_name), info.base_name) > (len(last), last)
        )
        if info.is_file and (beyond or info.base_name.startswith(WRITING)):
            files.delete_file(info.path)


def write_training_order(
    docs: DataFrame,
    folder: str,
    *,
    key: int = 20_240_229,
    id_column: str = "doc_id",
    text_column: str = "text",
    seq_len: int = SEQ_LEN,
    shard_sequences: int = SHARD_SEQUENCES,
    tokenizer: str | None = None,
    continuous: bool = False,
) -> DataFrame:
    """Write ``docs`` as shards below ``folder``, a path that all executors reach.

    A sequence holds one document or a piece of it; with ``continuous`` the documents of a task follow
    each other, each closed by its end id, and only the task's last sequence is filled up with
    zeros. Returns the manifest, one row per piece of a document: id, ``piece, slot, shard, byte_offset``
    of its record, ``offset`` (ids before it there), ``length, ids_crc32``.

    Writing happens as the result is computed. A shard that is already in ``folder`` with the same
    content is not written again, any other is replaced; shards of an earlier, longer run and parts
    that lost tasks left are removed first, so one run at a time may use a folder. A null or empty text
    is the end id alone; ids may be null; equal rows are pieces of their own; very long texts are
    cut; an empty table writes nothing. Only the two columns named are read.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # Stored in large compressed pages, dealt out compressed one by one; shards hold plain ids.
    sequences = materialise(
        _sequences(rows, seq_len, tokenizer or default_tokenizer(), continuous),
        "sequences",
        compression="zstd",
    )
    # One number per task of the step before.
    counts = sequences.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    base, total = {}, 0
    for row in counts:
        base[row["part"]] = total
        total += row["n"]
    n_shards = -(-total // shard_sequences)
    _clear_left_overs(folder, n_shards)
    cores = docs.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n_shards, max(4 * cores, -(-n_shards // TASK_SHARDS))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, inverse = np.unique(batch.column("part").to_numpy(), return_inverse=True)
            first = np.array([base[p] for p in part.tolist()], dtype=np.int64)
            slots = feistel_slots(first[inverse] + batch.column("nth").to_numpy(), total, key)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((slots // shard_sequences * tasks // max(1, n_shards)).astype(np.int32)),
                    pa.array(slots),
                    batch.column("docs"),
                    pa.array([zlib.compress(b.as_py(), 1) for b in batch.column("ids")], pa.binary()),
                ],
                names=["task", "slot", "docs", "ids"],
            )

    stride = 4 + 2 * seq_len
    head = struct.calcsize(HEADER)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _file_system(folder)

        def store(shard: int, slots: list, docs_: list, blobs: list) -> pa.RecordBatch:
            first = shard * shard_sequences
            if slots != list(range(first, min(first + shard_sequences, total))):
                raise ValueError(f"the slots of shard {shard} are not complete")
            content, found = bytearray(), []
            for k, (pieces, blob) in enumerate(zip(docs_, blobs, strict=True)):
                content += struct.pack("<I", len(blob) // 2) + blob + bytes(stride - 4 - len(blob))
                at = 0
                for p in pieces:
                    crc = zlib.crc32(blob[2 * at : 2 * (at + p["length"])])
                    found.append((p["doc_id"], p["piece"], slots[k], head + stride * k, at, p["length"], crc))
                    at += p["length"]
            crc = zlib.crc32(content)
            header = struct.pack(HEADER, MAGIC, VERSION, seq_len, first, len(blobs), crc)
            _store_shard(files, root, shard, bytes(content), header)
            doc_id, piece, slot, byte_offset, offset, length, ids_crc32 = zip(*found, strict=True)
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(doc_id, id_type),
                    "piece": pa.array(piece, pa.int32()),
                    "slot": pa.array(slot, pa.int64()),
                    "shard": pa.array(np.full(len(found), shard), pa.int64()),
                    "byte_offset": pa.array(byte_offset, pa.int64()),
                    "offset": pa.array(offset, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(ids_crc32, pa.int64()),
                }
            )

        shard, slots, docs_, blobs, id_type = None, [], [], [], None
        for batch in batches:
            column = batch.column("docs")
            id_type = column.type.value_type.field("doc_id").type
            for slot, pieces, packed in zip(
                batch.column("slot").to_pylist(), column.to_pylist(), batch.column("ids").to_pylist()
            ):
                if slot // shard_sequences != shard:
                    if slots:
                        yield store(shard, slots, docs_, blobs)
                    shard, slots, docs_, blobs = slot // shard_sequences, [], [], []
                slots.append(slot)
                docs_.append(pieces)
                blobs.append(zlib.decompress(packed))
        if slots:
            yield store(shard, slots, docs_, blobs)

    placed = sequences.mapInArrow(
        place,
        f"task int, slot bigint, docs array<struct<doc_id: {kind}, piece: int, length: int>>, ids binary",
    )
    manifest = (
        placed.repartitionById(tasks, F.col("task"))
        .sortWithinPartitions("slot")
        .select("slot", "docs", "ids")
        .mapInArrow(
            write,
            f"doc_id {kind}, piece int, slot bigint, shard bigint, byte_offset bigint, offset bigint, "
            "length bigint, ids_crc32 bigint",
        )
    )
    return manifest.withColumnRenamed("doc_id", id_column)


def read_sequences(folder: str, shard: int, start: int = 0, count: int | None = None) -> Iterator[np.ndarray]:
    """The ids of a shard's records from the ``start``-th on: one seek, then a sequential read."""
    files, base = _file_system(folder)
    with files.open_input_file(shard_path(base, shard)) as stream:
        magic, version, seq_len, _, records, _ = struct.unpack(HEADER, stream.read(struct.calcsize(HEADER)))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"not a token shard: {shard}")
        stride = 4 + 2 * seq_len
        stream.seek(struct.calcsize(HEADER) + stride * start)
        end = records if count is None else min(records, start + count)
        for _ in range(start, end):
            record = stream.read(stride)
            yield np.frombuffer(record, dtype="<u2", offset=4, count=struct.unpack_from("<I", record)[0])
