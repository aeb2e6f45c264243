"""Fill-in-middle transformation: a text's middle moves to its end, behind sentinels, for some documents.

Cuts are drawn in units (lines or characters) and made in bytes. An exception index holds the byte
position of each multibyte character and the bytes it takes beyond one; a binary search in it converts
between code points and bytes, and everything between two exceptions is plain arithmetic. A text in
ASCII has no exceptions, so its code points are its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.llm.words import text_chunks

# The strings before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

KEY = "7"
# Of 100 documents, how many are transformed, and how many of these put the suffix first.
RATE = 100
SUFFIX_FIRST = 50
UNITS = ("line", "char")

NEWLINE = 0x0A


class ExceptionIndex:
    """Positions of the multibyte characters of UTF-8 ``data`` and their bytes beyond the first."""

    def __init__(self, data: np.ndarray) -> None:
        self.at_byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.at_byte]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        # Excess bytes before each exception, and of all of them.
        self.before = np.concatenate([[0], np.cumsum(excess)])
        self.at_char = self.at_byte - self.before[:-1]

    def chars(self, positions: np.ndarray) -> np.ndarray:
        """Code points before each byte position, which is the start of a character or the end."""
        return positions - self.before[np.searchsorted(self.at_byte, positions)]

    def bytes(self, positions: np.ndarray) -> np.ndarray:
        """Bytes before each code point position."""
        return positions + self.before[np.searchsorted(self.at_char, positions)]


def unit_cuts(
    data: np.ndarray, offsets: np.ndarray, index: ExceptionIndex, unit: str
) -> tuple[np.ndarray, object]:
    """Units of each row, and a function: byte positions after the first ``k`` units of each row."""
    first, last = offsets[:-1], offsets[1:]
    if unit == "char":
        start = index.chars(offsets)
        return np.diff(start), lambda k: index.bytes(start[:-1] + k)
    newlines = np.flatnonzero(data == NEWLINE)
    begin = np.searchsorted(newlines, offsets)
    ended = np.diff(begin)
    # A last line without a newline is a unit as well.
    full = last > first
    open_end = np.zeros(len(first), dtype=bool)
    open_end[full] = data[last[full] - 1] != NEWLINE
    ends = np.append(newlines + 1, len(data))

    def cut(k: np.ndarray) -> np.ndarray:
        at = ends[np.clip(begin[:-1] + k - 1, 0, len(ends) - 1)]
        return np.where(k == 0, first, np.where(k > ended, last, at))

    return ended + open_end, cut


def fill_in_middle(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    unit: str = "line",
    key: str = KEY,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output)`` per row of ``docs``, over whole texts.

    A text has ``n`` units. Four 32-bit numbers from the SHA-256 of ``key:id`` place two cuts, each
    after 0 to ``n`` units, and choose the form: ``psm`` and ``spm`` put sentinels and the middle last,
    ``plain`` leaves the text. Equal ids get equal draws, so re-runs agree.

    Null and empty texts are ``plain`` with no units, as is a text that holds a sentinel: its output
    could not be told apart. A null id draws as an empty one. Rows are independent: equal rows give
    equal rows, an empty table none; a very long text is a chunk of its own. Only the two columns
    named are read, so further columns may have any name.
    """
    if unit not in UNITS:
        raise ValueError(f"unknown unit: {unit}")
    name = F.concat(F.lit(f"{key}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.substring(F.unhex(F.sha2(name.cast("binary"), 256)), 1, 16).alias("draws"),
        F.col(text_column).alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    sentinels = [s.encode() for s in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = sentinels

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = np.frombuffer(b"".join(batch.column("draws").to_pylist()), dtype=">u4")
            draws = draws.reshape(-1, 4).astype(np.int64)
            for row, data, offsets in text_chunks(batch.column("text")):
                count = len(offsets) - 1
                own = draws[row : row + count]
                index = ExceptionIndex(data)
                n, cut = unit_cuts(data, offsets, index, unit)
                drawn = own[:, :2] % (n[:, None] + 1)
                a, b = cut(drawn.min(axis=1)), cut(drawn.max(axis=1))
                first = index.chars(offsets[:-1])
                a_char, b_char = index.chars(a), index.chars(b)
                wanted = own[:, 2] % 100 < rate
                turned = own[:, 3] % 100 < suffix_first
                raw = data.tobytes()
                forms, outputs = [], []
                for r in range(count):
                    text = raw[offsets[r] : offsets[r + 1]]
                    if not text or not wanted[r] or any(x in text for x in sentinels):
                        forms.append("plain")
                        outputs.append(text)
                        continue
                    i, j = a[r] - offsets[r], b[r] - offsets[r]
                    prefix, middle, suffix = text[:i], text[i:j], text[j:]
                    if turned[r]:
                        forms.append("spm")
                        outputs.append(b"".join([s, suffix, p, prefix, m, middle]))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join([p, prefix, s, suffix, m, middle]))
                plain = np.array([f == "plain" for f in forms])
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": batch.column("id").slice(row, count),
                        "n": pa.array(n, pa.int64()),
                        "form": pa.array(forms, pa.string()),
                        "prefix_chars": pa.array(a_char - first, pa.int64(), mask=plain),
                        "middle_chars": pa.array(b_char - a_char, pa.int64(), mask=plain),
                        "output": pa.array(outputs, pa.binary()).cast(pa.string()),
                    }
                )

    result = rows.mapInArrow(
        transform,
        f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string",
    )
    return result.withColumnRenamed("id", id_column)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form alone.

    No part of a transformed text holds a sentinel, and a sentinel starts with the one character that
    it holds nowhere else, so the first occurrence of each after the leading one is the true one.
    """
    text = F.col(output)
    body = F.expr(f"substring(`{output}`, {len(PREFIX) + 1})")

    def parts(between: str) -> tuple[Column, Column, Column]:
        rest = F.split_part(body, F.lit(between), F.lit(2))
        return (
            F.split_part(body, F.lit(between), F.lit(1)),
            F.split_part(rest, F.lit(MIDDLE), F.lit(1)),
            F.split_part(rest, F.lit(MIDDLE), F.lit(2)),
        )

    prefix, suffix, middle = parts(SUFFIX)
    late_suffix, late_prefix, late_middle = parts(PREFIX)
    return (
        F.when(F.col(form) == "psm", F.concat(prefix, middle, suffix))
        .when(F.col(form) == "spm", F.concat(late_prefix, late_middle, late_suffix))
        .otherwise(text)
    )
