"""Token ids of whole texts by a public tokenizer whose splits respect white space.

Each distinct word is encoded once per worker and the ids of a text are gathered from those, which
gives the same ids as encoding the text at once, many times faster.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from addrloom.llm.words import LOWER, find_words, text_chunks, word_keys

# Words a worker remembers before it starts anew, which bounds its memory.
CACHED_WORDS = 400_000
END_ID = 0

_CUT_OFF = np.zeros(256, dtype=bool)
_CUT_OFF[[ord(c) for c in ".,;:!?"]] = True
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]] = True


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of the words seen so far: sorted digests, and where their ids lie."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.keys = np.empty(0, dtype=np.uint64)
        self.at = np.empty(0, dtype=np.int64)
        self.sizes = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.uint32)

    def add(self, keys: np.ndarray, words: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        at = len(self.ids) + np.cumsum(sizes) - sizes
        flat = np.fromiter((i for ids in found for i in ids), dtype=np.uint32, count=sizes.sum())
        keys, at, sizes = (
            np.concatenate(x) for x in ((self.keys, keys), (self.at, at), (self.sizes, sizes))
        )
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.sizes = keys[order], at[order], sizes[order]
        self.ids = np.concatenate([self.ids, flat])

    def of_chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk of texts, each text closed by ``END_ID``, and each text's first id."""
        if b"<|" not in data.tobytes():  # else a special token might be spelt by the lower case
            data = LOWER[data]
        starts, ends, first = find_words(data, offsets)
        # A sentence mark after a plain letter or digit is a token of its own: fewer distinct words.
        long = np.flatnonzero(ends - starts > 1)
        cut = long[_CUT_OFF[data[ends[long] - 1]] & _PLAIN[data[ends[long] - 2]]]
        marks = ends[cut] - 1
        ends[cut] -= 1
        starts = np.insert(starts, cut + 1, marks)
        ends = np.insert(ends, cut + 1, marks + 1)
        first = first + np.searchsorted(cut, first)
        keys, head, word = np.unique(
            word_keys(data, starts, ends), return_index=True, return_inverse=True
        )
        if len(self.keys) > CACHED_WORDS:
            self.forget()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            spans = zip(starts[head[new]].tolist(), ends[head[new]].tolist(), strict=True)
            self.add(keys[new], [raw[a:b].decode("utf-8", "replace") for a, b in spans])
            place = np.searchsorted(self.keys, keys)
        sizes = self.sizes[place][word]
        at = self.at[place][word]
        total = np.concatenate([[0], np.cumsum(sizes)])
        gather = np.repeat(at - total[:-1], sizes) + np.arange(total[-1])
        bounds = total[first]
        ids = np.insert(self.ids[gather], bounds[1:], END_ID)
        return ids, bounds + np.arange(len(bounds))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def texts_ids(path: str, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row number, ids with the end id) for every text of the column; null is empty."""
    tokenizer = word_ids(path)
    for row, data, offsets in text_chunks(column):
        ids, bounds = tokenizer.of_chunk(data, offsets)
        for k in range(len(bounds) - 1):
            yield row + k, ids[bounds[k] : bounds[k + 1]]
