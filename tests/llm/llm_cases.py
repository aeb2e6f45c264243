from __future__ import annotations

import random
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

# Names that the operators use themselves.
EXTRA = ["id", "row", "key", "set", "content", "score", "taken", "gone", "n_shards", "words"]


def words(text: str | None, lower: bool = False) -> list[bytes]:
    raw = (text or "").encode()
    return WORD.findall(raw.translate(LOWER) if lower else raw)


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(f"w{rng.randrange(400)}" for _ in range(n))


def tricky_texts() -> list[tuple[int | None, str | None, str | None]]:
    """(id, source, text): nulls, empty and very long texts, ties, repeated rows, near and exact copies."""
    rng = random.Random(5)
    base = sentence(rng, 120)
    passage = sentence(rng, 40)
    rows: list[tuple[int | None, str | None, str | None]] = [
        (1, "a", None), (2, "a", ""), (3, None, "  \n\t "), (None, "a", "no id at all"),
        (None, None, None), (4, "b", "one"), (5, "b", "one"), (5, "b", "one"), (6, "c", "One two three"),
        (7, "c", base), (8, "a", base), (8, "a", base), (9, "b", base + " tail"),
        (10, "a", base.upper()), (11, "a", "x" * 300_000), (12, "é", "ünï cödé text   ok"),
        (13, "a", sentence(rng, 60_000)), (14, "a", "tie"), (14, "b", "other text, the same id"),
    ]
    for k in range(20, 60):
        parts = base.split()
        for _ in range(3):
            parts[rng.randrange(len(parts))] = f"new{rng.randrange(1000)}"
        rows.append((k, "hot", " ".join(parts)))
    for k in range(60, 90):
        rows.append((k, "hot", f"{sentence(rng, 30)} {passage}\n{sentence(rng, 20)}"))
    rows += [(k, "hot", "the very same text, many times over, in one group") for k in range(100, 160)]
    rows += [(k, f"s{k % 7}", sentence(rng, rng.randrange(1, 200))) for k in range(200, 260)]
    return rows


class Components:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
