"""Jaccard join of n-gram sets with a prefix tree.

1. A first scan names each document's set of n-grams (equal sets share one name) and counts n-grams in a
   sketch of fixed size. Rare first, then by digest, is the global order of n-grams.
2. A second scan deals the first n-grams of each set over buckets. Two sets that link share several of
   these, so sets with too few shared ones are done. This is exact: no n-gram is too common.
3. The sets left are read once more and put into prefix trees by a few of their first n-grams, chosen among
   those that a second set has: the rarest, and those that most sets have, in which all copies of a text
   meet. Trees are walked: sets with a common beginning share its partial overlap, and a subtree ends
   where the lengths that remain cannot reach the threshold, or where all sets are in the class
   already. A large group is cut into blocks; each block meets itself and the first block, so the
   work grows with the group and not with its square, and the blocks' classes are joined.
4. Sets in different classes that share first n-grams but did not meet in a tree meet in a second one, with
   the classes found so far: a set walks through the trees of those blocks with which it shares enough
   first n-grams. No link between classes is lost. Classes are the connected components of all links.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.llm.components import connected_components
from addrloom.llm.words import chunk_keys, mix, text_chunks, window_keys
from addrloom.session import materialise

N = 5
SKETCH_BITS = 22
SEGMENT = 4096
BUCKET_POSTINGS = 200_000
TREE_SETS = 512
# N-grams by which a set goes into trees: its rarest shared ones, and those that most sets have.
RARE_HEADS = 2
COMMON_HEADS = 3
FILTER_BITS = 26
TOKEN_BITS = 56

# The threshold 0.8 in whole numbers: 100 * common >= 80 * union.
PERCENT = 80


def needed(n: np.ndarray | int) -> np.ndarray | int:
    """Least overlap with any linked set, from the set's own size."""
    return -(-PERCENT * n // 100)


def prefix_size(n: int, shared: int) -> int:
    """N-grams in global order of which linked sets share at least ``shared``."""
    return min(n, n - needed(n) + shared)


def extra(n: np.ndarray | int) -> np.ndarray | int:
    return 1 + n // 8


def linked(common: int, a: int, b: int) -> bool:
    return 100 * common >= PERCENT * (a + b - common)


# --- sets -----------------------------------------------------------------------------------------------


def text_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct 56-bit digests of its n-grams); fewer words than N are one n-gram."""
    for start, data, offsets in text_chunks(column):
        keys, first = chunk_keys(data, offsets, lower=True)
        windows = window_keys(keys, N) >> np.uint64(64 - TOKEN_BITS)
        for r in range(len(offsets) - 1):
            a, words = first[r], first[r + 1] - first[r]
            if words >= N:
                yield start + r, np.unique(windows[a : a + words - N + 1])
            elif words:
                whole = mix(window_keys(keys[a : a + words], int(words)) + np.uint64(words))
                yield start + r, whole >> np.uint64(64 - TOKEN_BITS)
            else:
                yield start + r, np.empty(0, dtype=np.uint64)


def set_name(tokens: np.ndarray) -> int:
    """A 64-bit name that equal sets share."""
    total = int(mix(tokens).sum()) + len(tokens) * 0x9E3779B97F4A7C15
    return int(mix(np.array([total & 0xFFFFFFFFFFFFFFFF], dtype=np.uint64)).view(np.int64)[0])


def _name_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Name and size of every set, and at the end the task's n-gram counts by sketch cell."""
    cells = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    waiting: list[np.ndarray] = []

    def count() -> None:
        nonlocal cells
        if waiting:
            cells += np.bincount(np.concatenate(waiting), minlength=len(cells))
            waiting.clear()

    for batch in batches:
        names, sizes, held = [], [], 0
        for _, tokens in text_sets(batch.column("text")):
            names.append(set_name(tokens))
            sizes.append(len(tokens))
            waiting.append((tokens >> np.uint64(TOKEN_BITS - SKETCH_BITS)).astype(np.int32))
            held += len(tokens)
            if held > 4_000_000:
                count()
                held = 0
        count()
        n = batch.num_rows
        yield pa.RecordBatch.from_pydict(
            {
                "doc": batch.column("doc"),
                "row": batch.column("row"),
                "set": pa.array(names, pa.int64()),
                "n": pa.array(sizes, pa.int64()),
                "segment": pa.nulls(n, pa.int32()),
                "counts": pa.nulls(n, pa.binary()),
                "doc_row": pa.array(np.ones(n, dtype=bool)),
            }
        )
        doc_type = batch.column("doc").type
    if not cells.any():
        return
    parts = np.minimum(cells, 65535).astype("<u2").reshape(-1, SEGMENT)
    n = len(parts)
    yield pa.RecordBatch.from_pydict(
        {
            "doc": pa.nulls(n, doc_type),
            "row": pa.nulls(n, pa.int64()),
            "set": pa.nulls(n, pa.int64()),
            "n": pa.nulls(n, pa.int64()),
            "segment": pa.array(np.arange(n), pa.int32()),
            "counts": pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary()),
            "doc_row": pa.array(np.zeros(n, dtype=bool)),
        }
    )


def _sum_segment(table: pa.Table) -> pa.Table:
    total = np.zeros(SEGMENT, dtype=np.int64)
    for counts in table["counts"]:
        total += np.frombuffer(zlib.decompress(counts.as_py()), dtype="<u2")
    ranks = np.minimum(8 * np.log2(1 + total), 255).astype(np.uint8)
    return pa.table({"segment": table["segment"].slice(0, 1), "ranks": pa.array([ranks.tobytes()])})


def _ordered(tokens: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Tokens in global order: the sketch's rank goes before the digest."""
    rank = ranks[(tokens >> np.uint64(TOKEN_BITS - SKETCH_BITS)).astype(np.int64)]
    return np.sort((rank.astype(np.uint64) << np.uint64(TOKEN_BITS)) | tokens)


# --- which sets share enough of their first n-grams --------------------------------------------------------


def _deal_prefixes(ranks, buckets: int):
    """First n-grams by bucket. One that several sets of a batch hold is sent once and counted here."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, owners = [], []
            for _, own in text_sets(batch.column("text")):
                if len(own):
                    part = _ordered(own, ranks.value)[: prefix_size(len(own), extra(len(own)))]
                    tokens.append(mix(part))
                    owners.append(np.full(len(part), set_name(own), dtype=np.int64))
            if not tokens:
                continue
            tokens, owners = np.concatenate(tokens), np.concatenate(owners)
            order = np.lexsort((owners, tokens))
            tokens, owners = tokens[order], owners[order]
            fresh = np.ones(len(tokens), dtype=bool)
            fresh[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
            tokens, owners = tokens[fresh], owners[fresh]
            heads = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
            sizes = np.diff(np.append(heads, len(tokens)))
            several = np.repeat(sizes > 1, sizes)
            done, counts = np.unique(owners[several], return_counts=True)
            sent, single = tokens[heads], sizes == 1
            who = owners[heads]
            bucket = ((sent >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = np.append(cuts[1:], len(bucket))
            # ``sent`` ascends and so do the buckets; counted sets go with any one of them.
            low = (sent & np.uint64(0xFFFFFFFF)).astype("<u4")
            spread = np.array_split(np.arange(len(done)), len(cuts))
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(bucket[cuts]),
                    "tokens": pa.array(
                        [low[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)]
                    ),
                    "owners": pa.array(
                        [who[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)]
                    ),
                    "single": pa.array(
                        [np.packbits(single[a:b]).tobytes() for a, b in zip(cuts, ends, strict=True)]
                    ),
                    "done": pa.array([done[k].tobytes() for k in spread]),
                    "counts": pa.array([counts[k].astype("<u4").tobytes() for k in spread]),
                }
            )

    return deal


def _count_shared(ranges: int):
    """Sums per set over the buckets are dealt in blobs, one per range of set names."""

    def count(table: pa.Table) -> pa.Table:
        sets, counts = _shared_in_bucket(table)
        home = ((sets.view(np.uint64) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        home, sets, counts = home[order], sets[order], counts[order].astype("<i8")
        cuts = np.flatnonzero(np.append(True, home[1:] != home[:-1]))[: len(home)]
        ends = np.append(cuts[1:], len(home)) if len(cuts) else cuts
        return pa.table(
            {
                "home": pa.array(home[cuts]),
                "sets": pa.array([sets[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
                "counts": pa.array([counts[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)], pa.binary()),
            }
        )

    return count


def _sum_shared(table: pa.Table) -> pa.Table:
    sets = np.concatenate([np.frombuffer(b.as_py(), dtype=np.int64) for b in table["sets"]])
    counts = np.concatenate([np.frombuffer(b.as_py(), dtype="<i8") for b in table["counts"]])
    names, back = np.unique(sets, return_inverse=True)
    sums = np.bincount(back, weights=counts).astype(np.int64)
    return pa.table({"set": pa.array(names), "shared": pa.array(sums)})


def _shared_in_bucket(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sets, and how many of their first n-grams in this bucket another set has too."""
    tokens, owners, single, sets, counts = [], [], [], [], []
    for t, o, s, d, c in zip(*[table[x] for x in ("tokens", "owners", "single", "done", "counts")], strict=True):
        own = np.frombuffer(t.as_py(), dtype="<u4")
        tokens.append(own)
        owners.append(np.frombuffer(o.as_py(), dtype=np.int64))
        single.append(np.unpackbits(np.frombuffer(s.as_py(), dtype=np.uint8), count=len(own)))
        sets.append(np.frombuffer(d.as_py(), dtype=np.int64))
        counts.append(np.frombuffer(c.as_py(), dtype="<u4").astype(np.int64))
    tokens, owners = np.concatenate(tokens), np.concatenate(owners)
    single = np.concatenate(single).astype(bool)
    order = np.lexsort((owners, tokens))
    tokens, owners, single = tokens[order], owners[order], single[order]
    new_token = np.append(True, tokens[1:] != tokens[:-1])
    new_pair = new_token | np.append(True, owners[1:] != owners[:-1])
    group = np.cumsum(new_token) - 1
    several = np.bincount(group, weights=new_pair) > 1
    several |= np.bincount(group, weights=~single) > 0
    # A set counts a token once, and not again where its own batch has counted it.
    open_ = np.bincount(np.cumsum(new_pair) - 1, weights=~single) == 0
    heads = np.flatnonzero(new_pair)
    mine = heads[several[group[heads]] & open_]
    names, found = np.unique(owners[mine], return_counts=True)
    return np.concatenate([*sets, names]), np.concatenate([*counts, found])


# --- reading the sets that are left ------------------------------------------------------------------------


def _filter_cells(names: np.ndarray) -> np.ndarray:
    bits = mix(names.view(np.uint64))
    return np.stack([bits >> np.uint64(64 - FILTER_BITS), bits & np.uint64((1 << FILTER_BITS) - 1)])


def _build_filter(names: DataFrame) -> np.ndarray:
    """A membership filter of fixed size (8 MB); a false hit only costs a set read in vain."""

    size = 1 << (FILTER_BITS - 3)
    part = 1 << 12

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cells = np.unique(_filter_cells(b.column(0).to_numpy()))
                yield pa.RecordBatch.from_pydict({"cell": pa.array(cells.astype(np.int64))})

    def pack(table: pa.Table) -> pa.Table:
        cells = table["cell"].to_numpy()
        bits = np.zeros(part * 8, dtype=np.uint8)
        bits[cells % (part * 8)] = 1
        return pa.table(
            {"part": pa.array([cells[0] // (part * 8)], pa.int64()), "bits": pa.array([np.packbits(bits).tobytes()])}
        )

    cells = names.mapInArrow(cells_of, "cell bigint").distinct()
    packed = cells.withColumn("part", F.expr(f"cell div {part * 8}")).groupBy("part").applyInArrow(
        pack, "part bigint, bits binary"
    )
    out = np.zeros(size, dtype=np.uint8)
    for row in packed.collect():
        out[row["part"] * part : (row["part"] + 1) * part] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def _passes(names: np.ndarray, bits: np.ndarray) -> np.ndarray:
    cells = _filter_cells(names).astype(np.int64)
    return ((bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1).all(axis=0)


def _read_sets(ranks, bits):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, np.ndarray] = {}
            names, sets = [], []
            for _, own in text_sets(batch.column("text")):
                if len(own):
                    names.append(set_name(own))
                    sets.append(own)
                    if len(names) == 512:
                        keep = _passes(np.array(names, dtype=np.int64), bits.value)
                        for k in np.flatnonzero(keep):
                            seen.setdefault(names[k], sets[k])
                        names, sets = [], []
            if names:
                keep = _passes(np.array(names, dtype=np.int64), bits.value)
                for k in np.flatnonzero(keep):
                    seen.setdefault(names[k], sets[k])
            if seen:
                ordered = [_ordered(s, ranks.value) for s in seen.values()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "set": pa.array(list(seen), pa.int64()),
                        "n": pa.array([len(s) for s in ordered], pa.int64()),
                        "tokens": pa.array([s.tobytes() for s in ordered], pa.binary()),
                    }
                )

    return read


# --- the prefix tree -----------------------------------------------------------------------------------------


class Classes:
    """Names joined to classes."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, name: int) -> int:
        up = self.up
        up.setdefault(name, name)
        while up[name] != name:
            up[name] = name = up[up[name]]
        return name

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        self.up[a] = b
        return a != b


class _Node:
    __slots__ = ("run", "children", "names", "shortest", "longest", "one_class")

    def __init__(self, run: np.ndarray) -> None:
        self.run, self.children, self.names = run, {}, []
        self.shortest, self.longest, self.one_class = 1 << 62, 0, None

    def split(self, at: int) -> None:
        rest = _Node(self.run[at:])
        rest.children, rest.names, rest.one_class = self.children, self.names, self.one_class
        rest.shortest, rest.longest = self.shortest, self.longest
        self.run, self.children, self.names = self.run[:at], {int(rest.run[0]): rest}, []


class PrefixTree:
    """Ordered sets by their common beginnings; an edge holds a run of tokens."""

    STEP = 64  # tokens of an edge looked at before the bound is tested again

    def __init__(self) -> None:
        self.root = _Node(np.empty(0, dtype=np.uint64))
        self.classes = Classes()

    def insert(self, name: int, tokens: np.ndarray) -> None:
        node, at, n = self.root, 0, len(tokens)
        self._cover(node, n, name)
        while at < n:
            child = node.children.get(int(tokens[at]))
            if child is None:
                leaf = _Node(tokens[at:])
                self._cover(leaf, n, name)
                leaf.names.append(name)
                node.children[int(tokens[at])] = leaf
                return
            m = min(len(child.run), n - at)
            differ = np.flatnonzero(child.run[:m] != tokens[at : at + m])
            same = int(differ[0]) if len(differ) else m
            if same < len(child.run):
                child.split(same)
            self._cover(child, n, name)
            node, at = child, at + same
        node.names.append(name)

    def _cover(self, node: _Node, n: int, name: int) -> None:
        """The lengths of the sets at or below a node, and their class while it is one."""
        root = self.classes.root(name)
        if node.longest == 0:
            node.one_class = root
        elif node.one_class is not None and self.classes.root(node.one_class) != root:
            node.one_class = None
        node.shortest, node.longest = min(node.shortest, n), max(node.longest, n)

    def probe(self, tokens: np.ndarray, name: int | None = None) -> list[int]:
        """Sets in the tree that link with ``tokens``; with a ``name``, one of each class that is joined.

        Subtrees whose sets are in the name's class already are left out.
        """
        n, found = len(tokens), []
        least, root = needed(n), self.classes.root
        todo = [(child, 0, 0) for child in self.root.children.values()]
        while todo:
            node, common, depth = todo.pop()
            if name is not None and node.one_class is not None and root(node.one_class) == root(name):
                continue
            alive = True
            for a in range(0, len(node.run), self.STEP):
                run = node.run[a : a + self.STEP]
                place = np.searchsorted(tokens, run)
                inside = place < n
                common += int((tokens[place[inside]] == run[inside]).sum())
                depth += len(run)
                passed = int(np.searchsorted(tokens, run[-1], side="right"))
                most = common + min(node.longest - depth, n - passed)
                size = max(node.shortest, least)
                if 100 * most < PERCENT * (n + size - most):
                    alive = False
                    break
            if not alive:
                continue
            if node.names and linked(common, n, depth):
                if name is None:
                    found.extend(node.names)
                else:
                    found.extend(other for other in node.names if self.classes.join(name, other))
            todo.extend((child, common, depth) for child in node.children.values())
        return found


def _tree_links(table: pa.Table) -> pa.Table:
    """Links that join the classes of one group's sets: all of a block, or those of two blocks.

    Sets with the fewest n-grams of their own go first: the text that others were copied from.
    """
    names, blobs = table["set"].to_pylist(), table["tokens"]
    blocks, low, high = table["block"].to_numpy(), table["low"][0].as_py(), table["high"][0].as_py()
    order = np.lexsort((table["set"].to_numpy(), table["own"].to_numpy(), blocks))
    tree, a, b = PrefixTree(), [], []
    for k in order.tolist():
        tokens = np.frombuffer(blobs[k].as_py(), dtype=np.uint64)
        if blocks[k] == high:
            found = tree.probe(tokens, names[k])
            a.extend([names[k]] * len(found))
            b.extend(found)
        if blocks[k] == low:
            tree.insert(names[k], tokens)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of each set's prefix, with their place in the set."""
    for batch in batches:
        tokens, counts = [], []
        for blob in batch.column("tokens"):
            own = np.frombuffer(blob.as_py(), dtype=np.uint64)
            tokens.append(own[: prefix_size(len(own), 1)].view(np.int64))
            counts.append(len(tokens[-1]))
        if tokens:
            rows = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            place = np.concatenate([np.arange(c, dtype=np.int32) for c in counts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens)), pa.array(place), *[batch.column(c).take(rows) for c in ("set", "n")]],
                names=["token", "place", "set", "n"],
            )


def _shared_postings(sets: DataFrame) -> DataFrame:
    """``(token, place, set, n, members)``: prefix n-grams that at least two sets have in their prefixes."""
    postings = materialise(
        sets.select("set", "n", "tokens").mapInArrow(
            _postings, "token bigint, place int, set bigint, n bigint"
        ),
        "postings",
    )
    several = postings.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
    return materialise(postings.join(several, "token"), "shared-postings")


def _heads(postings: DataFrame) -> DataFrame:
    """``(set, heads)``: structs of an n-gram and the number of sets that have it."""
    own = F.collect_list(F.struct("place", "token", "members"))
    rare = F.slice(F.sort_array("own"), F.lit(1), F.lit(RARE_HEADS))
    by_members = F.transform(
        "own", lambda t: F.struct((-t.members).alias("k"), t.token.alias("token"), t.members.alias("members"))
    )
    common = F.slice(F.sort_array(by_members), F.lit(1), F.lit(COMMON_HEADS))

    def plain(heads):
        return F.transform(heads, lambda t: F.struct(t.token.alias("head"), t.members.alias("members")))

    return postings.groupBy("set").agg(own.alias("own")).select(
        "set", F.array_union(plain(rare), plain(common)).alias("heads")
    )


def _join_by_head(sets: DataFrame, heads: DataFrame) -> DataFrame:
    """Links among sets with a common head.

    A large group is cut into blocks. A task holds a block, or the first block and another one: what is
    sent is at most three times the group. Links between two other blocks are not looked for here:
    their sets are joined through the first block, or compared later.
    """
    places = heads.select("set", F.explode("heads").alias("p")).select(
        "set", "p.head", F.expr(f"(p.members + {TREE_SETS - 1}) div {TREE_SETS}").alias("blocks")
    )
    own = F.expr(f"n - ({PERCENT} * n + 99) div 100 + 1 + n div 8 - shared").alias("own")
    others = F.expr("CASE WHEN block = 0 THEN sequence(0L, blocks - 1) ELSE array(0L, block) END")
    cells = (
        places.withColumn("block", F.pmod(F.xxhash64("set", "head"), F.col("blocks")))
        .withColumn("other", F.explode(others))
        .select(
            "set", "head", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block"
        )
    )
    grouped = cells.join(sets.select("set", own, "tokens"), "set")
    return grouped.groupBy("head", "low", "high").applyInArrow(_tree_links, "a bigint, b bigint")


# --- links between classes ---------------------------------------------------------------------------------


def _links_to_block(table: pa.Table) -> pa.Table:
    """Links that join classes: the sets that a block may link with are walked through the block's tree."""
    names, classes, blobs = table["set"].to_pylist(), table["class"].to_pylist(), table["tokens"]
    member = table["member"].to_numpy()
    tree, a, b = PrefixTree(), [], []
    for name, known in zip(names, classes, strict=True):
        tree.classes.join(name, known)
    order = np.lexsort((table["set"].to_numpy(), ~member))
    for k in order.tolist():
        tokens = np.frombuffer(blobs[k].as_py(), dtype=np.uint64)
        if member[k]:
            tree.insert(names[k], tokens)
        else:
            found = tree.probe(tokens, names[k])
            a.extend([names[k]] * len(found))
            b.extend(found)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _blocks(heads: DataFrame, classes: DataFrame) -> DataFrame:
    """``set, class, met, block``: sets in blocks of about ``TREE_SETS`` by the head that most sets have.

    The largest class of a head has blocks of its own. All sets of the heads in ``met`` have met in one tree.
    """
    met = F.transform(F.filter("heads", lambda h: h.members <= TREE_SETS), lambda h: h.head)
    top = F.array_max(F.transform("heads", lambda h: F.struct(h.members.alias("members"), h.head.alias("head"))))
    named = (
        heads.select("set", met.alias("met"), top.getField("head").alias("head"))
        .join(classes.select(F.col("node").alias("set"), F.col("component").alias("class")), "set", "left")
        .withColumn("class", F.coalesce("class", "set"))
    )
    by_class = named.groupBy("head", "class").agg(F.count("*").alias("k"))
    main = by_class.groupBy("head").agg(
        F.max_by("class", F.struct("k", "class")).alias("main"), F.max("k").alias("in_main"), F.sum("k").alias("k")
    )
    inside = F.col("class") == F.col("main")
    size = F.when(inside, F.col("in_main")).otherwise(F.col("k") - F.col("in_main"))
    part = F.pmod(F.xxhash64("set"), F.expr(f"(size + {TREE_SETS - 1}) div {TREE_SETS}"))
    return (
        named.join(main, "head")
        .withColumn("size", size)
        .select("set", "class", "met", F.struct("head", (2 * part + inside.cast("int")).alias("part")).alias("block"))
    )


def _links_between(
    sets: DataFrame, postings: DataFrame, heads: DataFrame, classes: DataFrame
) -> DataFrame:
    """Links between sets of different classes that did not meet in a tree.

    Sets are put in blocks, and a set is compared with a block, in the block's tree, if it has enough first
    n-grams that sets of other classes in the block have, too. So rows are a set and a block, not two sets.
    """
    placed = materialise(_blocks(heads, classes), "class-blocks")
    classed = postings.select("token", "set").join(placed.select("set", "class"), "set")
    across = (
        classed.groupBy("token")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low < high")
        .select("token")
    )
    kept = materialise(
        postings.select("token", "set", "n").join(across, "token").join(placed, "set"), "open-postings"
    )
    holders = kept.groupBy("token", "block").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.min("n").alias("p"), F.max("n").alias("q")
    )
    x, y = kept.alias("x"), holders.alias("y")
    others = F.expr("x.token = y.token AND x.block <= y.block AND (x.class <> y.low OR x.class <> y.high)")
    fits = F.expr(f"100 * y.q >= {PERCENT} * x.n AND 100 * x.n >= {PERCENT} * y.p")
    met = F.expr("array_contains(x.met, y.block.head)")
    near = (
        x.join(y, others & fits & ~met)
        .groupBy("x.set", "y.block")
        .agg(F.count("*").alias("c"), F.first("x.n").alias("n"), F.min("y.p").alias("p"), F.max("y.q").alias("q"))
        .withColumn("p", F.expr(f"greatest(p, ({PERCENT} * n + 99) div 100)"))
        .withColumn("q", F.expr(f"least(q, 100 * n div {PERCENT})"))
    )

    def shared(size: str) -> str:
        """First n-grams that a link with a set of this size needs. What lies beyond a prefix is one less
        than the least overlap, in the set whose prefix ends first."""
        overlap = f"({PERCENT} * (n + {size}) + {99 + PERCENT}) div {100 + PERCENT}"
        return f"{overlap} - ((greatest(n, {size}) * {PERCENT} + 99) div 100 - 1)"

    # The need rises up to the set's own size and falls beyond it, but for rounding.
    near = materialise(
        near.where(f"c >= least({shared('p')}, {shared('q')}) - 1").select("set", "block"), "near-blocks"
    )
    chunks = near.groupBy("block").agg(F.expr(f"(count(*) + {TREE_SETS - 1}) div {TREE_SETS}").alias("chunks"))
    probes = near.join(chunks, "block").select(
        "set", "block", F.pmod(F.xxhash64("set"), F.col("chunks")).alias("chunk"), F.lit(False).alias("member")
    )
    members = placed.join(chunks, "block").select(
        "set", "block", F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"), F.lit(True).alias("member")
    )
    cells = (
        probes.unionAll(members)
        .join(placed.select("set", "class"), "set")
        .join(sets.select("set", "tokens"), "set")
        .select("set", "class", "tokens", "member", "block.head", "block.part", "chunk")
    )
    return cells.groupBy("head", "part", "chunk").applyInArrow(_links_to_block, "a bigint, b bigint")


def _set_classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, named) of ``doc, row, text`` rows: ``doc, row, set, n`` per row, ``set, component`` per set."""
    spark = rows.sparkSession
    kind = rows.schema["doc"].dataType.simpleString()
    scanned = materialise(
        rows.mapInArrow(
            _name_sets,
            f"doc {kind}, row bigint, set bigint, n bigint, segment int, counts binary, doc_row boolean",
        ),
        "sets",
    )
    documents = scanned.where("doc_row").select("doc", "row", "set", "n")
    merged = (
        scanned.where("NOT doc_row")
        .select("segment", "counts")
        .groupBy("segment")
        .applyInArrow(_sum_segment, "segment int, ranks binary")
    )
    ranks = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)  # 4 MB whatever the corpus
    for row in merged.collect():
        at = row["segment"] * SEGMENT
        ranks[at : at + SEGMENT] = np.frombuffer(row["ranks"], dtype=np.uint8)
    shared_ranks = spark.sparkContext.broadcast(ranks)

    total = documents.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, int(total * (1.125 - PERCENT / 100)) // BUCKET_POSTINGS)
    texts = rows.select("text")
    dealt = texts.mapInArrow(
        _deal_prefixes(shared_ranks, buckets),
        "bucket int, tokens binary, owners binary, single binary, done binary, counts binary",
    )
    counted = (
        dealt.groupBy("bucket")
        .applyInArrow(_count_shared(max(1, buckets // 4)), "home bigint, sets binary, counts binary")
        .groupBy("home")
        .applyInArrow(_sum_shared, "set bigint, shared bigint")
    )
    sizes = documents.where("n > 0").groupBy("set").agg(F.first("n").alias("n"))
    # Any partner has at least ``needed`` n-grams, and so shares this many of the first ones.
    least = f"1 + ({PERCENT} * n + 99) div 100 div 8"
    open_sets = materialise(
        counted.join(sizes, "set").where(f"shared >= {least}").select("set", "shared"), "open-sets"
    )
    bits = spark.sparkContext.broadcast(_build_filter(open_sets.select("set")))
    read = texts.mapInArrow(
        _read_sets(shared_ranks, bits), "set bigint, n bigint, tokens binary"
    )
    once = read.groupBy("set").agg(
        F.first("n").alias("n"), F.first("tokens").alias("tokens")
    )
    sets = materialise(once.join(open_sets, "set"), "open-set-tokens")

    postings = _shared_postings(sets)
    heads = materialise(_heads(postings), "heads")
    links = materialise(_join_by_head(sets, heads), "tree-links")
    classes = materialise(connected_components(links), "classes")
    between = materialise(_links_between(sets, postings, heads, classes), "class-links")
    classes = connected_components(links.unionAll(between))
    named = sizes.join(
        classes.select(F.col("node").alias("set"), "component"), "set", "left"
    ).select("set", F.coalesce("component", "set").alias("component"))
    return documents, materialise(named, "set-classes")


def ngram_classes(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Two rows link when their sets of 5-word n-grams (letters A-Z lower-cased) have a Jaccard similarity
    of 0.8 or more. Fewer than five words are one n-gram; a null or empty text has none and links with
    nothing, not even another one. Equal rows link with each other. A row with a null id takes part,
    but its id is never the smallest unless its class has no other.
    """
    documents, named = _set_classes(
        docs.select(
            F.col(id_column).alias("doc"),
            F.lit(None).cast("long").alias("row"),
            F.col(text_column).alias("text"),
        )
    )
    first = materialise(documents.groupBy("set").agg(F.min("doc").alias("doc")), "set-docs")
    smallest = named.join(first, "set").groupBy("component").agg(F.min("doc").alias("component_id"))
    by_set = materialise(
        named.join(smallest, "component").select("set", "component_id"), "set-components"
    )
    return (
        documents.where("n > 0")
        .join(by_set, "set", "left")
        .select(F.col("doc").alias(id_column), F.col("n").alias("n_shingles"), "component_id")
        .unionAll(
            documents.where("n = 0").select(
                F.col("doc").alias(id_column), F.col("n").alias("n_shingles"),
                F.col("doc").alias("component_id"),
            )
        )
    )


def one_per_class(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each class of ``docs``, with all columns: that with the smallest id, nulls last.

    Of several rows with that id one stays. Rows without n-grams are in no class and all stay.
    """
    names = docs.columns
    # Stored, so that each row has the same number wherever it is read.
    whole = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
        ),
        "class-docs",
    )
    field = F.col("doc").getField
    documents, named = _set_classes(
        whole.select(field(id_column).alias("doc"), "row", field(text_column).alias("text"))
    )
    linked_rows = documents.where("n > 0")
    by_set = linked_rows.groupBy("set").agg(
        F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "row")).alias("first")
    )
    stays = materialise(
        named.join(by_set, "set")
        .groupBy("component")
        .agg(F.min("first").alias("first"))
        .select(F.col("first").getField("row").alias("row")),
        "class-rows",
    )
    gone = materialise(linked_rows.select("row").join(stays, "row", "left_anti"), "gone")
    return whole.join(gone, "row", "left_anti").select(*[field(c).alias(c) for c in names])
