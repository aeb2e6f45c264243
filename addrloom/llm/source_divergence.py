"""Source divergence audit: how far the sources of a language differ in their words, and by which.

Pairwise divergences are a sum over terms for each pair of groups, a matrix product in shape. The cube
(group, group, term) is cut into cells of one group block, another group block and one term block.
A cell gets the two blocks' slices of the count table, replicated along the axis that they do not
have, sums up its part of every pair, and the parts are added along the term axis. A cell is bounded
in all three directions, whatever number of sources, terms or documents there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrloom.llm.words import LOWER, find_words, text_chunks
from addrloom.operators.joins import lookup_join, top_k
from addrloom.session import materialise

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
# Scale of the integer probabilities and what is added to every count.
SCALE = 1_000_000_000
PRIOR = 5

GROUP_BLOCK = 64
TERM_BLOCK = 4096
# Bytes of text whose words are counted at once.
CHUNK_BYTES = 8 << 20

# Terms are runs of ASCII letters and of all bytes of multibyte characters.
GAPS = np.ones(256, dtype=bool)
GAPS[ord("A") : ord("Z") + 1] = False
GAPS[ord("a") : ord("z") + 1] = False
GAPS[0x80:] = False


def chunk_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms of a chunk; for each of its words in order, the term's index and the row."""
    starts, ends, first = find_words(data, offsets, GAPS)
    letters = LOWER[data[~GAPS[data]]]
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]
    ).dictionary_encode()
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return words.dictionary, words.indices.to_numpy().astype(np.int64), rows


def group_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` with occurrences and documents per group and term.

    Every group that occurs has a row with a null term as well. Counts are summed up per chunk of text,
    then per task, then after the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
            sources = max(1, len(source.dictionary))
            group = lang.indices.to_numpy().astype(np.int64) * sources + source.indices.to_numpy()
            for row, data, offsets in text_chunks(batch.column("text"), CHUNK_BYTES):
                own = group[row : row + len(offsets) - 1]
                terms, term, at = chunk_terms(data, offsets)
                size = max(1, len(terms))
                keys, n = np.unique(own[at] * size + term, return_counts=True)
                once = np.unique(at * size + term)
                _, documents = np.unique(own[once // size] * size + once % size, return_counts=True)
                bare = np.unique(own)
                named = np.concatenate([keys // size, bare])
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": lang.dictionary.take(pa.array(named // sources)),
                        "source": source.dictionary.take(pa.array(named % sources)),
                        "term": pa.concat_arrays(
                            [
                                terms.take(pa.array(keys % size)).cast(pa.string()),
                                pa.nulls(len(bare), pa.string()),
                            ]
                        ),
                        "n": pa.array(np.concatenate([n, np.zeros_like(bare)]), pa.int64()),
                        "docs": pa.array(np.concatenate([documents, np.zeros_like(bare)]), pa.int64()),
                    }
                )

    counted = docs.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def probability(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms))`` in whole numbers of any size."""
    up = (n + F.lit(PRIOR)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    down = total.cast("decimal(20,0)") + (terms * F.lit(PRIOR)).cast("decimal(20,0)")
    # Whole-number division of decimals has no Python name.
    return F.lit(1).cast("bigint") + F.call_function("div", up, down)


def _cell_sums(table: pa.Table) -> pa.Table:
    """The part of a cell in each of its pairs: the sum over the terms that any of its groups has, and
    their number. Terms that none has differ by the groups' bases alone and are added at the end."""
    marker = table["term_id"].is_null().to_numpy(zero_copy_only=False)
    group, p = table["group_id"].to_numpy(), table["p"].to_numpy()
    side = table["own"].to_numpy()
    groups, first = np.unique(group[marker], return_index=True)
    base, own = p[marker][first], side[marker][first]
    held = ~marker
    terms, column = np.unique(
        table["term_id"].filter(pa.array(held)).to_numpy(), return_inverse=True
    )
    matrix = np.repeat(base[:, None], len(terms), axis=1)
    matrix[np.searchsorted(groups, group[held]), column] = p[held]
    a, b = table["block_a"][0].as_py(), table["block_b"][0].as_py()
    left, right = np.flatnonzero(own == a), np.flatnonzero(own == b)
    x, y, part = [], [], []
    for i in left:
        # Within one block each pair is met once.
        others = right[right > i] if a == b else right
        x.append(np.full(len(others), groups[i]))
        y.append(groups[others])
        part.append(np.abs(matrix[others] - matrix[i]).sum(axis=1))
    none = [np.empty(0, dtype=np.int64)]
    pairs = np.concatenate(none + x)
    return pa.table(
        {
            "x": pa.array(pairs, pa.int64()),
            "y": pa.array(np.concatenate(none + y), pa.int64()),
            "part": pa.array(np.concatenate(none + part), pa.int64()),
            "covered": pa.array(np.full(len(pairs), len(terms)), pa.int64()),
        }
    )


def _cells(row_block: Column, blocks: Column) -> Column:
    """The (smaller, larger) group block of each cell row that a block takes part in."""
    return F.explode(
        F.transform(
            F.sequence(F.lit(0), blocks - 1),
            lambda other: F.struct(
                F.least(row_block, other).alias("block_a"), F.greatest(row_block, other).alias("block_b")
            ),
        )
    )


def audit_sources(
    docs: DataFrame,
    *,
    least_documents: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    group_block: int = GROUP_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: each source's distance to every other source of its
    language (part ``pair``), and the ``top`` terms it uses more than its language (part ``term``).

    A language keeps the terms of at least ``least_documents`` documents. Values are differences of
    whole-number probabilities, exact at any size; ties are ranked by the item's bytes.

    Null text, language and source are read as empty; a group whose texts hold no kept term still has
    its pairs, with what the prior gives. Equal rows count as documents of their own, very long texts
    are chunks of their own, an empty table gives no rows. Only the columns ``text, lang, source`` are
    read, so further columns may have any name.
    """
    read = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    )
    counts = materialise(group_terms(read), "group-terms")
    kept = materialise(
        counts.where("term IS NOT NULL")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_documents)
        .select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("term_id")),
        "kept-terms",
    )
    held = materialise(counts.join(kept, ["lang", "term"]).drop("docs"), "held-terms")
    # One row per group, as many as sources and languages.
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = counts.where("term IS NULL").select("lang", "source")
    per_lang = sources.groupBy("lang").agg(F.count("*").alias("groups"))
    block_count = F.ceil(F.col("groups") / F.lit(group_block)).cast("int")
    groups = materialise(
        sources.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .join(per_lang, "lang")
        .na.fill(0, ["total", "terms", "lang_total"])
        .select(
            "*",
            F.monotonically_increasing_id().alias("group_id"),
            block_count.alias("blocks"),
            F.greatest(F.lit(1), F.ceil(F.col("terms") / F.lit(term_block))).cast("int").alias("slices"),
        )
        .select(
            "*",
            F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("own"),
            # No kept term leaves nothing to divide by, and nothing to add up.
            F.when(F.col("terms") > 0, probability(F.lit(0), F.col("total"), F.col("terms")))
            .otherwise(F.lit(0))
            .alias("base"),
        ),
        "groups",
    )
    rows = lookup_join(held, groups, ["lang", "source"]).select(
        *["lang", "source", "term", "term_id", "group_id", "own", "blocks", "slices"],
        probability(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        probability(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
    )
    slices = rows.select(
        "lang",
        F.pmod(F.xxhash64("term_id"), F.col("slices")).cast("int").alias("slice"),
        *["group_id", "own", "term_id", "p"],
        _cells(F.col("own"), F.col("blocks")).alias("cell"),
    )
    markers = groups.select(
        "lang",
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
        *["group_id", "own", F.lit(None).cast("bigint").alias("term_id"), F.col("base").alias("p")],
        F.col("blocks"),
    ).select(
        *["lang", "slice", "group_id", "own", "term_id", "p"],
        _cells(F.col("own"), F.col("blocks")).alias("cell"),
    )
    parts = (
        slices.unionByName(markers)
        .select("lang", "slice", "cell.block_a", "cell.block_b", "group_id", "own", "term_id", "p")
        .groupBy("lang", "block_a", "block_b", "slice")
        .applyInArrow(_cell_sums, "x bigint, y bigint, part bigint, covered bigint")
    )
    summed = parts.groupBy("x", "y").agg(F.sum("part").alias("part"), F.sum("covered").alias("covered"))

    def side(name: str) -> DataFrame:
        columns = ["lang", "terms"] if name == "x" else []
        return groups.select(
            F.col("group_id").alias(name),
            F.col("source").alias(f"{name}_source"),
            F.col("base").alias(f"{name}_base"),
            *columns,
        )

    value = F.col("part") + (F.col("terms") - F.col("covered")) * F.abs(F.col("x_base") - F.col("y_base"))
    pairs = (
        lookup_join(lookup_join(summed, side("x"), ["x"]), side("y"), ["y"])
        .select("lang", "x_source", "y_source", value.alias("value"))
        .select(
            "lang",
            F.explode(
                F.array(
                    F.struct(F.col("x_source").alias("source"), F.col("y_source").alias("item")),
                    F.struct(F.col("y_source").alias("source"), F.col("x_source").alias("item")),
                )
            ).alias("way"),
            "value",
        )
        .select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
    )
    more = rows.where("p > q").select(
        "lang",
        "source",
        F.lit("term").alias("part"),
        F.col("term").alias("item"),
        (F.col("p") - F.col("q")).alias("value"),
    )
    order = [F.col("value").desc(), F.col("item").asc()]
    ranks = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)).alias("rank")
    best = top_k(more, ["lang", "source"], order, top)
    return pairs.select("*", ranks).unionByName(best.select("*", ranks))
