"""Mixing sources to target weights, with DataFrame operations only.

Each source's words, in a fixed order of its documents, are cut into blocks of ``BLOCK_WORDS``. A source
has as many slots as its target fills; every slot draws its output shard, so a shard's source counts
are a multinomial draw that keeps each source's total. Slot numbers go through a pseudorandom
permutation of the source's block numbers, anew for each pass over the source, and slots and blocks
are joined by that number. The last slot is cut to the word, so a source takes just its target.

No step needs the rows of one source together: offsets come from chunks of about the square root of
the row count and a table of chunk totals; slots are generated range by range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrloom.session import materialise

BLOCK_WORDS = 256
SHARD_SLOTS = 1024
SLOT_RANGE = 4096
ROUNDS = 16
PRIME = 2147483647

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _spread(value: str, salt: str) -> str:
    """Arithmetic that spreads a number below 2**62; the same text runs in DuckDB."""
    once = f"((({value}) % {PRIME}) * 48271 + ({salt}) % {PRIME}) % {PRIME}"
    return f"((({once}) * 69621 + 12345) % {PRIME})"


def permutation_round(v: str, r: str, n: str, seed: str) -> str:
    """A round swaps ``v`` with its partner or not; each is its own inverse."""
    partner = f"((({_spread(r, f'({seed}) * 7368787 + 17')}) % ({n}) - {v} + ({n})) % ({n}))"
    salt = f"{r} * 1000003 + ({seed}) * 15485863"
    swap = f"({_spread(f'greatest({v}, {partner})', salt)} >> 14) % 2 = 1"
    return f"CASE WHEN {swap} THEN {partner} ELSE {v} END"


def permuted(x: str, n: str, seed: str, *, inverse: bool = False) -> Column:
    """``x`` of 0..n-1 under a permutation of 0..n-1 that ``seed`` selects, or under its inverse."""
    rounds = f"sequence({ROUNDS - 1}, 0)" if inverse else f"sequence(0, {ROUNDS - 1})"
    body = permutation_round("v", "r", n, seed)
    return F.expr(f"aggregate({rounds}, CAST({x} AS BIGINT), (v, r) -> {body})")


def chunk_of(id_column: str, chunks: int | str) -> str:
    """Chunk of a row: spreads ids over ``chunks``; a row without an id goes by its size."""
    return f"({_spread(f'abs(coalesce({id_column}, size) % {PRIME})', '0')} % {chunks})"


def _targets(sizes: DataFrame) -> DataFrame:
    """Words per source: shares by weight, none above its bound, the excess shared out by weight."""
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("ratio", "rank")
    before = F.coalesce(
        F.sum("bound").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    ranked = (
        sizes.withColumn("rank", F.row_number().over(order) - 1)
        .withColumn("weight", F.get(weights, F.col("rank") % len(WEIGHTS)))
        .withColumn("bound", F.col("source_size") * MOST_COPIES)
        .withColumn("ratio", F.col("bound") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
    )
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn("level", (F.col("total") * SHARE - before) / rest).withColumn(
        "nth", F.row_number().over(filling)
    )
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("nth"))
    level = F.min_by(F.col("level"), fits).over(everything)
    return (
        levels.withColumn("level", level)
        .withColumn("target", F.least(F.col("bound").cast("double"), F.col("level") * F.col("weight")))
        .select("key", "rank", "source_size", "target")
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with source, place in the source's word sequence, target, blocks and words to take."""
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    keyed = rows.withColumn("key", key)
    n = keyed.count()
    chunks = max(1, int(n**0.5))
    chunked = keyed.withColumn("chunk", F.expr(chunk_of("id", chunks)))
    in_chunk = Window.partitionBy("key", "chunk").orderBy("id", "size", "row")
    rows_before = in_chunk.rowsBetween(Window.unboundedPreceding, -1)
    within = chunked.withColumn(
        "within", F.coalesce(F.sum("size").over(rows_before), F.lit(0).cast("long"))
    )
    totals = chunked.groupBy("key", "chunk").agg(
        F.sum("size").alias("chunk_size"), F.first("source").alias("source")
    )
    sizes = totals.groupBy("key").agg(
        F.sum("chunk_size").alias("source_size"), F.first("source").alias("source")
    )
    chunk_order = Window.partitionBy("key").orderBy("chunk")
    offsets = totals.select(
        "key", "chunk", (F.sum("chunk_size").over(chunk_order) - F.col("chunk_size")).alias("base")
    )
    with_targets = offsets.join(_targets(sizes), "key")
    return within.join(with_targets, ["key", "chunk"]).withColumn(
        "start", F.col("base") + F.col("within")
    )


def _slots(sources: DataFrame) -> DataFrame:
    """One row per slot: source, pass over the source, shard, block and the words it takes of it."""
    plan = (
        sources.where("source_size > 0")
        .withColumn("take", F.round("target").cast("long"))
        .withColumn("blocks", F.expr(f"(source_size + {BLOCK_WORDS - 1}) div {BLOCK_WORDS}"))
        .withColumn("full", F.expr("take div source_size"))
        .withColumn("rest", F.expr("take % source_size"))
        # One block more than the rest fills, as the source's short last block may be among them.
        .withColumn(
            "slots",
            F.expr(
                f"full * blocks + least(blocks, (rest + {BLOCK_WORDS - 1}) div {BLOCK_WORDS} + "
                "CASE WHEN rest > 0 THEN 1 ELSE 0 END)"
            ),
        )
        .where("slots > 0")
        .withColumn("short", F.expr(f"blocks * {BLOCK_WORDS} - source_size"))
        .withColumn("short_at", permuted("blocks - 1", "blocks", "rank * 4 + full", inverse=True))
    )
    # A fixed number of tasks: by size alone, rows about to be exploded would be put into one.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = plan.withColumn(
        "from", F.explode(F.expr(f"sequence(0L, slots - 1, {SLOT_RANGE}L)"))
    ).repartition(tasks, "key", "from")
    each = (
        ranges.withColumn(
            "slot", F.explode(F.expr(f"sequence(from, least(from + {SLOT_RANGE}, slots) - 1)"))
        )
        .withColumn("pass", F.expr("slot div blocks"))
        .withColumn("nth", F.expr("slot % blocks"))
        .withColumn("block", permuted("nth", "blocks", "rank * 4 + pass"))
    )
    length = F.expr(f"CASE WHEN block = blocks - 1 THEN {BLOCK_WORDS} - short ELSE {BLOCK_WORDS} END")
    filled = F.expr(f"nth * {BLOCK_WORDS} - CASE WHEN nth > short_at THEN short ELSE 0 END")
    words = F.when(F.col("pass") < F.col("full"), length).otherwise(
        F.least(length, F.greatest(F.lit(0), F.col("rest") - filled))
    )
    return each.withColumn("words", words).where("words > 0")


def mixture(docs: DataFrame, *, id_column: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, pieces) of the mix of ``docs`` (columns id, ``row``, ``source``, ``size``).

    ``rows``: each input row with ``source_size`` and ``target``. ``pieces``: the words taken, as
    ``row, pass, from, words``, where ``from`` counts in the document's own words, with the
    ``shard`` they go to. A null source is a source of its own, last in order; a row without words
    takes nothing; an empty table gives empty results.
    """
    rows = materialise(
        docs.select(
            "row",
            F.col(id_column).alias("id"),
            F.col("source").alias("source"),
            F.col("size").cast("long").alias("size"),
        ),
        "mix-rows",
    )
    placed = materialise(_placed(rows), "mix-placed")
    sources = placed.groupBy("key").agg(
        F.first("rank").alias("rank"),
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
    )
    # Stored, so that its true size is known where Spark chooses the join.
    drawn = materialise(_slots(sources).select("key", "block", "pass", "slot", "words"), "mix-slots")
    shards = drawn.agg(F.count("*").alias("n")).select(
        F.expr(f"greatest(1L, (n + {SHARD_SLOTS - 1}) div {SHARD_SLOTS})").alias("shards")
    ).first()[0]
    slots = drawn.select(
        "key",
        "block",
        "pass",
        "words",
        F.pmod(F.xxhash64("key", "slot"), F.lit(shards)).alias("shard"),
    )
    last = f"(start + size - 1) div {BLOCK_WORDS}"
    blocks = (
        placed.where("size > 0")
        .withColumn("block", F.explode(F.expr(f"sequence(start div {BLOCK_WORDS}, {last})")))
        .select(
            "key",
            "block",
            "row",
            F.expr(f"greatest(start - block * {BLOCK_WORDS}, 0)").alias("at"),
            F.expr(f"greatest(block * {BLOCK_WORDS} - start, 0)").alias("from"),
            F.expr(
                f"least(start + size, (block + 1) * {BLOCK_WORDS}) - "
                f"greatest(start, block * {BLOCK_WORDS})"
            ).alias("length"),
        )
    )
    pieces = (
        blocks.join(slots, ["key", "block"])
        .select(
            "row", "pass", "shard", "from",
            F.least(F.col("length"), F.col("words") - F.col("at")).alias("words"),
        )
        .where("words > 0")
    )
    return placed, pieces


def taken_words(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, ``size``, ``source_size``, ``target`` and ``taken`` words, repeats counted.

    A null text has no words. Equal rows are counted one by one.
    """
    sized = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        F.col("source").alias("source"),
        word_count(F.col(text_column)).alias("size"),
    )
    rows, pieces = mixture(sized)
    sums = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return rows.join(sums, "row", "left").select(
        F.col("id").alias(id_column),
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The mix as documents: per pass a row for each document it takes, with all columns of ``docs``.

    A document taken whole keeps its text unchanged; of one taken in part the taken words are joined
    by one space. ``n_chars``, where there is one, follows the text. A document without words is kept
    once, as it takes no share.
    """
    names = docs.columns
    whole = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            word_count(F.col(f"`{text_column}`")).alias("size"),
            F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
        ),
        "mix-docs",
    )
    sized = whole.select(
        "row",
        F.col("doc").getField(id_column).alias("doc_id"),
        F.col("doc").getField("source").alias("source"),
        "size",
    )
    _, pieces = mixture(sized)
    spans = pieces.groupBy("row", "pass").agg(
        F.sort_array(F.collect_list(F.struct("from", "words"))).alias("spans"),
        F.sum("words").alias("taken"),
    )
    text = F.col("doc").getField(text_column)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    joined = whole.join(spans, "row", "left").where("size = 0 OR taken IS NOT NULL")
    cut = F.array_join(
        F.flatten(
            F.transform(
                "spans",
                lambda s: F.slice(
                    F.col("words"), (s["from"] + 1).cast("int"), s["words"].cast("int")
                ),
            )
        ),
        " ",
    )
    part = F.col("taken") < F.col("size")
    rows = joined.withColumn("words", F.when(part, words)).withColumn(
        "new_text", F.when(part, cut).otherwise(text)
    )
    columns = []
    for c in names:
        value = F.col("doc").getField(c)
        if c == text_column:
            value = F.col("new_text")
        elif c == "n_chars":
            value = F.when(part, F.length("new_text").cast("long")).otherwise(value)
        columns.append(value.alias(c))
    return rows.select(*columns)
