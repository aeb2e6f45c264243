"""Search over normalised addresses: filters, prefixes, similarity, words.

Searches with literal arguments are narrow scans whose filters reach the Parquet reader. For many
repeated word searches, ``postings`` gives an inverted table to store with ``write_postings``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.functions.text import once
from addrloom.functions.tokens import tokens, trigram_similarity, trigrams
from addrloom.operators.joins import lookup_join, top_k
from addrloom.session import materialise

# Fixed value: least similarity of a match, the public default of trigram search.
DEFAULT_THRESHOLD = 0.3


def by_postal_code(df: DataFrame, country_code: str, postal_code: str | None = None) -> DataFrame:
    """Equality on country and, when given, postal code; both reach the scan."""
    found = df.where(F.col("country_code") == country_code)
    return found if postal_code is None else found.where(F.col("postal_code") == postal_code)


def by_street_prefix(df: DataFrame, prefix: str, *, column: str = "thoroughfare") -> DataFrame:
    """Rows whose street starts with ``prefix``, in byte order of the street."""
    return df.where(F.col(column).startswith(prefix)).orderBy(column)


def by_substring(df: DataFrame, needle: str, *, column: str = "address_norm") -> DataFrame:
    return df.where(F.col(column).contains(needle))


def by_similarity(
    df: DataFrame,
    query: str,
    *,
    k: int | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    column: str = "address_norm",
) -> DataFrame:
    """Rows similar to one query text, best first; ties in order of the text.

    No join and no shuffle: the query's trigrams are a constant, the best ``k`` are kept per task.
    """
    scored = df.select("*", once(similarity=trigram_similarity(F.col(column), F.lit(query))))
    found = scored.where(F.col("similarity") >= threshold)
    order = [F.col("similarity").desc(), F.col(column).asc()]
    return found.orderBy(*order) if k is None else found.orderBy(*order).limit(k)


def least_shared(size: Column, threshold: float) -> Column:
    """Fewest trigrams that a match at ``threshold`` shares with a query of ``size`` trigrams.

    Shared / all >= threshold and all >= size, so shared >= threshold * size. The small allowance
    keeps rounding from asking for one too many.
    """
    return F.greatest(F.lit(1), F.ceil(size * F.lit(threshold) - F.lit(1e-9))).cast("int")


# Longs of a signature; each has 64 bits.
SIGNATURE_WORDS = 4


def signature(members: Column) -> list[Column]:
    """A bitmap of an array's members, one column per word; every member sets one bit."""
    bit = lambda x: F.pmod(F.xxhash64(x), F.lit(64 * SIGNATURE_WORDS))

    def word(w: int) -> Column:
        own = F.filter(members, lambda x: F.floor(bit(x) / 64) == w)
        return F.aggregate(
            own,
            F.lit(0).cast("bigint"),
            lambda held, x: held.bitwiseOR(
                F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bit(x), F.lit(64)).cast("int"))
            ),
        )

    return [word(w).alias(f"_sig{w}") for w in range(SIGNATURE_WORDS)]


def absent_bits(left: str, right: str) -> Column:
    """Bits of the left signature that the right one has not: as many members at least are not shared."""
    missing = [
        F.bit_count(F.col(f"{left}_sig{w}").bitwiseAND(F.bitwise_not(F.col(f"{right}_sig{w}"))))
        for w in range(SIGNATURE_WORDS)
    ]
    total = missing[0]
    for more in missing[1:]:
        total = total + more
    return total


def trigram_rows(texts: DataFrame, number: str, name: str) -> DataFrame:
    """Texts with a number of their own, their trigrams and how many these are, stored."""
    return materialise(
        texts.select("*", once(_set=trigrams("_text"))).select(
            "*", F.size("_set").alias("_size"), F.monotonically_increasing_id().alias(number)
        ),
        name,
    )


def match_similar(
    df: DataFrame,
    queries: DataFrame,
    *,
    id_column: str,
    column: str = "address_norm",
    query_id: str = "query_id",
    query_text: str = "query_text",
    threshold: float = DEFAULT_THRESHOLD,
    k: int | None = None,
) -> DataFrame:
    """``(query_id, id, similarity)`` for many query texts at once, exact above ``threshold``.

    Trigrams that both sides hold are numbered, fewest rows first. A match shares at least ``m`` of a
    side's ``n`` trigrams, so both sides have a common one among their first ``n - m + 1``: only these
    are joined. Within the join a pair must pass three bounds on what it can share: its sizes, the
    numbers of trigrams behind the common one (which holds for its first), and a bitmap of each
    side. Pairs that pass are made distinct as two numbers and scored from the trigrams' numbers, so
    texts are neither split again nor joined. Repeated queries and repeated rows give a pair once.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    asked = trigram_rows(
        queries.select(F.col(query_id).alias("query_id"), F.col(query_text).alias("_text")).distinct(),
        "_query",
        "asked",
    )
    rows = trigram_rows(
        df.select(F.col(id_column).alias("id"), F.col(column).alias("_text")).distinct(), "_row", "texts"
    )
    asked_grams = asked.select("_query", "_size", F.explode("_set").alias("trigram"))
    row_grams = rows.select("_row", "_size", F.explode("_set").alias("trigram"))
    wanted = asked_grams.select("trigram").distinct()
    # In order of rarity the stored rows have ascending numbers.
    held = materialise(
        lookup_join(row_grams, wanted, ["trigram"])
        .groupBy("trigram")
        .agg(F.count("*").alias("_rows"))
        .orderBy("_rows", "trigram")
        .select("trigram", F.monotonically_increasing_id().alias("_gram")),
        "held-trigrams",
    )

    def sets(grams: DataFrame, number: str, side: str) -> DataFrame:
        """A side's common trigrams in order, its size and its signature."""
        found = (
            lookup_join(grams, held, ["trigram"])
            .groupBy(number, "_size")
            .agg(F.sort_array(F.collect_list("_gram")).alias("_held"))
        )
        return materialise(
            found.select(
                number,
                F.col("_size").alias(f"{side}_size"),
                F.col("_held").alias(f"{side}_held"),
                F.size("_held").alias(f"{side}_count"),
                *[word.alias(f"{side}_sig{w}") for w, word in enumerate(signature(F.col("_held")))],
            ),
            "trigram-sets",
        )

    def keys(side_sets: DataFrame, number: str, side: str) -> DataFrame:
        """The common trigrams among the first ``size - m + 1``; those that the other side lacks go first."""
        size, count = F.col(f"{side}_size"), F.col(f"{side}_count")
        length = size - least_shared(size, threshold) + 1 - (size - count)
        first = F.slice(F.col(f"{side}_held"), F.lit(1), F.greatest(length, F.lit(0)))
        return side_sets.select(
            number,
            f"{side}_size",
            f"{side}_count",
            *[f"{side}_sig{w}" for w in range(SIGNATURE_WORDS)],
            F.posexplode(first).alias(f"{side}_at", "_gram"),
        )

    row_sets, query_sets = sets(row_grams, "_row", "r"), sets(asked_grams, "_query", "q")
    r_size, q_size, r_count, q_count = (F.col(c) for c in ("r_size", "q_size", "r_count", "q_count"))
    # Shared / (both sizes - shared) >= threshold.
    needed = (r_size + q_size) * F.lit(threshold / (1 + threshold)) - F.lit(1e-9)
    behind = F.least(r_count - F.col("r_at"), q_count - F.col("q_at"))
    pairs = (
        lookup_join(keys(row_sets, "_row", "r"), keys(query_sets, "_query", "q"), ["_gram"])
        .where(
            (F.least(r_count, q_count) >= needed)
            & (behind >= needed)
            & (r_count - absent_bits("r", "q") >= needed)
            & (q_count - absent_bits("q", "r") >= needed)
        )
        .select("_row", "_query")
        .distinct()
    )
    shared = F.size(F.array_intersect("r_held", "q_held"))
    scored = (
        lookup_join(pairs, query_sets.select("_query", "q_held", "q_size"), ["_query"])
        .join(row_sets.select("_row", "r_held", "r_size"), "_row")
        .select("_row", "_query", "r_size", "q_size", once(shared=shared))
        .select(
            "_row",
            "_query",
            (
                F.col("shared").cast("double") / (r_size + q_size - F.col("shared")).cast("double")
            ).alias("similarity"),
        )
        .where(F.col("similarity") >= threshold)
    )
    texts = rows.select("_row", "id", "_text")
    if k is None:
        matches = scored.join(texts, "_row")
    else:
        order = [F.col("similarity").desc(), F.col("_text").asc(), F.col("id").asc()]
        matches = top_k(scored.join(texts, "_row"), ["_query"], order, k)
    return lookup_join(matches, asked.select("_query", "query_id"), ["_query"]).select(
        "query_id", "id", "similarity"
    )


def by_tokens(df: DataFrame, query: str, *, column: str = "address_norm") -> DataFrame:
    """Rows that hold every word of the query as a whole word."""
    words = F.array_distinct(tokens(F.lit(query)))
    return df.where(F.size(F.array_except(words, tokens(column))) == 0)


def postings(df: DataFrame, id_column: str, terms: Column) -> DataFrame:
    """Inverted table ``(term, id)`` with one row per distinct term of a row."""
    return df.select(
        F.explode(F.array_distinct(terms)).alias("term"), F.col(id_column).alias("id")
    )


def write_postings(inverted: DataFrame, path: str, partitions: int | None = None) -> None:
    """Store sorted by term and id: a term reads few row groups, a very common term is spread over
    several files because the id is part of the range key."""
    numbers = [] if partitions is None else [partitions]
    inverted.repartitionByRange(*numbers, "term", "id").sortWithinPartitions(
        "term", "id"
    ).write.mode("overwrite").parquet(path)


def ids_with_all_terms(inverted: DataFrame, terms: list[str]) -> DataFrame:
    """Ids that hold all terms; only the postings of these terms are read and counted."""
    wanted = sorted(set(terms))
    return (
        inverted.where(F.col("term").isin(wanted))
        .groupBy("id")
        .agg(F.count_distinct("term").alias("_found"))
        .where(F.col("_found") == len(wanted))
        .select("id")
    )
