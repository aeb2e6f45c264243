"""Word tokens and trigrams for text search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from addrloom.functions.text import ColumnOrName, as_column

# Fixed value: a word is a run of letters and digits.
WORD = r"[\p{L}\p{N}]+"


def tokens(text: ColumnOrName) -> Column:
    """Lower-cased words in text order: no stemming, no stop words."""
    return F.regexp_extract_all(F.lower(as_column(text)), F.lit(WORD), F.lit(0))


def token_positions(text: ColumnOrName) -> Column:
    """Words with their 1-based positions."""
    return F.transform(
        tokens(text), lambda word, i: F.struct(word.alias("token"), (i + 1).alias("position"))
    )


def trigrams(text: ColumnOrName) -> Column:
    """Distinct trigrams of every word, padded with two blanks before and one after."""

    padded = F.transform(tokens(text), lambda word: F.concat(F.lit("  "), word, F.lit(" ")))

    def of_word(word: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(word) - 2)
        return F.transform(starts, lambda i: word.substr(i, F.lit(3)))

    return F.array_distinct(F.flatten(F.transform(padded, of_word)))


def set_similarity(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Shared members over all members of two arrays of distinct values; 0 when both are empty."""
    left, right = as_column(left), as_column(right)
    shared = F.size(F.array_intersect(left, right))
    total = F.size(left) + F.size(right) - shared
    return F.when(total == 0, F.lit(0.0)).otherwise(
        shared.cast("double") / F.nullif(total, F.lit(0)).cast("double")
    )


def trigram_similarity(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Similarity of two texts. The one-element array makes each trigram set only once."""
    sets = F.array(F.struct(trigrams(left).alias("left"), trigrams(right).alias("right")))
    scores = F.transform(
        sets, lambda pair: set_similarity(pair.getField("left"), pair.getField("right"))
    )
    return F.get(scores, F.lit(0))
