"""Text clean-up on columns: whitespace, accents, title case, first non-empty value."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def code_point_class(accept: Callable[[str], bool]) -> str:
    """Body of a Java character class holding every code point that ``accept`` takes."""
    ranges: list[list[int]] = []
    for point in range(0x110000):
        if 0xD800 <= point <= 0xDFFF or not accept(chr(point)):
            continue
        if ranges and ranges[-1][1] == point - 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "".join(f"\\x{{{low:X}}}-\\x{{{high:X}}}" for low, high in ranges)


@cache
def whitespace() -> str:
    """Every Unicode whitespace character."""
    return "".join(ch for ch in map(chr, range(0x10000)) if ch.isspace())


@cache
def whitespace_class() -> str:
    return f"[{code_point_class(str.isspace)}]"


@cache
def combining_class() -> str:
    """Marks with a non-zero combining class.

    The left side of the intersection is one category look-up, so ordinary letters never walk the
    long range list; ``Cn`` lets through marks that the JVM's older Unicode tables do not know yet.
    """
    marks = code_point_class(lambda ch: unicodedata.combining(ch) != 0)
    return f"\\p{{M}}\\p{{Cn}}&&[{marks}]"


def once(**values: Column) -> Column:
    """Generator giving the columns ``values`` of exactly one row, each computed once.

    Catalyst copies the expressions of a projection into every filter above it, and does so again at
    each further projection. A filter does not move below a generator that makes its inputs.
    """
    return F.inline(F.array(F.struct(*[value.alias(name) for name, value in values.items()])))


def null_if_empty(value: ColumnOrName) -> Column:
    return F.nullif(as_column(value), F.lit(""))


def first_non_empty(*values: ColumnOrName) -> Column:
    return F.coalesce(*[null_if_empty(value) for value in values])


def strip(value: ColumnOrName) -> Column:
    """Drop Unicode whitespace at both ends (``trim`` alone would only drop U+0020).

    The general trim walks the whole text, so it only runs where an end is no visible ASCII. The
    value is looked at several times: give a plain column, not a long expression.
    """
    text = F.trim(as_column(value))
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    unsure = (first < "!") | (first > "~") | (last < "!") | (last > "~")
    return F.when(unsure, F.btrim(text, F.lit(whitespace()))).otherwise(text)


def clean_ws(value: ColumnOrName) -> Column:
    """Collapse every run of Unicode whitespace to one space and trim."""
    return F.trim(F.regexp_replace(as_column(value), f"{whitespace_class()}+", " "))


def ascii_fold(value: ColumnOrName) -> Column:
    """Compatibility-decompose, then drop combining marks. Other letters stay as they are.

    ``java_method`` counts as non-deterministic in Catalyst: project the result before using it in
    an aggregate or a join condition, and put filters below it. Pure ASCII rows skip it.
    """
    text = as_column(value)
    decomposed = F.java_method(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), text, F.lit(True)
    )
    folded = F.regexp_replace(decomposed, f"[{combining_class()}]+", "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), folded).otherwise(text)


def title_case(value: ColumnOrName) -> Column:
    """Capital after every uncased character (``O'Brien``, ``5Th``), not only after spaces."""
    cased = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"
    runs = F.regexp_extract_all(as_column(value), F.lit(f"([{cased}]+|[^{cased}]+)"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")
