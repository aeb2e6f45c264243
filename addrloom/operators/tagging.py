"""Address tagging: ``tags ARRAY<STRUCT<value, label>>`` from parts or from free text.

The structured tagger is exact for features. The free-text tagger knows the comma layout that
``compose.raw_address`` writes; it claims no parity with statistical address parsers. Any other
tagger plugs in as a function over pandas batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.functions.regions import state_code_map
from addrloom.functions.text import null_if_empty, once

TAGS_TYPE = "ARRAY<STRUCT<value: STRING, label: STRING>>"

# Tag label of every address part, in the order of the raw address. A district is a
# second-level area (county, department), hence its label.
PART_LABELS = {
    "number": "house_number",
    "street": "road",
    "unit": "unit",
    "city": "city",
    "district": "state_district",
    "region": "state",
    "postcode": "postcode",
    "country": "country",
}

# Words that open the unit part of a delivery line.
UNIT_WORDS = ("apartment", "apt", "unit", "suite", "ste", "room", "rm", "flat", "lot")


def present_tags(values: dict[str, Column]) -> Column:
    pairs = [
        F.struct(value.alias("value"), F.lit(label).alias("label"))
        for label, value in values.items()
    ]
    return F.filter(F.array(*pairs), lambda pair: null_if_empty(pair.getField("value")).isNotNull())


def structured_tags() -> Column:
    return present_tags({label: F.col(f"part_{name}") for name, label in PART_LABELS.items()})


def with_free_text_tags(inputs: DataFrame) -> DataFrame:
    """Tags of ``<number> <street> <unit>, <city>[, <district>][, <region>][, <postcode>], <cc>``.

    Read from the right: a last segment of 2 or 3 letters is the country; then a segment with a
    digit is the postcode; then a US state, a code of up to three letters, or the last of several
    places is the region. Each step is its own column, so later steps do not repeat earlier ones.
    """

    def last(column: str) -> Column:
        return F.get(column, F.size(column) - 1)

    def rest(column: str, taken: str) -> Column:
        size = F.size(column) - F.when(F.col(taken).isNotNull(), 1).otherwise(0)
        return F.slice(column, F.lit(1), F.greatest(size, F.lit(0)))

    segments = F.transform(F.split("address_raw", ","), lambda segment: F.trim(segment))
    is_state = F.try_element_at(state_code_map(), F.upper("_candidate")).isNotNull()
    is_region = is_state | F.col("_candidate").rlike(r"^\p{L}{1,3}$") | (F.size("_rest2") > 1)
    unit_shape = rf"(?i)\s((?:{'|'.join(UNIT_WORDS)})\b\.?\s*\S+|#\s*\S+)$"
    steps = [
        {"_all": segments},
        {
            "_delivery": F.get("_all", F.lit(0)),
            "_rest0": F.slice("_all", F.lit(2), F.greatest(F.size("_all") - 1, F.lit(0))),
        },
        {"_last": last("_rest0")},
        {"_country": F.when(F.col("_last").rlike(r"^\p{L}{2,3}$"), F.col("_last"))},
        {"_rest1": rest("_rest0", "_country")},
        {"_last": last("_rest1")},
        {"_postcode": F.when(F.col("_last").rlike(r"\d"), F.col("_last"))},
        {"_rest2": rest("_rest1", "_postcode")},
        {"_candidate": last("_rest2")},
        {"_region": F.when(is_region, F.col("_candidate"))},
        {
            "_rest3": rest("_rest2", "_region"),
            "_street": F.regexp_replace("_delivery", r"^\S*\d\S*\s+", ""),
        },
    ]
    tags = present_tags(
        {
            "house_number": F.regexp_extract("_delivery", r"^(\S*\d\S*)\s", 1),
            "road": F.regexp_replace("_street", unit_shape, ""),
            "unit": F.regexp_extract("_street", unit_shape, 1),
            "city": F.get("_rest3", F.lit(0)),
            "state_district": F.get("_rest3", F.lit(1)),
            "state": F.col("_region"),
            "postcode": F.col("_postcode"),
            "country": F.col("_country"),
        }
    )
    tagged = inputs
    for step in steps:
        tagged = tagged.withColumns(step)
    return tagged.select(*inputs.columns, once(tags=tags))


def with_structured_tags(inputs: DataFrame) -> DataFrame:
    return inputs.withColumn("tags", structured_tags())


def with_custom_tags(
    inputs: DataFrame,
    tag: Callable[[str, str | None, str | None], Iterable[tuple[str, str]]],
) -> DataFrame:
    """Plug in any tagger ``(text, language, country) -> (value, label) pairs``; runs per batch.

    Only these three columns go to Python and only the tags come back.
    """

    @F.pandas_udf(TAGS_TYPE)
    def tags(texts: pd.Series, languages: pd.Series, countries: pd.Series) -> pd.Series:
        rows = zip(texts, languages, countries, strict=True)
        return pd.Series(
            [[{"value": value, "label": label} for value, label in tag(*row)] for row in rows],
            dtype=object,
        )

    return inputs.withColumn("tags", tags("address_raw", "language_code", "country_code"))
