"""Normalised records: schema mapping, back-fill, plausibility, canonical string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.functions.components import (
    COMPONENTS,
    canonical_string,
    component_columns,
    tag_arrays,
)
from addrloom.functions.regions import normalize_region
from addrloom.functions.text import (
    clean_ws,
    first_non_empty,
    null_if_empty,
    once,
    strip,
    title_case,
)
from addrloom.functions.validate import rejection_reason
from addrloom.operators.compose import PARTS

RECORD_COLUMNS = ("country_code", *COMPONENTS)

# Columns of an input record that the normalised record replaces.
INPUT_ONLY = (
    "address_raw", "language_code", "country_code", "extras", "tags",
    *[f"part_{name}" for name in PARTS],
)


def backfilled_region(missing_region: str) -> Column:
    """Region of the feature's own fields where no region was tagged.

    ``missing_region="none_text"`` treats an absent region as the text ``None`` (so ``NO`` in the
    US, ``NONE`` elsewhere), which is what the reference behaviour amounts to; the default leaves
    the field empty.
    """
    raw = first_non_empty("extras.region", "extras.state")
    if missing_region == "none_text":
        raw = F.coalesce(raw, F.lit("None"))
    elif missing_region != "null":
        raise ValueError(f"unknown missing_region: {missing_region}")
    filled = null_if_empty(normalize_region(raw, F.col("country_code")))
    return F.coalesce(null_if_empty("admin_area_1"), filled)


def backfilled_locality() -> Column:
    return F.coalesce(
        null_if_empty("locality"),
        title_case(clean_ws(first_non_empty("extras.city", "extras.locality"))),
    )


def normalise(tagged_inputs: DataFrame, *, missing_region: str = "null") -> DataFrame:
    """One normalised record per tagged input; other columns are passed through."""
    kept = [name for name in tagged_inputs.columns if name not in INPUT_ONLY]
    indexed = tagged_inputs.select(*kept, "country_code", "extras", *tag_arrays())
    mapped = component_columns()
    components = indexed.select(
        *kept, "country_code", "extras", *[mapped[name].alias(name) for name in COMPONENTS]
    )
    replaced = {
        "country_code": F.upper(strip(F.coalesce("country_code", F.lit("")))),
        "admin_area_1": backfilled_region(missing_region),
        "locality": backfilled_locality(),
    }
    return components.select(
        *kept, once(**{name: replaced.get(name, F.col(name)) for name in RECORD_COLUMNS})
    )


def with_reason(records: DataFrame) -> DataFrame:
    return records.withColumn("reason", rejection_reason())


def plausible(checked: DataFrame) -> DataFrame:
    return checked.where("reason IS NULL").drop("reason")


def implausible(checked: DataFrame) -> DataFrame:
    return checked.where("reason IS NOT NULL")


def with_canonical(records: DataFrame) -> DataFrame:
    """Add ``address_norm``. Keep filters below this step: accent folding blocks pushdown."""
    return records.withColumn("address_norm", canonical_string())
