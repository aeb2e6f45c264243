"""From tagged address parts to the postal schema, and on to the canonical string."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from addrloom.functions.text import (
    ColumnOrName,
    ascii_fold,
    as_column,
    clean_ws,
    first_non_empty,
    null_if_empty,
)

# Tag labels that may fill a component, most specific first.
LABELS = {
    "thoroughfare": (
        "road", "pedestrian", "footway", "path", "residential", "cycleway", "construction",
    ),
    "house": ("house", "building"),
    "dependent_locality": (
        "suburb", "neighbourhood", "neighborhood", "hamlet", "quarter", "borough",
    ),
    "locality": ("city", "town", "village", "municipality", "city_district", "district"),
    "admin_area_2": ("county", "state_district", "province_district"),
    "admin_area_1": ("state", "province", "region", "island"),
}

# The parts of the canonical string after the delivery line, in output order.
CANONICAL_TAIL = (
    "dependent_locality", "locality", "admin_area_2", "admin_area_1", "postal_code",
)

COMPONENTS = (
    "postal_code", "admin_area_1", "admin_area_2", "locality", "dependent_locality",
    "thoroughfare", "premise", "sub_premise",
)


def tag_arrays(tags: ColumnOrName = "tags") -> list[Column]:
    """Tags as two parallel arrays, last tag first, values lower-cased and cleaned.

    Put these in their own projection: every component then costs one ``array_position`` per label
    instead of a filter over the whole array.
    """
    last_first = F.reverse(as_column(tags))
    texts = F.transform(last_first.getField("value"), lambda v: clean_ws(F.lower(v)))
    return [last_first.getField("label").alias("tag_labels"), texts.alias("tag_texts")]


def tagged(label: str) -> Column:
    """Value of a label; the last tag wins when a label occurs more than once."""
    position = F.array_position("tag_labels", F.lit(label))
    return F.get("tag_texts", (position - 1).cast("int"))


def pick(component: str) -> Column:
    return first_non_empty(*[tagged(label) for label in LABELS[component]])


def component_columns() -> dict[str, Column]:
    """The eight address components and the tagged country, read off the ``tag_arrays``."""

    def joined(*parts: Column) -> Column:
        return null_if_empty(F.concat_ws(" ", *[null_if_empty(part) for part in parts]))

    return {
        "postal_code": tagged("postcode"),
        "admin_area_1": pick("admin_area_1"),
        "admin_area_2": pick("admin_area_2"),
        "locality": pick("locality"),
        "dependent_locality": pick("dependent_locality"),
        "thoroughfare": pick("thoroughfare"),
        "premise": joined(tagged("house_number"), pick("house")),
        "sub_premise": joined(tagged("level"), tagged("unit")),
        "country": tagged("country"),
    }


def canonical_string(
    parts: Mapping[str, ColumnOrName] | None = None, country_code: ColumnOrName = "country_code"
) -> Column:
    """One-line address: folded, lower-cased, single-spaced; the unit is left out on purpose."""
    part = {name: as_column((parts or {}).get(name, name)) for name in COMPONENTS}
    delivery_line = F.concat_ws(
        " ", null_if_empty(part["premise"]), null_if_empty(part["thoroughfare"])
    )
    line = F.concat_ws(
        ", ",
        null_if_empty(delivery_line),
        *[null_if_empty(part[name]) for name in CANONICAL_TAIL],
        null_if_empty(F.lower(as_column(country_code))),
    )
    return clean_ws(F.lower(ascii_fold(line)))
