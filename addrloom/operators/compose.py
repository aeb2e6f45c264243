"""From address features to raw input addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrloom.functions.regions import normalize_region
from addrloom.functions.text import clean_ws, first_non_empty, null_if_empty, strip
from addrloom.operators.joins import lookup_join
from addrloom.sources.geojson import PROPERTIES
from addrloom.sources.manifest import city_from_job, split_source_name

# Fixed value: language of an input address when nothing else is known.
DEFAULT_LANGUAGE = "en"

PARTS = ("number", "street", "unit", "city", "district", "region", "postcode", "country")
EXTRAS = ("city", "locality", "region", "state")


def with_all_properties(features: DataFrame) -> DataFrame:
    """Add missing optional property columns as nulls."""
    present = set(features.columns)
    added = {
        name: F.lit(None).cast("string") for name in PROPERTIES if name not in present
    }
    if "not_text" not in present:
        added["not_text"] = F.lit(False)
    return features.withColumns(added) if added else features


def has_required_fields() -> Column:
    """House number and street are both given; a street that is no text is refused."""
    return (
        null_if_empty("number").isNotNull()
        & null_if_empty("street").isNotNull()
        & ~F.col("not_text")
    )


def required_fields(features: DataFrame) -> DataFrame:
    return with_all_properties(features).where(has_required_fields())


def join_jobs(features: DataFrame, jobs: DataFrame) -> DataFrame:
    """Give every feature the place of its job; jobs with a malformed name give no rows."""
    named = split_source_name(jobs).select("job_id", "job_country", "job_region", "job_city")
    return lookup_join(features, named, ["job_id"])


def country_text() -> Column:
    return F.upper(first_non_empty("country", "job_country"))


def unstripped_parts() -> dict[str, Column]:
    """The eight parts a raw address is made of, with the job's place as fallback."""
    country = country_text()
    region = normalize_region(first_non_empty("region", "state", "job_region"), country)
    return {
        "number": F.col("number"),
        "street": F.upper(first_non_empty("street", "street_name")),
        "unit": F.col("unit"),
        "city": F.upper(F.coalesce(first_non_empty("city", "locality"), city_from_job())),
        "district": F.col("district"),
        "region": F.upper(region),
        "postcode": F.col("postcode"),
        "country": country,
    }


def part_columns(*, strip_outer: bool = False) -> list[Column]:
    """The parts as plain columns ``part_<name>``; stripped and with empty ones null on demand.

    They are columns and not a struct on purpose: the optimizer takes structs apart again and would
    then repeat a part's expression wherever the part is used.
    """
    if not strip_outer:
        return [part.alias(f"part_{name}") for name, part in unstripped_parts().items()]
    as_they_are = ("region", "country")
    return [
        null_if_empty(F.col(f"part_{n}") if n in as_they_are else strip(f"part_{n}")).alias(
            f"part_{n}"
        )
        for n in PARTS
    ]


def raw_address() -> Column:
    """``<number> <street> <unit>, <city>, <district>, <region>, <postcode>, <country>``."""
    part = {name: F.col(f"part_{name}") for name in PARTS}
    left = F.concat_ws(" ", part["number"], part["street"], part["unit"])
    right = null_if_empty(
        F.concat_ws(", ", part["city"], part["district"], part["region"], part["postcode"])
    )
    return clean_ws(F.concat_ws(", ", left, right, part["country"]))


def country_code() -> Column:
    return null_if_empty(F.upper(strip("part_country")))


def input_addresses(features_with_jobs: DataFrame) -> DataFrame:
    """Input records: raw text, language, country code, the back-fill extras and the parts.

    Columns that are no feature property (ids, file columns) are passed through.
    """
    dropped = {*PROPERTIES, "not_text", "job_country", "job_region", "job_city"}
    source = with_all_properties(features_with_jobs)
    kept = [name for name in source.columns if name not in dropped]
    parts = [f"part_{name}" for name in PARTS]
    return (
        source.select(*kept, F.struct(*EXTRAS).alias("extras"), *part_columns())
        .select(*kept, "extras", *part_columns(strip_outer=True))
        .select(
            *kept,
            raw_address().alias("address_raw"),
            F.lit(DEFAULT_LANGUAGE).alias("language_code"),
            country_code().alias("country_code"),
            "extras",
            *parts,
        )
    )
