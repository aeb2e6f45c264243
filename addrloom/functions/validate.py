"""Plausibility of a normalised record: the first rule it breaks, or null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from addrloom.functions.components import COMPONENTS
from addrloom.functions.text import ColumnOrName, as_column, null_if_empty, strip

# Postal code shapes by country, matched on stripped upper-cased text.
POSTAL_SHAPES = {
    "US": r"^\d{5}(?:-\d{4})?$",
    "CA": r"^[A-Z]\d[A-Z][ -]?\d[A-Z]\d$",
    "GB": r"^[A-Z]{1,2}\d[A-Z\d]?\s*\d[A-Z]{2}$",
    "AU": r"^\d{4}$",
    "NZ": r"^\d{4}$",
    "FR": r"^\d{5}$",
    "DE": r"^\d{5}$",
    "NL": r"^\d{4}\s?[A-Z]{2}$",
    "ES": r"^\d{5}$",
    "IT": r"^\d{5}$",
}

# Field length limit, control characters that are refused, what counts as content.
MAX_FIELD_LENGTH = 256
CONTROL_CHARACTERS = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
CONTENT = r"[A-Za-z0-9]"


def postal_shape_ok(country_code: ColumnOrName, postal_code: ColumnOrName) -> Column:
    """True for a matching shape and for countries without a known shape."""
    country, text = as_column(country_code), F.upper(strip(postal_code))
    matches = F
    for code, shape in POSTAL_SHAPES.items():
        matches = matches.when(country == code, text.rlike(f"(?U){shape}"))
    return matches.otherwise(F.lit(True))


def rejection_reason() -> Column:
    """First broken rule of a record with the nine schema columns; null means plausible."""
    country = F.upper(strip(F.coalesce(F.col("country_code"), F.lit(""))))
    field = {name: F.col(name) for name in COMPONENTS}
    present = {name: null_if_empty(column) for name, column in field.items()}

    def none_of(*names: str) -> Column:
        return F.coalesce(*[present[name] for name in names]).isNull()

    def has_content(name: str) -> Column:
        return F.coalesce(field[name].rlike(CONTENT), F.lit(False))

    # One look at all fields together settles the common case; only then each field is examined.
    everything = F.concat_ws("", *field.values())
    suspect = (F.length(everything) > MAX_FIELD_LENGTH) | everything.rlike(CONTROL_CHARACTERS)
    hygiene = []
    for name in COMPONENTS:
        hygiene.append((F.length(field[name]) > MAX_FIELD_LENGTH, f"{name}_too_long"))
        hygiene.append((field[name].rlike(CONTROL_CHARACTERS), f"{name}_has_control_chars"))
    delivery = [
        (~country.rlike(r"^\p{L}{2}$"), "invalid country_code"),
        (none_of("thoroughfare", "premise"), "missing thoroughfare_or_premise"),
        (
            none_of("locality", "admin_area_1", "admin_area_2", "postal_code"),
            "missing locality_admin_or_postal",
        ),
    ]
    shapes = [
        (
            present["postal_code"].isNotNull() & ~postal_shape_ok(country, "postal_code"),
            "postal_code_shape_mismatch",
        ),
        (
            (country == "US")
            & present["admin_area_1"].isNotNull()
            & ~F.upper(strip("admin_area_1")).rlike(r"^[A-Z]{2}$"),
            "admin_area_1_not_two_letter_state",
        ),
        (
            ~(has_content("thoroughfare") | has_content("premise")),
            "empty_delivery_line_content",
        ),
    ]

    def first_broken(rules: list[tuple[Column, str]]) -> Column:
        return F.coalesce(*[F.when(broken, F.lit(reason)) for broken, reason in rules])

    return F.coalesce(
        first_broken(delivery), F.when(suspect, first_broken(hygiene)), first_broken(shapes)
    )
