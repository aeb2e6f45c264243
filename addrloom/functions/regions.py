"""US state names and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from addrloom.functions.text import ColumnOrName, as_column, strip

# The 50 US states and the District of Columbia with their postal codes.
US_STATES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA",
    "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "District of Columbia": "DC",
    "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL",
    "Indiana": "IN", "Iowa": "IA", "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA",
    "Maine": "ME", "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN",
    "Mississippi": "MS", "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV",
    "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY",
    "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR",
    "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD",
    "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA",
    "Washington": "WA", "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}


def state_code_map() -> Column:
    """Literal map from upper-cased state name, or code, to the code (102 entries)."""
    entries = {name.upper(): code for name, code in US_STATES.items()}
    entries.update({code: code for code in US_STATES.values()})
    return F.create_map(*[F.lit(text) for entry in entries.items() for text in entry])


def normalize_region(region: ColumnOrName, country_code: ColumnOrName) -> Column:
    """Two-letter state code for the US, upper-cased text elsewhere, ``''`` for no region."""
    raw = as_column(region)
    upper = F.upper(strip(raw))
    in_us = F.upper(as_column(country_code)) == "US"
    state = F.coalesce(F.try_element_at(state_code_map(), upper), F.substring(upper, 1, 2))
    return (
        F.when(raw.isNull() | (raw == ""), F.lit("")).when(in_us, state).otherwise(upper)
    )
