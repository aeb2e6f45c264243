"""Postal address data on Spark: normalise, check, de-duplicate, load and search."""
