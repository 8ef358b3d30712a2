"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Where postal code and town stand in a one-line address.
POSTAL_CODE = r"(\d{5})"
TOWN = r"\d{5}\s+(.*)$"

# Fixed value: what a missing sport declaration reads as.
NO_SPORT = "Aucune"


def postal_code(address: Column) -> Column:
    """First run of five digits; '' when there is none, NULL for a NULL address."""
    return F.regexp_extract(address, POSTAL_CODE, 1)


def town(address: Column) -> Column:
    return F.trim(F.regexp_extract(address, TOWN, 1))


def normalised(label: Column) -> Column:
    return F.lower(F.trim(label))


def declared_sport(practice: Column) -> Column:
    """NULL and '' count as no declaration; blanks are kept as they are."""
    return F.coalesce(F.nullif(practice, F.lit("")), F.lit(NO_SPORT))


def full_name(first: Column, last: Column, fallback: Column) -> Column:
    return F.coalesce(F.concat(first, F.lit(" "), last), fallback)
