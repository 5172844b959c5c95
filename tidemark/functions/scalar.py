"""Scalar feature expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First digit of a card number and the issuer it stands for.
CARD_ISSUERS = {"4": "Visa", "5": "MasterCard", "6": "Discover"}
OTHER_ISSUER = "other"


def card_issuer(number: Column) -> Column:
    """Issuer of a card, from the first digit of its number."""
    first = F.substring(number.cast("string"), 1, 1)
    branches = None
    for digit, issuer in CARD_ISSUERS.items():
        hit = first == F.lit(digit)
        branches = F.when(hit, issuer) if branches is None else branches.when(hit, issuer)
    return branches.otherwise(OTHER_ISSUER)


def flag_above(value: Column, limit: float) -> Column:
    """1 above the limit, else 0; a missing value counts as not above."""
    return F.when(value > F.lit(limit), 1).otherwise(0)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def joined(values: list[Column], sep: str = ",") -> Column:
    """Values as one delimited string; a null becomes an empty field."""
    return F.concat_ws(sep, *[F.coalesce(v.cast("string"), F.lit("")) for v in values])
