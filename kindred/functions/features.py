"""The sixteen pair features as SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.functions import parts
from kindred.schemas import FEATURES


def _flag(test: str) -> str:
    return f"CAST(CASE WHEN {test} THEN 1 ELSE 0 END AS BIGINT)"


def _same(a: str, b: str, guard: bool = True) -> str:
    return _flag(f"{a} <> '' AND {a} = {b}" if guard else f"{a} = {b}")


def _contains(a: str, b: str) -> str:
    return _flag(f"{a} <> '' AND {b} <> '' AND (contains({a}, {b}) OR contains({b}, {a}))")


def _length_diff(a: str, b: str) -> str:
    return f"CAST(abs({a} - {b}) AS BIGINT)"


def _length_ratio(a: str, b: str) -> str:
    shortest, longest = f"least({a}, {b})", f"greatest({a}, {b})"
    return f"CASE WHEN {longest} = 0 THEN 0.0D ELSE CAST({shortest} AS DOUBLE) / {longest} END"


def _missing(a: str, b: str) -> str:
    return _flag(f"{a} = '' OR {b} = ''")


# What the features compare, worked out once per record: a record is part of many pairs.
RECORD_PARTS = {
    "country": lambda: F.col("country"),
    "name": lambda: F.col("name"),
    "name_first": lambda: parts.first_word(F.col("name")),
    "name_last": lambda: parts.last_word(F.col("name")),
    "name_two": lambda: parts.first_two_words(F.col("name")),
    "name_length": lambda: F.length("name"),
    "address": lambda: F.col("address"),
    "address_first": lambda: parts.first_word(F.col("address")),
    "address_number": lambda: parts.first_number(F.col("address")),
    "address_length": lambda: F.length("address"),
}


def record_parts(prefix: str) -> list[Column]:
    """The parts of a normalised record, each name with ``prefix`` in front."""
    return [part().alias(prefix + name) for name, part in RECORD_PARTS.items()]


def feature_columns(
    left: str, right: str, guard_empty: bool = True, address_contains: str | None = None
) -> list[Column]:
    """The features of the records whose parts carry the prefixes ``left`` and ``right``.

    ``address_contains`` is the test for different addresses of which one contains the other, where
    the addresses themselves are stood for by something that is equal if they are.

    With ``guard_empty`` two empty parts never count as equal; without it, first, last
    and first-two words of empty or short fields compare as equal empty strings.
    """

    def sides(part):
        return left + part, right + part

    values = {
        "country_match": _same(*sides("country")),
        "name_exact": _same(*sides("name")),
        "name_first_match": _same(*sides("name_first"), guard_empty),
        "name_last_match": _same(*sides("name_last"), guard_empty),
        "name_first_two_match": _same(*sides("name_two"), guard_empty),
        "name_contains": _contains(*sides("name")),
        "name_length_diff": _length_diff(*sides("name_length")),
        "name_length_ratio": _length_ratio(*sides("name_length")),
        "address_exact": _same(*sides("address")),
        "address_first_match": _same(*sides("address_first"), guard_empty),
        "address_number_match": _same(*sides("address_number")),
        "address_contains": _contains(*sides("address")),
        "address_length_diff": _length_diff(*sides("address_length")),
        "address_length_ratio": _length_ratio(*sides("address_length")),
        "name_missing": _missing(*sides("name")),
        "address_missing": _missing(*sides("address")),
    }
    if address_contains:
        a, b = sides("address")
        values["address_contains"] = _flag(f"{a} <> '' AND {b} <> '' AND ({a} = {b} OR {address_contains})")
    return [F.expr(values[f]).alias(f) for f in FEATURES]
