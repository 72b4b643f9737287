"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from wardlight.schema import CONDITION_PREFIXES, LOW_RISK_BELOW, HIGH_RISK, TIER_1, TIER_2


def patient_name() -> Column:
    return F.concat("first_name", F.lit(" "), "last_name")


def condition_prefix(name: str) -> str | None:
    """ICD-10 prefix of a condition; the name's case does not matter."""
    wanted = name.upper()
    return next((p for c, p in CONDITION_PREFIXES.items() if c.upper() == wanted), None)


def has_prefix(code: Column, prefixes: Iterable[str]) -> Column:
    """Any-of prefix test; each arm is a StartsWith that the scan can take."""
    test = F.lit(False)
    for position, prefix in enumerate(prefixes):
        arm = code.startswith(prefix)
        test = arm if position == 0 else test | arm
    return test


def contains_any(text: Column, words: Iterable[str]) -> Column:
    test = F.lit(False)
    for word in words:
        test = test | text.contains(word)
    return test


def count_contained(text: Column, words: Iterable[str]) -> Column:
    """How many of ``words`` occur in ``text`` as literal substrings."""
    total = F.lit(0)
    for word in words:
        total = total + text.contains(word).cast("int")
    return total


def risk_category(score: Column) -> Column:
    return (F.when(score < LOW_RISK_BELOW, "Low")
            .when(score < HIGH_RISK, "Moderate")
            .otherwise("High"))


def tier_label(score: Column) -> Column:
    """Tier by score; a missing score counts as the lowest tier."""
    return (F.when(score > TIER_1, "TIER 1")
            .when(score > TIER_2, "TIER 2")
            .otherwise("TIER 3"))


def contact_hours(score: Column) -> Column:
    return F.when(score > TIER_1, 24).when(score > TIER_2, 48).otherwise(72)


def two_decimals(value: Column) -> Column:
    """Text with two decimals, rounded on the exact binary value."""
    return F.format_number(value, 2)


def hash_draw(seed: str, key: Column) -> Column:
    """A repeatable whole number in 0 … 2^32-1 for ``key``."""
    digest = F.md5(F.concat(F.lit(seed), key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def uniform_draw(seed: str, key: Column) -> Column:
    """A repeatable draw in [0, 1)."""
    return hash_draw(seed, key) / F.lit(2.0 ** 32)
