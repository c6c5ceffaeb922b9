"""Seeded pseudo-random order that any engine can reproduce."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SHUFFLE_SEED = 42
SAMPLE_SEED = 123


def shuffle_key(row_id: Column, seed: int = SHUFFLE_SEED) -> Column:
    """Hex digest of ``seed:id``; sorting by it is the seeded shuffle."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def key_bucket(key: Column, digits: int) -> Column:
    """Leading hex digits as a number: monotone in the key and evenly filled."""
    if digits == 0:
        return F.lit(0).cast("bigint")
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("bigint")


def bucket_digits(rows: int, rows_per_bucket: int) -> int:
    """Hex digits needed so that an average bucket holds at most ``rows_per_bucket`` rows."""
    digits = 0
    while rows > rows_per_bucket * 16**digits:
        digits += 1
    return digits


def whole_div(value: Column, by: int) -> Column:
    """Integer division of a non-negative whole number, exact beyond 2**53."""
    return F.call_function("div", value, F.lit(by))
