"""Labels, bars and shard names of the printed reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def grouped_number(value: Column, width: int = 8) -> Column:
    """Right-aligned number with thousands separators; wider numbers are not cut."""
    digits = F.format_number(value, 0)
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit(" "))


def range_label(low: Column, high: Column) -> Column:
    return F.concat(grouped_number(low), F.lit(" - "), grouped_number(high))


def bar(count: Column, total: Column, width: int = 50) -> Column:
    share = F.floor(count * width / F.greatest(total, F.lit(1)))
    return F.repeat(F.lit("#"), F.least(share, F.lit(width)).cast("int"))


def mebibytes(n_bytes: Column) -> Column:
    return n_bytes / F.lit(1024 * 1024)


def shard_label(path: Column) -> Column:
    """File name, preceded by its ``shard=N`` folder where there is one."""
    return F.regexp_extract(path, r"((?:[^/=]+=[^/=]+/)?[^/]+)$", 1)


def shard_number(path: Column) -> Column:
    """The number in the last ``shard=N``, ``shard_N`` or ``shard-N`` of a path; a path without one is an error."""
    number = F.regexp_extract(path, r".*shard[=_-](\d+)", 1)
    missing = F.raise_error(F.concat(F.lit("no shard number in "), path)).cast("bigint")
    return F.when(number == "", missing).otherwise(number.cast("bigint"))
