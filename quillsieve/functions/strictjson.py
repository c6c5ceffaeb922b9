"""JSON parsing that rejects what strict parsers reject."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_OPTIONS = {"allowSingleQuotes": "false"}


def parse_single(text: Column, type_name: str) -> Column:
    """Parse exactly one JSON value; anything after it makes the result null.

    ``from_json`` stops after the first value and ignores the rest. Inside an
    array of one and, again, inside an object the rest is a syntax error.
    """
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{type_name}>", _OPTIONS)
    held = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), f"v {type_name}", _OPTIONS)
    return F.when(F.size(listed) == 1, held["v"])
