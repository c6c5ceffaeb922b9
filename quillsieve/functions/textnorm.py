"""Text normalisation with code-point semantics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters removed by Unicode whitespace stripping.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Whitespace a browser strips around a frame line.
FRAME_WHITESPACE = (
    "\t\n\x0b\x0c\r \xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# Estimate used when a document carries no token count, and the
# length thresholds of the two document kinds.
CHARS_PER_TOKEN = 4.8
MIN_DOC_CHARS = 50
MIN_BOOK_CHARS = 201

# The public-domain e-book header and footer lines. The line tail
# is [^\n] because "." also stops at other line ends in Java.
BOOK_START = r"(?i)\A[\s\S]*?\*\*\* ?START OF (?:THE|THIS) PROJECT GUTENBERG EBOOK[^\n]*?\*\*\*"
BOOK_END = r"(?i)\*\*\* ?END OF (?:THE|THIS) PROJECT GUTENBERG EBOOK[^\n]*?\*\*\*[\s\S]*\z"


def strip(text: Column, chars: str = WHITESPACE) -> Column:
    """Both-ends strip over an explicit character set (native, no regex)."""
    return F.trim(text, F.lit(chars))


def long_enough(text: Column, min_chars: int = MIN_DOC_CHARS) -> Column:
    """True when the stripped text has at least ``min_chars`` code points; null is false.

    The raw length is tested first, so short rows never reach the strip.
    """
    return F.coalesce(
        (F.length(text) >= min_chars) & (F.length(strip(text)) >= min_chars), F.lit(False)
    )


def is_empty(text: Column) -> Column:
    """Null or blank after stripping."""
    return F.coalesce(F.length(strip(text)) == 0, F.lit(True))


def estimate_from_length(n_chars: Column) -> Column:
    return (n_chars / F.lit(CHARS_PER_TOKEN)).cast("bigint")


def token_count(text: Column, stored: Column | None = None) -> Column:
    """Stored token count where present, else the length-based estimate."""
    estimate = estimate_from_length(F.length(text))
    return estimate if stored is None else F.coalesce(stored.cast("bigint"), estimate)


def strip_boilerplate(raw: Column) -> Column:
    """Cut e-book header and footer, strip, and collapse runs of 4+ newlines to 3."""
    body = F.regexp_replace(raw, F.lit(BOOK_START), F.lit(""))
    body = F.regexp_replace(body, F.lit(BOOK_END), F.lit(""))
    return F.regexp_replace(strip(body), F.lit(r"\n{4,}"), F.lit("\n\n\n"))


def preview(text: Column, max_chars: int = 300) -> Column:
    head = F.translate(F.substring(text, 1, max_chars), "\n", " ")
    return F.concat(head, F.lit("..."))


def shard_name(shard: Column) -> Column:
    return F.format_string("shard_%05d", shard)


def pattern_tokens(text: Column) -> Column:
    """Default tokenizer: words and single symbols, counted natively."""
    return F.size(F.regexp_extract_all(text, F.lit(r"(\w+|[^\w\s])"), F.lit(1))).cast("bigint")
