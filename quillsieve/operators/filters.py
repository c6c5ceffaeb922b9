"""Row filters and gates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.matching import blocked, first_term, has_phrase
from ..functions.patterns import DEFAULT_PHRASES, TermList
from ..functions.textnorm import MIN_DOC_CHARS, is_empty, long_enough, strip
from ..runtime import spread

# Subsets opened by default and the audiences accepted in each.
DEFAULT_SUBSETS: dict[str, list[str] | None] = {
    "stories": ["young_children"],
    "auto_math_text": ["grade_school_students"],
    "openstax": ["young_children", "middle_school_students"],
    "stanford": ["young_children"],
    "khanacademy": ["young_children", "grade_school_students", "middle_school_students"],
    "wikihow": ["young_children", "grade_school_students", "middle_school_students"],
}


def audience_allowed(
    subset: Column, audience: Column, subsets: Mapping[str, Sequence[str] | None]
) -> Column:
    """Plain predicate over the subset rules, so it can reach the scan.

    A subset without audiences takes every row; an unlisted subset takes none.
    """
    normal = strip(F.lower(F.coalesce(audience, F.lit(""))))
    allowed = F.lit(False)
    open_subsets = [name for name, wanted in subsets.items() if not wanted]
    if open_subsets:
        allowed = allowed | subset.isin(open_subsets)
    rules: dict[tuple, list[str]] = {}
    for name, wanted in subsets.items():
        if wanted:
            rules.setdefault(tuple(sorted({w.lower() for w in wanted})), []).append(name)
    for wanted, names in rules.items():
        allowed = allowed | (subset.isin(names) & normal.isin(list(wanted)))
    # Implied by the rules, but unlike them it can be pushed into the scan.
    return subset.isin(list(subsets)) & allowed


def audience_filter(
    df: DataFrame,
    subsets: Mapping[str, Sequence[str] | None] = DEFAULT_SUBSETS,
    subset: str = "subset",
    audience: str = "audience",
) -> DataFrame:
    return df.where(audience_allowed(F.col(subset), F.col(audience), subsets))


def min_length(df: DataFrame, min_chars: int = MIN_DOC_CHARS, text: str = "text") -> DataFrame:
    return df.where(long_enough(F.col(text), min_chars))


def empty_docs(df: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """Rows and empty documents, per key if keys are given."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("docs"),
        F.count_if(is_empty(F.col(text))).alias("empty"),
    )


def blocklist_filter(df: DataFrame, terms: TermList, text: str = "text") -> DataFrame:
    """Keep the documents in which no term occurs."""
    return spread(df).where(~blocked(F.col(text), terms))


def with_first_term(
    df: DataFrame, terms: TermList, text: str = "text", out: str = "matched_term"
) -> DataFrame:
    """Add the first matching term in list order, null for clean documents."""
    return spread(df).withColumn(out, first_term(F.col(text), terms))


def flagged(
    df: DataFrame, terms: TermList, text: str = "text", out: str = "matched_term"
) -> DataFrame:
    """Only the documents that match, with the term that rejected them."""
    named = spread(df).withColumn(out, first_term(F.col(text), terms, once=True))
    return named.where(F.col(out).isNotNull())


def phrase_filter(
    df: DataFrame, phrases: Iterable[str] = DEFAULT_PHRASES, text: str = "text"
) -> DataFrame:
    return spread(df).where(~has_phrase(F.col(text), phrases))


def is_safe_verdict(verdict: Column) -> Column:
    """Fail-closed: anything but "safe" (a missing verdict included) is unsafe."""
    return F.coalesce(F.lower(strip(verdict)) == "safe", F.lit(False))


def verdict_gate(
    df: DataFrame, verdicts: DataFrame, key: str, verdict: str = "verdict", out: str = "is_safe"
) -> DataFrame:
    """Attach the external verdict. ``verdicts`` holds one row per key."""
    joined = df.join(verdicts.select(key, verdict), key, "left")
    return joined.withColumn(out, is_safe_verdict(F.col(verdict))).drop(verdict)


def over_threshold(scores: Sequence[str], threshold: float) -> Column:
    """True when any score exceeds the threshold; missing scores do not."""
    over = F.lit(False)
    for name in scores:
        over = over | F.coalesce(F.col(name) > threshold, F.lit(False))
    return over


def score_gate(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Keep the rows in which every score stays at or below its limit."""
    kept = F.lit(True)
    for name, limit in limits.items():
        kept = kept & ~over_threshold([name], limit)
    return df.where(kept)


def layered_gate(df: DataFrame, layers: Sequence[tuple[str, Column]]) -> DataFrame:
    """Name the first layer that rejects a row (null: passed all).

    ``layers`` is a list of ``(name, rejects)`` with the cheap ones first; a
    later layer is evaluated only for the rows the earlier ones let through.
    """
    reason = None
    for name, rejects in layers:
        rejects = F.coalesce(rejects, F.lit(False))
        reason = F.when(rejects, name) if reason is None else reason.when(rejects, name)
    return df.withColumn("rejected_by", reason)
