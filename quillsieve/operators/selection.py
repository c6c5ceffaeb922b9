"""Choosing documents: subset union, catalogue lookup, token budgets, mixtures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.ordering import whole_div
from ..runtime import materialize

# Token-budget shares of the two source kinds.
SOURCE_FRACTIONS = {"educational": 0.70, "books": 0.30}

# Rows one running-sum window may hold, and the ways a wider range is split.
LEAF_ROWS = 1 << 20
RANGE_SPLITS = 1024


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; no deduplication."""
    return reduce(lambda left, right: left.unionByName(right), parts)


def catalog_select(catalog: DataFrame, topic: str = "children", language: str = "en") -> DataFrame:
    """Sorted distinct ids of the entries in a language whose topics mention a phrase."""
    about = F.exists("topics", lambda t: F.lower(t).contains(topic.lower()))
    wanted = F.array_contains("languages", language) & about
    return catalog.where(wanted).select("id").distinct().orderBy("id")


def epoch_mixture(parts: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """Repeat each dataset ``epochs`` times and concatenate, tagging dataset and epoch."""
    repeated = [
        df.withColumn("dataset", F.lit(name)).withColumn(
            "epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs)))
        )
        for name, (df, epochs) in parts.items()
        if epochs > 0
    ]
    return union_sources(repeated)


def fraction_budgets(
    target: int, fractions: Mapping[str, float] = SOURCE_FRACTIONS
) -> dict[str, int]:
    return {name: int(target * share) for name, share in fractions.items()}


def budget_cut(
    df: DataFrame,
    budgets: int | Mapping[str, int],
    tokens: str = "tokens",
    ord: str = "ord",
    row_id: str = "row_id",
    group: str | None = None,
    leaf_rows: int = LEAF_ROWS,
    splits: int = RANGE_SPLITS,
) -> DataFrame:
    """Keep rows, in ``(ord, row_id)`` order, while the tokens before them are below budget.

    The crossing row is kept. With ``group`` every group has its own budget and
    groups without one are dropped. ``ord`` numbers the subsets of a source
    (few values); ``row_id`` is an integer unique within it.

    No total order of the corpus is built. Range sums narrow down where the
    running total crosses the budget, only that range is ordered, and the
    result is a plain filter on the order columns.
    """
    by_group = {"": budgets} if group is None else dict(budgets)
    group_col = F.lit("") if group is None else F.col(group)
    narrow = materialize(
        df.select(
            group_col.alias("g"),
            F.col(ord).alias("o"),
            F.col(row_id).alias("r"),
            F.coalesce(F.col(tokens), F.lit(0)).cast("bigint").alias("t"),
        ),
        "budget",
    )
    summed = narrow.groupBy("g", "o").agg(
        F.sum("t").alias("t"), F.count("t").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi")
    )
    limit = F.lit(None).cast("bigint")
    for name, budget in by_group.items():
        limit = F.when(F.col("g") == name, F.lit(budget)).otherwise(limit)
    # One row per subset; the crossing subset of each group that has a budget comes back.
    upto = F.sum("t").over(Window.partitionBy("g").orderBy("o").rowsBetween(Window.unboundedPreceding, 0))
    crossed = summed.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("t")).where(
        (F.col("before") < limit) & (limit <= F.col("upto"))
    )
    open_ranges = {
        row.g: dict(o=row.o, lo=row.lo, hi=row.hi, n=row.n, before=row.before) for row in crossed.collect()
    }

    def inside(ranges: Mapping[str, dict]) -> Column:
        tests = [
            (F.col("g") == name) & (F.col("o") == r["o"]) & F.col("r").between(r["lo"], r["hi"])
            for name, r in ranges.items()
        ]
        return reduce(lambda a, b: a | b, tests)

    while wide := {k: r for k, r in open_ranges.items() if r["n"] > leaf_rows and r["hi"] > r["lo"]}:
        part = F.lit(None).cast("bigint")
        for name, r in wide.items():
            r["step"] = (r["hi"] - r["lo"]) // splits + 1
            # Decimals, because ids may span more than half of the bigint range.
            offset = F.col("r").cast("decimal(20,0)") - F.lit(Decimal(r["lo"]))
            part = F.when(F.col("g") == name, whole_div(offset, Decimal(r["step"]))).otherwise(part)
        sums = (
            narrow.where(inside(wide))
            .groupBy("g", part.alias("part"))
            .agg(F.sum("t").alias("t"), F.count("t").alias("n"))
            .collect()
        )
        for row in sorted(sums, key=lambda row: (row.g, row.part)):
            r = wide[row.g]
            if r.get("done"):
                continue
            if r["before"] + row.t >= by_group[row.g]:
                low = r["lo"] + row.part * r["step"]
                r.update(lo=low, hi=min(r["hi"], low + r["step"] - 1), n=row.n, done=True)
            else:
                r["before"] += row.t
        for r in wide.values():
            r.pop("done", None)

    crossing: dict[str, int] = {}
    if open_ranges:
        running = F.sum("t").over(
            Window.partitionBy("g").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
        )
        reached = F.lit(False)
        for name, r in open_ranges.items():
            missing = by_group[name] - r["before"]
            reached = reached | ((F.col("g") == name) & (F.col("running") >= missing))
        found = (
            narrow.where(inside(open_ranges))
            .select("g", "r", running.alias("running"))
            .where(reached)
            .groupBy("g")
            .agg(F.min("r").alias("r"))
        )
        crossing = {row.g: row.r for row in found.collect()}

    keep = F.lit(False)
    for name, budget in by_group.items():
        if budget <= 0:
            continue
        mine = F.lit(True) if group is None else F.col(group) == name
        if name in crossing:
            cut = open_ranges[name]["o"]
            mine = mine & (
                (F.col(ord) < cut) | ((F.col(ord) == cut) & (F.col(row_id) <= crossing[name]))
            )
        keep = keep | mine
    return df.where(keep)


def subset_totals(df: DataFrame, tokens: str = "tokens", subset: str = "subset") -> DataFrame:
    return df.groupBy(subset).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(tokens).cast("bigint").alias("tokens")
    )


def capped_extract(
    df: DataFrame,
    doc_cap: int,
    max_chars: int,
    text: str = "text",
    ord: str = "ord",
    row_id: str = "row_id",
) -> DataFrame:
    """Cut every document to ``doc_cap`` characters and stop at a total character budget.

    The cut is the feature here: it feeds a tokenizer trainer, not the corpus.
    """
    capped = df.withColumn(text, F.substring(text, 1, doc_cap)).withColumn(
        "_chars", F.length(text).cast("bigint")
    )
    return budget_cut(capped, max_chars, "_chars", ord, row_id).drop("_chars")
