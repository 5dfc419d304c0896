"""Counts, means and cross products per part of a table, from which correlations of any union of parts follow.

A part is a value of a column, usually the one a table is partitioned by. The
moments of parts merge without their rows, around the mean of the union, so large means
lose no digits. A question about other parts, or other pairs, reads the stored moments only.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Pair = tuple[str, str]


def moments(df: DataFrame, part: str, pairs: Sequence[Pair], complete: bool = False) -> DataFrame:
    """One row for each part and pair: n, means, sums of squares and products about them, least and greatest values.

    Of the rows where both values exist. `complete` says that no column has nulls;
    what depends on one column is then computed once for all its pairs. One pass over the rows.
    """
    columns = list(dict.fromkeys(name for pair in pairs for name in pair))
    numbers = df.selectExpr(f"`{part}` AS part", *[f"double(`{c}`) AS c{i}" for i, c in enumerate(columns)])
    place = {c: i for i, c in enumerate(columns)}
    texts: dict[str, str] = {}

    def one(x: str, y: str | None, name: str) -> list[str]:
        """Names of what depends on one column, among rows that have the other."""
        value = x if complete else f"CASE WHEN {y} IS NOT NULL THEN {x} END"
        for kind, text in (
            ("mean", f"avg({value})"), ("square", f"var_pop({value}) * count({value})"), ("low", f"min({value})"), ("high", f"max({value})"),
        ):
            texts[f"{kind}_{name}"] = text
        return [f"{kind}_{name}" for kind in ("mean", "square", "low", "high")]

    rows = []
    for k, (a, b) in enumerate(pairs):
        x, y = f"c{place[a]}", f"c{place[b]}"
        texts[f"n_{k}"] = f"count(CASE WHEN {y} IS NOT NULL THEN {x} END)"
        texts[f"product_{k}"] = f"covar_pop({x}, {y}) * count(CASE WHEN {y} IS NOT NULL THEN {x} END)"
        own = one(x, y, x if complete else f"{k}_a"), one(y, x, y if complete else f"{k}_b")
        both = [name for pair in zip(*own) for name in pair]
        rows.append(", ".join([f"'{a}'", f"'{b}'", f"n_{k}", f"product_{k}", *both]))
    wide = numbers.groupBy("part").agg(*[F.expr(text).alias(name) for name, text in texts.items()])
    names = "a, b, n, product, mean_a, mean_b, square_a, square_b, low_a, low_b, high_a, high_b"
    return wide.selectExpr("part", f"stack({len(rows)}, {', '.join(rows)}) AS ({names})").where("n > 0")


def merged(parts: DataFrame) -> DataFrame:
    """The moments of the union of parts, one row a pair."""
    pair = Window.partitionBy("a", "b")
    centred = parts.select(
        "*",
        *[(F.sum(F.col("n") * F.col(f"mean_{s}")).over(pair) / F.sum("n").over(pair)).alias(f"centre_{s}") for s in "ab"],
    )
    off = {s: f"(mean_{s} - centre_{s})" for s in "ab"}
    return centred.groupBy("a", "b").agg(
        F.expr("sum(n) AS n"),
        F.expr(f"sum(product + n * {off['a']} * {off['b']}) AS product"),
        *[F.expr(f"max(centre_{s}) AS mean_{s}") for s in "ab"],
        *[F.expr(f"sum(square_{s} + n * {off[s]} * {off[s]}) AS square_{s}") for s in "ab"],
        *[F.expr(f"min(low_{s}) AS low_{s}") for s in "ab"],
        *[F.expr(f"max(high_{s}) AS high_{s}") for s in "ab"],
    )


def correlations_of(parts: DataFrame, pairs: Sequence[Pair], places: int = 6) -> DataFrame:
    """One row (a, b, r) a pair over all parts given; r is null where it is undefined, or the pair has no rows.

    A pair may be asked for either way round.
    """
    asked = parts.sparkSession.sql(
        f"SELECT stack({len(pairs)}, " + ", ".join(f"'{a}', '{b}', '{min(a, b)}', '{max(a, b)}'" for a, b in pairs) + ") AS (a, b, first, second)"
    )
    # Equal values leave rounding behind when parts merge, so constants are told by their limits.
    varies = "low_a < high_a AND low_b < high_b"
    known = merged(parts).selectExpr(
        "least(a, b) AS first", "greatest(a, b) AS second",
        f"CASE WHEN {varies} THEN round(try_divide(product, sqrt(square_a) * sqrt(square_b)), {places}) END AS r",
    )
    return asked.join(known, ["first", "second"], "left").select("a", "b", "r")


def triangle(columns: Sequence[str]) -> list[Pair]:
    """The pairs of a lower triangle, as `correlation_matrix` names them."""
    return [(b, a) for a, b in combinations(columns, 2)]
