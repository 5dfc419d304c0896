"""Grouped summaries: ranks, shares, pivots, cross tables, contrasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.functions import mean, same_text
from fieldlake.functions.exact import share


def means_by(
    df: DataFrame,
    by: Sequence[str],
    values: dict[str, Column | str],
    count: str | None = None,
    places: int = 2,
) -> DataFrame:
    """Rounded means per group, with an optional row count."""
    aggregates = [mean(value, places).alias(name) for name, value in values.items()]
    if count:
        aggregates.append(F.count(F.lit(1)).alias(count))
    return df.groupBy(*by).agg(*aggregates)


def rank_groups(
    df: DataFrame,
    within: Sequence[str],
    value: str,
    output: str,
    method: str = "rank",
    top: int | None = None,
) -> DataFrame:
    """Rank summary rows inside each group by `value`, greatest first.

    `method` is "rank" (gaps after ties) or "dense_rank". `top` keeps ranks up
    to that number, ties included.
    """
    methods = {"rank": F.rank, "dense_rank": F.dense_rank}
    window = Window.partitionBy(*within).orderBy(F.col(value).desc_nulls_last())
    ranked = df.withColumn(output, methods[method]().over(window))
    return ranked if top is None else ranked.where(F.col(output) <= top)


def share_of_parent(
    df: DataFrame, parent: Sequence[str], child: Sequence[str], count: str, percent: str
) -> DataFrame:
    """Rows per (parent, child) and their percentage of the parent's rows.

    The parent total is a window over the counts, not a second scan and join.
    """
    counts = df.groupBy(*parent, *child).agg(F.count(F.lit(1)).alias(count))
    total = F.sum(count).over(Window.partitionBy(*parent))
    return counts.withColumn(percent, share(F.col(count), total))


def crosstab(
    df: DataFrame, row: str, column: str, count: str = "rows", percent: str = "percent"
) -> DataFrame:
    """Rows per (row, column) and their percentage of the row's rows that have a column value."""
    return share_of_parent(df.where(F.col(column).isNotNull()), [row], [column], count, percent)


def widen(
    cells: DataFrame,
    row: str,
    column: str,
    value: str,
    labels: Sequence[str] | None = None,
    fill: float | None = None,
    most: int = 1000,
) -> DataFrame:
    """One row per `row`, one column per label, from cells (row, column, value).

    Without `labels` every value of `column` becomes a column, null last as
    "unknown". With them the order is theirs, listed but absent ones hold
    `fill`, and a value that is not listed is an error, so no cell is lost.
    More than `most` labels are an error.
    """
    found = [r[0] for r in cells.select(column).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} values of {column}; keep the long form")
    if labels is None:
        labels = sorted(found, key=lambda x: (x is None, str(x)))
    elif set(found) - set(labels):
        raise ValueError(f"values of {column} without a label: {sorted(map(str, set(found) - set(labels)))}")
    names = [column_name(label) for label in labels]
    if len(set(names)) < len(names):
        raise ValueError(f"labels of {column} give equal column names")
    wide = cells.groupBy(row).agg(
        *[F.max(F.when(F.col(column).eqNullSafe(label), F.col(value))).alias(n) for label, n in zip(labels, names)]
    )
    return wide if fill is None else wide.fillna(fill, names)


def column_name(label: str | None) -> str:
    return "unknown" if label is None else str(label).lower().replace(" ", "_")


def ordered_means(
    df: DataFrame, category: str, order: Sequence[str], values: Sequence[str], places: int = 2
) -> DataFrame:
    """Means per category in a fixed order; listed but absent categories stay as nulls."""
    means = means_by(
        df.where(F.col(category).isin(*order)), [category], {v: v for v in values}, places=places
    )
    return (
        labelled(df, order, category)
        .join(means, category, "left")
        .select("position", category, *values)
    )


def labelled(df: DataFrame, labels: Sequence[str], name: str) -> DataFrame:
    """The fixed labels as a table with their position from 1."""
    listed = F.posexplode(F.array(*[F.lit(label) for label in labels])).alias("_at", name)
    return df.sparkSession.range(1).select(listed).select(
        (F.col("_at") + 1).alias("position"), name
    )


def contrast(df: DataFrame, flag: str, values: Sequence[str], places: int = 2) -> DataFrame:
    """Means of rows without and with the flag, their difference and relative change.

    One pass over the data; one result row per measure.
    """
    yes = same_text(flag, "Yes")
    no = same_text(flag, "No")
    sides = df.agg(
        *[mean(F.when(no, F.col(v)), places).alias(f"without_{v}") for v in values],
        *[mean(F.when(yes, F.col(v)), places).alias(f"with_{v}") for v in values],
    )
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(v).alias("measure"),
                    F.col(f"without_{v}").alias("mean_without"),
                    F.col(f"with_{v}").alias("mean_with"),
                )
                for v in values
            ]
        )
    )
    without, with_flag = F.col("mean_without"), F.col("mean_with")
    return sides.select(rows).select(
        "measure",
        "mean_without",
        "mean_with",
        F.round(with_flag - without, places).alias("difference"),
        F.round(F.try_divide(100 * (with_flag - without), F.abs(without)), places).alias(
            "change_pct"
        ),
    )
