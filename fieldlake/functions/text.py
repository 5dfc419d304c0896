"""Text standardisation and date parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upper_columns(df: DataFrame, columns: Sequence[str], trim: bool = False) -> DataFrame:
    """Upper-case the named text columns; `trim` also drops outer blanks."""
    def tidy(name: str) -> Column:
        return F.upper(F.trim(F.col(name))) if trim else F.upper(F.col(name))

    return df.withColumns({name: tidy(name) for name in columns})


def parse_dates(df: DataFrame, columns: Sequence[str], fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Text to DATE; text that does not fit the pattern becomes null."""
    return df.withColumns(
        {name: F.try_to_date(F.col(name), fmt) for name in columns}
    )


def same_text(name: str | Column, literal: str) -> Column:
    """Case-insensitive comparison with a fixed word; false for null."""
    value = F.col(name) if isinstance(name, str) else name
    return F.coalesce(F.upper(value) == literal.upper(), F.lit(False))


def is_yes(name: str | Column) -> Column:
    return same_text(name, "Yes")
