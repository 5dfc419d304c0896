"""CSV feeds with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fieldlake.contracts import CLIMATE_FEED, FARM_FEED, STATION_FEED, Contract
from fieldlake.sinks.settle import settle

# File names of the three feeds.
FEED_FILES = {
    FARM_FEED.name: "agriculture_crop_analysis.csv",
    STATION_FEED.name: "imd_weather_station_data.csv",
    CLIMATE_FEED.name: "noaa_climate_environmental_data.csv",
}


def read_feed(
    spark: SparkSession,
    path: str,
    contract: Contract,
    strict: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A feed in its declared types.

    Strict reading compares the header with the declared names and fails on a
    cell that does not fit; otherwise columns bind by position and such cells
    become null. `columns` picks columns by name; the scan parses only those.
    """
    reader = spark.read.schema(contract.schema).option("header", True)
    if strict:
        reader = reader.option("enforceSchema", False).option("mode", "FAILFAST")
    feed = reader.csv(path)
    return feed.select(*columns) if columns else feed


def read_feeds(spark: SparkSession, raw_dir: str, strict: bool = True) -> dict[str, DataFrame]:
    return {
        contract.name: read_feed(
            spark, f"{raw_dir.rstrip('/')}/{FEED_FILES[contract.name]}", contract, strict
        )
        for contract in (FARM_FEED, STATION_FEED, CLIMATE_FEED)
    }


def profile_feed(spark: SparkSession, path: str) -> DataFrame:
    """An unknown feed with types guessed from its cells; reads the file twice."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table from literal rows."""
    return spark.createDataFrame(list(rows), schema)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """`df` with its row count observed by whichever action reads it next."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


# Malformed rows ---------------------------------------------------------------

_LINE, _FILE = "_line", "_file"


class RejectedRows(ValueError):
    """More lines of a feed do not fit its contract than the load allows."""


def read_with_quarantine(
    spark: SparkSession, path: str, contract: Contract, most: int | float = 0.01
) -> tuple[DataFrame, DataFrame]:
    """The rows of a feed that fit its contract, and the lines that do not.

    A line is rejected if it has too many or too few cells, if a cell is not of its declared type, or
    if a required cell is empty; the others load. The second frame is (feed, file, line, reason), one
    row a line, in which `reason` names every fault. The header must fit, as in
    strict reading. More rejected lines than `most`, a number or, below 1, a share of all lines, raise
    `RejectedRows`. The files are read once: what was parsed is settled, so both frames agree.
    """
    schema = StructType([*(StructField(f.name, f.dataType) for f in contract.schema), StructField(_LINE, StringType())])
    parsed = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
        # All cells count, also those that no query asks for.
        .option("columnPruning", False)
        .csv(path)
    )
    empty = " OR ".join(f"`{name}` IS NULL" for name in contract.required()) or "false"
    # A line whose cells parse but lack a required one is put together again.
    cells = ", ".join(f"'{name}', `{name}`" for name in contract.columns)
    line = f"coalesce({_LINE}, CASE WHEN {empty} THEN to_csv(named_struct({cells})) END) AS {_LINE}"
    columns = [f"`{name}`" for name in contract.columns]
    parsed = settle(parsed.selectExpr(*columns, line, f"_metadata.file_path AS {_FILE}"), f"parsed-{contract.name}")
    counts = parsed.agg(F.count(F.lit(1)).alias("lines"), F.count(_LINE).alias("rejected")).first()
    allowed = most if most >= 1 or most == 0 else most * counts.lines
    good = parsed.where(F.col(_LINE).isNull()).select(*contract.columns)
    rejected = parsed.where(F.col(_LINE).isNotNull()).select(
        F.lit(contract.name).alias("feed"), F.col(_FILE).alias("file"), F.col(_LINE).alias("line"), _reason(contract).alias("reason")
    )
    if counts.rejected > allowed:
        first = "; ".join(f"{r.file}: {r.reason}" for r in rejected.orderBy("file", "line").limit(3).collect())
        raise RejectedRows(f"{contract.name}: {counts.rejected} of {counts.lines} lines rejected, {allowed:g} allowed: {first}")
    return good, rejected


def _reason(contract: Contract) -> Column:
    """What is wrong with a rejected line, from its cells as text."""
    names = [f"c{i}" for i in range(len(contract.columns) + 1)]
    texts = F.from_csv(_LINE, ", ".join(f"{n} STRING" for n in names), {"mode": "PERMISSIVE"})
    cell = {f.name: texts[f"c{i}"] for i, f in enumerate(contract.schema)}
    faults = [F.when(texts[names[-1]].isNotNull(), F.lit("too many cells"))]
    for field in contract.schema:
        typed = cell[field.name].try_cast(field.dataType)
        wrong = cell[field.name].isNotNull() & typed.isNull()
        faults.append(F.when(wrong, F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), cell[field.name])))
        if not field.nullable:
            faults.append(F.when(cell[field.name].isNull(), F.lit(f"{field.name} is empty")))
    # Faults of quoting or of the number of cells that leave every cell readable.
    return F.coalesce(F.nullif(F.concat_ws("; ", *faults), F.lit("")), F.lit("the line does not have the declared cells"))


def read_feeds_with_quarantine(
    spark: SparkSession, raw_dir: str, most: int | float = 0.01
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The feeds of a folder, and all rejected lines of them."""
    good, rejected = {}, []
    for contract in (FARM_FEED, STATION_FEED, CLIMATE_FEED):
        path = f"{raw_dir.rstrip('/')}/{FEED_FILES[contract.name]}"
        good[contract.name], bad = read_with_quarantine(spark, path, contract, most)
        rejected.append(bad)
    return good, reduce(DataFrame.unionByName, rejected)
