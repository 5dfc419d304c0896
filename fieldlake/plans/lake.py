"""Tables of one source directory, each computed once per application.

Analysis queries read the published star rather than re-deriving it from the
feeds. A table is built on first use, together with the tables it needs, and
stays in the shared folder until the lake is closed; a change of the source
files starts afresh. A query's plan is built once, so asking again stores
nothing again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from fieldlake.contracts import CLIMATE_FEED, DIM_FARMS, FACT_CLIMATE, FACT_WEATHER, FACT_YIELD, FARM_FEED, ROLLUPS, Contract
from fieldlake.operators.dedup import settled_first_per_key
from fieldlake.plans import model
from fieldlake.plans.charts import climate_moments
from fieldlake.plans.rollups import build_rollups
from fieldlake.sinks.settle import Owner, bucket_count, settle, settle_table, source_state
from fieldlake.sources.derived import DERIVED, derive_feed
from fieldlake.sources.feeds import counted

_LAKES: dict[tuple, "Lake"] = {}

_SOURCES = sorted({table for feed in DERIVED.values() for table in feed.tables})

#: Tables of the star in their order, and the property of a lake that has each.
_STAR = {
    "dim_farms": "dim_farms",
    "dim_weather_stations": "dim_stations",
    "fact_crop_yield": "fact_yield",
    "fact_weather_observations": "fact_weather",
    "fact_global_climate_environment": "fact_climate",
}


class _Asked(dict):
    def __init__(self, lake: "Lake"):
        self.lake = lake

    def __missing__(self, name: str) -> DataFrame:
        self[name] = getattr(self.lake, _STAR[name])
        return self[name]


class Lake:
    def __init__(self, spark: SparkSession, source_dir: str):
        self.spark = spark
        self.source_dir = source_dir
        self.owner = Owner(spark)
        self._tables: dict[str, str] = {}
        self._frames: dict[str, DataFrame] = {}
        self._answers: dict[str, DataFrame] = {}
        #: Rows of feeds and tables, observed while a table that comes from them was stored.
        self._rows: dict[str, int] = {}
        self._observing: dict[str, Observation] = {}

    @classmethod
    def of(cls, spark: SparkSession, source_dir: str) -> "Lake":
        state = source_state(spark, [f"{source_dir.rstrip('/')}/{t}.parquet" for t in _SOURCES])
        key = (spark.sparkContext.applicationId, id(spark), source_dir, state)
        if key not in _LAKES:
            _LAKES[key] = cls(spark, source_dir)
        return _LAKES[key]

    def answer(self, name: str, build: Callable[["Lake"], DataFrame]) -> DataFrame:
        """The frame of a named query; what building it settles belongs to the lake."""
        if name not in self._answers:
            with self.owner.open():
                self._answers[name] = build(self)
        return self._answers[name]

    def close(self) -> None:
        """Delete all stored tables of this lake; its frames must not be used any more."""
        self.owner.release()
        for key in [key for key, lake in _LAKES.items() if lake is self]:
            del _LAKES[key]

    def feed(self, name: str) -> DataFrame:
        """A raw feed, computed whenever it is read."""
        return derive_feed(self.spark, self.source_dir, name)

    def _unique(self, contract: Contract) -> DataFrame:
        """One row per key of a feed, whose rows are stored for that."""
        return settled_first_per_key(self._counted(self.feed(contract.name), contract.name), contract.key, contract.name)

    def row_counts(self, names: Sequence[str], label: str) -> DataFrame:
        """One row per feed or table, its name and its rows: what was counted when the star was stored."""
        self.farms, self.stations, self.star()
        told = ", ".join(f"'{name}', {self._rows[name]}L" for name in names)
        return self.spark.sql(f"SELECT stack({len(names)}, {told}) AS ({label}, rows)")

    # Clean tables -----------------------------------------------------------

    @property
    def farms(self) -> DataFrame:
        return self._once("clean_farms", lambda: model.clean_farms(self._unique(FARM_FEED), unique=True))

    @property
    def stations(self) -> DataFrame:
        return self._once("clean_stations", lambda: model.clean_stations(self._counted(self.feed("feed_stations"), "feed_stations")))

    # Published star ---------------------------------------------------------

    @property
    def dim_farms(self) -> DataFrame:
        return self._table(DIM_FARMS, lambda: model.dim_farms(self.farms))

    @property
    def dim_stations(self) -> DataFrame:
        return self._once("dim_weather_stations", lambda: model.dim_stations(self.stations))

    @property
    def fact_yield(self) -> DataFrame:
        return self._table(
            FACT_YIELD,
            lambda: model.fact_crop_yield(
                model.match_farms(self.farms, self.stations, self.dim_stations)
            ),
        )

    @property
    def fact_weather(self) -> DataFrame:
        return self._table(FACT_WEATHER, lambda: model.fact_weather(self.stations))

    @property
    def fact_climate(self) -> DataFrame:
        return self._table(
            FACT_CLIMATE,
            lambda: model.fact_climate(model.clean_climate(self._unique(CLIMATE_FEED), unique=True)),
        )

    def star(self) -> dict[str, DataFrame]:
        return {name: self.asked()[name] for name in _STAR}

    def asked(self) -> dict[str, DataFrame]:
        """The star, each table of which is stored when it is first asked for."""
        return _Asked(self)

    @property
    def rollups(self) -> dict[str, DataFrame]:
        """The rollups as stored, with their surrogate keys."""
        if not all(name in self._frames for name in ROLLUPS):
            with self.owner.open():
                plans = build_rollups(self.star())
            for name in ROLLUPS:
                self._once(name, lambda name=name: plans[name])
        return {name: self._frames[name] for name in ROLLUPS}

    @property
    def climate_moments(self) -> DataFrame:
        """Moments of the climate measures by country: correlations read these and no facts."""
        return self._once("climate_moments", lambda: climate_moments(self.fact_climate))

    # Storage ----------------------------------------------------------------

    def _once(self, name: str, build) -> DataFrame:
        if name not in self._frames:
            with self.owner.open():
                self._observing = {}
                self._frames[name] = settle(self._counted(build(), name), name)
            self._note_rows()
        return self._frames[name]

    def _table(self, contract, build) -> DataFrame:
        if contract.name not in self._tables:
            with self.owner.open():
                self._observing = {}
                self._tables[contract.name] = settle_table(
                    self._counted(build(), contract.name),
                    contract.name,
                    partition_by=contract.partition_by,
                    bucket_by=contract.bucket_by,
                    buckets=self._farm_buckets() if contract.bucket_by else 1,
                )
            self._note_rows()
        # The stored layout puts partition columns last; hand out contract order.
        return self.spark.table(self._tables[contract.name]).select(*contract.columns)

    def _counted(self, df: DataFrame, name: str) -> DataFrame:
        """`df`, its rows counted by the job that stores what comes from it."""
        df, self._observing[name] = counted(df, f"rows-{name}")
        return df

    def _note_rows(self) -> None:
        """Keep what the job just done has counted; an empty frame may report nothing.

        A job that failed reports never, so each one starts without what was to be observed before.
        """
        self._rows |= {name: seen.get.get("rows", 0) for name, seen in self._observing.items()}
        self._observing = {}

    def _farm_buckets(self) -> int:
        """One number for every table bucketed by farm, from the stored farm size."""
        return bucket_count(self.spark, self.farms)
