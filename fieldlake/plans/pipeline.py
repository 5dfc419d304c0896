"""The whole job: feeds, clean tables, star, rollups, checks, publication."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.contracts import FEEDS
from fieldlake.operators.dedup import settled_first_per_key
from fieldlake.plans import analysis, checks, model
from fieldlake.plans.rollups import build_rollups
from fieldlake.sinks.database import reload_database
from fieldlake.sinks.publish import PublishError, Snapshot, current, require_clean_contracts
from fieldlake.sinks.settle import Owner, bucket_count, settle
from fieldlake.sinks.small import create_view, write_log
from fieldlake.sources.feeds import counted, read_feeds, read_feeds_with_quarantine
from fieldlake.sources.tables import Database, load_tables

# Names of the two published views.
RAINFALL_GAP_VIEW = "view_rainfall_reporting_gap"
DISASTER_RISK_VIEW = "view_noaa_disaster_risk_distribution"

#: Checks without which the tables contradict each other; the others judge the data.
BLOCKING_CHECKS = ("unique_keys", "orphans", "row_counts", "profit_rows")

_CLEANERS = {
    "feed_farms": model.clean_farms,
    "feed_stations": model.clean_stations,
    "feed_climate": model.clean_climate,
}


def refresh(
    feeds: dict[str, DataFrame],
    target: str,
    database: Database | None = None,
    log_path: str | None = None,
    strict: bool = True,
    blocking: Collection[str] = BLOCKING_CHECKS,
    keep: int | None = None,
    unique: bool = False,
) -> dict[str, int]:
    """Rebuild and publish everything from the feeds; returns rows read per feed.

    Each clean table is computed once and each later step reads stored tables.
    The quality suite runs on the new tables before they become current, and is
    logged either way. With `strict` they become current only if they keep their
    contracts and pass the `blocking` checks; other checks report. `keep` bounds
    the published runs that stay. Partitions that are as the current run has them are not
    written again. Intermediate tables go when the job ends. `unique` says that
    every feed has one row per key, which saves shuffling it for that.
    """
    spark = next(iter(feeds.values())).sparkSession
    with Owner(spark):
        clean, seen = {}, {}
        for name, cleaner in _CLEANERS.items():
            feed, seen[name] = counted(feeds[name], name)
            rows = feed if unique else settled_first_per_key(feed, FEEDS[name].key, name)
            clean[name] = settle(cleaner(rows, True), f"clean-{name}")

        farms = clean["feed_farms"]
        snapshot = Snapshot(spark, target, carry=True)
        star_plans = model.build_star(farms, clean["feed_stations"], clean["feed_climate"])
        buckets = bucket_count(spark, farms)
        for name, df in star_plans.items():
            snapshot.write(name, df, buckets)
        star = snapshot.tables()
        for name, df in build_rollups(star).items():
            snapshot.write(name, df)

        results = settle(checks.run_standard(star, farms), "checks")
        if log_path:
            write_log(results, log_path)

        def validate(tables: dict[str, DataFrame]) -> None:
            require_clean_contracts(tables)
            failed = results.where(~F.col("passed") & F.col("check_id").isin(*blocking))
            found = [row.check_id for row in failed.select("check_id").collect()]
            if found:
                raise PublishError(f"checks failed: {', '.join(sorted(found))}")

        snapshot.commit(validate if strict else None, keep)
        if database:
            reload_database(snapshot.tables(), database)
        return {name: observed.get["rows"] for name, observed in seen.items()}


def run(
    spark: SparkSession, raw_dir: str, target: str, quarantine: str | None = None, most_rejected: int | float = 0.01, **options
) -> dict[str, int]:
    """`refresh` from the CSV files in a folder.

    A line that does not fit its contract stops the load. With `quarantine`, a folder,
    such lines are written there with file and reason, and only more than
    `most_rejected` of a feed, a number or a share, stop it.
    """
    if quarantine is None:
        return refresh(read_feeds(spark, raw_dir), target, **options)
    with Owner(spark):
        feeds, rejected = read_feeds_with_quarantine(spark, raw_dir, most_rejected)
        rejected.write.mode("overwrite").partitionBy("feed").parquet(quarantine)
        return refresh(feeds, target, **options)


def open_views(spark: SparkSession, target: str) -> None:
    """Register the published tables and the two analysis views."""
    star = load_tables(spark, current(spark, target))
    for name, df in star.items():
        create_view(df, name)
    gap = analysis.rainfall_gap_by_state(
        star["fact_crop_yield"], star["dim_farms"], star["fact_weather_observations"]
    )
    create_view(gap, RAINFALL_GAP_VIEW)
    create_view(
        analysis.disaster_risk_share(star["fact_global_climate_environment"]), DISASTER_RISK_VIEW
    )
