"""The ten analysis questions and the walkthrough summaries, over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.functions import mean
from fieldlake.operators.groups import means_by, rank_groups, share_of_parent
from fieldlake.operators.joins import not_in, star_join
from fieldlake.operators.ordered import running_average
from fieldlake.operators.stats import largest
from fieldlake.plans.rollups import alerted, farm_weather


def farm_yield(fact_yield: DataFrame, dim_farms: DataFrame) -> DataFrame:
    return star_join(fact_yield, dim_farms, "farm_id", "farm_id", "_farm")


def avg_profit_by_state_crop(fact_yield: DataFrame, dim_farms: DataFrame) -> DataFrame:
    return means_by(
        farm_yield(fact_yield, dim_farms),
        ["state", "crop"],
        {"avg_profit_loss_inr": "profit_loss_inr"},
        count="total_farms",
    ).orderBy(F.col("avg_profit_loss_inr").asc_nulls_last(), "state", "crop")


def avg_profit_by_state(fact_yield: DataFrame, dim_farms: DataFrame) -> DataFrame:
    return means_by(
        farm_yield(fact_yield, dim_farms),
        ["state"],
        {"avg_profit_loss_inr": "profit_loss_inr"},
        count="farm_count",
    ).orderBy(F.col("avg_profit_loss_inr").asc_nulls_last(), "state")


def top_yield_gaps(fact_yield: DataFrame, dim_farms: DataFrame, size: int = 10) -> DataFrame:
    joined = farm_yield(fact_yield, dim_farms).select(
        "farm_id", "state", "district", "crop",
        "expected_yield_tonnes", "actual_yield_tonnes", "yield_gap_tonnes",
    )
    return largest(joined, "yield_gap_tonnes", "farm_id", size)


def rainfall_gap_by_state(
    fact_yield: DataFrame, dim_farms: DataFrame, fact_weather: DataFrame
) -> DataFrame:
    """Reported against measured rain. The percentage averages the per-row ratios and
    leaves out rows whose station measured nothing."""
    farm, station = F.col("farm_reported_rainfall_mm"), F.col("rainfall_mm")
    off_percent = F.try_divide(F.abs(farm - station) * 100, station)
    return farm_weather(fact_yield, dim_farms, fact_weather).groupBy("state").agg(
        mean(farm).alias("avg_farm_reported_rainfall_mm"),
        mean(station).alias("avg_station_reported_rainfall_mm"),
        mean(farm - station).alias("avg_absolute_gap_mm"),
        mean(off_percent, scale=8, precision=24).alias("avg_gap_percentage"),
    )


def rank_crops_by_sustainability(fact_yield: DataFrame, dim_farms: DataFrame) -> DataFrame:
    """Ranks the rounded means, so near-equal crops tie."""
    scores = means_by(
        farm_yield(fact_yield, dim_farms),
        ["state", "crop"],
        {"avg_sustainability_score": "sustainability_score"},
    )
    return rank_groups(scores, ["state"], "avg_sustainability_score", "sustainability_rank")


def best_crop_per_state(fact_yield: DataFrame, dim_farms: DataFrame) -> DataFrame:
    """Top crop by the unrounded mean; ties all stay."""
    scores = means_by(
        farm_yield(fact_yield, dim_farms),
        ["state", "crop"],
        {"avg_score": "sustainability_score"},
        places=10,
    )
    best = rank_groups(scores, ["state"], "avg_score", "crop_rank", top=1)
    return best.withColumn("avg_score", F.round("avg_score", 6))


def highest_yield_crop(fact_yield: DataFrame, dim_farms: DataFrame) -> DataFrame:
    yields = means_by(
        farm_yield(fact_yield, dim_farms),
        ["state", "crop"],
        {"avg_actual_yield_tonnes": "actual_yield_tonnes"},
    )
    best = rank_groups(
        yields, ["state"], "avg_actual_yield_tonnes", "yield_rank", method="dense_rank", top=1
    )
    return best.drop("yield_rank").orderBy("state", "crop")


def compare_match_types(fact_yield: DataFrame) -> DataFrame:
    return means_by(
        fact_yield,
        ["match_type"],
        {
            "avg_profit_loss_inr": "profit_loss_inr",
            "avg_yield_gap_tonnes": F.col("expected_yield_tonnes") - F.col("actual_yield_tonnes"),
        },
        count="farm_count",
    )


def running_avg_profit(fact_yield: DataFrame) -> DataFrame:
    return running_average(
        fact_yield.select("farm_id", "sowing_date", "profit_loss_inr"),
        order="sowing_date",
        tie="farm_id",
        value="profit_loss_inr",
        output="running_avg_profit_loss_inr",
    )


def states_without_alerts(
    fact_yield: DataFrame, dim_farms: DataFrame, fact_weather: DataFrame
) -> DataFrame:
    """States none of whose farms is resolved to a station with an alert.

    The facts shrink to distinct (state, station) pairs before they meet the
    weather, so a station or a state with very many farms costs no more.
    """
    pairs = (
        farm_yield(fact_yield, dim_farms)
        .where(F.col("matched_station_code").isNotNull())
        .select("state", F.col("matched_station_code").alias("station_code"))
        .distinct()
    )
    stations = fact_weather.where(alerted()).select("station_code")
    excluded = pairs.join(stations, "station_code", "left_semi").select("state")
    return not_in(dim_farms.select("state").distinct(), "state", excluded)


def pest_against_health(fact_yield: DataFrame) -> DataFrame:
    return means_by(
        fact_yield,
        ["pest_attack"],
        {
            "avg_crop_health_score": "crop_health_score",
            "avg_sustainability_score": "sustainability_score",
        },
        count="farm_count",
    )


def disaster_risk_share(fact_climate: DataFrame) -> DataFrame:
    shares = share_of_parent(
        fact_climate, ["country"], ["disaster_risk"], "risk_occurrence_count", "risk_percentage"
    )
    return shares.orderBy("country", F.desc("risk_percentage"), "disaster_risk")
