"""Weekly game variety per user. Input: user_id, weekOfYear, gameVariety."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import JobConfig
from tidemark.operators.prep import without_future_weeks


def variety_stats(df: DataFrame, null_policy: str = "poison") -> DataFrame:
    """gv_max, gv_avg, gv_std_dev (population) over a user's weeks.

    'poison': a missing week makes all three 0. 'skip': missing weeks do not
    count, and only a user without any value gets 0.
    """
    if null_policy not in ("poison", "skip"):
        raise ValueError(f"null_policy must be 'poison' or 'skip', not {null_policy!r}")
    v = F.col("gameVariety")
    stats = (
        df.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.max(v).alias("gv_max"),
            F.avg(v).alias("gv_avg"),
            F.stddev_pop(v).alias("gv_std_dev"),
            F.count(v).alias("_known"),
            F.count(F.lit(1)).alias("_weeks"),
        )
    )
    usable = F.col("_known") == F.col("_weeks") if null_policy == "poison" else F.col("_known") > 0

    def filled(name: str) -> Column:
        return F.when(usable, F.col(name)).otherwise(F.lit(0.0)).alias(name)

    return stats.select("user_id", filled("gv_max"), filled("gv_avg"), filled("gv_std_dev"))


def variety_features(df: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    rows = without_future_weeks(df, config.as_of) if config.as_of else df
    return variety_stats(rows, config.null_policy)
