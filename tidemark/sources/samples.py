"""The supplied sample tables (orders, events, customer) as the four logical tables.

The samples have no missing values, so missing ones come in by rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sessions import fold_plays

# On these tables 730 days labels about a quarter of the users.
SAMPLE_THRESHOLD = 730


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    """One activity row per order."""
    day = F.to_date("o_orderdate")
    status = F.col("o_orderstatus")
    state = F.when(status == "F", "subs").when(status == "O", "free").when(status == "P", "trial")
    return _read(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("rid"),
        day.alias("date"),
        state.alias("state"),
        F.dayofmonth(day).alias("workout_day"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.month(day)).alias("gameplay_day"),
    )


def history_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """One session per order: few per user, with missing lpi, without hours and games."""
    return _read(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("rid"),
        F.to_date("o_orderdate").alias("date"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("lpi"),
    )


def plays(spark: SparkSession, folder: str) -> DataFrame:
    """One play per event; errors have no lpi."""
    return _read(spark, folder, "events").select(
        "user_id",
        F.col("ts").alias("at"),
        F.col("event_id").alias("rid"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("lpi"),
        F.hour("ts").alias("hour"),
        F.get_json_object("props", "$.k").cast("int").alias("game_id"),
    )


def day_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """One session per user and day, its hours folded."""
    return fold_plays(plays(spark, folder))


def play_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """One session per user and day with its hours and games as lists.

    For what shows or writes the lists: a user's whole day is in one row, so memory
    follows the longest day. `day_sessions` and `plays` have no such row.
    """
    shown = [F.col(c).cast("string").alias(c) for c in ("hour", "game_id")]
    played = F.array_sort(F.collect_list(F.struct("at", "rid", *shown)))
    days = plays(spark, folder).groupBy("user_id", F.to_date("at").alias("date")).agg(
        F.min("rid").alias("rid"), F.avg("lpi").alias("lpi"), played.alias("played")
    )
    return days.select(
        "user_id",
        "date",
        "rid",
        "lpi",
        F.array_join("played.hour", ",").alias("hour"),
        F.array_join("played.game_id", ",").alias("gameId"),
    )


def variety(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct event types per user and ISO week; weeks under four events are missing."""
    weekly = _read(spark, folder, "events").groupBy("user_id", F.weekofyear("ts").alias("weekOfYear"))
    kinds = F.when(F.count(F.lit(1)) >= 4, F.count_distinct("event_type")).cast("double")
    return weekly.agg(kinds.alias("gameVariety"))


def demographics(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer."""
    segment = F.col("c_mktsegment")
    gender = F.when(segment.isin("BUILDING", "AUTOMOBILE"), "m").when(segment != "MACHINERY", "f")
    return _read(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.floor(F.col("c_acctbal") / 80).cast("int").alias("age"),
        gender.alias("gender"),
        segment.alias("language"),
    )


def event_values(spark: SparkSession, folder: str) -> DataFrame:
    """Each event's value as a dated index with its time of day."""
    return _read(spark, folder, "events").select(
        "user_id", F.col("ts").alias("date"), F.col("event_id").alias("rid"), F.col("value").alias("lpi")
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a spaced column and one that is empty, missing or quoted in turn."""
    turn = F.col("doc_id") % 3
    quoted = F.concat(F.lit('"'), "source", F.lit('"'))
    return _read(spark, folder, "documents").select(
        "doc_id",
        "text",
        F.concat(F.lit("  "), "lang", F.lit(" ")).alias("spaced"),
        F.when(turn == 0, "").when(turn == 2, quoted).alias("odd"),
    )
