"""Per-user features of play sessions.

Input columns: user_id, date, rid, lpi (performance index), hour and gameId
(comma lists of integers, one entry per game played). Sessions that `fold_plays` made of
single plays have HOUR_COLUMNS in place of the hour list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.config import JobConfig
from tidemark.functions.columns import int_list, list_square_sum, list_sum, population_std
from tidemark.operators.ordering import MAX_SLICE_ROWS, order_number, user_sequence

# Output names, oldest change first.
CHANGE_COLUMNS = [
    "ffth_last_lpi_change",
    "frth_last_lpi_change",
    "thrd_last_lpi_change",
    "sec_last_lpi_change",
    "last_lpi_change",
]


def _known_users(df: DataFrame) -> DataFrame:
    return df.where(F.col("user_id").isNotNull())


def _first_lpi(df: DataFrame) -> Column:
    # A number as the order, where a struct would force the aggregation to sort.
    order = order_number(F.col("date"), df.schema["date"].dataType, F.col("rid"))
    return F.min_by("lpi", F.when(F.col("lpi").isNotNull(), order)).alias("first_recorded_lpi")


def first_lpi(df: DataFrame) -> DataFrame:
    """The earliest recorded lpi of each user; NULL where none is recorded."""
    return _known_users(df).groupBy("user_id").agg(_first_lpi(df))


def lpi_deltas(df: DataFrame, max_rows: int = MAX_SLICE_ROWS) -> DataFrame:
    """Add ``delta``: lpi minus the user's previous row's lpi; NULL if either is missing."""
    columns = df.columns
    rows = user_sequence(df, carry=["lpi"], max_rows=max_rows)
    return rows.select(*columns, (F.col("lpi") - F.col("prev_lpi")).alias("delta"))


def last_five_list(df: DataFrame) -> DataFrame:
    """``last_5_deltas``: the lpi changes of a user's last five rows, oldest first.

    The change of a user's first row is NULL, as is one next to a missing lpi.
    Five changes need the last six rows. That limit is applied before the
    shuffle, so a user sends at most six rows per input task.
    """
    newest_first = W.partitionBy("user_id").orderBy(F.desc("date"), F.desc("rid"))
    recent = (
        _known_users(df)
        .select("user_id", "date", "rid", "lpi")
        .withColumn("_rn", F.row_number().over(newest_first))
        .where("_rn <= 6")
        .groupBy("user_id")
        .agg(
            F.least(F.count(F.lit(1)), F.lit(5)).cast("int").alias("_n"),
            *[F.max(F.when(F.col("_rn") == i, F.col("lpi"))).alias(f"_v{i}") for i in range(1, 7)],
        )
    )
    changes = F.array(*[F.col(f"_v{i}") - F.col(f"_v{i + 1}") for i in range(5, 0, -1)])
    return recent.select("user_id", F.slice(changes, 6 - F.col("_n"), F.col("_n")).alias("last_5_deltas"))


def last_five_changes(df: DataFrame, align: str = "left") -> DataFrame:
    """The last five lpi changes of each user as columns, missing ones 0.

    With n < 5 rows, 'left' puts the n changes into the oldest slots, 'right'
    into the newest.
    """
    if align not in ("left", "right"):
        raise ValueError(f"align must be 'left' or 'right', not {align!r}")
    deltas = F.col("last_5_deltas")
    gap = F.lit(0) if align == "left" else F.lit(5) - F.size(deltas)
    return last_five_list(df).select(
        "user_id",
        *[F.coalesce(F.get(deltas, F.lit(i) - gap), F.lit(0.0)).alias(name) for i, name in enumerate(CHANGE_COLUMNS)],
    )


# What is kept of a session's hours: enough for all features, whatever its length.
HOUR_COLUMNS = ["first_hour", "last_hour", "hour_count", "hour_sum", "hour_squares"]


def fold_plays(plays: DataFrame) -> DataFrame:
    """One session per user and day, from one row per play.

    `plays` has user_id, at (time of the play), rid (a unique number, which orders plays of
    one instant), hour and lpi. The session's date is the play's, its rid the smallest,
    its lpi the mean, and its hours are folded into HOUR_COLUMNS. All of it adds up
    before the shuffle, so a day of any number of plays is one small row.
    """
    kind = plays.schema["at"].dataType
    order = order_number(F.col("at"), kind, F.col("rid"))
    # Plays without an hour are no part of the list that this stands for.
    known = F.when(F.col("hour").isNotNull(), order)
    hour = F.col("hour").cast("bigint")
    return plays.groupBy("user_id", F.to_date("at").alias("date")).agg(
        F.min("rid").alias("rid"),
        F.avg("lpi").alias("lpi"),
        F.min_by("hour", known).alias("first_hour"),
        F.max_by("hour", known).alias("last_hour"),
        F.count("hour").alias("hour_count"),
        F.sum(hour).alias("hour_sum"),
        F.sum(hour * hour).alias("hour_squares"),
    )


def _with_hours(df: DataFrame) -> DataFrame:
    """Sessions with HOUR_COLUMNS; lists fold within their row."""
    if "hour" not in df.columns:
        return df
    hours = F.col("_h")
    folded = [
        F.get(hours, F.lit(0)),
        F.get(hours, F.size(hours) - 1),
        F.when(hours.isNotNull(), F.size(hours)),
        list_sum(hours),
        list_square_sum(hours),
    ]
    return df.withColumn("_h", int_list("hour")).withColumns(dict(zip(HOUR_COLUMNS, folded))).drop("_h")


def _hour_moments() -> list[Column]:
    return [
        F.sum("hour_count").alias("_count"),
        F.sum("hour_sum").alias("_sum"),
        F.sum("hour_squares").alias("_squares"),
    ]


def _session_length() -> Column:
    return F.avg(F.abs(F.col("last_hour") - F.col("first_hour"))).alias("length_of_session_avgs")


def _hour_columns() -> list[Column]:
    n, s, q = F.col("_count"), F.col("_sum"), F.col("_squares")
    return [
        (s / n).alias("hour_avg"),
        population_std(n, s, q).alias("hour_std"),
    ]


def session_length(df: DataFrame) -> DataFrame:
    """Mean over sessions of |last hour - first hour|; across midnight that is 23."""
    rows = _with_hours(_known_users(df))
    return rows.groupBy("user_id").agg(_session_length())


def hour_stats(df: DataFrame) -> DataFrame:
    """Mean and population deviation of every hour a user played.

    Lists fold into integer moments within their row: no row is multiplied.
    """
    rows = _with_hours(_known_users(df))
    return rows.groupBy("user_id").agg(*_hour_moments()).select("user_id", *_hour_columns())


def games_in_order(df: DataFrame, max_rows: int = MAX_SLICE_ROWS) -> DataFrame:
    """user_id, pos, gameId: the game lists of a user's sessions, numbered in play order."""
    rows = user_sequence(df.select("user_id", "date", "rid", "gameId"), max_rows=max_rows)
    return rows.select("user_id", "pos", "gameId")


def games_string(df: DataFrame, max_sessions: int, max_rows: int = MAX_SLICE_ROWS) -> DataFrame:
    """`games_in_order` as comma strings of `max_sessions` sessions each.

    Segment s holds sessions s*max_sessions+1 and on, so a cell stays bounded;
    a user with up to `max_sessions` sessions has one row with the whole text,
    and joining a user's segments by comma gives it for the others.
    """
    rows = games_in_order(df, max_rows)
    segment = F.floor((F.col("pos") - 1) / max_sessions).alias("segment")
    joined = F.expr("listagg(gameId, ',') WITHIN GROUP (ORDER BY pos)")
    return rows.groupBy("user_id", segment).agg(joined.alias("games"))


def session_features(df: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """All session features of users with at least one recorded lpi."""
    base = (
        _with_hours(_known_users(df))
        .groupBy("user_id")
        .agg(_first_lpi(df), _session_length(), *_hour_moments())
        .where(F.col("first_recorded_lpi").isNotNull())
    )
    # Both sides are grouped by user_id: the join needs no further shuffle.
    joined = base.join(last_five_changes(df, config.align), "user_id")
    return joined.select(
        "user_id", "first_recorded_lpi", *CHANGE_COLUMNS, "length_of_session_avgs", *_hour_columns()
    )
