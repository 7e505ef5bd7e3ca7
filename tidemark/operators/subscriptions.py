"""Inactivity gaps and churn labels from dated activity rows.

Input columns: user_id, date, rid (unique tie-break), and for the features
state, workout_day, gameplay_day. A user's rows are ordered by (date, rid).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.config import JobConfig
from tidemark.functions.columns import one_hot
from tidemark.operators.ordering import MAX_SLICE_ROWS, user_sequence
from tidemark.operators.quantiles import impute_median
from tidemark.storage import materialize

STATES = ("subs", "free", "trial")


def state_flags(df: DataFrame, states: Sequence[str] = STATES) -> DataFrame:
    """One 0/1 column per state, ``is_<state>``; 'subs' is ``is_subs_acct``."""
    names = {s: "is_subs_acct" if s == "subs" else f"is_{s}" for s in states}
    return df.select("*", *one_hot("state", states, names))


def day_gap(df: DataFrame, max_rows: int = MAX_SLICE_ROWS) -> DataFrame:
    """Add ``day_gap``: calendar days since the user's previous row, NULL on the first."""
    columns = df.columns
    rows = user_sequence(df, carry=["date"], max_rows=max_rows)
    gap = F.datediff(F.to_date("date"), F.to_date("prev_date"))
    return rows.select(*columns, gap.alias("day_gap"))


def churn_flag(df: DataFrame, threshold: int) -> DataFrame:
    """Add ``churned``: 1 where day_gap exceeds the threshold, else 0 (also for NULL)."""
    return df.withColumn("churned", F.when(F.col("day_gap") > threshold, 1).otherwise(0))


def keep_one_row(df: DataFrame) -> DataFrame:
    """Latest row among a user's rows with the highest ``churned``.

    Spark applies the row limit before the shuffle too, so a user sends at
    most one row per input task.
    """
    w = W.partitionBy("user_id").orderBy(F.desc("churned"), F.desc("date"), F.desc("rid"))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def churn_summary(
    df: DataFrame, threshold: int, payload: Sequence[str] = (), as_written: bool = False
) -> DataFrame:
    """One row per user: the kept row's rid, date, day_gap, churned and `payload`,
    with churn_count and prior_churn_count over all rows.

    Same result as day_gap + churn_flag + keep_one_row, from days instead of
    rows: only a day's first row can have a positive gap, so a day reduces to
    its first and last row before anything is ordered. The ordered part has at
    most one row per user and calendar day.
    """
    if threshold < 0:
        raise ValueError("threshold must be 0 or more days")
    days = (
        df.where(F.col("user_id").isNotNull())
        .withColumn("date", F.to_date("date"))
        .groupBy("user_id", "date")
        .agg(
            F.min("rid").alias("_first_rid"),
            F.max("rid").alias("_last_rid"),
            F.count(F.lit(1)).alias("_rows"),
            *[F.min_by(c, "rid").alias(f"_first_{c}") for c in payload],
            *[F.max_by(c, "rid").alias(f"_last_{c}") for c in payload],
        )
    )
    # A date is unique per user here, so the order is complete.
    w = W.partitionBy("user_id").orderBy("date")
    gap = F.datediff("date", F.lag("date").over(w))
    flagged = days.withColumn("_gap", gap).withColumn("_churned", F.coalesce(F.col("_gap") > threshold, F.lit(False)))
    # Rank of a day: churned days above all others, then by date.
    rank = F.coalesce(F.unix_date("date"), F.lit(-10_000_000)) + F.when(F.col("_churned"), 100_000_000).otherwise(0)
    ranked = flagged.withColumn("_rank", rank)

    def kept(name: str):
        chosen = F.when(F.col("_churned"), F.col(f"_first_{name}")).otherwise(F.col(f"_last_{name}"))
        return F.max_by(chosen, "_rank").alias(name)

    # The day's last row follows its first on the same date: its gap is 0.
    kept_gap = F.when(F.col("_churned") | (F.col("_rows") == 1), F.col("_gap")).otherwise(
        F.when(F.col("date").isNotNull(), 0)
    )
    churns = F.sum(F.col("_churned").cast("bigint"))
    users = ranked.groupBy("user_id").agg(
        kept("rid"),
        F.max_by("date", "_rank").alias("date"),
        F.max_by(kept_gap, "_rank").alias("day_gap"),
        F.max(F.col("_churned").cast("int")).alias("churned"),
        churns.alias("churn_count"),
        *[kept(c) for c in payload],
    )
    prior = F.lit(0).cast("bigint") if as_written else F.col("churn_count") - F.col("churned")
    return users.withColumn("prior_churn_count", prior)


def subscription_features(df: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """user_id, workout_day, gameplay_day, churned, prior_churn_count per user.

    Missing numbers of the kept rows take the global median; then users whose
    kept row has any other NULL are dropped, whichever input column it is in.
    """
    imputed = ["workout_day", "gameplay_day", "day_gap"]
    others = [c for c in df.columns if c not in (*imputed, "user_id", "rid")]
    complete = F.lit(True)
    for c in others:
        complete = complete & F.col(c).isNotNull()
    rows = df.withColumn("_complete", complete)
    payload = ["workout_day", "gameplay_day", "_complete"]
    if config.keep_state_flag:
        rows = rows.select("*", *one_hot("state", ["subs"], {"subs": "is_subs_acct"}))
        payload.append("is_subs_acct")
    kept = churn_summary(rows, config.churn_threshold, payload, config.prior_as_written)
    # Medians take several passes over this one-row-per-user table.
    kept = materialize(kept, "churn-summary")
    filled = impute_median(kept, imputed).where("_complete").na.drop(subset=imputed)
    out = ["user_id", "workout_day", "gameplay_day", "churned", "prior_churn_count"]
    if config.keep_state_flag:
        out.append("is_subs_acct")
    return filled.select(*out)
