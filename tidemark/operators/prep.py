"""Filters, duplicate removal, demographics and user buckets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import digest_number, one_hot, salted_digest

# Ages outside these open bounds are not believed.
MIN_AGE, MAX_AGE = 4, 117


def gender_flag(df: DataFrame) -> DataFrame:
    """Add ``is_male``: 1 for 'm', 0 for anything else including NULL."""
    return df.select("*", *one_hot("gender", ["m"], {"m": "is_male"}))


def believable_age(df: DataFrame) -> DataFrame:
    """Keep 4 < age < 117; unknown ages go."""
    return df.where((F.col("age") > MIN_AGE) & (F.col("age") < MAX_AGE))


def demographic_features(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """user_id, age, is_male, and further input columns if named in `extra`."""
    kept = believable_age(df.where(F.col("user_id").isNotNull()))
    return gender_flag(kept).select("user_id", "age", "is_male", *extra)


def without_future_weeks(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Keep rows up to the ISO week of `as_of`."""
    return df.where(F.col("weekOfYear") <= F.weekofyear(F.lit(as_of)))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Remove exact copies; copies combine before the shuffle."""
    return df.dropDuplicates()


def first_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first `n` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def user_bucket(df: DataFrame, buckets: int, seed: int = 0) -> DataFrame:
    """Add ``bucket`` in 0..buckets-1; all rows of a user get the same one."""
    number = digest_number(salted_digest("user_id", seed))
    return df.withColumn("bucket", F.pmod(number, F.lit(buckets)).cast("int"))


def partition_by_user(df: DataFrame, partitions: int) -> DataFrame:
    """Place whole users in partitions, for per-partition consumers such as file sinks.

    The operators of this package do not need it: they split heavy users.
    """
    return df.repartition(partitions, "user_id")


def bucket_sizes(df: DataFrame, buckets: int, seed: int = 0) -> DataFrame:
    """Rows and users per bucket."""
    per_user = user_bucket(df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), buckets, seed)
    return per_user.groupBy("bucket").agg(F.sum("n").alias("n_rows"), F.count("user_id").alias("n_users"))
