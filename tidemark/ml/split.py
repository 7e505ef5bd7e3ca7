"""Train/test splits and folds that depend on user ids alone, not on row order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.columns import digest_number, salted_digest

_HASH_RANGE = 2**32


def label_rank(df: DataFrame, label: str, seed: int = 42, user: str = "user_id") -> DataFrame:
    """Add ``label_rank`` (1-based, in seeded hash order within the label) and ``label_rows``.

    A window over a label would put half of all users on one task. The rank is
    taken within 65,536 hash prefixes per label, plus the rows of the prefixes
    before; that offset table has at most 65,536 rows per label.
    """
    columns = df.columns
    digest = df.withColumn("_digest", salted_digest(user, seed)).withColumn("_prefix", F.substring("_digest", 1, 4))
    part = [label, "_prefix"]
    whole = W.partitionBy(label)
    before = whole.orderBy("_prefix").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        digest.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *part,
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
            F.sum("_n").over(whole).alias("label_rows"),
        )
    )
    inside = W.partitionBy(*part).orderBy("_digest", user)
    ranked = digest.withColumn("_rn", F.row_number().over(inside)).join(offsets, part)
    return ranked.select(*columns, (F.col("_before") + F.col("_rn")).alias("label_rank"), "label_rows")


def stratified_split(
    df: DataFrame, label: str, test_share: float = 0.2, seed: int = 42, user: str = "user_id"
) -> DataFrame:
    """Add ``label_rank`` and ``is_test``: exactly round(share * n) test users of each label."""
    ranked = label_rank(df, label, seed, user)
    size = F.round(F.col("label_rows") * F.lit(float(test_share)))
    return ranked.withColumn("is_test", F.col("label_rank") <= size).drop("label_rows")


def hash_split(df: DataFrame, test_share: float = 0.2, seed: int = 42, user: str = "user_id") -> DataFrame:
    """Add ``is_test`` from the user's hash alone: no shuffle, shares only approximate."""
    number = digest_number(salted_digest(user, seed))
    return df.withColumn("is_test", number < F.lit(test_share * _HASH_RANGE))


def stratified_folds(
    df: DataFrame, label: str, folds: int = 3, seed: int = 42, user: str = "user_id"
) -> DataFrame:
    """Add ``fold`` in 0..folds-1; each label's fold sizes differ by at most one."""
    ranked = label_rank(df, label, seed, user)
    return ranked.withColumn("fold", ((F.col("label_rank") - 1) % folds).cast("int")).drop("label_rank", "label_rows")
