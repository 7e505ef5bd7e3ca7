"""Ordered per-key sequences that do not put one key on one task.

A plain ``Window.partitionBy(user)`` sends all rows of a user to one task. Here
the rows of a heavy key are cut into consecutive slices of bounded size, the
window runs inside a slice, and what a slice needs from the one before it (its
last row and the number of rows so far) comes from a table with one row per
slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.storage import materialize

MAX_SLICE_ROWS = 1_000_000


def heavy_keys(df: DataFrame, key: Sequence[str], max_rows: int) -> DataFrame:
    """Keys with more than `max_rows` rows: at most rows/max_rows of them.

    Their number follows the data, so how to join them is left to Spark.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > max_rows).select(*key)


def _cuts(df: DataFrame, group: Sequence[str], axis: Column, max_rows: int) -> DataFrame:
    """For groups above `max_rows`, the start and width of equal ranges of `axis`."""
    sizes = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"), F.min(axis).alias("_lo"), F.max(axis).alias("_hi")
    )
    width = (F.col("_hi") - F.col("_lo")).cast("double") / F.ceil(F.col("_n") / F.lit(max_rows))
    return sizes.where(F.col("_n") > max_rows).select(*group, "_lo", width.alias("_width"))


def _with_slice(df: DataFrame, cuts: DataFrame, group: Sequence[str], axis: Column) -> DataFrame:
    position = F.floor(F.try_divide((axis - F.col("_lo")).cast("double"), F.col("_width")))
    return (
        df.join(cuts, list(group), "left")
        .withColumn("_slice", F.coalesce(position, F.lit(0).cast("bigint")))
        .drop("_lo", "_width")
    )


def sequence(
    df: DataFrame,
    key: Sequence[str],
    block: Column,
    order: Sequence[str],
    axis: Column,
    carry: Sequence[str] = (),
    max_rows: int = MAX_SLICE_ROWS,
) -> DataFrame:
    """Add each row's 1-based ``pos`` in its key, and ``prev_<c>`` per carried column.

    `block` is the leading, non-null part of the order (a day); `order` orders
    rows completely; `axis` is a number that never decreases along `order`.

    Keys of up to `max_rows` rows are one window group. Those above are cut at
    block borders, and blocks still too large along `axis`. The slice table
    covers the heavy keys only, with one row per block or slice of them.

    Heavy keys are found first, in a pass over the key columns. Where there are none, a plain
    window gives the same, with one shuffle of the rows.
    """
    heavy = materialize(heavy_keys(df, key, max_rows).withColumn("_heavy", F.lit(True)), "heavy-keys")
    if heavy.isEmpty():
        whole = W.partitionBy(*key).orderBy(*order)
        return df.select(
            *df.columns,
            F.row_number().over(whole).cast("bigint").alias("pos"),
            *[F.lag(c).over(whole).alias(f"prev_{c}") for c in carry],
        )
    group = [*key, "_block"]
    parts = [*group, "_slice"]
    marked = df.join(heavy, list(key), "left").withColumn("_block", F.when(F.col("_heavy"), block))
    in_heavy = F.col("_block").isNotNull()
    rows = _with_slice(marked, _cuts(marked.where(in_heavy), group, axis, max_rows), group, axis)

    inside = W.partitionBy(*parts).orderBy(*order)
    numbered = rows.select(
        "*",
        F.row_number().over(inside).alias("_rn"),
        *[F.lag(c).over(inside).alias(f"_lag_{c}") for c in carry],
    )

    last = F.struct(*order)
    across = W.partitionBy(*key).orderBy("_block", "_slice")
    before = across.rowsBetween(W.unboundedPreceding, -1)
    edges = (
        rows.where(in_heavy)
        .groupBy(*parts)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.max_by(c, last).alias(f"_last_{c}") for c in carry],
        )
        .select(
            *parts,
            F.sum("_n").over(before).alias("_before"),
            *[F.lag(f"_last_{c}").over(across).alias(f"_edge_{c}") for c in carry],
        )
    )
    # Light keys have no block and match no edge: their window is already whole.
    starts_slice = F.col("_rn") == 1
    return numbered.join(edges, parts, "left").select(
        *df.columns,
        (F.coalesce("_before", F.lit(0)) + F.col("_rn")).alias("pos"),
        *[
            F.when(starts_slice, F.col(f"_edge_{c}")).otherwise(F.col(f"_lag_{c}")).alias(f"prev_{c}")
            for c in carry
        ],
    )


def order_number(date: Column, kind: T.DataType, rid: Column) -> Column:
    """One number that orders rows as (date, rid) do, time of day included.

    The time in microseconds takes the leading digits and the row number, which is
    within 62 bits, the others. Differences of such numbers are exact, so rows of one
    instant are told apart too. Undated rows come first.
    """
    if isinstance(kind, T.TimestampType):
        micros = F.unix_micros(date)
    else:
        # Clock times without a zone must not pass through one that skips hours.
        clock = F.lit(0)
        if isinstance(kind, T.TimestampNTZType):
            clock = (F.hour(date) * 3600 + F.minute(date) * 60 + F.extract(F.lit("SECOND"), date)) * 1_000_000
        micros = F.unix_date(F.to_date(date)).cast("long") * 86_400_000_000 + clock.cast("long")
    leading = F.coalesce(micros, F.lit(-(1 << 56))).cast("decimal(18,0)")
    return leading * F.lit(1 << 62).cast("decimal(19,0)") + rid.cast("decimal(19,0)")


def user_sequence(
    df: DataFrame, carry: Sequence[str] = (), max_rows: int = MAX_SLICE_ROWS
) -> DataFrame:
    """`sequence` of a user's rows in (date, rid) order, undated rows first."""
    undated = F.to_date(F.lit("0001-01-01"))
    return sequence(
        df.where(F.col("user_id").isNotNull()),
        key=["user_id"],
        block=F.coalesce(F.to_date("date"), undated),
        order=["date", "rid"],
        axis=order_number(F.col("date"), df.schema["date"].dataType, F.col("rid")),
        carry=carry,
        max_rows=max_rows,
    )
