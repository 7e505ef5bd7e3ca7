"""Running totals over a whole table's order, without one task that sees all of it.

Rows are dealt to ranges of the order. A window runs inside each range, and what a
range needs from those before it is one number, from a table with a row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.storage import materialize

_RANGE = "_range"


def in_ranges(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """`df` written in ranges of `order`, with the number of each row's range in ``_range``.

    Ranges are found from a sample; rows that are equal in `order` share a range, so `order`
    should tell rows apart. Written, because the numbers must not change between passes.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).withColumn(_RANGE, F.spark_partition_id())
    return materialize(dealt, "ranges")


def totals_before(
    df: DataFrame, order: Sequence[str], values: dict[str, str], group: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Add, for each `values` item (new column: summed column), the sum over earlier rows of the group.

    Rows come in the order `group` + `order`, which must tell them apart. Sums are those of the
    rows before, so the first row has 0. Only a row per range and group meets in one window.
    """
    columns = df.columns
    ranged = in_ranges(df, [*group, *order], partitions)
    sums = ranged.groupBy(*group, _RANGE).agg(*[F.sum(v).alias(f"_sum_{c}") for c, v in values.items()])
    earlier = W.partitionBy(*group).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        *group, _RANGE, *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_offset_{c}") for c in values]
    )
    inside = W.partitionBy(_RANGE, *group).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    own = ranged.withColumns({f"_own_{c}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for c, v in values.items()})
    joined = own.join(offsets, [*group, _RANGE])
    return joined.select(*columns, *[(F.col(f"_own_{c}") + F.col(f"_offset_{c}")).alias(c) for c in values])
