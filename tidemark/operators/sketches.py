"""The join funnel from sketches: a small summary per table and day in place of user lists.

A theta sketch holds the smallest hashes of the users it has seen. Sketches of one table add
up over days, and those of different tables intersect, so the funnel of any span of days
comes from the stored sketches alone. It is approximate; `matrix.join_funnel` is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tables in join order.
TABLES = ("subs", "sessions", "variety", "demographics")
#: Binary logarithm of the hashes a sketch holds: 2^14, 128 KB at most.
LG_SIZE = 14


def relative_error(lg_size: int = LG_SIZE, deviations: float = 3.0) -> float:
    """Bound of an estimate's error, as a share of the users in any of the tables it joins.

    A union of sketches errs by 1/sqrt(size) of itself per standard deviation, and an intersection by
    as much of the union of what it intersects. Up to 2^lg_size users sketches are exact.
    """
    return deviations / 2 ** (lg_size / 2)


def daily_sketches(df: DataFrame, table: str, day: str | None = None, lg_size: int = LG_SIZE) -> DataFrame:
    """table, day, sketch: the users of each day; rows without a user do not count.

    Without a day column the whole table is one sketch, with a NULL day, that holds for all days.
    Users are hashed where they are read: a sketch per task and day passes the shuffle.
    """
    if table not in TABLES:
        raise ValueError(f"table must be one of {TABLES}, not {table!r}")
    days = F.col(day).cast("date") if day else F.lit(None).cast("date")
    rows = df.where(F.col("user_id").isNotNull()).select("user_id", days.alias("day"))
    sketch = F.call_function("theta_sketch_agg", F.col("user_id"), F.lit(lg_size))
    return rows.groupBy("day").agg(sketch.alias("sketch")).select(F.lit(table).alias("table"), "day", "sketch")


def sketched_funnel(sketches: DataFrame, first: str | None = None, last: str | None = None, lg_size: int = LG_SIZE) -> DataFrame:
    """step, side, users: `join_funnel` of the days from `first` to `last`, estimated.

    Sketches without a day belong to every span. Tables without a sketch in it have no users.
    """
    within = F.col("day").isNull()
    span = F.lit(True)
    if first:
        span &= F.col("day") >= F.lit(first).cast("date")
    if last:
        span &= F.col("day") <= F.lit(last).cast("date")
    chosen = sketches.where(within | span)
    union = {t: F.call_function("theta_union_agg", F.when(F.col("table") == t, F.col("sketch")), F.lit(lg_size)) for t in TABLES}
    whole = chosen.agg(*[u.alias(t) for t, u in union.items()])

    def both(a, b):
        return F.call_function("theta_intersection", a, b)

    subs, sess, var, demo = (F.col(t) for t in TABLES)
    stages = [
        (1, "subs", [subs]),
        (1, "sessions", [sess]),
        (2, "matrix", [subs, sess]),
        (2, "variety", [var]),
        (3, "matrix", [subs, sess, var]),
        (3, "demographics", [demo]),
        (4, "matrix", [subs, sess, var, demo]),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(step).alias("step"),
                F.lit(side).alias("side"),
                F.coalesce(F.call_function("theta_sketch_estimate", reduce(both, parts)), F.lit(0).cast("bigint")).alias("users"),
            )
            for step, side, parts in stages
        ]
    )
    return whole.select(F.inline(rows))
