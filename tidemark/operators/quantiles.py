"""Exact medians without sorting or collecting a whole column.

Global medians take two scans. The first makes a quantile sketch of each column, which brackets the
two middle ranks; the second counts what lies below the bracket and writes the distinct
values inside it, about a hundredth of the column, with their counts. Only these are put in order, in
ranges if they are many. Should a rank lie outside its bracket, it is widened and the second scan repeated.

Medians by group narrow buckets instead, with no state that grows with the number of
groups: each pass counts values per bucket (combined before the shuffle), finds the
bucket holding the wanted rank and narrows to it: first by magnitude, then by
equal ranges inside that magnitude, three times over. The last pass orders only the distinct
values left in one small bucket. 32-bit integers need no ranges.

The input is read once per pass; materialize a table that is costly to compute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ranges import totals_before
from tidemark.storage import materialize

_STEPS_PER_OCTAVE = 16
_RANGES = 65_536
_ROUNDS = 3
_SALTS = 64

# Up to this many groups the targets (two rows per group and column) are broadcast.
BROADCAST_GROUPS = 50_000


# Size of a column's sketch, whose ranks are then off by 0.0013 at most, 99 times of 100.
_SKETCH = 4096
# Half widths of the bracket around the middle, tried in turn; the last one holds everything.
_MARGINS = (0.005, 0.05, 0.5)
# Up to this many distinct values inside the brackets are ordered by one task.
_ONE_TASK = 1_000_000


def _valid(column: str) -> Column:
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def _sketch(df: DataFrame, columns: Sequence[str]) -> Row:
    """For each column the count of values, and their quantiles at the margins: the first scan."""
    ranks = F.array(*[F.lit(0.5 + sign * m) for sign in (-1, 1) for m in _MARGINS])
    aggregates = []
    for i, c in enumerate(columns):
        sketch = F.call_function("kll_sketch_agg_double", _valid(c), F.lit(_SKETCH))
        aggregates += [
            F.count(_valid(c)).alias(f"n{i}"),
            F.when(F.count(_valid(c)) > 0, F.call_function("kll_sketch_get_quantile_double", sketch, ranks)).alias(f"q{i}"),
        ]
    return df.agg(*aggregates).first()


def _inside_brackets(df: DataFrame, brackets: dict[str, tuple[float, float]]) -> DataFrame:
    """(name, v, n): counts of the values in each column's bracket, and with v NULL of those below: the second scan."""
    bounds = [
        F.struct(F.lit(c).alias("name"), _valid(c).alias("v"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
        for c, (lo, hi) in brackets.items()
    ]
    inside = df.select(F.explode(F.array(*bounds)).alias("p")).select("p.*").where(F.col("v") <= F.col("hi"))
    value = F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("v")
    return materialize(inside.groupBy("name", value).agg(F.count(F.lit(1)).alias("n")), "bracket")


def _global_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The interpolated median of each column; None where it has no value."""
    seen = _sketch(df, columns)
    medians: dict[str, float | None] = dict.fromkeys(columns)
    sizes = {c: seen[f"n{i}"] for i, c in enumerate(columns)}
    wanted = {c: ((n - 1) // 2, n // 2) for c, n in sizes.items() if n}
    for at in range(len(_MARGINS)):
        if not wanted:
            break
        brackets = {c: (seen[f"q{i}"][at], seen[f"q{i}"][len(_MARGINS) + at]) for i, c in enumerate(columns) if c in wanted}
        counts = _inside_brackets(df, brackets)
        order = [F.col("v").asc_nulls_first()]
        if counts.count() <= _ONE_TASK:
            before = F.sum("n").over(W.partitionBy("name").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
            ranked = counts.withColumn("before", F.coalesce(before, F.lit(0)))
        else:
            ranked = totals_before(counts, ["v"], {"before": "n"}, group=["name"])
        ends = []
        for c, ranks in wanted.items():
            here = F.col("v").isNotNull() & (F.col("name") == c)
            holds = [here & (F.col("before") <= r) & (F.col("before") + F.col("n") > r) for r in ranks]
            ends += [F.max(F.when(h, F.col("v"))) for h in holds]
        middle = ranked.agg(*[e.alias(f"e{i}") for i, e in enumerate(ends)]).first()
        for i, c in enumerate(list(wanted)):
            low, high = middle[2 * i], middle[2 * i + 1]
            if low is not None and high is not None:
                medians[c] = (low + high) / 2
                del wanted[c]
    return medians


def _magnitude(v: Column) -> Column:
    """Non-decreasing integer function of a double, at most about 70,000 values."""
    steps = F.floor(F.log2(F.abs(v)) * _STEPS_PER_OCTAVE)
    bounded = F.least(F.greatest(steps, F.lit(-20_000)), F.lit(20_000)) + 40_000
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("bigint") * bounded)


def _count(rows: DataFrame, key: Sequence[str], bucket: str) -> DataFrame:
    return rows.groupBy(*key, bucket).agg(
        F.sum("_c").alias("_n"), F.min("v").alias("_lo"), F.max("v").alias("_hi")
    )


def _pick(counts: DataFrame, key: Sequence[str], bucket: str) -> DataFrame:
    """Bounds of the bucket whose running total covers ``_rank``, and the rank inside it."""
    running = F.sum("_n").over(W.partitionBy(*key).orderBy(bucket).rowsBetween(W.unboundedPreceding, 0))
    return (
        counts.withColumn("_cum", running)
        .where((F.col("_rank") < F.col("_cum")) & (F.col("_rank") >= F.col("_cum") - F.col("_n")))
        .select(*key, (F.col("_rank") - (F.col("_cum") - F.col("_n"))).alias("_rank"), "_lo", "_hi")
    )


def _inside(values: DataFrame, target: DataFrame, key: Sequence[str], small: bool) -> DataFrame:
    """Values between the target bounds of their key.

    Too many targets for a broadcast are joined by key and a salt of the
    value, so that one group's values spread over tasks.
    """
    join_key = list(key)
    if small:
        target = F.broadcast(target)
    else:
        values = values.withColumn("_salt", F.pmod(F.xxhash64("v"), F.lit(_SALTS)))
        salts = F.sequence(F.lit(0).cast("bigint"), F.lit(_SALTS - 1).cast("bigint"))
        target = target.withColumn("_salt", F.explode(salts))
        join_key.append("_salt")
    return values.join(target, join_key).where(F.col("v").between(F.col("_lo"), F.col("_hi")))


def exact_medians(
    df: DataFrame, columns: Sequence[str], by: str | None = None, broadcast_groups: int = BROADCAST_GROUPS
) -> DataFrame:
    """One row (per `by` value) with the interpolated median of each column.

    NULL and NaN do not count. Windows run over at most 70,000 magnitude or
    65,536 range buckets, and at the end over the distinct values of one range. A
    magnitude holds at most 2^48 different doubles and each of the rounds of ranges
    divides by 65,536, so few are left however closely the values lie. With `by`, the
    number of groups is counted first; without, the medians are found at once.
    """
    if by is None:
        schema = T.StructType([T.StructField(c, T.DoubleType()) for c in columns])
        return df.sparkSession.createDataFrame([tuple(_global_medians(df, columns).values())], schema)
    group = [by]
    key = [*group, "name"]
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns]
    )
    values = (
        df.select(*group, F.explode(pairs).alias("p"))
        .select(*group, "p.name", F.col("p.v").alias("v"), F.lit(1).cast("bigint").alias("_c"))
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
    )
    small = few_groups(df, by, broadcast_groups)
    if not small:
        # Copies of a value become one row, so the salt can spread any group.
        values = values.groupBy(*key, "v").agg(F.sum("_c").alias("_c"))

    whole = (T.IntegerType, T.ShortType, T.ByteType)
    integers = all(isinstance(df.schema[c].dataType, whole) for c in columns)
    # 32-bit integers: at most 65,536 buckets of 65,536 values.
    bucket = F.floor(F.col("v") / _RANGES) if integers else _magnitude(F.col("v"))
    first = _count(values.withColumn("_b", bucket), key, "_b")
    total = F.sum("_n").over(W.partitionBy(*key))
    # Two ranks around the middle; equal for an odd count.
    ranks = F.array(
        F.struct(F.lit(0).alias("_side"), F.floor((F.col("_total") - 1) / 2).alias("_rank")),
        F.struct(F.lit(1).alias("_side"), F.floor(F.col("_total") / 2).alias("_rank")),
    )
    sided = [*key, "_side"]
    first = first.withColumn("_total", total).select("*", F.inline(ranks))
    target = _pick(first, sided, "_b")

    share = F.try_divide(F.col("v") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    ranged = F.coalesce(F.floor(share * _RANGES), F.lit(0).cast("bigint"))
    for _ in range(0 if integers else _ROUNDS):
        narrower = _count(_inside(values, target, key, small).withColumn("_b", ranged), [*sided, "_rank"], "_b")
        target = _pick(narrower, sided, "_b")

    last = _count(_inside(values, target, key, small).withColumn("_b", F.col("v")), [*sided, "_rank"], "_b")
    middle = _pick(last, sided, "_b")
    return middle.groupBy(*group).agg(
        *[F.avg(F.when(F.col("name") == c, F.col("_lo"))).alias(c) for c in columns]
    )


def few_groups(df: DataFrame, by: str, limit: int) -> bool:
    return df.select(by).distinct().limit(limit + 1).count() <= limit


def impute_median(
    df: DataFrame, columns: Sequence[str], by: str | None = None, broadcast_groups: int = BROADCAST_GROUPS
) -> DataFrame:
    """Fill NULLs and NaNs with the exact median, global or per `by` value; results are doubles."""
    if by is None:
        found = _global_medians(df, columns)
        return df.withColumns({c: F.coalesce(_valid(c), F.lit(m).cast("double")) for c, m in found.items()}).select(*df.columns)
    renamed = {c: f"_median_{c}" for c in columns}
    medians = exact_medians(df, columns, by, broadcast_groups).withColumnsRenamed(renamed)
    if few_groups(df, by, broadcast_groups):
        joined = df.join(F.broadcast(medians), by, "left")
    else:
        joined = df.join(medians, by, "left")
    filled = {c: F.coalesce(_valid(c), F.col(f"_median_{c}")) for c in columns}
    return joined.withColumns(filled).select(*df.columns)
