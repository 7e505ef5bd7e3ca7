"""Row-local column expressions; all stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_list(column: str) -> Column:
    """'7,9,12' -> [7, 9, 12]. A token that is no number fails the query."""
    return F.split(F.col(column), ",").cast("array<int>")


def list_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def list_square_sum(values: Column) -> Column:
    return F.aggregate(
        values, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint") * x
    )


def population_std(count: Column, total: Column, squares: Column) -> Column:
    """Population standard deviation from integer moments.

    The variance numerator is taken in exact decimals, so equal values give
    exactly 0 whatever the number of rows.
    """
    n, s, q = (c.cast("decimal(19,0)") for c in (count, total, squares))
    return F.sqrt((n * q - s * s).cast("double")) / count


def one_hot(column: str, categories: Sequence[str], names: Mapping[str, str] | None = None) -> list[Column]:
    """0/1 columns for a fixed category list; NULL gives 0 everywhere."""
    names = names or {}
    return [
        F.coalesce(F.col(column) == F.lit(c), F.lit(False)).cast("int").alias(names.get(c, c))
        for c in categories
    ]


def salted_digest(column: str, seed: int) -> Column:
    """Hex md5 of the value and a seed; the same in every SQL engine."""
    return F.md5(F.concat_ws("-", F.col(column).cast("string"), F.lit(str(seed))))


def digest_number(digest: Column) -> Column:
    """First 32 bits of a hex digest as a non-negative bigint."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
