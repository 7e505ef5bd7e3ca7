"""The modelling matrix and the users it keeps at each join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LABEL = "churned"


def data_matrix(
    subscriptions: DataFrame, sessions: DataFrame, variety: DataFrame, demographics: DataFrame
) -> DataFrame:
    """Inner join of the four per-user tables; user_id stays as the first column.

    The first three have one row per user by construction. Demographics come as they
    are: a user listed twice there is an error, as matrix rows would multiply.
    """
    return (
        subscriptions.join(sessions, "user_id")
        .join(variety, "user_id")
        .join(once_per_user(demographics), "user_id")
    )


def once_per_user(df: DataFrame) -> DataFrame:
    """`df`, or an error when it is run if a user has more than one row."""
    names = df.columns
    place = F.row_number().over(W.partitionBy("user_id").orderBy("user_id"))
    message = F.concat(F.lit("a user has more than one row: "), F.col("user_id").cast("string"))
    unique = F.when(F.col("_place") == 1, F.col("user_id")).otherwise(
        F.raise_error(message).cast(df.schema["user_id"].dataType)
    )
    return df.withColumn("_place", place).withColumn("user_id", unique).select(*names)


_TABLES = ("subs", "sessions", "variety", "demographics")


def _funnel_counts(users: DataFrame) -> DataFrame:
    """step, side, users from one row per user with a flag for each table."""
    subs, sess, var, demo = (F.col(n) for n in _TABLES)
    stages = [
        (1, "subs", subs),
        (1, "sessions", sess),
        (2, "matrix", subs & sess),
        (2, "variety", var),
        (3, "matrix", subs & sess & var),
        (3, "demographics", demo),
        (4, "matrix", subs & sess & var & demo),
    ]
    counts = users.agg(*[F.count_if(c).alias(f"c{i}") for i, (_, _, c) in enumerate(stages)])
    rows = F.array(
        *[
            F.struct(F.lit(step).alias("step"), F.lit(side).alias("side"), F.col(f"c{i}").alias("users"))
            for i, (step, side, _) in enumerate(stages)
        ]
    )
    return counts.select(F.inline(rows))


def join_funnel(
    subscriptions: DataFrame, sessions: DataFrame, variety: DataFrame, demographics: DataFrame
) -> DataFrame:
    """Distinct users on both sides of each join and in the result.

    One pass: users are tagged with the tables they occur in, so no join is
    repeated to count it. Columns: step, side, users.
    """
    tables = dict(zip(_TABLES, (subscriptions, sessions, variety, demographics)))
    tagged = reduce(
        DataFrame.unionAll,
        [
            t.select("user_id", *[F.lit(n == name).alias(n) for n in tables])
            for name, t in tables.items()
        ],
    )
    users = (
        tagged.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(*[F.max(n).alias(n) for n in tables])
    )
    return _funnel_counts(users)


def user_table(
    subscriptions: DataFrame, sessions: DataFrame, variety: DataFrame, demographics: DataFrame
) -> DataFrame:
    """One row per user of any table: a flag for each table, and all their columns.

    The matrix is the rows with all flags, the funnel counts flags, so both come from one pass
    over the four tables. Counters kept while the joins run would do the same, but count a task twice
    that runs again after an executor is lost. A user listed twice in a table is an error.
    """
    tables = dict(zip(_TABLES, (subscriptions, sessions, variety, demographics)))
    features = [(name, c) for name, t in tables.items() for c in t.columns if c != "user_id"]
    tagged = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            t.where(F.col("user_id").isNotNull()).select(
                "user_id", F.lit(name).alias("_table"), *[F.col(c).alias(f"{name}.{c}") for c in t.columns if c != "user_id"]
            )
            for name, t in tables.items()
        ],
    )
    rows = {n: F.count_if(F.col("_table") == n) for n in tables}
    users = tagged.groupBy("user_id").agg(
        *[n.alias(name) for name, n in rows.items()],
        *[F.max(f"`{name}.{c}`").alias(f"{name}.{c}") for name, c in features],
    )
    message = F.concat(F.lit("a user has more than one row: "), F.col("user_id").cast("string"))
    once = reduce(lambda a, b: a & b, [F.col(n) <= 1 for n in tables])
    checked = F.when(once, F.col("user_id")).otherwise(F.raise_error(message).cast(users.schema["user_id"].dataType))
    return users.withColumn("user_id", checked).withColumns({n: F.col(n) == 1 for n in tables})


def matrix_of_users(users: DataFrame) -> DataFrame:
    """`data_matrix` from the `user_table`."""
    everywhere = reduce(lambda a, b: a & b, [F.col(n) for n in _TABLES])
    features = [c for c in users.columns if "." in c]
    return users.where(everywhere).select("user_id", *[F.col(f"`{c}`").alias(c.partition(".")[2]) for c in features])


def funnel_of_users(users: DataFrame) -> DataFrame:
    """`join_funnel` from the `user_table`."""
    return _funnel_counts(users)


def repeated_users(df: DataFrame) -> DataFrame:
    """Users with more than one row, which would multiply matrix rows."""
    return df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def feature_columns(matrix: DataFrame, label: str = LABEL) -> list[str]:
    return [c for c in matrix.columns if c not in ("user_id", label)]


def assemble(matrix: DataFrame, features: Sequence[str] | None = None, label: str = LABEL) -> DataFrame:
    """user_id, label (double) and the feature vector; a NULL feature is an error."""
    names = list(features) if features else feature_columns(matrix, label)
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error")
    labelled = matrix.withColumn("label", F.col(label).cast("double"))
    return assembler.transform(labelled).select("user_id", "label", "features")
