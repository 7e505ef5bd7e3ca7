"""How a user's play divides over games.

Input: user_id and gameId (comma list), or user_id and game_id with one row per play.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.functions.columns import int_list
from tidemark.operators.ranges import totals_before
from tidemark.storage import fresh_path, materialize


def single_plays(df: DataFrame) -> DataFrame:
    """user_id, game_id: one row per play of a known user."""
    game = F.col("game_id") if "game_id" in df.columns else F.explode(int_list("gameId")).alias("game_id")
    return df.where(F.col("user_id").isNotNull()).select("user_id", game)


def game_counts(df: DataFrame) -> DataFrame:
    """user_id, game_id, plays."""
    return single_plays(df).groupBy("user_id", "game_id").agg(F.count(F.lit(1)).alias("plays"))


def game_totals(df: DataFrame) -> DataFrame:
    """user_id, total_plays; list lengths are added up without exploding."""
    if "game_id" in df.columns:
        return single_plays(df).groupBy("user_id").agg(F.count(F.lit(1)).alias("total_plays"))
    rows = df.where(F.col("user_id").isNotNull() & F.col("gameId").isNotNull())
    return rows.groupBy("user_id").agg(F.sum(F.size(int_list("gameId"))).alias("total_plays"))


def game_proportions(df: DataFrame) -> DataFrame:
    """user_id, game_id, plays, total_plays, proportion.

    The totals come from the counts; the shuffle of the counts serves both
    sides, and a join can split a heavy user where a window could not.
    """
    counts = game_counts(df)
    totals = counts.groupBy("user_id").agg(F.sum("plays").alias("total_plays"))
    return counts.join(totals, "user_id").withColumn("proportion", F.col("plays") / F.col("total_plays"))


def games_played(df: DataFrame) -> list[int]:
    """All games of the table, in order: the columns a matrix of it has."""
    played = single_plays(df).select("game_id").distinct()
    return sorted(r["game_id"] for r in played.where("game_id is not null").collect())


def game_matrix(
    df: DataFrame,
    games: Sequence[int] | None = None,
    values: Sequence[str] = ("proportion",),
    unlisted: str = "error",
) -> DataFrame:
    """One row per user, one column per game and value, 0 where not played.

    `games` is the column list. By default it is all games of the table, found in a
    pass of its own. With a given list a play of another game is an error, as its share
    would be lost, unless `unlisted` is "drop". Columns are ``<value>_<game>``, or ``game_<game>`` for the proportion
    alone.
    """
    only_proportion = list(values) == ["proportion"]
    aggregates = [F.sum(v).alias(v) for v in values]
    shares = game_proportions(df)
    if games is None:
        games = games_played(df)
    elif unlisted == "error":
        message = F.concat(F.lit("a game is not listed: "), F.col("game_id").cast("string"))
        listed = F.when(F.col("game_id").isin(list(games)), F.col("game_id")).otherwise(F.raise_error(message).cast("int"))
        shares = shares.withColumn("game_id", listed)
    wide = shares.groupBy("user_id").pivot("game_id", list(games)).agg(*aggregates)
    if only_proportion:
        names = {str(g): f"game_{g}" for g in games}
    else:
        spark_name = "{g}" if len(values) == 1 else "{g}_{v}"
        names = {spark_name.format(g=g, v=v): f"{v}_{g}" for g in games for v in values}
    return wide.withColumnsRenamed(names).na.fill(0)


def game_vectors(df: DataFrame) -> DataFrame:
    """One sparse row per user: a map game_id -> proportion.

    For catalogues too large for columns. A user's map has at most one entry
    per game of the catalogue.
    """
    entries = F.array_sort(F.collect_list(F.struct("game_id", "proportion")))
    return game_proportions(df).groupBy("user_id").agg(F.map_from_entries(entries).alias("proportions"))


def game_index(df: DataFrame) -> DataFrame:
    """game_id, index: the games of the table numbered from 0 in order, without gaps.

    The catalogue may be of any size: games are numbered within ranges of it, plus the number
    of games in the ranges before.
    """
    games = single_plays(df).select("game_id").where("game_id is not null").distinct()
    numbered = totals_before(games.withColumn("one", F.lit(1).cast("bigint")), ["game_id"], {"index": "one"})
    return materialize(numbered.select("game_id", F.col("index").cast("int")), "game-index")


def sparse_vectors(df: DataFrame, index: DataFrame) -> DataFrame:
    """user_id, features: a user's proportions as a sparse ML vector over the `game_index`.

    For catalogues past the limit of a pivot. All vectors have the size of the index; plays of
    games outside of it are an error. Written: vectors are a stored type, which the files carry
    without a Python function. A user's vector has an entry per game of theirs.
    """
    size = index.agg((F.coalesce(F.max("index"), F.lit(-1)) + 1).alias("size"))
    message = F.concat(F.lit("a game is not in the index: "), F.col("game_id").cast("string"))
    known = F.coalesce("index", F.raise_error(message).cast("int"))
    entries = game_proportions(df).join(index, "game_id", "left").select("user_id", known.alias("index"), "proportion")
    listed = entries.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("index", "proportion"))).alias("entries"))
    # One row: the size of the index.
    vectors = listed.crossJoin(F.broadcast(size)).select(
        "user_id",
        F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.col("size"),
            F.col("entries.index").alias("indices"),
            F.col("entries.proportion").alias("values"),
        ).alias("features"),
    )
    path = fresh_path(df.sparkSession, "game-vectors")
    vectors.write.parquet(path)
    schema = StructType([vectors.schema["user_id"], StructField("features", VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)


def vector_entries(vectors: DataFrame) -> DataFrame:
    """user_id, size, indices and values of sparse vectors, for those who need no ML type."""
    parts = F.unwrap_udt("features")
    return vectors.select("user_id", parts["size"].alias("size"), parts["indices"].alias("indices"), parts["values"].alias("values"))
