"""The four logical input tables and their readers and writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.prep import first_rows
from tidemark.sources.positions import with_positions

_id = T.StructField("user_id", T.LongType())

SCHEMAS: dict[str, T.StructType] = {
    "demographics": T.StructType(
        [
            _id,
            T.StructField("age", T.IntegerType()),
            T.StructField("gender", T.StringType()),
            T.StructField("language", T.StringType()),
        ]
    ),
    "sessions": T.StructType(
        [
            _id,
            T.StructField("date", T.DateType()),
            T.StructField("lpi", T.DoubleType()),
            T.StructField("hour", T.StringType()),
            T.StructField("gameId", T.StringType()),
        ]
    ),
    "variety": T.StructType(
        [
            _id,
            T.StructField("weekOfYear", T.IntegerType()),
            T.StructField("lpi", T.DoubleType()),
            T.StructField("gameVariety", T.DoubleType()),
        ]
    ),
    "subscriptions": T.StructType(
        [
            _id,
            T.StructField("date", T.DateType()),
            T.StructField("state", T.StringType()),
            T.StructField("workout_day", T.IntegerType()),
            T.StructField("gameplay_day", T.IntegerType()),
        ]
    ),
}

# Tables whose operators follow a user's rows in order and so need a tie-break.
ORDERED = ("sessions", "subscriptions")


@dataclass(frozen=True)
class Dataset:
    """Where one logical table lives. `row_id` names its unique row number column.

    Several paths are read one by one and put together by column name.
    """

    path: str | Sequence[str]
    format: str = "csv"
    separator: str = ","
    row_id: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)


def standard_user_key(df: DataFrame) -> DataFrame:
    """userId -> user_id where present."""
    return df.withColumnRenamed("userId", "user_id")


def _typed(field: T.StructField, source: T.DataType) -> Column:
    """Cast by name. Columns that already fit stay bare, so filters on them reach the scan."""
    c, kind = F.col(field.name), field.dataType
    if isinstance(kind, T.DoubleType):
        number = c.cast(kind)
        c = F.when(~F.isnan(number), number)
    elif source == kind:
        return c
    elif isinstance(kind, T.IntegerType) and isinstance(source, T.StringType):
        # Integer columns with gaps are often written as 3.0.
        c = c.cast("double").cast(kind)
    elif isinstance(kind, T.DateType):
        c = F.to_date(c.cast("timestamp_ntz"))
    else:
        c = c.cast(kind)
    return c.alias(field.name)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast to the table's schema by column name; extra columns stay, missing ones fail."""
    df = standard_user_key(df)
    schema = SCHEMAS[table]
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"table {table!r} lacks columns {missing}")
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*[_typed(f, df.schema[f.name].dataType) for f in schema], *extra)


def with_row_id(df: DataFrame, row_id: str | None) -> DataFrame:
    """Make the row number column ``rid``, of `row_id` or else generated.

    Generated numbers follow the row order of one read; tables read from files get stable
    ones in `read_table`.
    """
    if row_id is None:
        return df if "rid" in df.columns else df.withColumn("rid", F.monotonically_increasing_id())
    return df.withColumn("rid", F.col(row_id).cast("bigint")).drop(*([row_id] if row_id != "rid" else []))


def _raw(spark: SparkSession, dataset: Dataset, path: str) -> DataFrame:
    reader = spark.read.options(**dataset.options)
    if dataset.format == "csv":
        # Names are compared with each file's header, not with the first one's alone.
        text = reader.option("header", True).option("enforceSchema", False).option("sep", dataset.separator).csv(path)
        return text.select(*[F.nullif(F.col(f"`{c}`"), F.lit(MISSING)).alias(c) for c in text.columns])
    return reader.format(dataset.format).load(path)


def read_table(
    spark: SparkSession, table: str, dataset: Dataset, row_limit: int | None = None
) -> DataFrame:
    """Read a dataset as a logical table.

    Text files are read as strings with a header and cast by name, so column
    order does not matter and a list column of single numbers stays text. All files
    of one path share one header; a file with another one is an error. Ordered tables
    without a row number column, or one called ``rid``, are numbered by file name and place in the file.
    """
    paths = [dataset.path] if isinstance(dataset.path, str) else list(dataset.path)
    parts = [conform(_raw(spark, dataset, path), table) for path in paths]
    if table in ORDERED and dataset.row_id is None and not any("rid" in part.columns for part in parts):
        df = with_positions(parts)
    else:
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if table in ORDERED:
            df = with_row_id(df, dataset.row_id)
    if row_limit:
        order = ["user_id", "date", "rid"] if table in ORDERED else SCHEMAS[table].fieldNames()
        df = first_rows(df, order, row_limit)
    return df


def load(
    spark: SparkSession, registry: Mapping[str, Dataset], table: str, row_limit: int | None = None
) -> DataFrame:
    """`read_table` of a registered dataset."""
    if table not in registry:
        raise KeyError(f"no dataset for {table!r}; registered: {sorted(registry)}")
    return read_table(spark, table, registry[table], row_limit)


# A missing value in text files; a text of just these two characters cannot be told from it.
MISSING = "\\N"
# Blanks, empty texts, quotes and line breaks come back as they were written.
_TSV = {
    "header": True, "sep": "\t", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "nullValue": MISSING, "escape": '"', "lineSep": "\n",
}


def write_table(df: DataFrame, path: str, format: str = "tsv") -> str:
    """Overwrite `path` with the table, as tab-separated text with header or as parquet."""
    writer = df.write.mode("overwrite")
    if format == "tsv":
        writer.options(**_TSV, emptyValue='""').csv(path)
    elif format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"format must be 'tsv' or 'parquet', not {format!r}")
    return path


def read_back(spark: SparkSession, path: str, schema: T.StructType, format: str = "tsv") -> DataFrame:
    """Read what `write_table` wrote."""
    reader = spark.read.schema(schema)
    if format == "tsv":
        return reader.options(**_TSV, emptyValue="", multiLine=True).csv(path)
    return reader.parquet(path)
