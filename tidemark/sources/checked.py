"""Reading a table with bad rows: good rows and rejected ones, in one pass over the files.

`read_table` stops at the first value that does not fit. Here such rows are set aside with the
reasons, and the good ones are those that `read_table` would give for files without them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.positions import with_positions
from tidemark.sources.tables import MISSING, ORDERED, SCHEMAS, Dataset
from tidemark.storage import materialize

_CORRUPT, _REASONS, _RAW, _AT = "_corrupt_line", "_reasons", "_raw", "_at"
#: Columns whose absence makes a row useless, and columns that list whole numbers.
REQUIRED = {"demographics": ("user_id",), "variety": ("user_id",)} | dict.fromkeys(ORDERED, ("user_id", "date"))
LISTS = {"sessions": ("hour", "gameId")}


@dataclass(frozen=True)
class Checked:
    """The two parts of a table. `rejected` has at (the row's position), reasons and raw (the row as text)."""

    good: DataFrame
    rejected: DataFrame


def _text_rows(spark: SparkSession, dataset: Dataset, path: str) -> DataFrame:
    """All columns as the files have them, with lines of too few or too many fields in a column of their own."""
    if dataset.format != "csv":
        return spark.read.options(**dataset.options).format(dataset.format).load(path).withColumn(_CORRUPT, F.lit(None).cast("string"))
    reader = spark.read.options(**dataset.options).option("header", True).option("sep", dataset.separator)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    lines = reader.schema(schema).option("enforceSchema", False).option("mode", "PERMISSIVE")
    lines = lines.option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
    return lines.select(*[F.nullif(F.col(f"`{n}`"), F.lit(MISSING)).alias(n) for n in names], _CORRUPT)


def _parsed(name: str, kind: T.DataType) -> tuple[Column, str]:
    """A column's value, NULL where it does not fit, and what it should be."""
    c = F.col(name)
    if isinstance(kind, T.DoubleType):
        number = c.try_cast("double")
        return F.when(~F.isnan(number), number), "number"
    if isinstance(kind, (T.IntegerType, T.LongType)):
        # Whole numbers may be written as 3.0.
        number = c.try_cast("double")
        return F.coalesce(c.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind))), "whole number"
    if isinstance(kind, T.DateType):
        return F.to_date(c.try_cast("timestamp_ntz")), "date"
    return c.try_cast(kind), kind.simpleString()


def _reasons(table: str) -> Column:
    """What is wrong with a row, in the order of the table's columns; empty for a good one."""
    found = [F.when(F.col(_CORRUPT).isNotNull(), F.lit("the line has another number of fields than the header"))]
    for f in SCHEMAS[table]:
        value, kind = _parsed(f.name, f.dataType)
        given = F.col(f.name).isNotNull()
        if isinstance(f.dataType, T.DoubleType):
            # NaN stands for a missing number.
            given &= ~F.coalesce(F.isnan(F.col(f.name).try_cast("double")), F.lit(False))
        bad = given & value.isNull()
        if f.name in LISTS.get(table, ()):
            tokens = F.split(F.col(f.name).cast("string"), ",")
            bad, kind = F.exists(tokens, lambda t: t.try_cast("int").isNull()), "list of whole numbers"
        found.append(F.when(bad, F.concat(F.lit(f"{f.name}: not a {kind}: "), F.col(f.name).cast("string"))))
        if f.name in REQUIRED[table]:
            found.append(F.when(F.col(_CORRUPT).isNull() & ~given, F.lit(f"{f.name}: missing")))
    return F.array_compact(F.array(*found))


def read_checked(spark: SparkSession, table: str, dataset: Dataset) -> Checked:
    """A dataset's good and rejected rows; the files are read once.

    A row is rejected for a line that does not have the header's number of fields, a value that
    does not fit its column, or a missing user or date. Positions count all rows, so the order of the good
    ones is that of the files. A column that is missing altogether, or files with other headers, are errors as ever.
    """
    paths = [dataset.path] if isinstance(dataset.path, str) else list(dataset.path)
    parts = []
    for path in paths:
        rows = _text_rows(spark, dataset, path).withColumnRenamed("userId", "user_id")
        lacking = [f.name for f in SCHEMAS[table] if f.name not in rows.columns]
        if lacking:
            raise ValueError(f"table {table!r} lacks columns {lacking}")
        shown = [c for c in rows.columns if c != _CORRUPT]
        raw = F.coalesce(F.col(_CORRUPT), F.to_json(F.struct(*[F.col(f"`{c}`") for c in shown])))
        kept = {f.name: _parsed(f.name, f.dataType)[0] for f in SCHEMAS[table]}
        rows = rows.withColumns({_REASONS: _reasons(table), _RAW: raw})
        parts.append(rows.withColumns(kept).drop(_CORRUPT))
    numbered = materialize(with_positions(parts, _AT), "checked")
    bad = F.size(_REASONS) > 0
    rejected = numbered.where(bad).select(F.col(_AT).alias("at"), F.col(_REASONS).alias("reasons"), F.col(_RAW).alias("raw"))
    names = SCHEMAS[table].fieldNames()
    extra = [c for c in numbered.columns if c not in (*names, _AT, _REASONS, _RAW)]
    good = numbered.where(~bad).select(*names, *[f"`{c}`" for c in extra], _AT)
    if table not in ORDERED:
        return Checked(good.drop(_AT), rejected)
    if dataset.row_id:
        good = good.withColumn("rid", F.col(dataset.row_id).cast("bigint"))
        return Checked(good.drop(_AT, *([dataset.row_id] if dataset.row_id != "rid" else [])), rejected)
    return Checked(good.drop(_AT) if "rid" in extra else good.withColumnRenamed(_AT, "rid"), rejected)


def reason_counts(rejected: DataFrame) -> DataFrame:
    """reason, rows: how often each kind of defect occurs, without the values."""
    kinds = F.transform("reasons", lambda r: F.regexp_replace(r, "^([^:]+: not a [^:]+): .*", "$1"))
    return rejected.select(F.explode(kinds).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
