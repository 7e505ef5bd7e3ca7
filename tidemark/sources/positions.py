"""Row positions that follow the files, not the way a scan is cut into tasks.

A row's position counts the rows before it: those of the paths named earlier, of files
earlier by name, and earlier in its own file.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranges import totals_before
from tidemark.storage import materialize

_PLACE = ["_part", "_file", "_block"]


def _metadata(name: str):
    return F.col(f"_metadata.{name}")


def _placed(df: DataFrame, part: int) -> tuple[DataFrame, bool]:
    """Rows with their file, block and number there, and whether the number counts from the file's start."""
    whole = df.select("*", F.lit(part).alias("_part"), _metadata("file_path").alias("_file"))
    if "row_index" in df.select("_metadata").schema["_metadata"].dataType.fieldNames():
        # Columnar files number their rows.
        return whole.select("*", F.lit(0).cast("bigint").alias("_block"), _metadata("row_index").alias("_number")), True
    # Text files tell where a task's piece of them begins. Generated ids rise within a piece.
    start = _metadata("file_block_start").alias("_block")
    return whole.select("*", start, F.monotonically_increasing_id().alias("_number")), False


def with_positions(parts: Sequence[DataFrame], column: str = "rid") -> DataFrame:
    """The rows of all `parts`, put together by name, with their position from 0 in `column`.

    Each part is a table read from files. The same files in the same order give the same
    positions under any partitioning, core count or split size. Text files, whose rows have
    no number of their own, are written once, so that the numbers of a pass hold for the next;
    a line break inside a quoted field needs the reader's ``multiLine``, as ever. Only a row per
    file (or piece of one) is put in order.
    """
    placed = [_placed(df, i) for i, df in enumerate(parts)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df for df, _ in placed])
    if not all(numbered for _, numbered in placed):
        rows = materialize(rows, "numbered-rows")
    pieces = rows.groupBy(*_PLACE).agg(F.count(F.lit(1)).alias("_rows"), F.min("_number").alias("_first"))
    numbered = F.lit([i for i, (_, own) in enumerate(placed) if own] or [-1])
    first = F.when(F.array_contains(numbered, F.col("_part")), F.lit(0).cast("bigint")).otherwise(F.col("_first"))
    starts = totals_before(pieces, _PLACE, {"_before": "_rows"}).select(*_PLACE, "_before", first.alias("_zero"))
    position = F.col("_before") + F.col("_number") - F.col("_zero")
    columns = [c for c in rows.columns if c not in (*_PLACE, "_number", column)]
    return rows.join(starts, _PLACE).select(*columns, position.alias(column))
