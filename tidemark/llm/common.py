"""Helpers shared by the operators: folds, byte-bounded Arrow slices, row maps."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.storage import materialize

#: Text bytes a Python worker handles at a time; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20


#: Bytes of a record batch on its way to Python.
BATCH_BYTES = 4 << 20
_BATCH_OPTION = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """`df` through a function of record batches of a few megabytes (or one row).

    Batches are cut by rows alone otherwise, and rows of long texts fill an executor's
    memory outside its heap. The session's limit is lowered, never raised.
    """
    conf = df.sparkSession.conf
    if _in_bytes(conf.get(_BATCH_OPTION)) > BATCH_BYTES:
        conf.set(_BATCH_OPTION, f"{BATCH_BYTES}b")
    return df.mapInArrow(run, schema)


def _in_bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)([a-z]*)", size.strip().lower()).groups()
    scale = "bkmgtp".index((unit or "b")[0])
    return int(number) << (10 * scale) if int(number) > 0 else 1 << 62


def fold(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo `n`; a missing id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(n))


def slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose `column` has about `limit` bytes at most."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def map_slices(
    df: DataFrame,
    schema: str | StructType,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, object]]],
    column: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """`df` through a per-slice function, one call of `make` per task.

    The function returns the columns of `schema` for the rows of its slice;
    what a task keeps between slices (caches, models) lives in its closure.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for piece in slices(batches, column, limit):
            out = work(piece)
            yield pa.RecordBatch.from_arrays(
                [_as_arrow(out[f.name], f.type) for f in arrow], schema=arrow
            )

    return map_batches(df, run, kind)


def _as_arrow(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def texts(piece: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice; a missing one is empty."""
    return [t or "" for t in piece.column(column).to_pylist()]


def raw_texts(piece: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a slice as UTF-8; a missing one is empty."""
    return [t or b"" for t in piece.column(column).cast(pa.binary()).to_pylist()]


#: Beyond so many strata each gives fewer rows, so that the sample is bounded as a whole.
FULL_STRATA = 1000


def stratified(rows: DataFrame, stratum: str, order: Column, per: int) -> DataFrame:
    """About `per` rows of each value of `stratum`, or all where there are fewer; FULL_STRATA * `per` rows at most, or about that.

    `order` is a hash; a row is taken if its remainder is low enough for the count of its
    stratum. So nothing is ranked or moved, whatever the table's size and however its
    rows are spread. Rows with no stratum take no part. Where strata are more than rows wanted, each
    gives one with the chance that this leaves it. Only the number of strata reaches the driver.
    """
    wide = 1 << 30
    rows = rows.where(F.col(stratum).isNotNull())
    counts = materialize(rows.groupBy(stratum).count(), "strata")
    strata = counts.count()
    wanted = float(min(per, per * FULL_STRATA / max(strata, 1)))
    share = F.least(F.lit(wide), F.floor(F.lit(wanted * wide) / F.col("count")) + 1)
    shares = counts.select(stratum, share.alias("_share"))
    low = F.pmod(order, F.lit(wide))
    few = F.broadcast(shares) if strata <= FULL_STRATA * 10 else shares
    return rows.join(few, stratum).where(low < F.col("_share")).select(*rows.columns)
