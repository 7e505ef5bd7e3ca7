"""Rows of a table told by their place in its files, and a second scan that keeps some of them.

A row's place is its file and its number there. It does not depend on how a scan is cut
into tasks, so a decision taken on places alone holds for any later scan, and the rows'
texts are never moved.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import map_batches
from tidemark.llm.warc import place
from tidemark.storage import materialize

#: Rows of one file whose kept numbers are one list; a task holds a few such lists.
BLOCK = 1 << 20


def placed(df: DataFrame, names: tuple[str, str]) -> DataFrame:
    """`df` with its rows' file (a digest of its path) and number there in the columns `names`.

    A table that does not come from files is written first, so that its rows have places.
    """
    try:
        return _with_places(df, names)
    except AnalysisException:
        return _with_places(materialize(df, "rows"), names)


def _with_places(df: DataFrame, names: tuple[str, str]) -> DataFrame:
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    return df.select("*", F.md5(file.cast("binary")).alias(names[0]), row.alias(names[1]))


def free_names(df: DataFrame, *wanted: str) -> tuple[str, ...]:
    """The names `wanted`, made longer until `df` has no such columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return tuple(out)


def write_places(places: DataFrame, path: str) -> None:
    """Write (file, row) to `path`, in one folder for each file and block of its rows."""
    part = F.concat_ws("-", "file", F.floor(F.col("row") / BLOCK).cast("string"))
    listed = places.select("row", part.alias("part"))
    listed.repartition("part").write.partitionBy("part").parquet(path)


@lru_cache(maxsize=8)
def _rows_of(path: str, part: str) -> np.ndarray:
    """The listed row numbers of one file and block, in order; none where nothing was listed."""
    files, root = place(path)
    found = files.get_file_info(fs.FileSelector(posixpath.join(root, f"part={part}"), allow_not_found=True))
    lists = [pq.read_table(f.path, filesystem=files, columns=["row"], partitioning=None)["row"].to_numpy()
             for f in found if f.is_file and f.base_name.endswith(".parquet")]
    return np.sort(np.concatenate(lists)) if lists else np.empty(0, np.int64)


def keep_places(df: DataFrame, names: tuple[str, str], path: str, keep: bool = True) -> DataFrame:
    """The rows of `df` (see `placed`) whose places are listed in `path`, without the columns `names`.

    Without `keep` it is the rows whose places are not listed.
    """
    schema = StructType([f for f in df.schema if f.name not in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(names[1]).to_numpy(zero_copy_only=False)
            kept = np.zeros(len(rows), bool)
            files = batch.column(names[0]).dictionary_encode()
            codes, blocks = files.indices.to_numpy(zero_copy_only=False), rows // BLOCK
            for code, name in enumerate(files.dictionary.to_pylist()):
                for block in np.unique(blocks[codes == code]):
                    here = np.flatnonzero((codes == code) & (blocks == block))
                    listed = _rows_of(path, f"{name}-{block}")
                    at = np.searchsorted(listed, rows[here])
                    at[at == len(listed)] = 0
                    kept[here] = listed[at] == rows[here] if len(listed) else False
            out = batch.filter(pa.array(kept == keep))
            yield pa.RecordBatch.from_arrays([out.column(f.name) for f in schema], [f.name for f in schema])

    return map_batches(df, run, schema)


