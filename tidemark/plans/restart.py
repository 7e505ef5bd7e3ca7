"""Intermediate tables that a rerun of a job finds finished.

A table is written to a folder of its own under its name, and is finished once a manifest names
that folder. Manifests are single small files, created whole or not at all, so a reader never
meets half a table, and a job that was killed leaves at most a folder that no manifest names. A manifest is
told by a fingerprint of the job's options and of the input files, so other options or other
input never meet an old table.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.config import JobConfig
from tidemark.sources.tables import Dataset, read_back, write_table

#: Raised when the meaning of a written table changes.
VERSION = 1
#: Options that do not change what a table holds.
_PLACES = ("intermediates",)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def content_stamp(spark: SparkSession, path: str) -> list:
    """Number and size of the files below `path`, and a hash of their names, sizes and times.

    Listed and added up by Spark; the files are not read.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    mark = F.xxhash64("path", "length", "modificationTime")
    return list(listed.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(mark), F.sum(F.shiftright(mark, 20))).first())


def fingerprint(
    spark: SparkSession,
    table: str,
    config: JobConfig,
    inputs: Mapping[str, Dataset],
    chosen: Mapping[str, object] | None = None,
) -> str:
    """What decides a table's rows: its name, the job's options and the input files."""
    options = {k: str(v) for k, v in asdict(config).items() if k not in _PLACES}
    known = {}
    for name, dataset in sorted(inputs.items()):
        paths = [dataset.path] if isinstance(dataset.path, str) else list(dataset.path)
        fields = {k: str(v) for k, v in asdict(dataset).items() if k != "options"} | {"options": dict(dataset.options)}
        known[name] = [fields, [content_stamp(spark, p) for p in paths]]
    whole = json.dumps([VERSION, table, options, known, dict(chosen or {})], sort_keys=True)
    return hashlib.sha256(whole.encode()).hexdigest()[:32]


def _manifest(folder: str, mark: str) -> str:
    return f"{folder}/finished-{mark}.json"


def finished(spark: SparkSession, folder: str, mark: str) -> tuple[str, StructType, str] | None:
    """Path, schema and format of the finished table of a fingerprint, if there is one."""
    files, place = _files(spark, _manifest(folder, mark))
    if not files.exists(place):
        return None
    told = json.loads(spark.read.text(_manifest(folder, mark), wholetext=True).first()[0])
    return f"{folder}/{told['data']}", StructType.fromJson(told["schema"]), told["format"]


def publish(spark: SparkSession, folder: str, mark: str, data: str, schema: StructType, format: str) -> None:
    """Name the written folder `data` as the finished table. The first of several writers wins."""
    text = json.dumps({"data": data, "schema": schema.jsonValue(), "format": format})
    # Written aside and renamed, so that it appears whole; the rename fails where a manifest already is.
    files, aside = _files(spark, f"{folder}/_writing-{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    place = _files(spark, _manifest(folder, mark))[1]
    try:
        done = not files.exists(place) and files.rename(aside, place)
    except Py4JJavaError:
        done = False
    if not done:
        files.delete(aside, False)


def keep(
    spark: SparkSession, folder: str, mark: str, build: Callable[[], DataFrame], format: str
) -> tuple[DataFrame, bool]:
    """The finished table of a fingerprint, built and written first if it is not there; and whether it was there."""
    known = finished(spark, folder, mark)
    there = known is not None
    if not there:
        rows, data = build(), f"data-{uuid.uuid4().hex}"
        write_table(rows, f"{folder}/{data}", format)
        publish(spark, folder, mark, data, rows.schema, format)
        known = finished(spark, folder, mark)
    path, schema, written = known
    return read_back(spark, path, schema, written), there


def forget(spark: SparkSession, folder: str, marks: Sequence[str]) -> int:
    """Remove all of a table's folders and manifests but those of the fingerprints `marks`; how many went.

    For when no job runs: a table that is being written has no manifest yet.
    """
    files, place = _files(spark, folder)
    if not files.exists(place):
        return 0
    held = {_manifest(folder, m).rsplit("/", 1)[1] for m in marks}
    held |= {known[0].rsplit("/", 1)[1] for m in marks if (known := finished(spark, folder, m))}
    gone = [s.getPath() for s in files.listStatus(place) if s.getPath().getName() not in held]
    return sum(files.delete(p, True) for p in gone)
