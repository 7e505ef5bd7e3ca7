"""Tables stored by user: bucketed files whose per-user work needs no shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordering import heavy_keys

#: Rows of one user that one task writes, and rows of one file.
MAX_FILE_ROWS = 5_000_000
_KEY = "user_id"
_LAYOUT = "_layout"


def write_by_user(
    df: DataFrame, path: str, buckets: int, order: Sequence[str] = (_KEY,), max_rows: int = MAX_FILE_ROWS
) -> str:
    """Write `df` to the new folder `path` in `buckets` buckets of users, sorted by `order` in each file.

    A bucket is one file, written by one task, except for users of more than `max_rows` rows: their
    rows are dealt to many tasks and files of at most that size. Reading has a task per
    bucket, which reads all files of it, so a user's rows are still together; such a task takes as long as
    its heaviest user needs. Choose more buckets than there are cores.
    """
    spark = df.sparkSession
    heavy = heavy_keys(df.where(F.col(_KEY).isNotNull()), [_KEY], max_rows)
    # The hash that deals rows to tasks is the one that deals them to buckets.
    light = df.join(heavy, _KEY, "left_anti").repartition(buckets, _KEY)
    spread = df.join(heavy, _KEY, "left_semi").repartition(buckets, F.xxhash64(*df.columns))
    name = _new_name()
    both = light.select(df.columns).unionByName(spread.select(df.columns))
    writer = both.write.format("parquet").bucketBy(buckets, _KEY).sortBy(*order)
    writer.option("maxRecordsPerFile", max_rows).option("path", path).mode("error").saveAsTable(name)
    # Only the files are kept; whoever reads them makes a table of them.
    spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    layout = spark.createDataFrame([(columns, buckets, list(order))], "columns string, buckets int, ordered array<string>")
    layout.coalesce(1).write.json(f"{path}/{_LAYOUT}")
    return path


def _new_name() -> str:
    return f"by_user_{uuid.uuid4().hex}"


def read_by_user(spark: SparkSession, path: str) -> DataFrame:
    """The table written by `write_by_user`, as a bucketed table of this session.

    Grouping by user_id, windows by it, and joins on it with a table of as many buckets plan no
    exchange of these rows.
    """
    layout = spark.read.schema("columns string, buckets int, ordered array<string>").json(f"{path}/{_LAYOUT}").first()
    name, order = _new_name(), ", ".join(f"`{c}`" for c in layout["ordered"])
    spark.sql(
        f"CREATE TABLE {name} ({layout['columns']}) USING parquet CLUSTERED BY ({_KEY}) SORTED BY ({order}) "
        f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
