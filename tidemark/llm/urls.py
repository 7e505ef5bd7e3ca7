"""URL rules by a sort-merge range join.

A host's labels in reverse order, each with a dot, make a key under which a host and all
its subdomains lie next to each other: a rule's host is a prefix of their keys, that is,
an interval. URLs are range-partitioned and sorted by key; each task sweeps its part once
along the sorted rules and keeps a stack of the nested rule hosts that are open there.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import map_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules that one sweep holds, and that are sent to the tasks at a time.
BLOCK_RULES = 100_000


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ? or #; empty without ://."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def host_key(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


@dataclass
class Node:
    """The rules of one host: by path, and the paths' lengths, longest first."""

    key: str
    host_length: int
    by_path: dict[str, tuple[str, str]] = field(default_factory=dict)
    lengths: list[int] = field(default_factory=list)


class Sweep:
    """Best rules of keys that come in sorted order."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        nodes: dict[str, Node] = {}
        for verdict, host, path in rules:
            key = host_key(host)
            nodes.setdefault(key, Node(key, len(host))).by_path[path] = (host + path, verdict)
        for node in nodes.values():
            node.lengths = sorted({len(p) for p in node.by_path}, reverse=True)
        self.nodes = [nodes[k] for k in sorted(nodes)]
        self.keys = [n.key for n in self.nodes]
        self.by_key = nodes
        self.at: int | None = None
        self.stack: list[Node] = []

    def _begin(self, key: str) -> None:
        """Open the rule hosts that enclose the first key."""
        self.at = bisect_right(self.keys, key)
        end = key.find(".") + 1
        while end:
            if key[:end] in self.by_key:
                self.stack.append(self.by_key[key[:end]])
            end = key.find(".", end) + 1

    def move(self, key: str) -> None:
        """Go on to `key`: close the hosts that ended, open those that began."""
        if self.at is None:
            self._begin(key)
        while self.at < len(self.keys) and self.keys[self.at] <= key:
            self._close(self.keys[self.at])
            self.stack.append(self.nodes[self.at])
            self.at += 1
        self._close(key)

    def _close(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1].key):
            self.stack.pop()

    def best(self, path: str) -> tuple[str, str, int] | None:
        """The longest open rule whose path begins `path`, its verdict and its host's length.

        Of equally long ones the nearer host wins.
        """
        found, size = None, -1
        for node in reversed(self.stack):
            for length in node.lengths:
                if node.host_length + length <= size:
                    break
                if length <= len(path) and path[:length] in node.by_path:
                    found, size = (*node.by_path[path[:length]], node.host_length), node.host_length + length
                    break
        return found


def judge_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    default: str = "allow",
    block_rules: int = BLOCK_RULES,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of `pages`.

    `rules` are (verdict, host, path), verdicts `allow` or `block`; hosts are lower case.
    A rule fits its host and all subdomains if the url's path starts with the rule's; the
    longest wins, the nearer host on equal length, `block` if both verdicts are given for
    one rule. Without a fitting rule `rule` is null and the verdict is `default`. A url
    that is missing or has no `://` has empty host and path, which no rule fits. More
    rules than `block_rules` take a sweep per block over the same sorted rows. Equal urls
    may meet in different tasks: the sort order goes on by a hash of the row, so a common
    host is split. Repeated rows come out each; other columns are ignored.
    """
    # Of equal rules the last in order, block, stays.
    merged = {(host, path): verdict for verdict, host, path in sorted(set(rules))}
    rules = [(verdict, host, path) for (host, path), verdict in sorted(merged.items())]
    host = host_of(F.col("url"))
    found = pages.select(
        "page_id",
        F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"),
        F.lit(None).cast("string").alias("rule"),
        F.lit(default).alias("verdict"),
        F.lit(-1).alias("_near"),
    ).withColumn("_key", reversed_host(F.col("host")))
    tie = F.xxhash64("page_id", "path")
    found = found.repartitionByRange("_key", tie).sortWithinPartitions("_key", tie)
    for at in range(0, len(rules), block_rules):
        found = _swept(found, rules[at : at + block_rules])
    return found.drop("_key", "_near")


def _swept(rows: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """`rows`, sorted by _key, with longer rules of this block put in."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([rows.schema[c] for c in rows.columns])
    arrow = to_arrow_schema(schema)
    held = rows.sparkSession.sparkContext.broadcast(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep, last = Sweep(held.value), None
        for batch in batches:
            names, verdicts = batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()
            near = batch.column("_near").to_pylist()
            keys, paths = batch.column("_key").to_pylist(), batch.column("path").to_pylist()
            for i, (key, path) in enumerate(zip(keys, paths, strict=True)):
                if key != last:
                    sweep.move(key)
                    last = key
                best = sweep.best(path) if sweep.stack else None
                if best and (len(best[0]), best[2]) > (len(names[i] or ""), near[i]):
                    names[i], verdicts[i], near[i] = best
            own = {"rule": pa.array(names, pa.string()), "verdict": pa.array(verdicts, pa.string())}
            own["_near"] = pa.array(near, pa.int32())
            yield pa.RecordBatch.from_arrays([own.get(f.name, batch.column(f.name)) for f in arrow], schema=arrow)

    return map_batches(rows, run, schema)
