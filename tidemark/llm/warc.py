"""WARC archives of pages, read back and merged into ordered capture histories.

Each task writes archives of its pages into the shared folder, one gzip member per
record. Reading an archive gives a run: its captures sorted by URL key and time. Runs
are cut at common keys, and each range of keys is merged with a loser tree, so that the
ranges, one after the other, hold all captures in order.
"""

from __future__ import annotations

import re
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime, timedelta
from hashlib import sha1

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import map_batches, slices
from tidemark.storage import fresh_path, materialize

#: An archive ends after so many bytes or records.
ARCHIVE_BYTES = 128 << 20
ARCHIVE_RECORDS = 50_000
#: Bytes read from an archive at a time.
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIRST_CAPTURE = datetime(2000, 1, 1, tzinfo=UTC)

CAPTURE = (
    "run string, url_key string, captured_at string, page string, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to string, offset bigint"
)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def url_key(url: str) -> str:
    """Reversed host labels, then path and query: captures of a site sort together."""
    rest = url.partition("://")[2].partition("#")[0]
    m = re.match(r"[^/?]*", rest)
    return ",".join(reversed(m[0].lower().split("."))) + ")" + rest[m.end() :]


def digest(payload: bytes) -> str:
    return b32encode(sha1(payload).digest()).decode()


def capture_time(page: str | None) -> str:
    """Pages carry no time of capture; their numbers stand for seconds of one."""
    seconds = int(page) if page and page.lstrip("-").isdigit() else 0
    when = FIRST_CAPTURE + timedelta(seconds=seconds % (1 << 32))
    return when.strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if refers_to else payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}"]
    lines += [f"WARC-Record-ID: <urn:x-page:{page}>"] if page is not None else []
    if url is not None:
        lines.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Date: {capture_time(page)}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record; an error for a block that is cut short."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    if len(rest) < size:
        raise ValueError("the record is cut short")
    return headers, rest[:size]


def members(chunks: Iterable[bytes]) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member of an archive."""
    offset, at, engine, out = 0, 0, zlib.decompressobj(31), []
    for chunk in chunks:
        at += len(chunk)
        while chunk:
            out.append(engine.decompress(chunk))
            chunk = engine.unused_data
            if engine.eof:
                yield offset, b"".join(out)
                offset, engine, out = at - len(chunk), zlib.decompressobj(31), []
    if out:
        raise ValueError("the archive is cut short")


def _named(value: str | None) -> str | None:
    return value.removeprefix("<urn:x-page:").removesuffix(">") if value else None


def capture(run: str, offset: int, raw: bytes) -> dict[str, object]:
    """What a record says; a response's payload is checked against its digest."""
    headers, block = parse(raw)
    http, _, payload = block.partition(b"\r\n\r\n")
    said = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind = headers["WARC-Type"]
    if kind == "response" and (digest(payload) != said or len(payload) != size):
        raise ValueError(f"the payload at {offset} of {run} does not match its digest")
    return {
        "run": run, "url_key": url_key(headers.get("WARC-Target-URI", "")), "captured_at": headers["WARC-Date"],
        "page": _named(headers.get("WARC-Record-ID")), "payload_bytes": size, "payload_digest": said,
        "record_type": kind, "refers_to": _named(headers.get("WARC-Refers-To")), "offset": offset,
    }


def order_of(row: dict[str, object]) -> tuple:
    return row["url_key"], row["captured_at"], row["page"] or ""


def with_first(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """`pages` (page_id, url, html) with the smallest page_id of an equal payload, or null.

    Only payloads that occur more than once are joined back.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    marked = pages.select("page_id", "url", "html", F.sha1(payload).alias("_sha"))
    first = (
        marked.where(F.octet_length(payload) >= min_bytes)
        .groupBy("_sha")
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
        .where("n > 1")
        .select("_sha", "first")
    )
    return marked.join(first, "_sha", "left").select("page_id", "url", "html", "first")


def write_archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes a record per row of `pages`; (archive, records) of what was written.

    The table of archives is written too and is what counts: an archive that a lost task
    left behind is in no table, so nothing reads it.
    """
    spark = pages.sparkSession
    folder = fresh_path(spark, "archives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = place(folder)
        store.create_dir(root, recursive=True)
        name, sink, size, count = None, None, 0, 0
        done: list[tuple[str, int]] = []
        for piece in slices(batches, "html"):
            columns = [piece.column(c).to_pylist() for c in ("page", "url", "html", "refers_to")]
            for page, url, html, refers_to in zip(*columns, strict=True):
                if sink is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                engine = zlib.compressobj(1, zlib.DEFLATED, 31)
                raw = record(page, url, (html or "").encode(), refers_to)
                packed = engine.compress(raw) + engine.flush()
                sink.write(packed)
                size, count = size + len(packed), count + 1
                if size >= ARCHIVE_BYTES or count >= ARCHIVE_RECORDS:
                    sink.close()
                    sink = None
                    done.append((f"{folder}/{name}", count))
        if sink is not None:
            sink.close()
            done.append((f"{folder}/{name}", count))
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in done], pa.string()), pa.array([c for _, c in done], pa.int64())],
            names=["archive", "records"],
        )

    page, first = F.col("page_id").cast("string"), F.col("first")
    refers_to = F.when(first < F.col("page_id"), first.cast("string")).when(
        F.col("page_id").isNull(), first.cast("string")
    )
    rows = with_first(pages, min_bytes).select(
        page.alias("page"), "url", "html", refers_to.alias("refers_to")
    )
    return materialize(map_batches(rows, run, "archive string, records bigint"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """The captures of all archives, a sorted run each. An archive is read in pieces."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType.fromDDL(CAPTURE)
    arrow = to_arrow_schema(schema)

    def chunks(stream) -> Iterator[bytes]:
        while chunk := stream.read(READ_BYTES):
            yield chunk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, records in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                store, path = place(uri)
                with store.open_input_stream(path, compression=None) as stream:
                    rows = [capture(uri, offset, raw) for offset, raw in members(chunks(stream))]
                if len(rows) != records:
                    raise ValueError(f"{uri} holds {len(rows)} records, not {records}")
                yield pa.RecordBatch.from_pylist(sorted(rows, key=order_of), schema=arrow)

    spread = archives.select("archive", "records").repartition("archive")
    return materialize(map_batches(spread, run, schema), "captures")


class LoserTree:
    """Merges sorted runs: each inner place keeps the loser of its two sides."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        k = len(self.runs)
        self.losers = [-1] * max(k, 1)
        for i in range(k):
            self._settle(i)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a's head comes first; ended runs come last, ties go by run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None
        return (x, a) < (y, b)

    def _settle(self, winner: int) -> None:
        """Play run `winner` from its leaf up; places that no run has reached wait."""
        place = (winner + len(self.runs)) // 2
        while place > 0:
            if self.losers[place] < 0:
                self.losers[place] = winner
                return
            if self._less(self.losers[place], winner):
                self.losers[place], winner = winner, self.losers[place]
            place //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs:
            run = self.losers[0]
            head = self.heads[run]
            if head is None:
                return
            yield head
            self.heads[run] = next(self.runs[run], None)
            self._settle(run)


def merge_captures(captures: DataFrame) -> DataFrame:
    """All captures in global order of (url_key, captured_at, page), run after run merged.

    The rows are dealt to tasks by ranges of the whole order, so a common URL key is
    split; each task merges its slices of the runs, as Arrow columns.
    """
    order = ["url_key", "captured_at", "page"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        runs = table.column("run").to_pylist()
        keys, times = table.column("url_key").to_pylist(), table.column("captured_at").to_pylist()
        pages = [p or "" for p in table.column("page").to_pylist()]
        edges = [0, *(i for i in range(1, len(runs)) if runs[i] != runs[i - 1]), len(runs)]

        def run_rows(begin: int, end: int) -> Iterator[tuple]:
            return zip(keys[begin:end], times[begin:end], pages[begin:end], range(begin, end), strict=True)

        tree = LoserTree([run_rows(b, e) for b, e in zip(edges[:-1], edges[1:], strict=True)])
        at = pa.array([row[-1] for row in tree], pa.int64())
        yield from table.take(at).to_batches(max_chunksize=10_000)

    page = F.coalesce("page", F.lit(""))
    dealt = captures.repartitionByRange("url_key", "captured_at", page, "run")
    ordered = dealt.sortWithinPartitions("run", "url_key", "captured_at", page)
    return map_batches(ordered, run, captures.schema)


def capture_history(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes `pages` (page_id, url, html) as archives and reads their captures back.

    One row per page, in global order of URL key and time: page_id, payload_bytes,
    payload_digest, record_type, refers_to, url_key, captured_at, archive, offset. Of
    equal payloads of at least `min_bytes` the row with the smallest page_id is a
    response (all rows that repeat it, if any), the others are revisits of it; smaller
    payloads are all responses. A missing html is an empty payload, a missing url has an
    empty key; rows without page_id revisit the smallest id of their payload, or are
    responses where there is none. Other columns are ignored; an empty table gives an
    empty one.
    """
    kind = pages.schema["page_id"].dataType
    merged = merge_captures(read_archives(write_archives(pages, min_bytes)))
    return merged.select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "url_key", "captured_at",
        F.col("run").alias("archive"), "offset",
    )
