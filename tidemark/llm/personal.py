"""Personal data: fixed formats, and identifiers that stand where those stand.

Base spans follow four fixed formats, and some tokens have the shape of a secret; both are
seeds. Their surroundings (the one or two items before, the item after) are lexical patterns, and
tokens of other formats that look like identifiers have such surroundings too. A graph of patterns and
instances is scored in rounds: a pattern is as good as its instances, an instance as its
patterns, seeds stay at one. Tokens that trusted patterns vouch for become further spans, those
of a secret's shape among them: shape alone is not enough.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tidemark.llm.common import map_batches, slices, texts
from tidemark.storage import materialize

#: Base kinds in the order that breaks ties; found spans come last.
KINDS = ("email", "ip", "card", "phone")
FOUND = "context"

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Holds every ip, card and (after its plus) phone that begins in it.
_REGION = re.compile(r"[0-9][\x20().0-9-]*")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_NOT_DIGIT = re.compile(r"[^0-9]")
#: An identifier of unknown format: this long, with so many digits.
_TOKEN = re.compile(r"[A-Za-z0-9_-]{6,}")
_TOKEN_CHAR = re.compile(r"[A-Za-z0-9_-]")
_DIGIT = re.compile(r"[0-9]")
_LETTER = re.compile(r"[A-Za-z]")
MIN_DIGITS = 2
#: Shapes of secrets. Long hexadecimal runs, and the prefixes that issuers of keys give them.
SECRET = re.compile(
    r"(?=[^a-fA-F]*[a-fA-F])(?:[0-9a-f]{32,}|[0-9A-F]{32,})|(?:AKIA|ASIA)[A-Z0-9]{16}|gh[opusr]_[A-Za-z0-9]{36,}"
    r"|github_pat_[A-Za-z0-9_]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"
    r"|AIza[A-Za-z0-9_-]{35}|SG_[A-Za-z0-9_-]{20,}"
)
_ITEM = re.compile(r"\w+|[^\w\s]")
#: Characters looked at on either side of an instance.
CONTEXT_CHARS = 40

SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"
SIGHTS = "array<struct<start:bigint,end:bigint,instance:string,seed:boolean,shaped:boolean,patterns:array<string>>>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            floor = domain.end()
            yield start, floor
        else:
            floor = at + 1
        at = text.find("@", floor)


def base_spans(text: str, regions: list[re.Match]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, in order."""
    found = [(s, 0, e) for s, e in emails(text)]
    for region in regions:
        begin, end = region.span()
        if end - begin < 3:
            continue
        for m in _IP.finditer(text, begin, end):
            if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text, begin, end):
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if begin and text[begin - 1] == "+":
            number = region[0].rstrip(" ().-")
            if len(number) >= 3 and 10 <= len(_NOT_DIGIT.sub("", number)) <= 15:
                found.append((begin - 1, 3, begin + len(number)))
    return sorted(found)


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical surroundings of a span: one and two items before, one after."""
    left = _ITEM.findall(text[max(0, start - CONTEXT_CHARS) : start].lower())[-2:]
    right = _ITEM.findall(text[end : end + CONTEXT_CHARS].lower())[:1]
    out = [f"L {left[-1]}"] if left else []
    out += [f"LL {left[0]} {left[1]}"] if len(left) == 2 else []
    return out + ([f"R {right[0]}"] if right else [])


def sights(
    text: str, base: list[tuple[int, int, int]], regions: list[re.Match]
) -> list[dict[str, object]]:
    """Seeds and identifier-like tokens of a text, with their patterns.

    Tokens without a letter are none: the formats have looked at all digits.
    """
    places = [(s, e, True) for s, _, e in base]
    last, i, top = 0, 0, -1
    for region in regions:
        begin = region.start()
        if begin < last:
            continue
        while begin > last and _TOKEN_CHAR.match(text, begin - 1):
            begin -= 1
        token = _TOKEN.match(text, begin)
        if not token:
            continue
        last = token.end()
        if len(token[0]) - len(_DIGIT.sub("", token[0])) < MIN_DIGITS or not _LETTER.search(token[0]):
            continue
        while i < len(base) and base[i][0] < last:
            top = max(top, base[i][2])
            i += 1
        if top <= begin:
            places.append((begin, last, False))
    return [
        {
            "start": s, "end": e, "instance": hashlib.sha1(text[s:e].encode()).hexdigest(), "seed": seed,
            "shaped": not seed and SECRET.fullmatch(text, s, e) is not None, "patterns": patterns(text, s, e),
        }
        for s, e, seed in places
    ]


def read_rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` with _row (a number of its own), _base and _sights, for every row of `docs`."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = StructType([docs.schema[c] for c in keep])
    kind = StructType([*kind.fields, *StructType.fromDDL(f"_row bigint, _base {SPANS}, _sights {SIGHTS}").fields])
    arrow = to_arrow_schema(kind)
    read = [*keep] if "text" in keep else [*keep, "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for piece in slices(batches, "text"):
            base, seen = [], []
            for text in texts(piece):
                regions = list(_REGION.finditer(text))
                spans = base_spans(text, regions)
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                seen.append(sights(text, spans, regions))
            own = [range(row, row + piece.num_rows), base, seen]
            row += piece.num_rows
            columns = [piece.column(c) for c in keep]
            columns += [pa.array(v, f.type) for v, f in zip(own, list(arrow)[-3:], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return map_batches(docs.select(*read), run, kind)


def trusted_instances(
    edges: DataFrame, rounds: int, min_support: int, min_confidence: float, min_patterns: int
) -> DataFrame:
    """Instances that trusted patterns vouch for, base spans left out.

    `edges` has a row per (pattern, instance) with their common sights `weight`, whether the
    instance is a `seed` of a base format, and whether it is `shaped` like a secret, which makes it a seed
    too, but one that patterns have yet to vouch for. Each round, a pattern's confidence is the mean score
    of its sights with one failure added, and it needs `min_support` different instances
    that score `min_confidence`; an instance's score is the mean confidence of its
    supported patterns, of which it needs `min_patterns`. So what one round finds supports
    the patterns of the next.
    """
    edges = materialize(edges, "edges")
    known = F.col("seed") | F.col("shaped")
    scored = edges.withColumn("score", known.cast("double"))
    good = F.col("score") >= min_confidence
    for _ in range(rounds):
        confidence = (
            scored.groupBy("pattern")
            .agg(
                (F.sum(F.col("weight") * F.col("score")) / (F.sum("weight") + 1)).alias("confidence"),
                F.sum(good.cast("int")).alias("support"),
            )
            .where(F.col("support") >= min_support)
        )
        mean = F.sum(F.col("weight") * F.col("confidence")) / F.sum("weight")
        judged = materialize(
            edges.join(confidence, "pattern")
            .groupBy("instance")
            .agg(F.when(F.count("*") >= min_patterns, mean).otherwise(0.0).alias("mean")),
            "scores",
        )
        scored = edges.join(judged, "instance", "left").withColumn(
            "score", F.when(known, 1.0).otherwise(F.coalesce("mean", F.lit(0.0)))
        )
    return scored.where(~F.col("seed") & (F.col("mean") >= min_confidence)).select("instance").distinct()


def found_spans(
    rows: DataFrame, rounds: int = 3, min_support: int = 3, min_confidence: float = 0.5, min_patterns: int = 2
) -> DataFrame:
    """(_row, _found): the further spans of rows that have any."""
    seen = rows.select("_row", F.explode("_sights").alias("s")).select("_row", "s.*")
    edges = (
        seen.select("instance", "seed", "shaped", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "instance")
        .agg(F.count("*").alias("weight"), F.max("seed").alias("seed"), F.max("shaped").alias("shaped"))
    )
    # A text seen as a seed somewhere is one everywhere.
    seeds = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    edges = edges.drop("seed").join(seeds, "instance")
    trusted = trusted_instances(edges, rounds, min_support, min_confidence, min_patterns)
    span = F.struct("start", F.lit(len(KINDS)).alias("kind"), "end")
    return (
        seen.where("not seed").join(trusted, "instance").groupBy("_row").agg(F.collect_list(span).alias("_found"))
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every row of `docs`: arrays of (start, kind, end).

    Positions are code points, ends exclusive, kinds numbers into KINDS, and one more for
    spans that context found; arrays are sorted. A missing or empty text has no spans.
    Repeated rows come out each; other columns are ignored; an empty table gives an empty
    one.
    """
    rows = materialize(read_rows(docs, ["doc_id"]), "sights")
    return _with_spans(rows).select("doc_id", F.col("_base").alias("base"), "spans")


def _with_spans(rows: DataFrame) -> DataFrame:
    joined = rows.drop("_sights").join(found_spans(rows), "_row", "left")
    every = F.concat("_base", F.coalesce("_found", F.array().cast(SPANS)))
    return joined.withColumn("spans", F.array_sort(every)).drop("_found")


def span_list(spans: Column) -> Column:
    """`kind:start:end` of each span, joined with commas."""
    names = F.array(*[F.lit(k) for k in (*KINDS, FOUND)])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def _masked(text: str, spans: list[dict[str, int]]) -> str:
    """`text` with each run of overlapping spans replaced by its first kind's name."""
    names, out, at = (*KINDS, FOUND), [], 0
    i = 0
    while i < len(spans):
        start, end, kind = spans[i]["start"], spans[i]["end"], spans[i]["kind"]
        while i + 1 < len(spans) and spans[i + 1]["start"] < end:
            i += 1
            end = max(end, spans[i]["end"])
        out += [text[at:start], f"<{names[kind]}>"]
        at = end
        i += 1
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """`docs` with the name of its kind in place of every span of personal data.

    All rows and columns stay; an integer column n_chars follows the new length of the
    texts that changed. Missing and empty texts stay as they are. Rows with nothing to
    look at are not moved. Columns may have any names.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = docs.schema
    # Names of its own keep the working columns apart from those of `docs`.
    plain = [f"c{i}" if c != "text" else c for i, c in enumerate(docs.columns)]
    rows = materialize(read_rows(docs.toDF(*plain), plain), "sights")
    looked = F.size("_sights") > 0
    arrow = to_arrow_schema(schema)
    counts = "n_chars" in docs.columns and isinstance(schema["n_chars"].dataType, LongType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            spans = piece.column("spans").to_pylist()
            new = [_masked(t, s) if s else t for t, s in zip(piece.column("text").to_pylist(), spans, strict=True)]
            columns = {c: piece.column(p) for c, p in zip(schema.names, plain, strict=True)}
            columns["text"] = pa.array(new, pa.string())
            if counts:
                old = columns["n_chars"].to_pylist()
                sizes = [len(t) if s else n for t, s, n in zip(new, spans, old, strict=True)]
                columns["n_chars"] = pa.array(sizes, pa.int64())
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in arrow], schema=arrow)

    changed = map_batches(_with_spans(rows.where(looked)).select(*plain, "spans"), run, schema)
    return rows.where(~looked).select(*plain).toDF(*docs.columns).unionByName(changed)
