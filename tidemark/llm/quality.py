"""Quality rules: repetition, and how far a document's character classes and common words
lie from those of its language. Only built-in expressions; no Python runs on the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.storage import materialize

SPACES = r"[\x20\x09-\x0D]+"
NOT_LETTERS = r"[^\p{L}]+"
#: What each class leaves out; white space is counted by words and lower case is the rest.
NOT_CLASS = {
    "symbol": r"[^#*$%&|<>]+",
    "upper": r"[^A-Z]+",
    "digit": r"[^0-9]+",
    "mark": r"\P{Punct}+",
    "beyond": r"[\x00-\x7F]+",
}
#: Common words of the languages, compared by how often they occur.
COMMON_WORDS = (
    "the of and to a in is that it for on was "
    "de la le et les des en un du une est que "
    "der die und den von zu das mit sich für ist nicht "
    "el y los se del las por con para no su al"
).split()
WINDOW = 5
#: A document is judged by its characters from so many on, by its words from so many on.
MIN_CHARS, MIN_WORDS = 500, 80
#: Jensen-Shannon distances (base 2) are counted in steps. A limit lies so many spreads above the median, a
#: spread being the way to the upper quartile, of so many steps at least.
BIN = 0.001
SPREADS = {"char": 25, "word": 4}
LEAST_SPREADS = {"char": 4, "word": 25}
#: Judged documents and words that a language needs for limits and a reference of its own.
MIN_JUDGED, MIN_REFERENCE = 200, 10_000
#: Languages up to so many are broadcast.
MAX_BROADCAST = 1000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text."""
    def hashes(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
        )

    def repeats(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        starts = let(
            placed,
            lambda s: F.filter(
                s,
                lambda x, i: (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)))
                | (F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
            ),
        )
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        covered = F.aggregate(
            F.sort_array(F.transform(starts, lambda x: x["p"])),
            zero,
            lambda acc, p: F.struct(
                (acc["n"] + p + WINDOW - F.greatest(acc["end"], p)).alias("n"), (p + WINDOW).alias("end")
            ),
            lambda acc: acc["n"],
        )
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered).otherwise(0)

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > WINDOW, let(let(hashed, hashes), repeats)).otherwise(0).cast("long")


def features(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts and both histograms of every row of `docs`."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), text.alias("text"))
    no_blank = F.filter(F.split("text", SPACES), lambda w: w != "")
    common = F.filter(F.split(F.lower("text"), NOT_LETTERS), lambda w: w.isin(COMMON_WORDS))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    cut = rows.select(
        "doc_id", "lang", "text", no_blank.alias("words"), common.alias("common"), lines.alias("lines"),
        F.length("text").alias("n_chars"), F.length(F.regexp_replace("text", SPACES, "")).alias("word_chars"),
        *[F.length(F.regexp_replace("text", p, "")).alias(f"_{c}") for c, p in NOT_CLASS.items()],
    )
    n_words = F.size("words")
    space = F.col("n_chars") - F.col("word_chars")
    lower = F.col("word_chars") - F.col("_upper") - F.col("_digit") - F.col("_mark") - F.col("_beyond")
    plain = F.col("_mark") - F.col("_symbol")
    classes = [lower, F.col("_upper"), F.col("_digit"), plain, F.col("_symbol"), space, F.col("_beyond")]
    listed = F.array(*[F.lit(w) for w in COMMON_WORDS])
    per_word = let(
        F.col("common"),
        lambda m: F.transform(listed, lambda c: F.size(m) - F.size(F.array_remove(m, c))),
    )
    return cut.select(
        "doc_id", "lang", n_words.cast("long").alias("n_words"), F.col("word_chars").cast("long"),
        F.col("_symbol").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.col("n_chars").cast("long").alias("n_chars"),
        F.array(*classes).cast("array<bigint>").alias("chars"),
        F.concat(per_word, F.array(n_words)).cast("array<bigint>").alias("common"),
    )


CLASSES = 7


def references(rows: DataFrame) -> DataFrame:
    """Both histograms of each language, and of all languages, summed over all documents: a row per language."""
    sizes = {"chars": CLASSES, "common": len(COMMON_WORDS) + 1}

    def totals(suffix: str, source: str) -> list[Column]:
        return [F.array(*[F.sum(F.col(f"{n}{source}")[i]) for i in range(k)]).alias(f"{n}{suffix}") for n, k in sizes.items()]

    own = materialize(rows.groupBy("lang").agg(*totals("_ref", "")), "references")
    return own.crossJoin(F.broadcast(own.agg(*totals("_all", "_ref"))))


def with_languages(rows: DataFrame, languages: DataFrame) -> DataFrame:
    """`rows` with the columns of their language.

    Few languages are broadcast, after they are counted, so that rows of a common one need not meet in one task.
    """
    few = languages.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    return rows.join(F.broadcast(languages) if few else languages, "lang")


def limits(far: DataFrame) -> DataFrame:
    """lang, char_limit, word_limit: the distances that a document of a language may have.

    A limit is the median of the distances of all documents that are long enough to be judged, and so many
    times the way from there to the upper quartile (LEAST_SPREADS at least). Quantiles are read from counts per BIN,
    so that no distances are ordered. Languages of fewer than MIN_JUDGED documents take the limits of all languages.
    """
    halves = F.array(
        *[
            F.struct(F.lit(h).alias("half"), F.when(F.col(f"{h}_judged"), F.floor(F.col(f"{h}_distance") / BIN)).alias("bin"))
            for h in ("char", "word")
        ]
    )
    counts = far.select("lang", F.inline(halves)).where("bin is not null").groupBy("lang", "half", "bin").agg(F.count("*").alias("n"))
    counts = materialize(counts, "distance-counts")
    whole = counts.groupBy("half", "bin").agg(F.sum("n").alias("n"))

    def quantiles(table: DataFrame, key: list[str]) -> DataFrame:
        order = Window.partitionBy(*key).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        placed = table.withColumns({"below": F.sum("n").over(order), "total": F.sum("n").over(Window.partitionBy(*key))})
        found = placed.groupBy(*key).agg(
            F.min(F.when(F.col("below") * 2 >= F.col("total"), F.col("bin"))).alias("middle"),
            F.min(F.when(F.col("below") * 4 >= 3 * F.col("total"), F.col("bin"))).alias("upper"),
            F.max("total").alias("total"),
        )
        word = F.col("half") == "word"
        spread = F.greatest(F.col("upper") - F.col("middle"), F.when(word, LEAST_SPREADS["word"]).otherwise(LEAST_SPREADS["char"]))
        times = F.when(word, SPREADS["word"]).otherwise(SPREADS["char"])
        return found.select(*key, ((F.col("middle") + times * spread + 1) * BIN).alias("limit"), "total")

    def pick(half: str) -> Column:
        return F.max(F.when(F.col("half") == half, F.col("limit"))).alias(f"{half}_limit")

    own = quantiles(counts, ["lang", "half"]).where(F.col("total") >= MIN_JUDGED).groupBy("lang").agg(pick("char"), pick("word"))
    pooled = quantiles(whole, ["half"]).agg(*[pick(h).alias(f"{h}_pooled") for h in ("char", "word")])
    named = far.select("lang").distinct().join(own, "lang", "left").crossJoin(F.broadcast(pooled))
    chosen = [F.coalesce(f"{h}_limit", f"{h}_pooled", F.lit(1.0)).alias(f"{h}_limit") for h in ("char", "word")]
    return materialize(named.select("lang", *chosen), "limits")


def shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda n: n / F.greatest(total, F.lit(1)))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of shares."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    total = F.aggregate(terms, F.lit(0.0).cast("double"), lambda acc, t: acc + t)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def char_shares(counts: Column) -> Column:
    return let(counts, lambda c: shares(c, F.aggregate(c, F.lit(0).cast("long"), lambda acc, n: acc + n)))


def word_shares(counts: Column) -> Column:
    """Shares of the common words, and of all other words, in all words."""
    k = len(COMMON_WORDS)

    def body(c: Column) -> Column:
        listed = F.slice(c, 1, k)
        known = F.aggregate(listed, F.lit(0).cast("long"), lambda acc, n: acc + n)
        # Splitting at other signs than white space can give more common words than words.
        return let(
            F.concat(listed, F.array(F.greatest(F.get(c, F.lit(k)) - known, F.lit(0).cast("long")))), char_shares
        )

    return let(counts, body)


def distances(rows: DataFrame) -> DataFrame:
    """`rows` without their histograms, with the distances from the reference of their language.

    A document has no part in its own reference. A language of fewer than MIN_REFERENCE words beside
    the document is compared with the pooled reference of all languages.
    """
    k = len(COMMON_WORDS)
    few = (F.get("common_ref", F.lit(k)) - F.get("common", F.lit(k))) < MIN_REFERENCE

    def rest(name: str) -> Column:
        reference = F.when(few, F.col(f"{name}_all")).otherwise(F.col(f"{name}_ref"))
        return F.zip_with(reference, F.col(name), lambda a, b: a - b)

    both = with_languages(rows, materialize(references(rows), "references"))
    kept = [c for c in rows.columns if c not in ("chars", "common")]
    return both.select(
        *kept,
        distance(char_shares(F.col("chars")), char_shares(rest("chars"))).alias("char_distance"),
        distance(word_shares(F.col("common")), word_shares(rest("common"))).alias("word_distance"),
        (F.col("n_chars") >= MIN_CHARS).alias("char_judged"),
        (F.col("n_words") >= MIN_WORDS).alias("word_judged"),
    )


def judge(docs: DataFrame) -> DataFrame:
    """The base counts, both distances and the verdict of every row of `docs`.

    References are the histograms of all other documents of a language (see `distances`), and limits come
    from the spread of all distances in it (see `limits`); documents without a language are one of their
    own. A document fails by the base rule (few words, or many in repeated windows), or if it is long
    enough and further from its language than allowed. A missing text is empty, has no words and fails.
    Repeated rows are judged each and counted each; other columns are ignored; an empty table gives an
    empty one.
    """
    far = materialize(distances(materialize(features(docs), "features")), "distances")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    odd = (F.col("char_judged") & (F.col("char_distance") > F.col("char_limit"))) | (
        F.col("word_judged") & (F.col("word_distance") > F.col("word_limit"))
    )
    return with_languages(far, limits(far)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~odd).alias("kept"), F.round("char_distance", 6).alias("char_distance"),
        F.round("word_distance", 6).alias("word_distance"),
    )
