"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed terms. Besides a weight, each term has a short vector;
two terms that occur together add the product of their vectors, so a pair can count for
more, or less, than its parts. The machine is trained in numpy on a bounded sample of
labelled rows, over all terms that a few of them have.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_slices, raw_texts, stratified

#: Hash buckets of terms.
BUCKETS = 1 << 18
#: Letters; everything outside ASCII counts as one.
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Texts of the sample that a bucket must be in to be weighed.
MIN_DOCS = 5
#: Bins of pairs of terms, texts that a pair must be in, different terms of a text whose pairs count.
PAIR_BINS, PAIR_DOCS, PAIR_TERMS = 1 << 21, 20, 400
#: Standard deviations by which a pair stands out, about once by chance in 10^8 pairs, and pairs with vectors at most.
PAIR_SIGMA, MAX_PAIRS = 5.5, 256
#: Pairs handled at a time.
PAIR_CHUNK = 1 << 18
#: Thresholds that `fit_chosen` tries, and rows of either label that it needs on both sides for that.
THRESHOLDS = (0.1, 0.25, 0.5)
LEAST_CHOICE = 10


def term_buckets(text: bytes) -> np.ndarray:
    """The different hash buckets of a text's terms, in order."""
    terms = set(TERM.findall(text.lower()))
    return np.unique(np.fromiter(map(crc32, terms), np.uint32, len(terms)) % BUCKETS).astype(np.int32)


@dataclass
class Machine:
    """bias + sum of weights + sum over pairs of products of vectors, as a log-odds."""

    slot: np.ndarray  # place of each bucket, -1 for none
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def score(self, buckets: list[np.ndarray]) -> np.ndarray:
        """Probability of the label for each set of buckets."""
        places = [s[s >= 0] for s in (self.slot[b] for b in buckets)]
        sizes = np.fromiter(map(len, places), np.int64, len(places))
        odds = np.full(len(places), self.bias)
        full = np.flatnonzero(sizes)
        if len(full):
            flat = np.concatenate([places[i] for i in full])
            starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            vectors = self.vectors[flat]
            sums = np.add.reduceat(vectors, starts)
            squares = np.add.reduceat(vectors * vectors, starts)
            odds[full] += np.add.reduceat(self.weights[flat], starts)
            odds[full] += 0.5 * (sums * sums - squares).sum(axis=1)
        return 0.5 * np.tanh(0.5 * odds) + 0.5


def known_terms(buckets: list[np.ndarray]) -> np.ndarray:
    """The buckets that MIN_DOCS texts or more have, whatever their labels."""
    seen = np.bincount(np.concatenate([np.empty(0, np.int32), *buckets]), minlength=BUCKETS)
    return np.flatnonzero(seen >= MIN_DOCS)


def strong_pairs(places: list[np.ndarray], miss: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of terms that go with what the weights leave unexplained, and the log-odds they ask for.

    `miss` is each text's label less its probability and `spread` the variance of that label,
    both times the text's weight. From each text's `miss` the means of the two terms, less that of all
    texts, are taken first: what one term alone explains is no pair's. A pair stands out if the sum over its
    texts is PAIR_SIGMA times its chance spread; the MAX_PAIRS strongest are given. Sums are
    taken in hash bins first, and the pairs of bins that stand out are then told apart. Pairs in fewer than PAIR_DOCS texts do not count, nor do
    texts of more than PAIR_TERMS different terms.
    """
    flat = np.concatenate([np.empty(0, np.int64), *places])
    seen = np.bincount(flat)
    alone = np.bincount(flat, np.repeat(miss, [len(p) for p in places])) / np.maximum(seen, 1) - miss.mean() / 2
    frequent = [np.sort(p[seen[p] >= PAIR_DOCS]).astype(np.int64) for p in places]
    used = [i for i, p in enumerate(frequent) if 1 < len(p) <= PAIR_TERMS]

    def chunks() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of some texts, their bins, and the texts' numbers."""
        held, owners, size = [], [], 0
        for i in used:
            a, b = np.triu_indices(len(frequent[i]), 1)
            held.append(frequent[i][a] * len(seen) + frequent[i][b])
            owners.append(np.full(len(a), i))
            size += len(a)
            if size >= PAIR_CHUNK or i == used[-1]:
                pairs = np.concatenate(held)
                yield pairs, (pairs * 0x9E3779B1 >> 7) & (PAIR_BINS - 1), np.concatenate(owners)
                held, owners, size = [], [], 0

    def sums(pairs: np.ndarray, at: np.ndarray, owner: np.ndarray, size: int) -> Iterator[np.ndarray]:
        """Per place the sum of what the pairs leave unexplained, of its squares, and the number of texts."""
        own = miss[owner] - alone[pairs // len(seen)] - alone[pairs % len(seen)]
        yield np.bincount(at, own, size)
        yield np.bincount(at, own * own, size)
        yield np.bincount(at, minlength=size)

    def stands_out(total: np.ndarray, squares: np.ndarray, count: np.ndarray) -> np.ndarray:
        return (count >= PAIR_DOCS) & (np.abs(total) > PAIR_SIGMA * np.sqrt(squares))

    # One table of bins at a time, in floats: the driver holds little beside them.
    binned = np.zeros((3, PAIR_BINS), np.float32)
    for pairs, at, owner in chunks():
        for table, part in zip(binned, sums(pairs, at, owner, PAIR_BINS), strict=True):
            table += part
    bins = stands_out(*binned)
    del binned
    kept = [(pairs[bins[at]], owner[bins[at]]) for pairs, at, owner in chunks()] if bins.any() else []
    if not kept:
        return np.empty((0, 2), np.int64), np.empty(0)
    found, owner = (np.concatenate(x) for x in zip(*kept))
    pairs, at = np.unique(found, return_inverse=True)
    own = list(sums(found, at, owner, len(pairs)))
    good = np.flatnonzero(stands_out(*own))
    strength = np.abs(own[0][good]) / np.sqrt(own[1][good])
    good = good[np.argsort(-strength, kind="stable")][:MAX_PAIRS]
    effect = own[0] / (np.bincount(at, spread[owner], len(pairs)) + 1)
    return np.stack([pairs[good] // len(seen), pairs[good] % len(seen)], 1), np.clip(effect[good], -4, 4)


def starting_vectors(pairs: np.ndarray, effects: np.ndarray, terms: int, factors: int) -> np.ndarray:
    """Vectors whose products are as near to the pairs' effects as `factors` dimensions allow; zero for other terms."""
    out = np.zeros((terms, factors), np.float32)
    if len(pairs):
        own, at = np.unique(pairs, return_inverse=True)
        wanted = np.zeros((len(own), len(own)))
        at = at.reshape(-1, 2)
        wanted[at[:, 0], at[:, 1]] = wanted[at[:, 1], at[:, 0]] = effects
        # The diagonal is free: products of a term with itself do not count.
        np.fill_diagonal(wanted, -np.linalg.eigvalsh(wanted)[0])
        size, directions = np.linalg.eigh(wanted)
        most = min(factors, len(own))
        out[own, :most] = directions[:, ::-1][:, :most] * np.sqrt(np.maximum(size[::-1][:most], 0))
    return out


def fit(
    buckets: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, factors: int = 8, steps: int = 400,
    decay: float = 0.02, threshold: float = 0.5, batch: int = 512, seed: int = 11, pairs: bool = True,
) -> Machine:
    """Train on weighted sets of buckets with Adam, `batch` sets a step.

    A weight is drawn to zero by `threshold` times the chance spread of its term's share
    between the labels. In the first half of the steps the weights learn alone. Vectors then
    start from the pairs that stand out in what the weights leave unexplained, and learn
    together with the weights, drawn to zero by `decay`; terms of no such pair keep a zero vector, so that
    texts of many terms are not learned by heart. Without `pairs` all vectors stay zero.
    """
    terms = known_terms(buckets)
    slot = np.full(BUCKETS, -1, np.int32)
    slot[terms] = np.arange(len(terms))
    places = [s[s >= 0] for s in (slot[b] for b in buckets)]
    sizes = np.fromiter(map(len, places), np.int64, len(places))
    share = np.bincount(np.concatenate([np.empty(0, np.int32), *places]), minlength=len(terms)) / len(places)
    rarer = max(1, np.bincount(labels, minlength=2).min())
    pull_back = threshold * 0.5 * np.sqrt(share * (1 - share) / rarer)
    rng = np.random.default_rng(seed)
    bias, w = np.zeros(1, np.float32), np.zeros(len(terms), np.float32)
    v = np.zeros((len(terms), factors), np.float32)
    active = np.empty(0, np.int64)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (bias, w, v)]
    part = weights / weights.mean()
    order, at = rng.permutation(len(places)), 0
    for step in range(1, steps + 1):
        if at >= len(order):
            order, at = rng.permutation(len(places)), 0
        rows, at = order[at : at + batch], at + batch
        flat = np.concatenate([np.empty(0, np.int32), *[places[i] for i in rows]])
        owner = np.repeat(np.arange(len(rows)), sizes[rows])

        def per_row(x: np.ndarray) -> np.ndarray:
            return np.bincount(owner, x, len(rows))

        def per_term(x: np.ndarray) -> np.ndarray:
            return np.bincount(flat, x[owner], len(terms))

        odds = bias + per_row(w[flat])
        if len(active):
            vectors = v[flat]
            sums = np.stack([per_row(vectors[:, f]) for f in range(factors)], axis=1)
            odds = odds + 0.5 * ((sums * sums).sum(1) - per_row((vectors * vectors).sum(1)))
        miss = (0.5 * np.tanh(0.5 * odds) + 0.5 - labels[rows]) * part[rows] / len(rows)
        own = per_term(miss)
        rate = 0.05 * (1 - step / (steps + 1))

        def moved(place: int, g: np.ndarray, since: int) -> tuple[np.ndarray, np.ndarray]:
            m, s = moments[place]
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            return m / (1 - 0.9**since), np.sqrt(s / (1 - 0.99**since)) + 1e-8

        mean, root = moved(0, miss.sum(keepdims=True), step)
        bias -= rate * mean / root
        mean, root = moved(1, own, step)
        w -= rate * mean / root
        w[:] = np.sign(w) * np.maximum(np.abs(w) - rate / root * pull_back, 0)
        if len(active):
            pull = np.stack([per_term(miss * sums[:, f])[active] for f in range(factors)], axis=1)
            mean, root = moved(2, pull + (decay - own[active, None]) * v[active], step - steps // 2)
            v[active] -= rate * mean / root
        if step == steps // 2 and pairs:
            chance = Machine(slot, float(bias[0]), w, v).score(buckets)
            found, effects = strong_pairs(places, (labels - chance) * part, chance * (1 - chance) * part)
            v = starting_vectors(found, effects, len(terms), factors)
            active = np.unique(found)
            moments[2] = tuple(np.zeros((len(active), factors), np.float32) for _ in range(2))
    return Machine(slot, float(bias[0]), w, v)


def fit_chosen(buckets: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, seed: int = 11) -> Machine:
    """`fit` with the threshold, and with vectors or without, that do best on a fifth of the rows when fitted on the rest.

    No row outside of those given has a part in the choice. The threshold is chosen for the weights
    alone. Too few rows of a label leave the choice at the defaults.
    """
    aside = np.random.default_rng(seed).random(len(buckets)) < 0.2
    if min(np.bincount(labels[aside], minlength=2).min(), np.bincount(labels[~aside], minlength=2).min()) < LEAST_CHOICE:
        return fit(buckets, labels, weights)
    inner, judged = np.flatnonzero(~aside), np.flatnonzero(aside)

    def loss(threshold: float, pairs: bool) -> float:
        machine = fit([buckets[i] for i in inner], labels[inner], weights[inner], threshold=threshold, pairs=pairs)
        p = np.clip(machine.score([buckets[i] for i in judged]), 1e-6, 1 - 1e-6)
        return float(np.average(-np.where(labels[judged] == 1, np.log(p), np.log(1 - p)), weights=weights[judged]))

    plain = {t: loss(t, False) for t in THRESHOLDS}
    threshold = min(plain, key=plain.get)
    return fit(buckets, labels, weights, threshold=threshold, pairs=loss(threshold, True) < plain[threshold])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 6000) -> Machine | None:
    """A machine fitted on a sample of labelled rows; None if a class has no row.

    About `per_class` rows of either class reach the driver, as hash buckets, and both
    classes weigh alike. Rows without text or label take no part.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", label).distinct()
    picked = stratified(known, label, F.xxhash64("doc_id"), per_class)

    def make():
        def work(piece: pa.RecordBatch):
            found = [term_buckets(t) for t in raw_texts(piece)]
            return {"doc_id": piece.column("doc_id"), "label": piece.column(label), "buckets": found}

        return work

    # The sample is at most two classes of `per_class` ids.
    whole = docs.select("doc_id", "text").where("text is not null")
    chosen = whole.join(F.broadcast(picked), "doc_id").select("doc_id", label, "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    hashed = map_slices(chosen, f"doc_id {kind}, label int, buckets array<int>", make)
    rows = hashed.toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    ys = rows["label"].to_numpy()
    if len(set(ys.tolist())) < 2:
        return None
    lists = rows["buckets"].combine_chunks()
    sets = np.split(lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy())[:-1])
    return fit_chosen(sets, ys, 1 / np.bincount(ys)[ys])


def judge(docs: DataFrame, machine: Machine | None, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (doc_id) with score and predicted, for every row of `docs`.

    A missing or empty text scores by the bias alone; without a machine every score is
    0. predicted is 1 from a score of one half. Equal texts get equal scores; repeated
    rows come out each; other columns are ignored; an empty table gives an empty one.
    """
    keep = keep or ["doc_id"]

    def make():
        def work(piece: pa.RecordBatch):
            if machine is None:
                scores = np.zeros(piece.num_rows)
            else:
                scores = machine.score([term_buckets(t) for t in raw_texts(piece)])
            own = {"score": scores, "predicted": (scores >= 0.5).astype(np.int32)}
            return {c: piece.column(c) for c in keep} | own

        return work

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_slices(docs.select(*keep, "text"), f"{kinds}, score double, predicted int", make)
