"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample
of labelled rows. It labels every byte of every text; a document's probabilities are
the means over its bytes. Texts run through it in windows of `WINDOW` bytes, all
windows of a slice side by side.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, map_slices, raw_texts, slices, stratified, texts

WINDOW = 64
#: Windows that run side by side with up to so many languages; with more, fewer.
LANES, LANES_CLASSES = 2048, 64
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
PAD = 0x20


@dataclass
class Cell:
    """One direction: what a byte and the previous state add to the gates."""

    by_byte: np.ndarray  # 256 x 3 units: update, reset, candidate
    by_state: np.ndarray  # units x 3 units


@dataclass
class Network:
    languages: list[str]
    ahead: Cell
    back: Cell
    read_ahead: np.ndarray
    read_back: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [
            self.ahead.by_byte, self.ahead.by_state, self.back.by_byte, self.back.by_state,
            self.read_ahead, self.read_back, self.bias,
        ]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _states(cell: Cell, grid: np.ndarray) -> np.ndarray:
    """States after each byte of `grid` (steps x lanes): steps x units x lanes."""
    units = cell.by_state.shape[0]
    # Halved gate weights turn the logistic function into one tanh.
    scale = np.repeat(np.array([0.5, 0.5, 1.0], np.float32), units)
    by_byte = np.ascontiguousarray((cell.by_byte * scale).T)
    by_state = np.ascontiguousarray((cell.by_state * scale).T)
    steps, lanes = grid.shape
    out = np.empty((steps, units, lanes), np.float32)
    state = np.zeros((units, lanes), np.float32)
    for t in range(steps):
        seen = by_byte.take(grid[t], axis=1)
        held = by_state @ state
        gates, fresh, kept = seen[: 2 * units], seen[2 * units :], held[2 * units :]
        gates += held[: 2 * units]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        kept *= gates[units:]
        fresh += kept
        np.tanh(fresh, out=fresh)
        state = np.subtract(state, fresh, out=out[t])
        state *= gates[:units]
        state += fresh
    return out


def byte_probabilities(net: Network, grid: np.ndarray) -> np.ndarray:
    """Probability of each language at each byte of `grid`: steps x languages x lanes."""
    scores = net.read_ahead.T @ _states(net.ahead, grid)
    scores += net.read_back.T @ _states(net.back, grid[::-1])[::-1]
    scores += net.bias[:, None]
    return _softmax(scores)


def _softmax(x: np.ndarray) -> np.ndarray:
    """Over the middle axis; states are within 1, so the scores cannot overflow."""
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def document_probabilities(net: Network, docs: list[bytes]) -> np.ndarray:
    """Mean byte probabilities of each document; zeros for an empty one."""
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    windows = -(-sizes // WINDOW)
    total = int(windows.sum())
    sums = np.zeros((len(docs), len(net.languages)))
    if not total:
        return sums
    pad = bytes([PAD])
    joined = b"".join(d + pad * (-len(d) % WINDOW) for d in docs)
    grid = np.frombuffer(joined, np.uint8).reshape(total, WINDOW)
    owner = np.repeat(np.arange(len(docs)), windows)
    first = np.cumsum(windows) - windows
    inside = sizes[owner] - (np.arange(total) - first[owner]) * WINDOW  # real bytes of a window
    lanes = max(1, LANES * LANES_CLASSES // max(LANES_CLASSES, len(net.languages)))
    for at in range(0, total, lanes):
        part = np.ascontiguousarray(grid[at : at + lanes].T)
        found = byte_probabilities(net, part)
        real = np.arange(WINDOW)[:, None] < inside[at : at + lanes]
        if not real.all():
            found *= real[:, None, :]
        np.add.at(sums, owner[at : at + lanes], found.sum(axis=0).T)
    return sums / np.maximum(sizes, 1)[:, None]


def sample(docs: DataFrame, per_language: int, chars: int) -> DataFrame:
    """(lang, text): about `per_language` rows per language, `chars` characters of each.

    Rows are taken by a hash of their id, the passage starts at a place that the hash
    names. Empty texts take no part.
    """
    order = F.xxhash64("doc_id")
    start = F.lit(1) + F.pmod(order, F.greatest(F.lit(1), F.length("text") - F.lit(chars))).cast("int")
    rows = docs.where("text <> ''").select("lang", "doc_id", "text")
    passage = F.call_function("substring", "text", start, F.lit(chars)).alias("text")
    return stratified(rows, "lang", order, per_language).select("lang", passage)


def _cell_backward(cell: Cell, grid: np.ndarray, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of one direction, through time, given those of its states."""
    units = cell.by_state.shape[0]
    steps, lanes = grid.shape
    state = np.zeros((lanes, units), np.float32)
    kept = []
    for t in range(steps):
        seen, held = cell.by_byte[grid[t]], state @ cell.by_state
        update = _sigmoid(seen[:, :units] + held[:, :units])
        reset = _sigmoid(seen[:, units : 2 * units] + held[:, units : 2 * units])
        fresh = np.tanh(seen[:, 2 * units :] + reset * held[:, 2 * units :])
        kept.append((state, update, reset, fresh, held[:, 2 * units :]))
        state = fresh + update * (state - fresh)
    d_state = np.zeros((lanes, units), np.float32)
    d_by_state = np.zeros_like(cell.by_state)
    d_seen = np.empty((steps, lanes, 3 * units), np.float32)
    for t in range(steps - 1, -1, -1):
        before, update, reset, fresh, held = kept[t]
        d = d_out[t] + d_state
        d_fresh = d * (1 - update) * (1 - fresh * fresh)
        d_update = d * (before - fresh) * update * (1 - update)
        d_reset = d_fresh * held * reset * (1 - reset)
        d_held = np.concatenate([d_update, d_reset, d_fresh * reset], axis=1)
        d_by_state += before.T @ d_held
        d_state = d * update + d_held @ cell.by_state.T
        d_seen[t] = np.concatenate([d_update, d_reset, d_fresh], axis=1)
    d_by_byte = np.zeros_like(cell.by_byte)
    np.add.at(d_by_byte, grid.ravel(), d_seen.reshape(-1, 3 * units))
    return d_by_byte, d_by_state


def fit(
    rows: list[tuple[str, bytes]], units: int = 8, steps: int = 600, lanes: int = 96, seed: int = 7
) -> Network:
    """Train on (language, text) rows with Adam; languages with a text count alike."""
    languages = sorted({lang for lang, text in rows if text})
    by_lang = [[t for lang, t in rows if lang == x and t] for x in languages]
    rng = np.random.default_rng(seed)
    classes = len(languages)

    def normal(*shape: int, size: float) -> np.ndarray:
        return (rng.standard_normal(shape) * size).astype(np.float32)

    def cell() -> Cell:
        return Cell(normal(256, 3 * units, size=0.3), normal(units, 3 * units, size=units**-0.5))

    net = Network(
        languages, cell(), cell(), normal(units, classes, size=0.3), normal(units, classes, size=0.3),
        np.zeros(classes, np.float32),
    )
    if classes < 2:
        return net
    weights = net.arrays()
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        label = rng.integers(classes, size=lanes)
        grid = np.full((WINDOW, lanes), PAD, np.uint8)
        for lane, c in enumerate(label.tolist()):
            text = by_lang[c][rng.integers(len(by_lang[c]))]
            at = int(rng.integers(max(1, len(text) - WINDOW + 1)))
            piece = np.frombuffer(text[at : at + WINDOW], np.uint8)
            grid[: len(piece), lane] = piece
        ahead = _states(net.ahead, grid).swapaxes(1, 2)
        back = _states(net.back, grid[::-1])[::-1].swapaxes(1, 2)
        d = byte_probabilities(net, grid).swapaxes(1, 2)
        d[:, np.arange(lanes), label] -= 1
        d /= grid.size
        flat = d.reshape(-1, classes)
        grads = [
            *_cell_backward(net.ahead, grid, d @ net.read_ahead.T),
            *_cell_backward(net.back, grid[::-1], (d @ net.read_back.T)[::-1]),
            ahead.reshape(-1, units).T @ flat, back.reshape(-1, units).T @ flat, flat.sum(0),
        ]
        rate = 0.02 * (1 - step / (steps + 1)) + 0.001
        for w, g, m, s in zip(weights, grads, mean, square, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


def train(docs: DataFrame, per_language: int = 300, chars: int = 1000) -> Network | None:
    """A network fitted on a sample of the labelled rows of `docs`; None without any.

    About `per_language` rows of each language (fewer beyond a thousand languages, none
    is left out), and `chars` characters of each, reach the driver.
    """
    rows = [(r["lang"], r["text"].encode()) for r in sample(docs, per_language, chars).collect()]
    return fit(sorted(rows)) if rows else None


def judge(net: Network | None, piece: pa.RecordBatch) -> tuple[list[str], list[float]]:
    """Language and its mean probability for each text of a slice."""
    shown = [bool(LETTER.search(t)) for t in texts(piece)]
    if net is None or not any(shown):
        return [UNDETERMINED] * len(shown), [0.0] * len(shown)
    found = document_probabilities(net, [t if s else b"" for t, s in zip(raw_texts(piece), shown, strict=True)])
    best = found.argmax(axis=1)
    names = [net.languages[b] if s else UNDETERMINED for b, s in zip(best.tolist(), shown, strict=True)]
    return names, np.clip(found.max(axis=1), 0, 1).tolist()


def predict(docs: DataFrame, net: Network | None, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (doc_id) with lang_pred and score, for every row of `docs`.

    A text that is missing or has no letter is `und` with score 0; so is every text
    when there is no network. Equal texts get equal answers, repeated rows an answer
    each; other columns are ignored; an empty table gives an empty one.
    """
    keep = keep or ["doc_id"]

    def make():
        def work(piece: pa.RecordBatch):
            names, scores = judge(net, piece)
            return {c: piece.column(c) for c in keep} | {"lang_pred": names, "score": scores}

        return work

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_slices(docs.select(*keep, "text"), f"{kinds}, lang_pred string, score double", make)


def keep_known(docs: DataFrame, net: Network | None, min_score: float) -> DataFrame:
    """The rows of `docs` with a language and at least `min_score`, all columns kept.

    Rows whose text is missing, empty or without a letter have no language and go, as do all rows
    without a network. Very long texts are read whole; repeated rows are judged each; ids may be
    missing. An empty table gives an empty one; columns may have any names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            names, scores = judge(net, piece)
            good = [n != UNDETERMINED and s >= min_score for n, s in zip(names, scores, strict=True)]
            yield piece.filter(pa.array(good, pa.bool_()))

    return map_batches(docs, run, docs.schema)
