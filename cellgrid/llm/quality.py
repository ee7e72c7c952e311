"""Quality classifier: a generalised additive model with pairwise interactions.

Training visits the features in turn; each visit fits a shallow tree to the current gradients over the
feature's bins and adds it to that feature's lookup table.  The strongest pairs left in the residuals
get two-dimensional tables in the same way.  A score is a sum of table entries, one gather per term.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._store import fold
from cellgrid.llm._text import Words, byte_class, grams, pieces, words

FEATURES = ("log_words", "word_length", "word_length_spread", "distinct_words", "distinct_pairs", "repeats_before", "longest_run", "symbols", "upper", "digits", "one_byte_words", "symbol_words", "end_symbols", "lines", "distinct_lines", "high_bytes", "upper_words")

_SYMBOL = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_UPPER = byte_class((0x41, 0x5A))
_DIGIT = byte_class((0x30, 0x39))
_HIGH = byte_class((0x80, 0xFF))
_NEWLINE = byte_class((0x0A, 0x0A), (0x0D, 0x0D))
_NOT_NEWLINE = ~_NEWLINE


def _per_text(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[cuts[1:]] - sums[cuts[:-1]]


def _distinct(doc: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys of each text."""
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (k[1:] != k[:-1])
    return np.bincount(d[new], minlength=n).astype(np.float64)


def _longest_run(same: np.ndarray, w: Words) -> np.ndarray:
    """Words in the longest run of equal words of each text; same[i]: word i equals the word before it in its text."""
    n = len(w.first) - 1
    begins = np.flatnonzero(~same)
    length = np.diff(np.concatenate([begins, [len(same)]]))
    out = np.zeros(n)
    if len(begins):
        np.maximum.at(out, w.doc()[begins], length)
    return out


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each whole text. Every share has the pseudo-count 1 below it, so empty texts give zeros."""
    w = words(texts)
    n, doc, h = len(texts), w.doc(), w.hashes()
    count = w.counts.astype(np.float64)
    size = np.diff(w.offsets).astype(np.float64)
    length = (w.end - w.start).astype(np.float64)
    same = np.zeros(len(w), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    tail = _SYMBOL[w.data[w.end - 1]] if len(w) else np.empty(0, dtype=bool)
    symbol, upper = _SYMBOL[w.data], _UPPER[w.data]
    symbols_before = np.concatenate([[0], np.cumsum(symbol)])
    upper_before = np.concatenate([[0], np.cumsum(upper)])
    word_symbols = symbols_before[w.end] - symbols_before[w.start]
    word_upper = upper_before[w.end] - upper_before[w.start]
    pair = grams(h, 2)
    pair_doc = doc[: len(pair)][doc[: len(pair)] == doc[1:]] if len(pair) else doc[:0]
    pair = pair[doc[: len(pair)] == doc[1:]] if len(pair) else pair
    lines = words(texts, _NOT_NEWLINE)
    line_count = lines.counts.astype(np.float64)
    mean = _per_text(length, w.first) / (count + 1)
    return np.column_stack([
        np.log1p(count),
        mean,
        np.sqrt(np.maximum(_per_text(length**2, w.first) / (count + 1) - mean**2, 0)),
        _distinct(doc, h, n) / (count + 1),
        _distinct(pair_doc, pair, n) / (count + 1),
        _per_text(same, w.first) / (count + 1),
        _longest_run(same, w) / (count + 1),
        _per_text(symbol, w.offsets) / (size + 1),
        _per_text(upper, w.offsets) / (size + 1),
        _per_text(_DIGIT[w.data], w.offsets) / (size + 1),
        _per_text(length == 1, w.first) / (count + 1),
        _per_text(word_symbols == length, w.first) / (count + 1),
        _per_text(tail, w.first) / (count + 1),
        line_count / (count + 1),
        _distinct(lines.doc(), lines.hashes(), n) / (line_count + 1),
        _per_text(_HIGH[w.data], w.offsets) / (size + 1),
        _per_text((word_upper > 1) & (word_upper * 2 > length), w.first) / (count + 1),
    ])


@dataclass
class Gam:
    """base + the sum of tables[f][bin of f] + the sum of pair tables; edges[f] are a feature's upper bin edges."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="left")]
        for (f, g), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.pair_edges[f], x[:, f], side="left"), np.searchsorted(self.pair_edges[g], x[:, g], side="left")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A piecewise constant step over bins from their gradient and curvature sums: best splits first, up to `leaves` parts."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best: tuple[float, int, int] = (1e-9, -1, -1)
        for i, (a, z) in enumerate(parts):
            if z - a < 2:
                continue
            gl, hl = np.cumsum(g[a:z])[:-1], np.cumsum(h[a:z])[:-1]
            gs, hs = g[a:z].sum(), h[a:z].sum()
            gains = _gain(gl, hl, ridge) + _gain(gs - gl, hs - hl, ridge) - _gain(gs, hs, ridge)
            j = int(np.argmax(gains))
            if gains[j] > best[0]:
                best = (float(gains[j]), i, a + j + 1)
        if best[1] < 0:
            break
        a, z = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(a, best[2]), (best[2], z)]
    out = np.zeros(len(g))
    for a, z in parts:
        out[a:z] = g[a:z].sum() / (h[a:z].sum() + ridge)
    return out


def _quad(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """The best cut of a two-dimensional table at one row and one column: its four steps and its gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    def corners(c: np.ndarray) -> list[np.ndarray]:
        a, b, d = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        return [a, b - a, d - a, c[-1, -1] - b - d + a]

    gs, hs = corners(cg), corners(ch)
    gains = sum(_gain(x, np.maximum(y, 0), ridge) for x, y in zip(gs, hs, strict=True))
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    out = np.empty_like(g)
    for x, y, rows, columns in zip(gs, hs, (slice(0, i + 1), slice(0, i + 1), slice(i + 1, None), slice(i + 1, None)), (slice(0, j + 1), slice(j + 1, None)) * 2, strict=True):
        out[rows, columns] = x[i, j] / (max(y[i, j], 0) + ridge)
    return out, float(gains[i, j])


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0)


def fit_gam(x: np.ndarray, y: np.ndarray, bins: int = 32, pair_bins: int = 8, rounds: int = 120, pair_rounds: int = 60, n_pairs: int = 6, rate: float = 0.1, leaves: int = 4, ridge: float = 2.0) -> Gam:
    """Fit on features and 0/1 labels. One label only, or no rows, gives that label's smoothed log odds everywhere."""
    n_features = x.shape[1]
    p = (y.sum() + 1) / (len(y) + 2)
    model = Gam(float(np.log(p / (1 - p))), [_edges(x[:, f], bins) for f in range(n_features)], [], [], [_edges(x[:, f], pair_bins) for f in range(n_features)], [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    if not 0 < y.sum() < len(y):
        return model
    at = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(model.edges)]
    margin = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-margin))
        return y - q, q * (1 - q)

    for _ in range(rounds):
        for f in range(n_features):
            g, h = slopes()
            size = len(model.tables[f])
            step = rate * _tree(np.bincount(at[f], g, size), np.bincount(at[f], h, size), leaves, ridge)
            model.tables[f] += step
            margin += step[at[f]]
    coarse = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(model.pair_edges)]
    shape = [len(e) + 1 for e in model.pair_edges]

    def squares(f: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        key, n = coarse[f] * shape[k] + coarse[k], shape[f] * shape[k]
        return np.bincount(key, g, n).reshape(shape[f], shape[k]), np.bincount(key, h, n).reshape(shape[f], shape[k])

    able = [(f, k) for f, k in combinations(range(n_features), 2) if shape[f] > 1 and shape[k] > 1]
    model.pairs = sorted(able, key=lambda fk: -_quad(*squares(*fk), ridge)[1])[:n_pairs]
    model.pair_tables = [np.zeros((shape[f], shape[k])) for f, k in model.pairs]
    for _ in range(pair_rounds):
        for i, (f, k) in enumerate(model.pairs):
            step = rate * _quad(*squares(f, k), ridge)[0]
            model.pair_tables[i] += step
            margin += step[coarse[f], coarse[k]]
    return model


def train_quality(docs: DataFrame, labels: DataFrame, most: int = 20_000, folds: int = 3, held_out: int = 1, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Gam:
    """Fit on at most `most` labelled documents outside the held-out fold, chosen by a hash of the id.

    The chosen ids (a bounded list) go to the scan; texts become features where they lie and only these come
    back. Rows whose label is null are left out.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & (fold(doc_id, folds) != held_out))
    chosen = chosen.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)
    few = docs.sparkSession.createDataFrame(chosen.collect(), chosen.schema)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(few), "doc_id").select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            x = features(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), type=pa.list_(pa.float64())), b.column(1)], names=["x", "label"])

    got = rows.mapInArrow(run, "x array<double>, label int").toArrow()
    x = np.array(got.column("x").to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    y = np.array(got.column("label").to_pylist(), dtype=np.float64)
    order = np.lexsort((*x.T, y))  # the fit doesn't depend on how rows arrive
    return fit_gam(x[order], (y[order] > 0).astype(np.float64))


def score_quality(docs: DataFrame, model: Gam, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every row, in one narrow pass over whole texts; null texts score as empty ones."""
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(features(b.column(1))))], names=["doc_id", "score"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kinds[doc_id]}, score double")


def keep_good(docs: DataFrame, model: Gam, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of docs, unchanged, whose score is at least `least`."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)
    safe = docs.toDF(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, names[at]):
            yield b.filter(pa.array(model.score(features(b.column(at))) >= least))

    return safe.mapInArrow(run, safe.schema).toDF(*docs.columns)
