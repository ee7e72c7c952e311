"""Toxicity: a support vector machine on a subsequence string kernel, with Nystroem landmarks.

The kernel counts the common letter subsequences of two strings, each discounted by the stretch it
spans, so an insult with gaps or inserted characters stays near the plain one.  A unit is a word
without punctuation, a run of one-letter words put together, or a window of an overlong word. The machine
learns from labelled sentences, each of which stands for its worst unit; a text's score is a logistic link of
its worst unit's margin and of how many units are on the toxic side.  Only a unit that shares a subsequence of
the kernel's length with a landmark has a kernel value other than zero, which a bit-parallel longest common
subsequence finds first; so insults of fewer bytes than that have no value and are no landmarks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._store import fold
from cellgrid.llm._text import _LOWER, NON_SPACE, byte_class, flat, pieces, words

#: Length of the subsequences that the kernel counts, and the discount of each position they span.
LENGTH, DECAY = 4, 0.75
#: Longer words are read in windows of so many bytes, each starting STEP after the last: any 17 bytes in a row lie whole in one.
WINDOW, STEP = 24, 8
#: Runs of one-letter words are read in shorter windows, four bytes apart, so that an insult among other letters is a greater part of one.
SPACED = 20
#: Landmarks are at most this long: a state of the common subsequence fits 16 bits.
LANDMARK = 16

#: A clean sentence teaches something where its unit's kernel with a landmark is over this.
FAR = 0.1
#: What folds within the training rows choose from: costs of an example, and how near to a landmark the unit of a toxic
#: document's sentence must be for the sentence to be shown as toxic.
COSTS, NEARS, FOLDS = (1.0, 3.0, 10.0, 30.0), (0.35, 0.5, 0.65), 3
#: Documents that a rare unit is in at most, and hashes of rare units by which near copies are told.
RARE, KEYS = 20, 4
#: Share of landmarks that may be there by chance.
CHANCE = 0.1

_PUNCTUATION = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


def units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of texts as (bytes, start, end, text number)."""
    data, offsets = flat(texts)
    kept = ~_PUNCTUATION[data]
    moved = np.concatenate([[0], np.cumsum(kept)])[offsets]
    data = _LOWER[data[kept]]
    small = pa.StringArray.from_buffers(len(texts), pa.py_buffer(moved.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))
    w = words(small, NON_SPACE)
    doc, start, end = w.doc(), w.start, w.end
    length = end - start
    long = np.flatnonzero(length > WINDOW)
    short = length <= WINDOW
    starts, ends, docs, more = [start[short]], [end[short]], [doc[short]], []
    if len(long):
        n = -(-(length[long] - WINDOW) // STEP) + 1
        i = np.repeat(long, n)
        shift = (np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)) * STEP
        starts.append(start[i] + shift)
        ends.append(np.minimum(start[i] + shift + WINDOW, end[i]))
        docs.append(doc[i])
    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    lone = letters[end] - letters[start] == 1
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (lone[1:] & lone[:-1] & (doc[1:] == doc[:-1])).astype(np.int8), [0]])))
    at = len(data)
    for a, z in zip(edge[::2], edge[1::2] + 1, strict=True):
        if z - a >= LENGTH:
            run = np.concatenate([data[i:j] for i, j in zip(start[a:z], end[a:z], strict=True)])
            for s in range(0, max(len(run) - SPACED // 2, 1), SPACED // 5):  # the last windows are the run's end, from 20 bytes down to 10
                part = run[s : s + SPACED]
                more.append(part)
                starts.append(np.array([at]))
                ends.append(np.array([at + len(part)]))
                docs.append(doc[a : a + 1])
                at += len(part)
    if more:
        data = np.concatenate([data, *more])
    return data, np.concatenate(starts), np.concatenate(ends), np.concatenate(docs)


def _packed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rows of WINDOW bytes, padded with zero."""
    long = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(long, WINDOW)[start]
    rows[np.arange(WINDOW) >= (end - start)[:, None]] = 0
    return rows


def distinct_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of bytes of the distinct units, their place for each unit, text number of each unit)."""
    data, start, end, doc = units(texts)
    rows = np.ascontiguousarray(_packed(data, start, end))
    keys = rows.view([("a", "<u8"), ("b", "<u8"), ("c", "<u8")]).reshape(-1)
    folded = (keys["a"] * np.uint64(0x9E3779B97F4A7C15)) ^ (keys["b"] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)) ^ (keys["c"] * np.uint64(0x165667B19E3779F9) + np.uint64(7))
    _, first, place = np.unique(folded, return_index=True, return_inverse=True)
    same = (keys == keys[first[place]]) if len(keys) else np.empty(0, bool)
    if not same.all():  # two units of one folded key: compare them whole
        _, first, place = np.unique(keys, return_index=True, return_inverse=True)
    return rows[first], place, doc


def common_subsequence(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of rows (n x WINDOW bytes) and landmarks (m x LANDMARK bytes)."""
    m = len(landmarks)
    masks = np.zeros((256, m), dtype=np.uint16)
    for i in range(LANDMARK):
        masks[landmarks[:, i], np.arange(m)] |= np.uint16(1 << i)
    masks[0] = 0
    size = (landmarks > 0).sum(1)
    full = ((1 << size.astype(np.int64)) - 1).astype(np.uint16)
    state = np.repeat(full[None, :], len(rows), axis=0)
    width = int((rows > 0).sum(1).max()) if len(rows) else 0
    for t in range(width):
        u = state & masks[rows[:, t]]
        state = ((state + u) | (state - u)) & full
    zeros = full[None, :] & ~state
    return np.bitwise_count(zeros).astype(np.int8)


def subsequence_kernel(a: np.ndarray, b: np.ndarray, p: int = LENGTH, decay: float = DECAY) -> np.ndarray:
    """The kernel of rows a[i] and b[i], byte strings padded with zero (which matches nothing)."""
    n, m = a.shape[1], b.shape[1]
    before = np.ones((m + 1, n + 1, len(a)))  # level i: weighted subsequences of length i in prefixes
    out = np.zeros(len(a))
    square = decay * decay
    same = (a.T[None, :, :] == b.T[:, None, :]) & (a.T[None, :, :] > 0)
    for level in range(p):
        if level == p - 1:
            out = square * (before[:-1, :-1] * same).sum(axis=(0, 1))
            break
        now = np.zeros_like(before)
        for j in range(1, m + 1):
            run = np.zeros(len(a))
            for i in range(1, n + 1):
                run = decay * run + square * same[j - 1, i - 1] * before[j - 1, i - 1]
                now[j, i] = decay * now[j - 1, i] + run
        before = now
    return out


def _width(rows: np.ndarray) -> int:
    return max(int((rows > 0).sum(1).max()), 1) if len(rows) else 1


@dataclass
class ToxicModel:
    """Landmark rows, weights of the normalised kernel to each, offset, and the numbers of the logistic link."""

    landmarks: np.ndarray
    own: np.ndarray
    alpha: np.ndarray
    offset: float
    link: np.ndarray

    def kernel(self, rows: np.ndarray, chunk: int = 2000) -> np.ndarray:
        """Normalised kernel values of rows against the landmarks (n x m); exact, zero where no subsequence is shared."""
        out = np.zeros((len(rows), len(self.landmarks)), dtype=np.float32)
        for c in range(0, len(rows), 1 << 16):
            near = common_subsequence(rows[c : c + (1 << 16)], self.landmarks) >= LENGTH
            i, j = np.nonzero(near)
            size, own = (rows[c : c + (1 << 16)] > 0).sum(1), (self.landmarks > 0).sum(1)
            order = np.argsort(size[i] * 32 + own[j], kind="stable")  # pairs of like lengths share a table without padding
            i, j = i[order], j[order]
            for s in range(0, len(i), chunk):
                a, b = rows[c + i[s : s + chunk]], self.landmarks[j[s : s + chunk]]
                a, b = a[:, : _width(a)], b[:, : _width(b)]
                out[c + i[s : s + chunk], j[s : s + chunk]] = subsequence_kernel(a, b)
            some = np.unique(i)
            some = c + some[np.argsort(size[some], kind="stable")]
            for s in range(0, len(some), chunk):
                a = rows[some[s : s + chunk]]
                a = a[:, : _width(a)]
                out[some[s : s + chunk]] /= np.sqrt(subsequence_kernel(a, a))[:, None]
        out /= np.sqrt(self.own)[None, :]
        return out

    def margins(self, rows: np.ndarray) -> np.ndarray:
        return self.kernel(rows) @ self.alpha + self.offset

    def text_signs(self, texts: pa.Array) -> np.ndarray:
        """For each text: its worst unit's margin (bounded), the units on the toxic side, and their share."""
        rows, place, doc = distinct_units(texts)
        return text_signs(self.margins(rows)[place], doc, len(texts), self.offset)

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.text_signs(texts) @ self.link[:-1] + self.link[-1], -30, 30)))


def text_signs(margin: np.ndarray, doc: np.ndarray, n: int, offset: float, times: np.ndarray | None = None) -> np.ndarray:
    """The text-level columns from unit margins (each met `times` times); a text without units stands at the offset."""
    times = np.ones(len(margin)) if times is None else times
    worst = np.full(n, offset)
    np.maximum.at(worst, doc, margin)
    toxic = np.bincount(doc, np.clip(margin, 0, 1) * times, n)
    return np.column_stack([np.tanh(worst), np.log1p(toxic), 10 * toxic / (np.bincount(doc, times, n) + 10)])


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 60) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by Newton's steps over the examples inside the margin; the last
    weight is the offset's."""
    z = np.column_stack([x, np.ones(len(x))]) * y[:, None]
    w = np.zeros(z.shape[1])

    def loss(w: np.ndarray) -> float:
        return float(w @ w + (cost * np.maximum(1 - z @ w, 0) ** 2).sum()) / 2

    for _ in range(steps):
        short = 1 - z @ w
        some = short > 0
        c, inside = cost[some], z[some]
        step = np.linalg.solve(np.eye(len(w)) + (inside * c[:, None]).T @ inside, w - inside.T @ (c * short[some]))
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _link(signs: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression of the label on text-level columns by Newton's steps; the last number is the offset."""
    x = np.column_stack([signs, np.ones(len(signs))])
    v = np.zeros(x.shape[1])
    ridge = np.array([*[1e-2] * signs.shape[1], 1e-6])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(np.logaddexp(0, z).sum() - y @ z + (ridge * v * v).sum() / 2)

    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.diag(ridge), x.T @ (q - y) + ridge * v)
        size = 1.0
        while size > 1e-4 and loss(v - size * step) > loss(v):
            size /= 2
        v = v - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return v


@dataclass
class Bags:
    """Labelled sentences as sets of units: the distinct units, a row (unit, sentence, times) for each unit of a sentence, the
    document of each sentence, and each document's label and a hash of its text."""

    rows: np.ndarray
    unit: np.ndarray
    sentence: np.ndarray
    times: np.ndarray
    doc: np.ndarray
    label: np.ndarray
    tid: np.ndarray


def sentences(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The sentences of texts and the text number of each: cut after . ! ? before white space, and at line ends. Null has none."""
    parts = pc.split_pattern_regex(pc.fill_null(texts.cast(pa.string()), ""), pattern=r"[.!?]+[ \t]+|[\r\n]+")
    return parts.flatten(), np.repeat(np.arange(len(texts)), parts.value_lengths().to_numpy(zero_copy_only=False))


def bags_of(texts: pa.Array, labels: np.ndarray, tids: np.ndarray) -> Bags:
    parts, doc = sentences(texts)
    rows, place, sentence = distinct_units(parts)
    pair, times = np.unique(sentence.astype(np.int64) * max(len(rows), 1) + place, return_counts=True)
    return Bags(rows, pair % max(len(rows), 1), pair // max(len(rows), 1), times, doc, labels, tids)


def merged_bags(parts: list[Bags]) -> Bags:
    """One table of all; documents go by the hash of their text and their label, and those of one hash and label count once."""
    if not parts:
        return Bags(np.zeros((0, WINDOW), np.uint8), *(np.zeros(0, np.int64) for _ in range(6)))
    rows, place = np.unique(np.concatenate([p.rows for p in parts]).view(f"S{WINDOW}").reshape(-1), return_inverse=True)
    shift = lambda sizes: np.concatenate([[0], np.cumsum(sizes)])
    us, ss, ds = shift([len(p.rows) for p in parts]), shift([len(p.doc) for p in parts]), shift([len(p.label) for p in parts])
    unit = np.concatenate([place[us[i] + p.unit] for i, p in enumerate(parts)])
    sentence = np.concatenate([p.sentence + ss[i] for i, p in enumerate(parts)])
    doc = np.concatenate([p.doc + ds[i] for i, p in enumerate(parts)])
    label, tid = np.concatenate([p.label for p in parts]), np.concatenate([p.tid for p in parts])
    _, first = np.unique(np.stack([tid, label]), axis=1, return_index=True)
    number = np.full(len(label), -1)
    number[first] = np.arange(len(first))
    live = number[doc] >= 0
    order = np.argsort(number[doc[live]], kind="stable")
    again = np.full(len(doc), -1)
    again[np.flatnonzero(live)[order]] = np.arange(int(live.sum()))
    ok = again[sentence] >= 0
    by = np.lexsort((unit[ok], again[sentence[ok]]))
    times = np.concatenate([p.times for p in parts])
    return Bags(rows.view(np.uint8).reshape(-1, WINDOW), unit[ok][by], again[sentence[ok]][by], times[ok][by], number[doc[live]][order], label[first], tid[first])


def fit_toxicity(texts: list[str | None], labels: list[int], n_landmarks: int = 32) -> ToxicModel:
    """Fit on whole texts and 0/1 labels."""
    return fit_bags(merged_bags([bags_of(pa.array(texts, pa.string()), np.array(labels, dtype=np.int64), np.arange(len(texts)))]), n_landmarks)


def fit_bags(bags: Bags, n_landmarks: int = 32, rounds: int = 3) -> ToxicModel:
    """A multiple-instance support vector machine on labelled sentences (Andrews et al. 2003).

    A sentence stands for its unit of the largest margin. Sentences of clean documents are clean; those of toxic documents are
    toxic where that unit's kernel with a landmark is near enough, as a toxic document has clean sentences too. The machine
    learns both apart, then the units are chosen anew by its margins, for some rounds. Landmarks are units that toxic
    documents hold more often than chance explains, unlike each other; each is also shown with one inserted letter. The cost
    of an example and how near is enough are chosen by folds within these documents: the pair of the least loss on documents
    that it was not fitted on, plus the share of stretched landmarks on the clean side; ties go to the first pair.
    """
    rows, y = bags.rows, (bags.label > 0).astype(np.float64)
    d = bags.doc[bags.sentence]
    n_units = max(len(rows), 1)
    held = np.unique(d * n_units + bags.unit)
    good = np.bincount(held % n_units, (1 - y)[held // n_units], len(rows))
    chosen = _landmarks(rows, held % n_units, held // n_units, y, good, n_landmarks)
    if not len(chosen):
        p = (y.sum() + 1) / (len(y) + 2)
        none = np.zeros((0, LANDMARK), dtype=np.uint8)
        return ToxicModel(none, np.zeros(0), np.zeros(0), 0.0, np.array([0.0, 0.0, 0.0, np.log(p / (1 - p))]))
    landmarks = np.ascontiguousarray(rows[chosen][:, :LANDMARK])
    model = ToxicModel(landmarks, subsequence_kernel(landmarks, landmarks), np.zeros(len(chosen)), 0.0, np.zeros(4))
    k = model.kernel(rows)
    gram = np.clip(model.kernel(np.pad(landmarks, ((0, 0), (0, WINDOW - LANDMARK)))), 0, 1)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    whole = value > 1e-6
    root = vector[:, whole] / np.sqrt(value[whole])  # Nystroem: features whose dot products are the kernel on the landmarks
    near = model.kernel(_stretched(rows[chosen]))
    first = k.max(1) - good / max(good.max(), 1)  # before a machine is there: likeness to a landmark, less for what clean documents hold
    fold_of = _spread(bags.tid) % np.uint64(FOLDS)
    best = None
    for cost in COSTS:
        for least in NEARS:
            loss = 0.0
            for f in range(FOLDS):
                ours, theirs = fold_of != f, fold_of == f
                if not theirs.any() or len(np.unique(y[ours])) < 2:
                    continue
                alpha, offset, link = _machine(bags, k, near, root, first, y, ours, cost, least, rounds)
                z = text_signs((k @ alpha + offset)[bags.unit], d, len(y), offset, bags.times.astype(np.float64))[theirs] @ link[:-1] + link[-1]
                loss += float(np.logaddexp(0, np.where(y[theirs] > 0, -z, z)).mean()) + float(np.mean(near @ alpha + offset <= 0))
            if best is None or loss < best[0] - 1e-9:
                best = (loss, cost, least)
    model.alpha, model.offset, model.link = _machine(bags, k, near, root, first, y, np.ones(len(y), dtype=bool), *best[1:], rounds)
    return model


def _spread(tids: np.ndarray) -> np.ndarray:
    return (tids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def _machine(bags: Bags, k: np.ndarray, near: np.ndarray, root: np.ndarray, margin: np.ndarray, y: np.ndarray, ours: np.ndarray, price: float, least: float, rounds: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights of the landmarks, offset and link, fitted on the documents that are `ours`."""
    d = bags.doc[bags.sentence]
    able = np.flatnonzero((k.max(1) > FAR)[bags.unit] & ours[d])  # no other unit can stand for its sentence
    unit, sentence, bad = bags.unit[able], bags.sentence[able], y[d[able]] > 0
    for _ in range(rounds):
        plus, minus = (np.unique(_best(unit[of], sentence[of], margin)) for of in (bad, ~bad))
        plus, minus = plus[k[plus].max(1) > least], minus[k[minus].max(1) > FAR]
        x = np.vstack([k[plus], near, k[minus], np.zeros((1, k.shape[1]))]) @ root
        side = np.concatenate([np.ones(len(plus) + len(near)), -np.ones(len(minus) + 1)])
        cost = price * np.where(side > 0, max(1.0, (side < 0).sum() / max((side > 0).sum(), 1)), 1.0)
        w, offset = _svm(x, side, cost)
        alpha = root @ w
        margin = k @ alpha + offset
    signs = text_signs(margin[bags.unit], d, len(y), offset, bags.times.astype(np.float64))
    return alpha, offset, _link(signs[ours], y[ours])


def _chance(hits: np.ndarray, held: np.ndarray, share: float) -> np.ndarray:
    """A bound on the chance that so many of `held` documents are toxic: exp(-held * divergence of their share from `share`)."""
    if not 0 < share < 1:
        return np.ones(len(hits))
    q = np.divide(hits, held, out=np.zeros(len(hits)), where=held > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = np.where(q > 0, q * np.log(q / share), 0) + np.where(q < 1, (1 - q) * np.log((1 - q) / (1 - share)), 0)
    return np.where(q > share, np.exp(-held * apart), 1.0)


def _beyond_chance(hits: np.ndarray, held: np.ndarray, share: float) -> float:
    """The greatest chance that is still no accident among so many units (Benjamini and Hochberg 1995, at CHANCE); 0 if there is none. Units of one document are no test."""
    chance = np.sort(_chance(hits, held, share)[held >= 2])
    passed = np.flatnonzero(chance <= CHANCE * np.arange(1, len(chance) + 1) / max(len(chance), 1))
    return float(chance[passed[-1]]) if len(passed) else 0.0


def _best(unit: np.ndarray, group: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """The unit of the largest margin of each group, the first of equals."""
    order = np.lexsort((unit, -margin[unit], group))
    g = group[order]
    return unit[order][np.concatenate([[True], g[1:] != g[:-1]])] if len(g) else unit


def _independent(unit: np.ndarray, doc: np.ndarray, y: np.ndarray, n_units: int) -> np.ndarray:
    """How many toxic documents hold each unit, near copies of one document counted once.

    Documents are taken for copies if the rare units of both (held by at most RARE documents) have one least hash; of KEYS
    hashes, the one that gives the fewest counts.
    """
    mine = y[doc] > 0
    unit, doc = unit[mine], doc[mine]
    rare = np.bincount(unit, minlength=n_units)[unit] <= RARE
    counts = []
    for i in range(KEYS):
        with np.errstate(over="ignore"):
            spread = (unit.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15 + 2 * i)
            spread = (spread ^ (spread >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        key = np.arange(len(y)).astype(np.uint64)  # a document without rare units is like no other
        least = np.full(len(y), np.iinfo(np.uint64).max)
        np.minimum.at(least, doc[rare], spread[rare])
        key = np.where(least < np.iinfo(np.uint64).max, least, key)
        pairs = np.unique(np.stack([unit.astype(np.uint64), key[doc]]), axis=1)
        counts.append(np.bincount(pairs[0].astype(np.int64), minlength=n_units))
    return np.min(counts, axis=0).astype(np.float64)


def _landmarks(rows: np.ndarray, unit: np.ndarray, doc: np.ndarray, y: np.ndarray, good: np.ndarray, most: int) -> np.ndarray:
    """Units (pairs of unit and doc say who holds them) that toxic documents hold beyond chance, unlike those chosen before.

    Likeness to a landmark scales a unit down. Where labels are so few that nothing is beyond chance, units of at least two
    toxic documents are taken.
    """
    size = (rows > 0).sum(1)
    able = (size >= LENGTH) & (size <= LANDMARK)
    share, n_bad, n_good = (y.mean() if len(y) else 0.0), y.sum(), (1 - y).sum()
    bad = _independent(unit, doc, y, len(rows))
    odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((good + 0.5) / (n_good + 1))
    limit = _beyond_chance(bad, bad + good, share)
    sound = _chance(bad, bad + good, share) <= limit if limit else bad >= 2
    weight = np.where(able & sound & (odds > 2), bad * odds, 0)
    some = np.flatnonzero(weight > 0.02 * weight.max(initial=0))
    some = some[np.lexsort((some, -weight[some]))][: 40 * most]
    left, short = weight[some].copy(), np.ascontiguousarray(rows[some][:, :LANDMARK])
    own = subsequence_kernel(short, short) if len(some) else np.zeros(0)
    chosen: list[int] = []
    while len(chosen) < most and len(some) and left.max() > 0.02 * weight.max():
        i = int(np.argmax(left))
        chosen.append(int(some[i]))
        like = subsequence_kernel(short, np.repeat(short[i : i + 1], len(short), axis=0)) / np.sqrt(own * own[i])
        left *= 1 - np.clip(like, 0, 1)
        left[i] = 0
    return np.array(chosen, dtype=np.int64)


def _stretched(rows: np.ndarray) -> np.ndarray:
    """Virtual examples: every row with one letter inserted at each inner place."""
    out = []
    for r in rows:
        word = bytes(r[r > 0])
        if len(word) < WINDOW:
            out += [np.frombuffer((word[:i] + word[i - 1 : i] + word[i:]).ljust(WINDOW, b"\0"), np.uint8) for i in range(1, len(word))]
            out += [np.frombuffer((word[:i] + b"x" + word[i:]).ljust(WINDOW, b"\0"), np.uint8) for i in range(1, len(word))]
    return np.array(out, dtype=np.uint8).reshape(-1, WINDOW)


def train_toxicity(docs: DataFrame, labels: DataFrame, most: int = 3000, folds: int = 5, held_out: int = 0, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicModel:
    """Fit on at most `most` labelled documents of each label outside the held-out fold, chosen by a hash of the id.

    The bound on rows limits only what is fitted on, never what is scored. Whole texts of any length become sentences of
    distinct units where they lie; only these reach the driver. Rows whose label is null are left out; without labels,
    without toxic ones or without landmarks, every score is the smoothed share of toxic documents.
    """
    given = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & (fold(doc_id, folds) != held_out)).select(F.col(doc_id).alias("doc_id"), (F.col(label) > 0).cast("int").alias("label"))
    few = [r for v in (0, 1) for r in given.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()]
    chosen = docs.sparkSession.createDataFrame(few, given.schema)
    whole = F.col(text).cast("string")
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("text"), F.xxhash64(whole).alias("tid")).join(F.broadcast(chosen), "doc_id").select("text", "label", "tid")
    kinds = {"rows": np.uint8, "unit": np.int64, "sentence": np.int64, "times": np.int64, "doc": np.int64, "label": np.int64, "tid": np.int64}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            bags = bags_of(b.column(0), b.column(1).to_numpy(), b.column(2).to_numpy())
            packed = [zstd.ZstdCompressor(1).compress(np.ascontiguousarray(getattr(bags, c).astype(t)).tobytes()) for c, t in kinds.items()]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], names=list(kinds))

    got = rows.mapInArrow(run, ", ".join(f"{c} binary" for c in kinds)).toArrow().to_pylist()
    parts = [Bags(**{c: np.frombuffer(zstd.ZstdDecompressor().decompress(r[c]), t).reshape((-1, WINDOW) if c == "rows" else -1) for c, t in kinds.items()}) for r in got]
    return fit_bags(merged_bags(parts))


def score_toxicity(docs: DataFrame, model: ToxicModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every row, in one narrow pass over whole texts; null texts score as empty ones."""
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", 2 << 20):  # a longer piece repeats more of its words
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(b.column(1)))], names=["doc_id", "score"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id {kinds[doc_id]}, score double")
