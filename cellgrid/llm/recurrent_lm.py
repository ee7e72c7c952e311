"""Language-model scores: a gated recurrent network over words with a class-factored softmax, in numpy.

Tokens become numbers of a dictionary of their own in every chunk of documents; counts of all words of
all training texts are added up in the cluster and joined back to the chunks' dictionaries, so each token
meets its exact corpus count while no task holds the corpus vocabulary.

The model gives P(word | past) = P(class | state) P(word | class, state). Frequent words are dealt to
classes of about equal mass and have their own softmax within the class. All other words are one class,
within which a word has its smoothed share of the corpus count, an unseen word the share of count zero.
Training truncates backpropagation at a window and carries the state on; scoring carries it over a whole
document, whatever its length.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._store import fold, forget, keep
from cellgrid.llm._text import NON_SPACE, batch_of, pieces, release, words

#: Words with an output of their own, width of the state, and words that a chunk of documents gathers.
VOCABULARY, HIDDEN, CHUNK = 2048, 32, 1_000_000
#: Tokens of chunks that one scoring call takes together: texts of all of them advance side by side.
TOGETHER = 2_000_000
#: Stands for the end of a text; no word hashes are changed by it, as they are 64-bit mixes.
END = np.uint64(0x1D8AF066E5C4C3B1)
WINDOW = 32
#: Share of training texts that the network is fitted to (all of them), and rounds of averaging, among which the texts are dealt.
SHARE, ROUNDS = 1.0, 3
#: Texts that a task's copy of the network reads side by side: wide steps cost less a token.
LANES = 256


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _grouped(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in the order of their keys 0..n-1, where each key begins). Narrow keys sort in linear time."""
    order = np.argsort(keys.astype(np.int16) if n < 1 << 15 else keys, kind="stable")
    return order, np.searchsorted(keys[order], np.arange(n))


class _Rows:
    """Softmax rows of different lengths that lie one after another in `flat`, each with the place of its target. `flat` is overwritten."""

    def __init__(self, flat: np.ndarray, length: np.ndarray, target: np.ndarray) -> None:
        begin = np.cumsum(length) - length
        self.flat, self.length, self.begin, self.at = flat, length, begin, begin + target

    def log_shares(self) -> np.ndarray:
        """The log of each target's share; then `flat` holds exponentials and `total` their sums."""
        if not len(self.begin):
            return np.empty(0, np.float32)
        self.flat -= np.repeat(np.maximum.reduceat(self.flat, self.begin), self.length)
        found = self.flat[self.at]
        np.exp(self.flat, out=self.flat)
        self.total = np.add.reduceat(self.flat, self.begin)
        return found - np.log(self.total)

    def slopes(self) -> None:
        """Turn `flat` into shares less one at each target: the slopes of the loss."""
        if len(self.begin):
            self.log_shares()
            self.flat /= np.repeat(self.total, self.length)
            self.flat[self.at] -= 1


def _with_one(states: np.ndarray) -> np.ndarray:
    return np.concatenate([states, np.ones((len(states), 1), states.dtype)], axis=1)


@dataclass
class Gru:
    """Word numbers are 0..n-1 for words with outputs (n-1 last), n for all others. Word w has class of[w] and place[w] in it."""

    of: np.ndarray
    place: np.ndarray
    sizes: np.ndarray
    w: dict[str, np.ndarray] = field(default_factory=dict)
    #: Training tokens that the network has learnt from.
    seen: int = 0

    @property
    def rest(self) -> int:
        return len(self.of)

    @classmethod
    def fresh(cls, counts: np.ndarray, other: float, hidden: int, seed: int = 7) -> Gru:
        """Classes of about equal shares of the square root of counts, over words in falling order; offsets at the logarithms of counts.
        `other` counts the tokens of all other words."""
        mass = np.cumsum(np.sqrt(counts + 1.0))
        n_classes = max(1, int(np.sqrt(len(counts))))
        of = np.minimum((mass - mass[0]) / max(mass[-1], 1) * n_classes, n_classes - 1).astype(np.int64) if len(counts) else np.empty(0, np.int64)
        of = np.unique(of, return_inverse=True)[1].reshape(-1) if len(of) else of
        sizes = np.bincount(of) if len(of) else np.empty(0, np.int64)
        place = np.arange(len(of)) - np.concatenate([[0], np.cumsum(sizes)])[of] if len(of) else of
        rng = np.random.default_rng(seed)
        n, c, width = len(of), len(sizes) + 1, int(sizes.max()) if len(sizes) else 1
        draw = lambda *s: (rng.normal(size=s) * 0.1).astype(np.float32)
        bias = np.full((max(c - 1, 1), width), -1e9, np.float32)
        bias[of, place] = np.log(counts + 1.0)
        mass = np.append(np.bincount(of, counts + 1.0), other + 1.0) if n else np.array([other + 1.0])
        return cls(of, place, sizes, {"x": draw(n + 2, 3 * hidden), "u": draw(hidden, 3 * hidden), "b": np.zeros(3 * hidden, np.float32), "c": draw(hidden, c), "cb": np.log(mass / mass.sum()).astype(np.float32), "o": draw(max(c - 1, 1), hidden, width) * 0.1, "ob": bias})

    def step(self, a: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The next states (hidden x texts) after words whose inputs are the columns of a."""
        hidden = len(h)
        r = self.w["u"].T @ h
        g = _sigmoid(a[: 2 * hidden] + r[: 2 * hidden])
        new = r[2 * hidden :]
        new *= g[hidden:]
        new += a[2 * hidden :]
        np.tanh(new, out=new)
        out = h - new
        out *= g[:hidden]
        out += new
        return out

    def inputs(self) -> np.ndarray:
        """What each word adds to the gates, a row for each. Row rest + 1 is the start of a text."""
        return self.w["x"] + self.w["b"]

    def classes(self, words: np.ndarray) -> np.ndarray:
        """Class of each word number; the last class holds all other words."""
        return np.append(self.of, len(self.sizes))[words]

    def outputs(self) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the classes, and of the words of each class, each with its offsets as the last row."""
        return np.vstack([self.w["c"], self.w["cb"]]), np.concatenate([self.w["o"], self.w["ob"][:, None]], axis=1)

    def within(self, states: np.ndarray, words: np.ndarray, cut: np.ndarray, o: np.ndarray) -> tuple[_Rows, list[np.ndarray]]:
        """Logits within the classes, of states in the order of their classes; also as one matrix for each class."""
        n = np.diff(cut)
        end = np.cumsum(n * self.sizes)
        flat = np.empty(end[-1] if len(end) else 0, states.dtype)
        parts = [flat[e - m * size : e].reshape(m, size) for e, m, size in zip(end.tolist(), n.tolist(), self.sizes.tolist(), strict=True)]
        for k, part in enumerate(parts):
            np.matmul(states[cut[k] : cut[k + 1]], o[k, :, : part.shape[1]], out=part)
        return _Rows(flat, np.repeat(self.sizes, n), self.place[words[: cut[-1]]]), parts

    def log_probs(self, h: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Natural log of P(class | state), times P(word | class, state) for words with outputs."""
        class_of = self.classes(words)
        order, cut = _grouped(class_of, len(self.sizes) + 1)
        (c, o), states, class_of = self.outputs(), _with_one(h[order]), class_of[order]
        logits = c.T @ states.T
        logits -= logits.max(0)
        found = logits[class_of, np.arange(len(class_of))] - np.log(np.exp(logits, out=logits).sum(0))
        found[: cut[-1]] += self.within(states, words[order], cut, o)[0].log_shares()
        out = np.empty_like(found)
        out[order] = found
        return out

    def train_window(self, x: np.ndarray, y: np.ndarray, live: np.ndarray, h: np.ndarray, rate: float, memory: dict[str, np.ndarray]) -> np.ndarray:
        """One update from a window of words (time x texts); gradients stop at the window's edge. Returns the state to carry on.

        Places that are not live end a lane: they have no target, so no gradient either. Inside, arrays are hidden x texts,
        so that each gate is one block of memory.
        """
        (steps, lanes), hidden = x.shape, h.shape[1]
        h, u, a = h.T, np.ascontiguousarray(self.w["u"].T), self.inputs()[x]
        before, new, past, s = (np.empty((steps, hidden, lanes), np.float32) for _ in range(4))
        gate = np.empty((steps, 2 * hidden, lanes), np.float32)
        for t in range(steps):
            before[t] = h
            r, add = u @ before[t], np.ascontiguousarray(a[t].T)
            _sigmoid(np.add(add[: 2 * hidden], r[: 2 * hidden], out=gate[t]))
            past[t] = r[2 * hidden :]
            np.multiply(gate[t, hidden:], past[t], out=new[t])
            new[t] += add[2 * hidden :]
            np.tanh(new[t], out=new[t])
            np.subtract(before[t], new[t], out=s[t])
            s[t] *= gate[t, :hidden]
            s[t] += new[t]
            h = s[t]
        on = np.flatnonzero(live)
        words = y.reshape(-1)[on]
        class_of = self.classes(words)
        order, cut = _grouped(class_of, len(self.sizes) + 1)
        on, words, class_of = on[order], words[order], class_of[order]  # by class, so that each class is a run of rows
        n = max(len(on), 1)
        (c, o), states = self.outputs(), _with_one(s.transpose(0, 2, 1).reshape(-1, hidden)[on])
        p = c.T @ states.T
        p -= p.max(0)
        np.exp(p, out=p)
        p /= p.sum(0)
        p[class_of, np.arange(len(on))] -= 1
        by_class, d_flat = states.T @ p.T, p.T @ self.w["c"].T
        rows, parts = self.within(states, words, cut, o)
        rows.slopes()
        by_word = np.zeros_like(o)
        for k, q in enumerate(parts):
            if len(q):
                i = slice(cut[k], cut[k + 1])
                by_word[k, :, : q.shape[1]] = states[i].T @ q
                d_flat[i] += q @ self.w["o"][k, :, : q.shape[1]].T
        grad = {"u": np.zeros_like(self.w["u"]), "c": by_class[:-1], "cb": by_class[-1], "o": by_word[:, :-1], "ob": by_word[:, -1]}
        d_states = np.zeros((steps * lanes, hidden), np.float32)
        d_states[on] = d_flat
        d_states = np.ascontiguousarray(d_states.reshape(steps, lanes, hidden).transpose(0, 2, 1))
        z, reset = gate[:, :hidden], gate[:, hidden:]
        by_z = (before - new) * z * (1 - z)
        by_new = (1 - z) * (1 - new * new)
        by_reset = past * reset * (1 - reset)
        pulls = np.empty((3 * hidden, steps, lanes), np.float32)
        d, back = np.empty((3 * hidden, lanes), np.float32), np.zeros((hidden, lanes), np.float32)  # d: on r = u h; its last third is that on a times the reset gate
        for t in range(steps - 1, -1, -1):
            back += d_states[t]
            np.multiply(back, by_z[t], out=d[:hidden])
            d_new = back * by_new[t]
            np.multiply(d_new, by_reset[t], out=d[hidden : 2 * hidden])
            np.multiply(d_new, reset[t], out=d[2 * hidden :])
            grad["u"] += before[t] @ d.T
            pulls[: 2 * hidden, t], pulls[2 * hidden :, t] = d[: 2 * hidden], d_new
            back *= z[t]
            back += u.T @ d
        met = x.reshape(-1)
        rows, place = np.unique(met, return_inverse=True)
        table = np.stack([np.bincount(place, g, len(rows)) for g in pulls.reshape(3 * hidden, -1)], axis=1).astype(np.float32)
        grad["b"] = table.sum(0)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()) + float((table * table).sum())) / n
        scale = min(1.0, 1.0 / max(norm, 1e-9)) / n
        for k, g in grad.items():  # adaptive steps: each weight by its own mean square gradient
            g = g * scale
            memory[k] = 0.99 * memory.get(k, np.zeros_like(g)) + 0.01 * g * g if k in memory else g * g
            self.w[k] = (self.w[k] - rate * g / (np.sqrt(memory[k]) + 1e-4)).astype(np.float32)
        kept = memory.setdefault("x", np.zeros_like(self.w["x"]))
        table = table * scale
        kept[rows] = np.where(kept[rows] == 0, table * table, 0.99 * kept[rows] + 0.01 * table * table)
        self.w["x"][rows] -= rate * table / (np.sqrt(kept[rows]) + 1e-4)
        return h.T

    def train(self, texts: list[np.ndarray], rate: float = 0.004, lanes: int = 96, passes: int = 1, memory: dict[str, np.ndarray] | None = None) -> None:
        """Texts (word numbers with ends) are put end to end in lanes of equal length; the state goes on within a lane; it is
        zero where a text and a window start together, and elsewhere the input of a start is learnt to clear it.
        `memory` holds the mean square gradients of earlier calls, and is carried on."""
        if not texts:
            return
        memory = {} if memory is None else memory
        start = self.rest + 1
        x = np.concatenate([np.concatenate([[start], t[:-1]]) for t in texts])
        y = np.concatenate(texts)
        lanes = max(1, min(lanes, len(x) // (16 * WINDOW)))  # few texts still make 16 updates
        size = -(-len(x) // lanes)
        pad = size * lanes - len(x)
        live = np.concatenate([np.ones(len(x), bool), np.zeros(pad, bool)]).reshape(lanes, size).T
        x = np.concatenate([x, np.full(pad, start)]).reshape(lanes, size).T
        y = np.concatenate([y, np.zeros(pad, y.dtype)]).reshape(lanes, size).T
        for _ in range(passes):
            h = np.zeros((lanes, self.w["u"].shape[0]), np.float32)
            for t in range(0, size, WINDOW):
                h = np.where((x[t] == start)[:, None], 0, h).astype(np.float32)
                h = self.train_window(x[t : t + WINDOW], y[t : t + WINDOW], live[t : t + WINDOW], h, rate, memory)

    def score(self, tokens: np.ndarray, cuts: np.ndarray, memory: int = 1 << 14) -> np.ndarray:
        """The sum of log_probs of each of the texts that lie side by side, each from a fresh state carried to its end.

        Texts advance together, longest first; states are turned into probabilities whenever `memory` have gathered.
        """
        length = np.diff(cuts)
        order = np.argsort(-length, kind="stable")
        begin, length = cuts[:-1][order], length[order]
        out = np.zeros(len(order))
        h = np.zeros((self.w["u"].shape[0], len(order)), np.float32)
        before = np.full(len(order), self.rest + 1)
        states, targets, held = [], [], 0
        inputs = self.inputs()

        def flush() -> None:
            sizes = [len(t) for t in targets]
            of = np.concatenate([order[:n] for n in sizes])
            out[:] += np.bincount(of, self.log_probs(np.concatenate(states, axis=1).T.copy(), np.concatenate(targets)), len(out))

        for t in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -t, side="left"))
            h = self.step(np.ascontiguousarray(inputs[before[:n]].T), h[:, :n])
            before = tokens[begin[:n] + t]
            states.append(h)
            targets.append(before)
            held += n
            if held >= memory:
                flush()
                states, targets, held = [], [], 0
        if states:
            flush()
        return out


def _chunks(most: int):
    """Documents as numbers of a chunk's own dictionary: ids, folds, cuts, tokens, dictionary and its training counts."""
    schema = pa.schema([("chunk", pa.int64()), ("ids", pa.binary()), ("missing", pa.binary()), ("held", pa.binary()), ("cuts", pa.binary()), ("tokens", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids, missing, out, n, h = (np.concatenate(x) for x in zip(*held, strict=True))
            dictionary, tokens = np.unique(h, return_inverse=True)
            cuts = np.concatenate([[0], np.cumsum(n)])
            counts = np.bincount(tokens[np.repeat(~out, n)], minlength=len(dictionary))
            planes = np.ascontiguousarray(tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
            row = [x.tobytes() for x in (ids.astype("<i8"), missing, out, cuts.astype("<i8"))]
            return batch_of(schema, [uuid.uuid4().int >> 65], *[[x] for x in (*row, zstd.ZstdCompressor(1).compress(planes), dictionary.tobytes(), counts.astype("<i8").tobytes())])

        for b in pieces(batches, "text"):
            w = words(b.column(1), NON_SPACE, lower=True)
            n = w.counts + 1
            h = np.full(len(w) + b.num_rows, END, dtype=np.uint64)
            h[np.arange(len(w)) + w.doc()] = w.hashes()
            ids = b.column(0)
            held.append((ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False), n, h))
            size += len(h)
            if size >= most:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


def _tokens(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstd.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(-1)


def _entries(names: np.ndarray | None = None):
    """One row for each word of each chunk's dictionary, but for those of `names`: chunk, place, word, training count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, raw, counts in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                w, n = np.frombuffer(raw, np.int64), np.frombuffer(counts, np.int64)
                at = np.arange(len(w)) if names is None else np.flatnonzero(_numbers(names, w.view(np.uint64)) == len(names))
                for s in range(0, len(at), 1 << 17):
                    i = at[s : s + (1 << 17)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), chunk)), pa.array(i.astype(np.int32)), pa.array(w[i]), pa.array(n[i])], names=["chunk", "place", "word", "n"])

    return run


def _frequent(names: np.ndarray, c: np.ndarray):
    """One row for each word of each chunk's dictionary that is one of `names`: chunk, place, its corpus count and output number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                number = _numbers(names, np.frombuffer(raw, np.uint64))
                i = np.flatnonzero(number < len(names))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), chunk)), pa.array(i.astype(np.int32)), pa.array(c[number[i]]), pa.array(number[i])], names=["chunk", "place", "c", "number"])

    return run


def _numbers(names: np.ndarray, dictionary: np.ndarray) -> np.ndarray:
    """The place of each word of a dictionary among the names, their number for those that are not there."""
    if not len(names):
        return np.zeros(len(dictionary), np.int64)
    order = np.argsort(names)
    at = np.minimum(np.searchsorted(names[order], dictionary), len(names) - 1)
    return np.where(names[order][at] == dictionary, order[at], len(names))


def _aligned(group: pa.Table) -> pa.Table:
    """The corpus counts and the output numbers of one chunk's dictionary, in its order."""
    out = np.empty((2, group.num_rows), "<i8")
    out[:, group.column("place").to_numpy()] = group.column("c").to_numpy(), group.column("number").to_numpy()
    raw = np.ascontiguousarray(out.view(np.uint8).reshape(-1, 8).T).tobytes()
    return pa.table({"chunk": group.column("chunk").slice(0, 1), "known": pa.array([zstd.ZstdCompressor(1).compress(raw)], pa.binary())})


def _known(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstd.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    c, number = np.ascontiguousarray(planes.T).view("<i8").reshape(2, -1)
    return c, number


def _sample(top: np.ndarray, share: float, rounds: int):
    """Training texts of a chunk as numbers of the model's vocabulary, those of one round: each text is in one of the rounds.
    A share below 1 takes texts by a hash of their doc_id."""

    def run(row: dict, turn: int) -> list[np.ndarray]:
        number = _numbers(top, np.frombuffer(row["words"], np.uint64))
        tokens, cuts, held = number[_tokens(row["tokens"])], np.frombuffer(row["cuts"], np.int64), np.frombuffer(row["held"], bool)
        ids = np.frombuffer(row["ids"], np.int64).astype(np.uint64)
        chosen = (((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.float64) / 2**24 < share) & ~held
        return [tokens[cuts[i] : cuts[i + 1]] for i in np.flatnonzero(chosen)[turn::rounds]]

    return run


def _bytes(w: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([w[k].reshape(-1) for k in sorted(w)]).astype("<f4").tobytes()


def _weights(raw: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = raw[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _averaged(group: pa.Table) -> pa.Table:
    n = group.column("n").to_numpy()
    total = sum(np.frombuffer(w, "<f4").astype(np.float64) * m for w, m in zip(group.column("w").to_pylist(), n, strict=True))
    mean = total / max(n.sum(), 1)
    return pa.table({"lot": group.column("lot").slice(0, 1), "n": pa.array([n.sum()], pa.int64()), "w": pa.array([mean.astype("<f4").tobytes()], pa.binary())})


def train_lm(chunks: DataFrame, counts: DataFrame, n: int, vocabulary: int = VOCABULARY, hidden: int = HIDDEN, share: float = SHARE, rounds: int = ROUNDS) -> tuple[np.ndarray, Gru]:
    """(hashes of words with outputs, most frequent first; the network).

    Every task trains a copy of the network on its chunks' training texts, one chunk after another; copies are
    averaged by their tokens in two levels, and the mean starts the next round. Each round has texts of its own of
    every chunk, so that all rounds together learn from every training text once; the driver gets one set of
    weights for each of at most 16 lots.
    """
    top = counts.where("c > 0").orderBy(F.desc("c"), "word").limit(vocabulary).toArrow()
    names = top.column("word").to_numpy().astype(np.int64).view(np.uint64)
    c = top.column("c").to_numpy().astype(np.float64)
    model = Gru.fresh(c, n - c.sum(), hidden)
    sample = _sample(names, share, rounds)
    for r in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], model=model, r=r) -> Iterator[pa.RecordBatch]:
            own = Gru(model.of, model.place, model.sizes, {k: v.copy() for k, v in model.w.items()})
            memory: dict[str, np.ndarray] = {}
            for b in batches:
                for i in range(b.num_rows):
                    texts = sample({c: b.column(c)[i].as_py() for c in ("ids", "held", "cuts", "tokens", "words")}, r)
                    own.train(texts, rate=0.01 if r == 0 else 0.004, lanes=LANES, memory=memory)
                    own.seen += sum(map(len, texts))
            release()
            if own.seen:
                row = [np.int32(TaskContext.get().partitionId() % 16)], [own.seen], [_bytes(own.w)]
                yield pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), pa.array(row[1], pa.int64()), pa.array(row[2], pa.binary())], names=["lot", "n", "w"])

        trained = chunks.select("chunk", "ids", "held", "cuts", "tokens", "words").mapInArrow(run, "lot int, n long, w binary").where("n > 0")
        lots = trained.groupBy("lot").applyInArrow(_averaged, "lot int, n long, w binary").collect()
        if lots:
            total = sum(x.n for x in lots)
            mean = sum(np.frombuffer(x.w, "<f4").astype(np.float64) * (x.n / total) for x in sorted(lots, key=lambda x: x.lot))
            model = Gru(model.of, model.place, model.sizes, _weights(mean, model.w), model.seen + total)
    return names, model


def score_lm(docs: DataFrame, folds: int = 7, held_out: int = 2, doc_id: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY, hidden: int = HIDDEN, share: float = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Scores are log10 probabilities of whole texts with their end. base_score adds log10((c + 1) / (N + V + 1))
    over tokens, with c, N and V counted over all training texts. Null texts are empty (one token: the end);
    without training texts N and V are 0 and every score still is a probability. An integer doc_id is needed;
    a null one is in the fold of the empty id.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), (fold(doc_id, folds) == held_out).alias("held"))
    chunks = keep(given.mapInArrow(_chunks(CHUNK), "chunk long, ids binary, missing binary, held binary, cuts binary, tokens binary, words binary, counts binary"), "lm-chunks")
    entries = lambda but=None: chunks.select("chunk", "words", "counts").mapInArrow(_entries(but), "chunk long, place int, word long, n long")
    counts = keep(entries().groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    names, model = train_lm(chunks, counts, n, vocabulary, hidden, share, rounds)
    # words with outputs stand in nearly every chunk: their counts go with the tasks, and only rarer words are joined
    held = {r.word: r.c for r in counts.where(F.col("c") > 0).orderBy(F.desc("c"), "word").limit(vocabulary).collect()}
    frequent = np.array([held[w] for w in names.view(np.int64).tolist()], np.int64)
    top_mass = int(frequent.sum())
    rare = entries(names).select("chunk", "place", "word").join(counts, "word").select("chunk", "place", "c", F.lit(len(names)).cast("long").alias("number"))
    common = chunks.select("chunk", "words").mapInArrow(_frequent(names, frequent), "chunk long, place int, c long, number long")
    known = rare.unionByName(common).groupBy("chunk").applyInArrow(_aligned, "chunk long, known binary")
    # within the class of all other words: one more than each count, over those words and one unseen
    rest_total = (n - top_mass) + (v - len(names)) + 1

    def counted(row: dict) -> tuple[np.ndarray, ...]:
        """Of one chunk: output numbers of its tokens, text lengths, known tokens, base scores, and shares within the class of other words."""
        tokens, cuts = _tokens(row["tokens"]), np.frombuffer(row["cuts"], np.int64)
        c, number = _known(row["known"])
        add = lambda x: np.add.reduceat(x[tokens], cuts[:-1])
        inner = np.where(number == len(names), np.log10((c + 1.0) / rest_total), 0.0)
        return number.astype(np.int32)[tokens], np.diff(cuts), add((c > 0).astype(np.int64)), add(np.log10((c + 1.0) / (n + (v + 1)))), add(inner)

    def scored(rows: list[dict]) -> pa.RecordBatch:
        numbers, *parts = zip(*(counted(r) for r in rows), strict=True)
        lengths, n_known, base, inner = (np.concatenate(p) for p in parts)
        deep = model.score(np.concatenate(numbers), np.concatenate([[0], np.cumsum(lengths)])) / np.log(10) + inner
        join = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows])
        ids = pa.array(join("ids", np.int64), mask=join("missing", bool))
        return pa.RecordBatch.from_arrays([ids, pa.array(join("held", bool)), pa.array(lengths), pa.array(n_known), pa.array(np.full(len(lengths), n), pa.int64()), pa.array(base), pa.array(deep)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for b in batches:
            for i in range(b.num_rows):
                rows.append({c: b.column(c)[i].as_py() for c in ("ids", "missing", "held", "cuts", "tokens", "known")})
                if len(rows) * CHUNK >= TOGETHER:
                    yield scored(rows)
                    rows = []
        if rows:
            yield scored(rows)
        release()

    full = chunks.select("chunk", "ids", "missing", "held", "cuts", "tokens").join(known, "chunk")
    out = keep(full.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"), "lm-scores")
    forget(chunks, counts)
    return out
