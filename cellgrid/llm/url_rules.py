"""URL filter: glob rules run as one bit-parallel Shift-And automaton over each canonical URL.

Every rule's states are neighbouring bits of a row of 64-bit words.  One step of the automaton reads
one byte of every URL of a batch: shift the state rows, mask them with the byte's row, and keep the
bits whose state loops on any byte (those before a `*`).  All rules advance together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._text import batch_of, flat, pieces

#: Stands between host and path; no UTF-8 text holds this byte.
EDGE = b"\xff"


@dataclass(frozen=True)
class Rule:
    """`host` and its subdomains, where the path starts with `path`; the longest name wins."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def glob(self) -> bytes:
        """Over `.host`, EDGE, path: any labels before the host, anything after the path."""
        return b"*." + self.host.lower().encode() + EDGE + self.path.encode() + b"*"


class ShiftAnd:
    """Globs of literal bytes, `?` (any byte) and `*` (any bytes), matched against whole byte strings."""

    def __init__(self, globs: Sequence[bytes]):
        literals: list[list[int | None]] = []
        loops: list[set[int]] = []
        for g in globs:
            some: list[int | None] = []
            loop: set[int] = set()
            for c in g:
                if c == 0x2A:
                    loop.add(len(some))
                else:
                    some.append(None if c == 0x3F else c)
            literals.append(some)
            loops.append(loop)
        bits = sum(len(x) + 1 for x in literals)
        self.n = max(1, -(-bits // 64))
        self.start = np.zeros(self.n, dtype=np.uint64)
        self.loop = np.zeros(self.n, dtype=np.uint64)
        self.step = np.zeros((256, self.n), dtype=np.uint64)
        self.final: list[int] = []
        at = 0
        for some, loop in zip(literals, loops, strict=True):
            self._set(self.start, at)
            for i in loop:
                self._set(self.loop, at + i)
            for i, c in enumerate(some):
                for row in self.step if c is None else [self.step[c]]:
                    self._set(row, at + i + 1)
            at += len(some)
            self.final.append(at)
            at += 1

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // 64] |= np.uint64(1 << (bit % 64))

    def run(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The state row of each string after its last byte."""
        length = np.diff(offsets)
        order = np.argsort(-length, kind="stable")
        begin, length = offsets[:-1][order], length[order]
        state = np.repeat(self.start[None, :], len(order), axis=0)
        for t in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -t, side="left"))  # strings that have a byte t
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.step[data[begin[:n] + t]]
            moved |= now & self.loop
            state[:n] = moved
        out = np.empty_like(state)
        out[order] = state
        return out

    def matched(self, states: np.ndarray, glob: int) -> np.ndarray:
        word, bit = divmod(self.final[glob], 64)
        return (states[:, word] >> np.uint64(bit)) & np.uint64(1) == 1


def canonical(url: str = "url") -> tuple[object, object]:
    """Columns host (A-Z in lower case) and path of a URL; both empty for null and for a URL without `://`."""
    split = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    given = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(given, split, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(given, split, 2)


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict of every row, in one narrow pass that reads two columns.

    The longest rule that fits wins (of equals, the first by name); without one, rule is null and the
    verdict is `default`.  Null and malformed URLs have an empty host and path and fit no rule. Rows
    that repeat are judged each; other columns are not read.
    """
    ranked = sorted(rules, key=lambda r: (len(r.name), [-ord(c) for c in r.name]))
    automaton = ShiftAnd([r.glob() for r in ranked])
    names = np.array([r.name for r in ranked] + [None], dtype=object)
    verdicts = np.array([r.verdict for r in ranked] + [default], dtype=object)
    host, path = canonical(url)
    seen = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), F.concat(F.lit("."), host).alias("dotted"))
    schema = f"page_id {dict(pages.dtypes)[page_id]}, host string, path string, rule string, verdict string"
    kinds = pa.schema([("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "path"):
            data, offsets = _joined(flat(b.column(3)), flat(b.column(2)))
            states = automaton.run(data, offsets)
            best = np.full(b.num_rows, len(ranked))
            for i in range(len(ranked)):
                best[automaton.matched(states, i)] = i
            rest = batch_of(kinds, b.column(1), b.column(2), names[best], verdicts[best])
            yield pa.RecordBatch.from_arrays([b.column(0), *rest.columns], names=["page_id", *kinds.names])

    return seen.mapInArrow(run, schema)


def _joined(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row by row: left, EDGE, right."""
    a, b = np.diff(left[1]), np.diff(right[1])
    offsets = np.concatenate([[0], np.cumsum(a + 1 + b)])
    out = np.full(int(offsets[-1]), EDGE[0], dtype=np.uint8)
    for (data, at), size, shift in ((left, a, 0), (right, b, a + 1)):
        out[np.repeat(offsets[:-1] + shift - at[:-1], size) + np.arange(len(data))] = data
    return out, offsets
