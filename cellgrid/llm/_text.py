"""Vectorised word tables over Arrow string columns.

A batch of texts stays one flat byte buffer.  Words are byte ranges of it, a word's hash is a
64-bit polynomial over its bytes, and a k-gram's hash is a polynomial over word hashes; both come
from prefix sums, so their cost does not depend on k.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

_R = 0x9E3779B97F4A7C15 | 1
_G = 0xD6E8FEB86659FD93 | 1
_M64 = (1 << 64) - 1
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true within the inclusive byte ranges."""
    out = np.zeros(256, dtype=bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Words `[^\x20\x09-\x0D]+`.
NON_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of texts whose A-Z are in lower case.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least."""
    have = _tables.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, dtype=np.uint64)
            x[0] = 1
            both.append(np.cumprod(x, dtype=np.uint64))
        have = (both[0], both[1])
        if size <= PIECE_BYTES * 8:
            _tables[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """The words of a run of texts. `first[d]` is the first word of text d; `first[-1]` counts all."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash for each word; it depends on the word's bytes only."""
        up, down = _powers(_R, len(self.data) + 1)
        sums = np.empty(len(self.data) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k consecutive words from each word; the last k-1 places are left out."""
    n = len(hashes)
    if n < k:
        return np.empty(0, dtype=np.uint64)
    up, down = _powers(_G, n + 1)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(hashes * up[:n], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[: n - k + 1] + np.uint64(k))


def within(first: np.ndarray, k: int) -> np.ndarray:
    """For each start of k consecutive words, whether all k belong to one text."""
    n = int(first[-1])
    ok = np.ones(max(n - k + 1, 0), dtype=bool)
    if len(ok) and k > 1:
        edge = np.zeros(n + 1, dtype=np.int64)
        inner = first[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        np.add.at(edge, inner, 1)  # empty texts repeat an edge
        before = np.cumsum(edge)  # edges at or before a word
        ok = before[k - 1 : n] == before[: n - k + 1]
    return ok


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not (pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type)):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, dtype=kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array, kind: np.ndarray = NON_SPACE, lower: bool = False) -> Words:
    """The word table of whole texts: maximal runs of the bytes in `kind`."""
    data, offsets = flat(texts)
    if lower:
        data = _LOWER[data]
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = kind[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = inside[1:-1][cuts]
    ends[cuts - 1] = inside[1:-1][cuts - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def release() -> None:
    """Hand memory that a finished task has freed back to the system: idle Python workers share their executor's limit with running ones."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries can
        ctypes.CDLL(None).malloc_trim(0)


def pieces(batches: Iterator[pa.RecordBatch], text: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `most` bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        _, offsets = flat(column)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
    release()


def batch_of(schema: pa.Schema, *columns: object) -> pa.RecordBatch:
    """A record batch of the columns, each cast to the schema's type."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
