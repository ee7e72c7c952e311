"""Bounded-space online packing of token streams into sequences of one size.

Every task reads its documents once and keeps a fixed number of windows open.  A document goes into the
fullest window that still has room for it; where none has, the fullest of all is topped up with the
document's head and leaves, and the tail goes on.  What is open at a task's end is merged with the open
windows of its neighbours in a reduction tree of bounded groups, so the corpus ends in one partial window.
"""

from __future__ import annotations

import os
import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellgrid.llm._store import keep
from cellgrid.llm._text import _LOWER, byte_class, flat, pieces

SIZE = 4096
#: Windows that a task, or a group of the tree, holds open.
WINDOWS = 32
#: Tasks or groups whose open windows meet in one group of the tree: at most FAN_IN * WINDOWS windows.
FAN_IN = 32
#: Units that an encoder remembers, and the bytes beyond which a unit is not remembered.
REMEMBERED, LONGEST = 400_000, 64
#: Bytes of ids in one batch of results.
OUT_BYTES = 2 << 20

# Classes of bytes: white space, letters, digits, other signs; an apostrophe and all that is not ASCII hold on to their neighbours.
_SPACE, _LETTER, _DIGIT, _SIGN, _BOUND = range(5)
_CLASS = np.full(256, _BOUND, dtype=np.uint8)
_CLASS[byte_class((0x21, 0x7E))] = _SIGN
_CLASS[byte_class((0x09, 0x0D), (0x20, 0x20))] = _SPACE
_CLASS[byte_class((0x30, 0x39))] = _DIGIT
_CLASS[byte_class((0x41, 0x5A), (0x61, 0x7A))] = _LETTER
_CLASS[0x27] = _BOUND


#: Words of small Latin letters that are their own NFC form.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    printable = [33 <= b <= 126 or 161 <= b <= 255 and b != 173 for b in range(256)]
    return [chr(b) if printable[b] else chr(256 + b - sum(printable[:b])) for b in range(256)]


class Encoder:
    """Ids of texts by a lower-casing word BPE, each distinct unit encoded once.

    The vocabulary's own pattern never matches across white space, nor across a change between ASCII letters,
    digits and signs (but for an apostrophe), and takes digits one by one; ids of a text are thus those of its
    units in turn. A unit of small Latin letters alone goes to the merges as it is, any other through the whole tokenizer.
    Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = self.tokenizer.model
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def units(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The units of all texts in turn, and the first unit of each text (the last entry counts all)."""
        data, offsets = flat(texts)
        data = _LOWER[data]
        kind = _CLASS[data]
        before, here = kind[:-1], kind[1:]
        starts = np.empty(len(kind), dtype=bool)
        starts[:1] = kind[:1] > _SPACE
        loose = (before < _BOUND) & (here < _BOUND) & ((before != here) | (here == _DIGIT))
        starts[1:] = (here > _SPACE) & ((before == _SPACE) | loose)
        cuts = offsets[1:-1]
        cuts = cuts[cuts < len(kind)]
        starts[cuts] = kind[cuts] > _SPACE
        solid = kind > _SPACE
        at = np.flatnonzero(starts)
        ends = np.append(np.flatnonzero(starts[solid]), np.count_nonzero(solid)).astype(np.int32)
        column = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(data[solid]))
        return column.dictionary_encode(), np.searchsorted(at, offsets)

    def _remember(self, coded: dict[str, bytes]) -> None:
        """Keep what was met last: the older half goes once the newer one is full."""
        for u, ids in coded.items():
            if len(u) <= LONGEST:
                self.known[u] = ids
        if len(self.known) > REMEMBERED // 2:
            self.older, self.known = self.known, {}

    def _bytes(self, units: list[str]) -> list[bytes]:
        known, older, merges, letters = self.known.get, self.older.get, self.merges.tokenize, self.letters
        coded: dict[str, bytes] = {}
        others = []
        out = []
        for u in units:
            ids = known(u)
            if ids is None:
                ids = older(u)
                if ids is None:
                    if _PLAIN(u):
                        ids = array("I", [t.id for t in merges(u if u.isascii() else "".join([letters[b] for b in u.encode()]))]).tobytes()
                    else:
                        others.append(len(out))
                if ids is not None:
                    coded[u] = ids
            out.append(ids)
        for i, e in zip(others, self.tokenizer.encode_batch_fast([units[i] for i in others], add_special_tokens=False), strict=True):
            coded[units[i]] = out[i] = array("I", e.ids).tobytes()
        self._remember(coded)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in turn, and where each text's ids begin (the last entry counts all). Null texts have none."""
        column, first = self.units(texts)
        parts = self._bytes(column.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, parts), dtype=np.int32, count=len(parts)) // 4
        source = np.cumsum(size, dtype=np.int32) - size
        codes = column.indices.to_numpy()
        lengths = size[codes]
        ends = np.zeros(len(codes) + 1, dtype=np.int32)
        np.cumsum(lengths, out=ends[1:])
        at = np.repeat(source[codes] - ends[:-1], lengths)
        at += np.arange(ends[-1], dtype=np.int32)
        return np.frombuffer(b"".join(parts), dtype="=u4")[at], ends[first]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: A piece: doc_id, start, ids, doc_tokens.
Piece = tuple[object, int, np.ndarray, int]


def cut(unit: list[Piece], n: int) -> tuple[list[Piece], list[Piece]]:
    """The first n ids of the pieces, and the others."""
    head: list[Piece] = []
    for i, (doc, start, ids, tokens) in enumerate(unit):
        if n < len(ids):
            rest = [(doc, start + n, ids[n:], tokens), *unit[i + 1 :]]
            return ([*head, (doc, start, ids[:n], tokens)] if n else head), rest
        head.append(unit[i])
        n -= len(ids)
    return head, []


def length(unit: list[Piece]) -> int:
    return sum(len(p[2]) for p in unit)


class Packer:
    """At most `windows` open windows of `size` ids; `emit` gets the pieces of each that leaves."""

    def __init__(self, size: int, windows: int, emit: Callable[[list[Piece]], None]):
        self.size, self.windows, self.emit = size, windows, emit
        self.room: list[tuple[int, int]] = []  # (free ids, number), in order
        self.held: dict[int, list[Piece]] = {}
        self.made = 0

    def add(self, unit: list[Piece]) -> None:
        n = length(unit)
        while n >= self.size:
            whole, unit = cut(unit, self.size)
            self.emit(whole)
            n -= self.size
        while n:
            i = bisect_left(self.room, (n, -1))
            if i < len(self.room):
                free, number = self.room.pop(i)
            elif len(self.room) < self.windows:
                free, number, self.made = self.size, self.made, self.made + 1
                self.held[number] = []
            else:
                free, number = self.room.pop(0)
            head, unit = (unit, []) if n <= free else cut(unit, free)
            taken = min(n, free)
            self.held[number] += head
            n -= taken
            if taken == free:
                self.emit(self.held.pop(number))
            else:
                insort(self.room, (free - taken, number))

    def left(self) -> list[list[Piece]]:
        """Open windows, the fullest first."""
        return [self.held[number] for _, number in self.room]


def finish(units: list[list[Piece]], size: int, emit: Callable[[list[Piece]], None]) -> None:
    """Close the last windows: they follow one another into full ones, and what remains is cut at powers of two."""
    rest = [p for u in units for p in u]
    n = length(rest)
    while n:
        step = size if n >= size else 1 << (n.bit_length() - 1)
        head, rest = cut(rest, step)
        emit(head)
        n -= step


class _Rows:
    """Pieces of sequences as record batches."""

    def __init__(self, doc_type: pa.DataType, level: int, part: int):
        self.schema = pa.schema([("doc_id", doc_type), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()), ("part", pa.int64()), ("open", pa.bool_())])
        self.base, self.part, self.count, self.bytes = (level << 56) | (part << 32), part, 0, 0
        self.columns: list[list] = [[] for _ in self.schema]

    def sequence(self, unit: list[Piece], still_open: bool = False) -> None:
        at = 0
        for doc, start, ids, tokens in unit:
            for column, value in zip(self.columns, (doc, start, len(ids), tokens, self.base + self.count, at, ids.astype("<u4").tobytes(), self.part, still_open), strict=True):
                column.append(value)
            at += len(ids)
            self.bytes += 4 * len(ids) + 64
        self.count += 1

    def flush(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.columns[0] and self.bytes >= least:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema, strict=True)], schema=self.schema)
            self.columns, self.bytes = [[] for _ in self.schema], 0


def _schema(kind: str) -> str:
    return f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, part long, open boolean"


def _merge(level: int, last: bool, size: int, windows: int):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        rows = _Rows(group.schema.field("doc_id").type, level, key[0].as_py())
        units: dict[int, list[Piece]] = {}
        t = group.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        for doc, start, tokens, number, ids in zip(*(t.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "sequence_id", "ids")), strict=True):
            units.setdefault(number, []).append((doc, start, np.frombuffer(ids, dtype="<u4"), tokens))
        packer = Packer(size, windows, rows.sequence)
        for unit in sorted(units.values(), key=length, reverse=True):
            packer.add(unit)
        if last:
            finish(packer.left(), size, rows.sequence)
        else:
            for unit in packer.left():
                rows.sequence(unit, still_open=True)
        return pa.Table.from_batches(list(rows.flush()), schema=rows.schema)

    return run


def pack_documents(docs: DataFrame, vocabulary: str, size: int = SIZE, end: int = 2, windows: int = WINDOWS, fan_in: int = FAN_IN, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece of a document in a sequence: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    A document's ids are those of its whole text and `end`; null and empty texts have `end` alone. Pieces hold each
    id once; `ids` are little-endian unsigned 32-bit numbers. Every sequence is full (`size` ids) but for those that
    the very last window is cut into, whose lengths are powers of two, so nothing is padded. A document is cut only
    where it tops up a window. Rows that repeat, and rows of one id, are documents of their own; null ids stay null;
    other columns of docs play no part; an empty table gives no rows. Which sequence a document falls in depends on
    how the rows are dealt to tasks; the numbers are unique in one result.
    """
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = packer = None
        coder = encoder(vocabulary)
        for b in pieces(batches, "text"):
            if rows is None:
                rows = _Rows(b.column(0).type, 0, TaskContext.get().partitionId())
                packer = Packer(size, windows, rows.sequence)
            ids, first = coder.encode(b.column(1))
            for i, doc in enumerate(b.column(0).to_pylist()):
                whole = np.append(ids[first[i] : first[i + 1]], np.uint32(end))
                packer.add([(doc, 0, whole, len(whole))])
                yield from rows.flush(OUT_BYTES)
        if rows is not None:
            for unit in packer.left():
                rows.sequence(unit, still_open=True)
            yield from rows.flush()

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    made = [keep(chosen.mapInArrow(run, _schema(kind)), "packed", codec="zstd")]
    groups = (made[0].agg(F.max("part")).first()[0] or 0) + 1
    while True:
        groups = -(-groups // fan_in)
        last = groups == 1
        dealt = made[-1].where("open").withColumn("group", F.floor(F.col("part") / fan_in)).groupBy("group")
        made.append(keep(dealt.applyInArrow(_merge(len(made), last, size, windows), _schema(kind)), "packed", codec="zstd"))
        if last:
            break
    out = made[0]
    for m in made[1:]:
        out = out.unionByName(m)
    return out.where("not open").drop("part", "open")
