"""Packing documents into token windows: bounded-space, online, best fit.

Every partition packs its documents in one pass and keeps a fixed number of open windows. A
document's full windows are cut off first; its remainder goes into the open window that it
fills best. When none has room, the fullest window is emitted: a gap of more than ``slack``
ids is first filled with the head of the remainder (cuts are free), so emitted windows are full
but for a few ids. What is still open at the end of a partition is written with its ids and
merged: groups of ``fan`` partitions are packed again by the same rule, level by level, and the
last group closes its windows into one another, so that at most one window of the whole table is
left unfilled. A task of a merge level holds at most ``fan * open_windows`` windows.

The ids are those of the ``tokenizers`` library for the given file. Byte-level BPE works on
pieces that the pre-tokenizer cuts, and it always cuts before a single space and around a single
line break that stand between other characters; so words are looked up in a bounded memo per
worker and only new ones are encoded. Texts with other white space are encoded whole, texts that
hold a special token's string by ``tokenizers`` itself.

Defined results
* null text counts as empty: such a document is the end id alone (one piece of length 1).
* any length: a document of n ids yields pieces that cover 0..n-1 once, in order of ``start``.
* repeated rows are packed once each; null identifiers are carried through.
* an empty table gives an empty result; extra columns are ignored.
* the packing depends only on the scan's partitions and row order, and a lost task repeats it.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import workers_import

# fixed values: the file's pre-tokenizer pattern, the end id
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_ID = 1

# white space that the words' memo does not know: two in a row, or anything but space and line break
DOUBLE = ("  ", "\n\n", " \n", "\n ")
OTHER_SPACE = re.compile("[" + "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n") + "]")

WINDOW = 2048
OPEN_WINDOWS = 16
FAN = 16
SLACK = 8
MEMO = 1_000_000  # words remembered per worker, about 200 bytes each

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "part long, ids binary")
RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Memo(dict):
    """Word to its ids (4 bytes each); a missing word is encoded and, while there is room, kept."""

    def __init__(self, encode, prefix: str):
        super().__init__()
        self.encode, self.prefix = encode, prefix
        self.marks = {m: encode(m) for m in ".,;:!?"}

    def __missing__(self, word: str) -> bytes:
        if len(word) > 1 and word[-1] in ".,;:!?" and word[-2].isalpha():
            # letters and a mark after them are separate pieces
            return self[word[:-1]] + self.marks[word[-1]]
        ids = self.encode(self.prefix + word)
        if len(word) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """``encode(text)``: the ids of a text as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        import sys
        from array import array

        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.specials}
        bpe = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.reference = Tokenizer.from_file(path)
        assert array("I").itemsize == 4 and sys.byteorder == "little"
        self.pack = lambda ids: array("I", ids).tobytes()
        self.plain = lambda text: self.pack(bpe.encode_ordinary(text))
        self.first, self.inner = _Memo(self.plain, ""), _Memo(self.plain, " ")
        self.newline = self.plain("\n")

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.specials):
            return self.pack(self.reference.encode(text, add_special_tokens=False).ids)
        # every white-space character a single space or line break between words?
        if text[0] in " \n" or text[-1] in " \n" or any(gap in text for gap in DOUBLE) or OTHER_SPACE.search(text):
            return self.plain(text)
        lines = []
        for line in text.split("\n"):
            head, *tail = line.split(" ")
            lines.append(self.first[head] + b"".join(map(self.inner.__getitem__, tail)))
        return self.newline.join(lines)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Packer:
    """Open windows of one task; finished pieces collect in ``rows``."""

    def __init__(self, level: int, part: int, open_windows: int):
        self.ids = (level << 56) | (part << 32)
        self.part, self.limit = part, open_windows
        self.free: list[tuple[int, int]] = []  # (room, window), sorted
        self.held: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def _emit(self, window: int) -> None:
        self.rows.extend((*p[:7], self.part, None) for p in self.held.pop(window))

    def _put(self, window: int, room: int, piece: tuple) -> None:
        doc, start, total, ids = piece
        n = len(ids) // 4
        self.held[window].append((doc, start, n, zlib.crc32(ids), total, window, WINDOW - room, ids))
        if room == n:
            self._emit(window)
        else:
            insort(self.free, (room - n, window))

    def _open(self) -> int:
        window, self.ids = self.ids, self.ids + 1
        self.held[window] = []
        return window

    def add(self, doc, start: int, total: int, ids: bytes) -> None:
        while ids:
            n = len(ids) // 4
            if n >= WINDOW:
                take = WINDOW
                self._put(self._open(), WINDOW, (doc, start, total, ids[:4 * take]))
            else:
                at = bisect_left(self.free, (n, -1))
                if at < len(self.free):
                    room, window = self.free.pop(at)
                    take = n
                elif len(self.free) < self.limit:
                    room, window, take = WINDOW, self._open(), n
                else:  # the fullest goes; a large gap takes the head of this piece
                    room, window = self.free.pop(0)
                    take = room if room > SLACK else 0
                if not take:
                    self._emit(window)
                    continue
                self._put(window, room, (doc, start, total, ids[:4 * take]))
            start, ids = start + take, ids[4 * take:]

    def close(self) -> None:
        """Pour the open windows into one another; one unfilled window is left and emitted."""
        rest = [p for window in sorted(self.held) for p in self.held[window]]
        self.held, self.free, self.limit = {}, [], 1
        for doc, start, _, _, total, _, _, ids in rest:
            while ids:
                room, window = self.free.pop() if self.free else (WINDOW, self._open())
                take = min(room, len(ids) // 4)
                self._put(window, room, (doc, start, total, ids[:4 * take]))
                start, ids = start + take, ids[4 * take:]
        for window in sorted(self.held):
            self._emit(window)

    def leftovers(self) -> list[tuple]:
        return [(*p[:7], self.part, p[7]) for window in sorted(self.held) for p in self.held[window]]


def _arrow_schema() -> pa.Schema:
    names = [c.split()[0] for c in PIECES.split(", ")]
    return pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in names])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = _arrow_schema()
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, *, key: str = "doc_id", text: str = "text",
                   open_windows: int = OPEN_WINDOWS, fan: int = FAN) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        packer = Packer(0, TaskContext.get().partitionId(), open_windows)
        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = enc.encode(value.as_py() or "") + END_ID.to_bytes(4, "little")
                packer.add(doc, 0, len(ids) // 4, ids)
                if len(packer.rows) >= 10_000:
                    yield _batch(packer.rows)
                    packer.rows = []
        yield _batch(packer.rows + packer.leftovers())

    def next_level(level: int, last: bool):
        def merge(key: tuple, left: pd.DataFrame) -> pd.DataFrame:
            packer = Packer(level, int(key[0]), open_windows)
            left = left.sort_values(["sequence_id", "offset"])
            for doc, start, total, ids in zip(left.doc_id, left.start, left.doc_tokens, left.ids):
                packer.add(None if pd.isna(doc) else int(doc), int(start), int(total), bytes(ids))
            if last:
                packer.close()
            return _batch(packer.rows + packer.leftovers()).to_pandas()

        return merge

    pieces = stage(workers_import(docs).select(F.col(key).cast("long"), F.col(text)).mapInArrow(first_level, PIECES), "packed")
    done, level = pieces.filter("ids IS NULL").select(RESULT), 0
    while True:
        left = pieces.filter("ids IS NOT NULL")
        parts = left.agg(F.max("part")).first()[0]
        if parts is None:
            return done
        level += 1
        last = parts < fan
        merged = left.groupBy(F.floor(F.col("part") / fan).alias("group")).applyInPandas(next_level(level, last), PIECES)
        pieces = stage(merged, "packed_level")
        done = done.unionByName(pieces.filter("ids IS NULL").select(RESULT))
