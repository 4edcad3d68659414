"""Repeated-substring removal by prefix doubling over names.

Every byte covered by a 200-byte string that also starts anywhere else (any document, the same one
included) is removed. Prefix doubling ranks positions by ever longer prefixes: the rank of 2 L bytes
is the pair of the ranks at p and at p + L. Here a rank is a name, a 64-bit hash of the pair, so
that one pass over a text takes its positions from 1 to 50 bytes, and Spark's sort groups equal
names of all documents; positions whose name is unique are settled, the others go on to 200 bytes.

Not every position needs to be sorted at 50 bytes: a 200-byte window is represented by the least
name among its 151 strings of 50 bytes (the leftmost of equals), its anchor. Equal windows have equal
anchors, and consecutive windows share one, so a run of up to 151 windows is one row:

1. One pass over the texts: runs as (anchor name, name of the whole run's bytes, start, length).
   Equal runs of a batch are combined before the shuffle: they are repeats, and one stays as witness.
2. Runs sorted by anchor. A lone anchor settles its windows as unique. Runs equal in full are
   repeats. Runs that share an anchor but differ go to the next offset, one per distinct content.
3. Those runs' bytes are cut from the texts and sorted by anchor again; windows of 200 bytes are
   compared on the bytes themselves. Anchors with very many different runs (the edges of a
   passage that a third of all documents hold) are sorted by 200-byte names instead, with equal
   names of a batch combined first, so no task holds them together.
4. The repeated windows of a document are gathered and cut out of its text.

Names are 64 bits, and equality always rests on two of them at least (anchor and run, or two
lanes of the window), or on the bytes.

Defined results
* null text counts as empty: 0 bytes, nothing removed, the hash of nothing. Texts under 200 bytes keep all.
* copies of a document of 200 bytes or more are all removed entirely, repeated rows included.
* every length is processed whole, in overlapping stretches of at most ``STRETCH`` bytes.
* an empty table gives an empty result; null ids are carried through; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import workers_import

LENGTH = 200
GRAM = 50
SPAN = LENGTH - GRAM + 1  # grams in a window
STRETCH = 2_000_000  # bytes whose names are held at a time
HOT_RUNS = 1000  # different runs of one anchor that a task compares on their bytes

_U = np.uint64
_LETTERS = np.random.default_rng(20240229).integers(1, 2**63, size=256, dtype=np.uint64)


def _named(x: np.ndarray, y: np.ndarray, lane: int = 0) -> np.ndarray:
    """Name of the pair (x, y)."""
    h = x * _U(0x9E3779B97F4A7C15 if lane == 0 else 0xC2B2AE3D27D4EB4F) + y
    h ^= h >> _U(29)
    h *= _U(0xBF58476D1CE4E5B9 if lane == 0 else 0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def gram_names(data: np.ndarray) -> np.ndarray:
    """Names of the 50 bytes at every position, by doubling 1, 2, 4, ... 32, then 32 and 32 overlapping."""
    h, n = _LETTERS[data], 1
    while 2 * n <= GRAM:
        h = _named(h[:-n], h[n:])
        n *= 2
    return _named(h[:-(GRAM - n)], h[GRAM - n:])


def window_names(grams: np.ndarray, at: np.ndarray, lane: int = 0) -> np.ndarray:
    """Names of the 200 bytes at the positions ``at``: 50 to 100 to 200."""
    a = _named(grams[at], grams[at + GRAM], lane)
    b = _named(grams[at + 2 * GRAM], grams[at + 3 * GRAM], lane)
    return _named(a, b, lane)


def anchors(grams: np.ndarray) -> np.ndarray:
    """Position of the least gram name of every window (leftmost of equals), by doubling minima."""
    low, at, n = grams, np.arange(len(grams), dtype=np.int32), 1
    while n < SPAN:
        step = min(n, SPAN - n)
        right = low[step:]
        left, at_left, at_right = low[:len(right)], at[:len(right)], at[step:]
        if step == n:
            take = right < left
        else:  # the stretches overlap: an equal name further right is the same or later
            take = right < left
        low = np.where(take, right, left)
        at = np.where(take, at_right, at_left)
        n += step
    return at


def _runs(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor name, run name, start, length) of the runs of one stretch of 200 bytes or more."""
    grams = gram_names(data)
    at = anchors(grams)
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    length = np.diff(np.concatenate([start, [len(at)]]))
    # first and last window of a run cover it
    name = _named(window_names(grams, start, 1), window_names(grams, start + length - 1, 1) + length.astype(np.uint64), 1)
    return grams[at[start]], name, start, length


def _stretches(size: int) -> Iterator[tuple[int, int]]:
    """Byte ranges that cut a text's windows into parts: ranges overlap by 199 bytes."""
    begin = 0
    while size - begin >= LENGTH:
        end = min(size, begin + STRETCH + LENGTH - 1)
        yield begin, end
        begin = end - LENGTH + 1


def text_runs(raw: bytes) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(raw, np.uint8)
    parts = [(a, n, s + begin, k) for begin, end in _stretches(len(raw)) for a, n, s, k in [_runs(data[begin:end])]]
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*parts))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(values))


FIRST = ("row long, doc_id long, n_bytes long, sha256 string, packed binary, anchor array<long>, run array<long>, "
         "start array<int>, length array<int>, more array<int>, done_start array<int>, done_length array<int>")


def _first_pass(docs: DataFrame) -> DataFrame:
    """Per document: its packed bytes, the runs to sort, and the runs already known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        pack = zstandard.ZstdCompressor(level=1).compress
        for big in batches:
            for lo in range(0, big.num_rows, 1000):
                batch = big.slice(lo, 1000)
                raws = [(t.as_py() or "").encode("utf-8", "replace") for t in batch.column(1)]
                per = [text_runs(raw) for raw in raws]
                counts = np.array([len(p[0]) for p in per])
                anchor, name, start, length = (np.concatenate(c) for c in zip(*per))
                owner = np.repeat(np.arange(len(raws)), counts)
                _, first, back, times = np.unique(_named(anchor, name), return_index=True, return_inverse=True, return_counts=True)
                sent = np.zeros(len(anchor), bool)
                sent[first] = True
                repeated = times[back] > 1
                send, done = owner[sent], owner[repeated]
                size = len(raws)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + size)), batch.column(0), pa.array([len(r) for r in raws], pa.int64()),
                    pa.array([hashlib.sha256(r).hexdigest() for r in raws]), pa.array([pack(r) for r in raws], pa.binary()),
                    _lists(anchor[sent].view(np.int64), np.bincount(send, minlength=size)),
                    _lists(name[sent].view(np.int64), np.bincount(send, minlength=size)),
                    _lists(start[sent].astype(np.int32), np.bincount(send, minlength=size)),
                    _lists(length[sent].astype(np.int32), np.bincount(send, minlength=size)),
                    _lists(repeated[sent].astype(np.int32), np.bincount(send, minlength=size)),
                    _lists(start[repeated].astype(np.int32), np.bincount(done, minlength=size)),
                    _lists(length[repeated].astype(np.int32), np.bincount(done, minlength=size)),
                ], [c.split()[0] for c in FIRST.split(", ")])
                row += size

    return docs.mapInArrow(run, FIRST)


def _sorted_runs(first: DataFrame) -> DataFrame:
    """Runs whose anchor is not alone: ``repeat`` (equal in full to another run), ``open`` (to be compared at 200 bytes)."""
    runs = first.select("row", F.inline(F.arrays_zip("anchor", "run", "start", "length", "more")))
    by_anchor, by_run = Window.partitionBy("anchor"), Window.partitionBy("anchor", "run")
    seen = F.sum(F.col("more") + 1)
    return (
        runs.repartition("anchor")
        .withColumn("equal", seen.over(by_run)).withColumn("nth", F.row_number().over(by_run.orderBy("row", "start")))
        .withColumn("all", seen.over(by_anchor)).withColumn("kinds", F.sum(F.when(F.col("nth") == 1, 1).otherwise(0)).over(by_anchor))
        .filter("all > 1")
        .select("row", "anchor", "start", "length", (F.col("equal") > 1).alias("repeat"),
                ((F.col("kinds") > 1) & (F.col("nth") == 1)).alias("open"), (F.col("kinds") > HOT_RUNS).alias("hot"), "more")
    )


CUT = "key long, lane long, row long, start int, length int, twice boolean, bytes binary, known boolean"


def _cut_runs(first: DataFrame, runs: DataFrame) -> DataFrame:
    """The bytes of the open runs (key: anchor), or their windows' names (key and lane) for hot anchors;
    ``known``: windows already seen to repeat within the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        names = [c.split()[0] for c in CUT.split(", ")]
        for big in batches:
            for lo in range(0, big.num_rows, 500):
                out, hot = [], []
                for r in big.slice(lo, 500).to_pylist():
                    raw = unpack(r["packed"])
                    data = np.frombuffer(raw, np.uint8)
                    for x in r["runs"]:
                        s, k, piece = x["start"], x["length"], raw[x["start"]:x["start"] + x["length"] + LENGTH - 1]
                        if x["hot"]:
                            grams, at = gram_names(data[s:s + k + LENGTH - 1]), np.arange(k)
                            hot.append((window_names(grams, at), window_names(grams, at, 1), np.full(k, r["row"]), s + at, np.full(k, x["repeat"])))
                        else:
                            out.append((x["anchor"], 0, r["row"], s, k, x["repeat"], piece, False))
                arrays = [list(c) for c in zip(*out)] if out else [[] for _ in names]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(a, type=t) for a, t in zip(arrays, types)], names)
                if hot:
                    key, lane, row, start, twice = (np.concatenate(c) for c in zip(*hot))
                    _, at, back, times = np.unique(_named(key, lane), return_index=True, return_inverse=True, return_counts=True)
                    known = (times[back] > 1) | twice
                    sent = np.zeros(len(key), bool)
                    sent[at] = True
                    keep = sent | known
                    n = int(keep.sum())
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.where(sent, key.view(np.int64), 0)[keep], mask=~sent[keep]), pa.array(lane.view(np.int64)[keep]),
                        pa.array(row[keep]), pa.array(start[keep].astype(np.int32)), pa.array(np.ones(n, np.int32)), pa.array(known[keep]),
                        pa.nulls(n, pa.binary()), pa.array(known[keep]),
                    ], names)

    listed = runs.filter("open").groupBy("row").agg(F.collect_list(F.struct("anchor", "start", "length", "repeat", "hot")).alias("runs"))
    return first.select("row", "packed").join(listed, "row").mapInArrow(run, CUT)


def _windows_of(rows: list[tuple]) -> Iterator[tuple]:
    """Repeated windows of the runs of one anchor, compared on their 200 bytes, as (row, start, length)."""
    count: dict[bytes, int] = {}
    for _, _, length, twice, data in rows:
        for i in range(length):
            w = data[i:i + LENGTH]
            count[w] = count.get(w, 0) + 1 + twice
    for row, start, length, _, data in rows:
        hits = [i for i in range(length) if count[data[i:i + LENGTH]] > 1]
        for _, group in groupby(enumerate(hits), lambda x: x[1] - x[0]):
            own = [i for _, i in group]
            yield row, start + own[0], len(own)


def _compare(cut: DataFrame) -> DataFrame:
    """Repeated windows among the cut runs: (row, start, length). Keys come sorted, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns))

        out: list[tuple] = []

        def flush():
            got = list(zip(*out)) or [[], [], []]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(got[0], pa.int64()), pa.array(got[1], pa.int32()), pa.array(got[2], pa.int32())], ["row", "start", "length"])

        for (_, _, named), group in groupby(rows(), lambda r: (r[0], r[1], r[6] is None)):
            if named:  # equal names of different batches: stream them, two are enough
                held, some = None, False
                for _, _, row, start, _, twice, _ in group:
                    if held is None:
                        held, some = (row, start, 1), twice
                        continue
                    if held is not False:
                        out.append(held)
                        held = False
                    out.append((row, start, 1))
                if held and some:
                    out.append(held)
            else:
                runs = [(row, start, length, twice, data) for _, _, row, start, length, twice, data in group]
                if len(runs) > 1:
                    out.extend(_windows_of(runs))
            if len(out) > 20_000:
                yield flush()
        yield flush()

    keyed = cut.filter("key IS NOT NULL").select("key", "lane", "row", "start", "length", "twice", "bytes")
    return keyed.repartition("key").sortWithinPartitions("key", "lane", F.col("bytes").isNull()).mapInArrow(run, "row long, start int, length int")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _removed(first: DataFrame, windows: DataFrame, every: bool) -> tuple[DataFrame, DataFrame]:
    """Result rows of the touched documents (of every one on request), and the rows of ``windows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                raw = unpack(r["packed"])
                edge = np.zeros(len(raw) + 1, np.int32)
                for ranges in (r["ranges"] or [], zip(r["done_start"], r["done_length"])):
                    for x in ranges:
                        s, k = (x["start"], x["length"]) if isinstance(x, dict) else x
                        edge[s] += 1
                        edge[s + k - 1 + LENGTH] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
                out.append((r["doc_id"], len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = list(zip(*out)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], [c.split()[0] for c in RESULT.split(", ")])

    per_row = windows.groupBy("row").agg(F.collect_list(F.struct("start", "length")).alias("ranges"))
    touched = first.select("row", "doc_id", "packed", "done_start", "done_length").join(per_row, "row", "left")
    if not every:
        touched = touched.filter(F.col("ranges").isNotNull() | (F.size("done_start") > 0))
    return touched.select("doc_id", "packed", "done_start", "done_length", "ranges").mapInArrow(run, RESULT), per_row


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the remaining bytes)."""
    docs = workers_import(docs).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    first = stage(_first_pass(docs), "repeat_runs")
    runs = stage(_sorted_runs(first), "repeat_sorted")
    cut = stage(_cut_runs(first, runs), "repeat_cut")
    windows = stage(
        runs.filter("repeat AND more = 0").select("row", "start", "length")
        .unionByName(cut.filter("known").select("row", "start", "length")).unionByName(_compare(cut)), "repeat_windows")
    removed, per_row = _removed(first, windows, with_text)
    if with_text:
        return removed
    whole = first.join(per_row.select("row"), "row", "left_anti").filter(F.size("done_start") == 0).select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha256").alias("kept_sha256"))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return removed.select(columns).unionByName(whole)
