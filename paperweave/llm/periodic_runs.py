"""Periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at
least max(6, 4q) words long, that no neighbouring word extends with the same period.

Every word of a run stands in it at least four times. So a word that occurs fewer than four times
within a segment belongs to no run inside it and splits the segment there; the parts are counted
again until nothing splits any more, and parts of fewer than six words go. What survives is scanned
lag by lag. At lag q only the words at multiples of q are looked at: a run covers at least 3q
places that equal their neighbour at q, so three multiples of q in a row. That makes the scan of a segment
of n words O(n log n) whatever it holds. Places where a hash of the whole stretch agrees too are
compared word by word and extended to both sides. Lags rise, and a place inside a run found before is
passed over: its period there is a multiple of the run's.

Documents are independent: there is no shuffle, and no key, source or copy can get hot. A lost
task repeats its own texts.

Defined results
* null, empty or wordless text: no runs, collapsed text empty.
* any length: the work of a text is O(words * log words) and a few arrays of its length.
* ties: runs come by start, then period; the greatest exponent takes the smallest start, then period.
* repeated rows and identifiers: one result row each; null identifiers are kept.
* an empty table gives an empty result; ``find_runs`` keeps all other columns.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound, workers_import, words

# fixed values: least length of a run, least number of its periods
LEAST_WORDS = 6
LEAST_PERIODS = 4

PAIRS = 1 << 20  # (lag, place) pairs looked at in one step
RUNS_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _bounds(places: np.ndarray) -> np.ndarray:
    """Where a new stretch of consecutive places begins."""
    fresh = np.empty(len(places), bool)
    fresh[0] = True
    np.not_equal(np.diff(places), 1, out=fresh[1:])
    return fresh


def segments(ids: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (begin, end) that may hold runs: no word in them is rarer than a run needs.

    Each pass splits all open stretches at their rare words; a stretch that lost nothing is done.
    """
    done: list[tuple[int, int]] = []
    places = np.flatnonzero(counts[ids] >= LEAST_PERIODS)
    while len(places):
        fresh = _bounds(places)
        number = np.cumsum(fresh) - 1
        sizes = np.bincount(number)
        long_enough = sizes[number] >= LEAST_WORDS
        places, number = places[long_enough], number[long_enough]
        if not len(places):
            break
        _, cell, per_cell = np.unique(number * np.int64(len(counts)) + ids[places], return_inverse=True, return_counts=True)
        rare = per_cell[cell] < LEAST_PERIODS
        split = np.zeros(len(sizes), bool)
        split[number[rare]] = True
        for n in np.unique(number[~split[number]]):
            at = np.searchsorted(number, [n, n + 1])
            done.append((int(places[at[0]]), int(places[at[1] - 1]) + 1))
        places = places[~rare & split[number]]
    return sorted(done)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _candidates(w: np.ndarray, prefix: np.ndarray, powers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(lag q, places k*q) where w[s:s+2q+1] and w[s+q:s+3q+1] have equal hashes."""
    n, q = len(w), 1
    most = n // LEAST_PERIODS
    while q <= most:
        # as many lags as fit into one step, at least one
        lags = np.arange(q, min(most, q + max(1, PAIRS * q // n)) + 1, dtype=np.int64)
        per_lag = (n - 1) // lags - 2  # multiples k of the lag with k + 3 inside the segment
        lags, per_lag = lags[per_lag > 0], per_lag[per_lag > 0]
        lag = np.repeat(lags, per_lag)
        place = (np.arange(len(lag)) - np.repeat(np.cumsum(per_lag) - per_lag, per_lag)) * lag
        first = w[place]
        same = np.flatnonzero(first == w[place + lag])
        same = same[w[place[same] + 2 * lag[same]] == first[same]]
        same = same[w[place[same] + 3 * lag[same]] == first[same]]
        if len(same):
            p, g = place[same], lag[same]
            here = (prefix[p + 2 * g + 1] - prefix[p]) * powers[g]
            there = prefix[p + 3 * g + 1] - prefix[p + g]
            p, g = p[here == there], g[here == there]
            if len(p):
                cuts = np.flatnonzero(np.diff(g)) + 1
                for part in np.split(np.arange(len(p)), cuts):
                    yield int(g[part[0]]), p[part]
        q = int(lags[-1]) + 1 if len(lags) else most + 1


def _extended(w: np.ndarray, s: int, q: int) -> tuple[int, int]:
    """The maximal [begin, end) around w[s:s+q] whose words equal those q further on (begin..end are left places)."""
    n, step, end = len(w) - q, 64, s
    while end < n:
        stop = min(n, end + step)
        differs = np.flatnonzero(w[end:stop] != w[end + q:stop + q])
        if len(differs):
            end += int(differs[0])
            break
        end, step = stop, step * 2
    begin, step = s, 64
    while begin > 0:
        stop = max(0, begin - step)
        differs = np.flatnonzero(w[stop:begin] != w[stop + q:begin + q])
        if len(differs):
            begin = stop + int(differs[-1]) + 1
            break
        begin, step = stop, step * 2
    return begin, end


def lag_scan(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a segment of word numbers."""
    powers = _powers(len(w) + 1)
    hashed = (w.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
    hashed ^= hashed >> np.uint64(29)
    prefix = np.zeros(len(w) + 1, np.uint64)
    np.cumsum(hashed * powers[:-1], dtype=np.uint64, out=prefix[1:])
    runs: list[tuple[int, int, int]] = []
    reach = np.zeros(len(w) + 1, np.int64)  # furthest end of a run found so far that covers the place
    for q, places in _candidates(w, prefix, powers):
        places = places[reach[places] < places + 3 * q + 1]
        at = 0
        while at < len(places):
            s = int(places[at])
            begin, end = _extended(w, s, q)
            if end - s >= 2 * q + 1:
                length = end - begin + q
                if length >= max(LEAST_WORDS, LEAST_PERIODS * q):
                    runs.append((begin, length, q))
                    np.maximum(reach[begin:begin + length], begin + length, out=reach[begin:begin + length])
                at = int(np.searchsorted(places, end))
            else:  # equal hashes of different words
                at += 1
    return runs


def text_runs(tokens: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    if len(tokens) < LEAST_WORDS:
        return []
    counted = Counter(tokens)
    if max(counted.values()) < LEAST_PERIODS:
        return []
    numbers = dict(zip(counted, range(len(counted))))
    ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
    counts = np.fromiter(counted.values(), np.int64, len(counted))
    found = []
    for begin, end in segments(ids, counts):
        found += [(begin + s, length, q) for s, length, q in lag_scan(ids[begin:end])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(tokens: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those that some run holds after its first period."""
    if not runs:
        return b" ".join(tokens)
    depth = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(depth, [s + q for s, _, q in runs], 1)
    np.add.at(depth, [s + length for s, length, _ in runs], -1)
    return b" ".join([tokens[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)])


def find_runs(docs: DataFrame, *, text: str = "text", runs: str = "runs", out: str = "collapsed") -> DataFrame:
    """All columns of ``docs`` (those named as the two results are replaced), with ``runs``
    (array of start, length, period) and the text without its repetitions (words joined by a space)."""
    fields = [f for f in docs.schema.fields if f.name not in (runs, out) or f.name == text]
    names = [f.name for f in fields]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = [], []
            for value in batch.column(names.index(text)):
                tokens = (value.as_py() or "").encode("utf-8", "replace").split()
                r = text_runs(tokens)
                found.append([dict(zip(("start", "length", "period"), x)) for x in r])
                texts.append(collapsed(tokens, r).decode("utf-8"))
            columns = [c for c, name in zip(batch.columns, names) if name not in (runs, out)]
            kept = [name for name in names if name not in (runs, out)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.list_(_RUN)), pa.array(texts, pa.string())], names=[*kept, runs, out])

    schema = T.StructType([f for f in fields if f.name not in (runs, out)])
    schema = schema.add(runs, T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long")))
    return workers_import(docs).select(names).mapInArrow(scan, schema.add(out, "string"))


def best_run(runs: Column) -> Column:
    """The run of greatest length / period (exact), the earliest and then shortest period on ties; null without runs."""
    def better(best: Column, run: Column) -> Column:
        wins = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(wins, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def planted(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text)`` with the repetitions that the query's contract plants into every tenth document (by
    crc32 of the identifier): from word a on, the words go round the p words that start there.
    Rows with a null identifier stay as they are."""
    h = F.crc32(F.col(key).cast("string"))
    g = F.floor(h / 10).cast("long")

    def spread(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        first = F.slice(w, F.lit(1), a.cast("int"))
        cycle = F.slice(w, (a + 1).cast("int"), p.cast("int"))
        times = F.ceil((n - a) / p).cast("int")
        rest = F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), (n - a).cast("int"))
        return F.when(n > 0, F.array_join(F.concat(first, rest), " ")).otherwise(F.lit(""))

    return docs.select(
        F.col(key).cast("long").alias(key),
        F.when(F.pmod(h, F.lit(10)) == 0, bound(words(F.col(text)), spread)).otherwise(F.col(text)).alias(text),
    )


def run_report(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest row per document: number of runs, the best run, digests of all runs and of the collapsed text."""
    found = find_runs(docs.select(key, text), text=text, runs="__runs", out="__collapsed")
    listed = F.transform("__runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.when(F.size("__runs") > 0, F.concat(F.array_join(listed, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        key, F.size("__runs").cast("long").alias("n_runs"), best_run(F.col("__runs")).alias("__best"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("__collapsed"), 256).alias("collapsed_sha256"),
    ).select(
        key, "n_runs", "__best.start", "__best.length", "__best.period",
        F.expr("1000 * __best.length div __best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )
