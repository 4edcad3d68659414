"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled documents: one on
ordinary windows, one on the stretches of toxic text that ordinary text hardly contains
(6-byte strings whose document frequency is ``ratio`` times higher there, and by ``z`` standard errors).
The toxic coder reads the ordinary dictionary followed by the toxic one, the ordinary coder the
ordinary dictionary followed by as many bytes of ordinary text, so ordinary prose costs both the
same and only toxic wording is cheaper for the first. Every window of a text is compressed with
both; windows whose difference passes ``hit`` are compressed again word by word. A logistic curve
over these differences, fitted on labelled documents that the dictionaries have not seen, gives
the score. Language, source, identifier and label are never part of it.

Sampling bound (documented parameters): ``toxic_docs``/``ordinary_docs`` for the dictionaries and
``calibrate_toxic``/``calibrate_ordinary`` for the curve, each text of at most ``max_bytes``;
scoring reads every document and its whole text.

Defined results
* null text counts as empty; empty and wordless texts get the score of a text without hits.
* no usable labels, or one class only: nothing can be learnt, every score is 0.
* labels: repeated rows of an id count once (toxic if any says so); null ids and null flags are
  ignored. Repeated documents are scored alike; extra columns are ignored.
* null doc_id: scored, never held out.
* the sample is chosen by a hash of the identifier, so reruns learn the same model.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import workers_import

GRAM = 6


@dataclass(frozen=True)
class Fit:
    toxic_docs: int = 1200
    ordinary_docs: int = 2400
    calibrate_toxic: int = 500
    calibrate_ordinary: int = 1500
    max_bytes: int = 100_000
    window: int = 48
    ordinary_dictionary: int = 32_768
    toxic_dictionary: int = 3072
    level: int = 3
    z: float = 5.0
    ratio: float = 5.0
    hit: int = 2
    penalty: float = 1.0


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    fit: Fit


def held_out(doc_id: Column) -> Column:
    """Rows that learning must not see: crc32 of the id's text divisible by 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split()


def windows(text: str, size: int) -> list[bytes]:
    """The words of a text in order, grouped into windows of at least ``size`` bytes."""
    out, held, n = [], [], 0
    for w in _words(text):
        held.append(w)
        n += len(w) + 1
        if n >= size:
            out.append(b" %b " % b" ".join(held))
            held, n = [], 0
    if held or not out:
        out.append(b" %b " % b" ".join(held))
    return out


def _grams(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = len(a) - GRAM + 1
    v = np.zeros(max(n, 0), np.uint64)
    for j in range(GRAM if n > 0 else 0):
        v = v * np.uint64(256) + a[j:j + n]
    return v


def _flat(text: str) -> bytes:
    return b" %b " % b" ".join(_words(text))


def _frequencies(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    per_text = [np.unique(_grams(_flat(t))) for t in texts]
    return np.unique(np.concatenate(per_text), return_counts=True)


def distinct_texts(texts: list[str]) -> list[str]:
    """One text of each set of (near) copies: those that share the least hash of four words in a row.
    Copies would make any wording of theirs look typical of the class."""
    first: dict[int, str] = {}
    for t in texts:
        ws = _words(t)
        runs = (zlib.crc32(b" ".join(ws[i:i + 4])) for i in range(max(1, len(ws) - 3)))
        first.setdefault(min(runs), t)
    return list(first.values())


def telling_stretches(toxic: list[str], ordinary: list[str], z: float, ratio: float) -> list[bytes]:
    """Stretches of the toxic texts covered by strings that ordinary texts lack."""
    grams, k1 = _frequencies(toxic)
    other, counts = _frequencies(ordinary)
    k0 = np.zeros(len(grams))
    if len(other):
        at = np.minimum(np.searchsorted(other, grams), len(other) - 1)
        k0 = np.where(other[at] == grams, counts[at], 0)
    n1, n0 = len(toxic), len(ordinary)
    p = (k1 + k0) / (n1 + n0)
    score = (k1 / n1 - k0 / n0) / np.sqrt(np.maximum(p * (1 - p) * (1 / n1 + 1 / n0), 1e-12))
    telling = grams[(score > z) & (k1 / n1 > ratio * (k0 + 0.5) / n0)]
    out = []
    for t in toxic:
        data = _flat(t)
        edge = np.diff(np.concatenate([[0], np.isin(_grams(data), telling).astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            out.append(data[a:b + GRAM - 1])
    return out


def _trained(size: int, samples: list[bytes], **options) -> bytes:
    samples = [s * -(-8 // len(s)) for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples, **options).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the samples themselves
        return b"".join(dict.fromkeys(samples))[-size:]


class Coders:
    """The two compressors of a model, and the differences of a text under them."""

    def __init__(self, ordinary: bytes, toxic: bytes, fit: Fit):
        n = len(toxic)
        neutral = ordinary[-2 * n:-n] if n else b""
        self.plain, self.toxic = self._coder(ordinary + neutral, fit), self._coder(ordinary + toxic, fit)
        self.fit = fit

    @staticmethod
    def _coder(content: bytes, fit: Fit) -> zstandard.ZstdCompressor:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=fit.level)
        return zstandard.ZstdCompressor(level=fit.level, dict_data=d, write_content_size=False, write_dict_id=False, write_checksum=False)

    def gain(self, data: bytes) -> int:
        return len(self.plain.compress(data)) - len(self.toxic.compress(data))

    def features(self, text: str) -> list[float]:
        parts = windows(text, self.fit.window)
        gains = [self.gain(w) for w in parts]
        hits = [w for w, g in zip(parts, gains) if g >= self.fit.hit]
        again = [self.gain(b" %b " % q) for w in hits for q in (x.strip(b".,;:!?\"") for x in w.split()) if len(q) > 3]
        top = sorted(gains, reverse=True)[:3] + [0, 0]
        best = sorted(again, reverse=True)[:3] + [0, 0, 0]
        n = len(parts)
        sure = sum(g >= 3 for g in again)
        return [top[0], top[1], top[2], best[0], best[1], best[2], sure, sure / n, sum(g >= 4 for g in again) / n,
                float(np.log1p(n)), sum(g for g in gains if g > 0) / n, len(hits) / n]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + penalty * np.eye(a.shape[1])
        w = w + np.linalg.solve(hessian, a.T @ (weight * (y - p)) - penalty * w)
    return mean, scale, w


def learn(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), *, key: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Model | None:
    """A model from the labelled rows that are not held out; None if a class is missing."""
    flagged = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("__id")).agg(
        F.max(label).cast("int").alias("toxic")
    ).filter(~held_out(F.col("__id")))
    shares = {r["toxic"]: r["count"] for r in flagged.groupBy("toxic").count().collect()}
    if not shares.get(0) or not shares.get(1):
        return None
    sizes = {1: fit.toxic_docs + fit.calibrate_toxic, 0: fit.ordinary_docs + fit.calibrate_ordinary}
    order = F.xxhash64("__id")
    chosen = None
    for c, n in sizes.items():  # one hash order per class; bounded by the parameters
        part = flagged.filter(F.col("toxic") == c).orderBy(order, "__id").limit(n)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(stage(chosen, "toxicity_sample"))
    rows = docs.select(F.col(key).alias("__id"), F.col(text).alias("text")).filter(
        F.octet_length(F.coalesce("text", F.lit(""))) <= fit.max_bytes
    ).join(chosen, "__id").select("__id", "toxic", "text").collect()
    rows = sorted({(r["__id"], r["toxic"], r["text"] or "") for r in rows})
    rng = np.random.default_rng(7)
    by_class = {c: [t for _, k, t in rows if k == c] for c in (0, 1)}
    if not by_class[0] or not by_class[1]:
        return None
    seen, fresh = {}, {}
    for c, own in ((1, fit.toxic_docs), (0, fit.ordinary_docs)):
        texts = distinct_texts([by_class[c][i] for i in rng.permutation(len(by_class[c]))])
        cut = min(own, max(1, len(texts) * own // sizes[c]))
        seen[c], fresh[c] = texts[:cut], texts[cut:] or texts
    ordinary = _trained(fit.ordinary_dictionary, [w for t in seen[0] for w in windows(t, fit.window)])
    toxic = _trained(fit.toxic_dictionary, telling_stretches(seen[1], seen[0], fit.z, fit.ratio), k=32, d=6)[-fit.toxic_dictionary:]
    coders = Coders(ordinary, toxic, fit)
    x = np.array([coders.features(t) for c in (1, 0) for t in fresh[c]], float)
    y = np.array([1.0] * len(fresh[1]) + [0.0] * len(fresh[0]))
    # back to the classes' shares among all labels
    share = shares[1] / (shares[0] + shares[1])
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(ordinary, toxic, *_logistic(x, y, weight, fit.penalty), fit)


def score_documents(docs: DataFrame, model: Model | None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if model is None:
        scored = rows.select("doc_id", F.lit(0.0).alias("score"))
    else:
        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coders = Coders(model.ordinary, model.toxic, model.fit)
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = np.array([coders.features(t.as_py() or "") for t in batch.column(1)], float)
                p = np.column_stack([np.ones(len(x)), (x - model.mean) / model.scale]) @ model.weights
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(p, -30, 30))))], ["doc_id", "score"])

        scored = workers_import(rows).mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
