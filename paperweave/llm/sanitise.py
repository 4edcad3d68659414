"""Personal data: fixed patterns, then information-theoretic sanitisation of what gives them away.

Pattern pass: e-mail addresses, IP addresses, card and phone numbers, leftmost without overlap per
kind. Every find stands for two protected entities: its normalised value, and the group that the value belongs to
(domain of an e-mail address, /24 network of an IP address, first six digits of a card, a phone number without its last
seven digits). Terms are the words outside finds.

Disclosure: over the whole corpus, a term t reveals an entity e when P(e | t) = texts that hold both /
texts that hold t, is at least ``posterior``, the pointwise information log2 P(e | t) / P(e) at least
``bits``, and the co-occurrence significant: the Chernoff bound of its hypergeometric tail, times the
number of (entity, term) pairs, is at most ``alpha``. Texts count once however often they are copied
(equal words outside the finds, so the rows of a form letter are one text). Every occurrence of a
telling term, in every document, is a span of kind ``term``. ``sanitise`` replaces pattern finds by
their kind, removes terms that reveal a value (``[TERM]``, capitalised ones ``[NAME]``) and generalises
terms that reveal a group only to what the group is (``[ORGANISATION]``, ``[NETWORK]``, ``[ISSUER]``, ``[REGION]``).

The texts are read three times: entities and terms of documents with finds; how many texts hold each
candidate term; spans. Pairs are counted only where they can be significant: no count below the least
one that could be, no entity in more texts than ``bits`` allows, no term held by more texts than its entity could explain.

Defined results
* null text counts as empty: no finds. Whole texts are read, whatever their length; patterns run in
  linear time (possessive repeats, no restart inside a run).
* a find that fails its check (parts over 255, Luhn, number of digits) is dropped without a retry.
* terms never overlap a pattern find; terms that several entities make telling are reported once.
* tables go to the workers whole only while their counted bytes are at most ``broadcast_bytes``; beyond it terms,
  telling ones too, meet the texts in joins (hot terms salted), with the same result.
* repeated rows are searched alike; null ids are carried through; an empty table gives an empty
  result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import ROW, numbered, salted_join, workers_import

# fixed values: kinds in order, patterns
KINDS = ("email", "ip", "card", "phone")
GROUPS = ("ORGANISATION", "NETWORK", "ISSUER", "REGION")  # what a group of each kind is
TERM = len(KINDS)  # span kind of terms that reveal a value; TERM + 1 + kind: terms that reveal a group of that kind
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")


@dataclass(frozen=True)
class Disclosure:
    """``alpha``: chance that chance alone makes any term telling; ``broadcast_bytes``: bytes that a worker may hold
    of each table (candidate terms, protected entities, copied texts, telling terms)."""

    posterior: float = 0.5
    bits: float = 3.0
    alpha: float = 0.01
    broadcast_bytes: int = 32 << 20


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(found: str) -> str:
    return "".join(c for c in found if c in "0123456789")


def pattern_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, kind number, end, normalised value) of every pattern find, in order of start, then kind."""
    out = []
    if "@" in text:
        out += [(s, 0, e, text[s:e].lower()) for s, e in _emails(text)]
    if "." in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append((m.start(), 2, m.end(), d))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(d := _digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end(), "+" + d))
    return sorted(out)


def free_words(text: str, spans: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int]]:
    """(start, end) of every word that no pattern find touches. ``spans`` are in order of start."""
    finds = iter(spans)
    find = next(finds, None)
    for m in _TERM.finditer(text):
        while find and find[2] <= m.start():
            find = next(finds, None)
        if not find or find[0] >= m.end():
            yield m.start(), m.end()


def lowered(text: str, spans: list[tuple[int, int, str, str]]) -> str:
    """The terms of a text in order, one space between; what makes two rows copies of one text."""
    return " ".join([text[s:e] for s, e in free_words(text, spans)] if spans else _TERM.findall(text)).lower()


def group_of(kind: int, value: str) -> str:
    """The group that a normalised value belongs to."""
    if kind == 0:
        return value.partition("@")[2]
    return value.rpartition(".")[0] if kind == 1 else value[:6] if kind == 2 else value[:-7]


_CODES = 16  # an entity's number modulo this is the span kind of the terms that reveal it


def _entity(code: int, name: str) -> int:
    return (xxhash.xxh3_64_intdigest(name) - 2**63) // _CODES * _CODES + code


def entities_of(kind: int, value: str) -> tuple[int, int]:
    """The numbers of the two entities of a find: value and group."""
    return _entity(TERM, f"{KINDS[kind]}:{value}"), _entity(TERM + 1 + kind, f"{GROUPS[kind]}:{group_of(kind, value)}")


FOUND = "digest binary, entities array<long>, terms array<string>"


def _found(docs: DataFrame) -> DataFrame:
    """Per row: digest of its terms; where it has finds, their distinct entities and its distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest, entities, terms = [], [], []
            for t in batch.column(0):
                text = t.as_py() or ""
                spans = pattern_spans(text)
                words = lowered(text, spans)
                digest.append(xxhash.xxh3_128_digest(words))
                entities.append(sorted({x for _, k, _, v in spans for x in entities_of(k, v)}))
                terms.append(sorted(set(words.split())) if spans else [])
            yield pa.RecordBatch.from_arrays([
                pa.array(digest, pa.binary()), pa.array(entities, pa.list_(pa.int64())), pa.array(terms, pa.list_(pa.string())),
            ], ["digest", "entities", "terms"])

    return docs.select("text").mapInArrow(run, FOUND)


def _fits(rows: DataFrame, limit: int) -> bool:
    """Whether the rows' counted bytes (64 a row besides texts) are at most ``limit``."""
    texts = [F.octet_length(c) for c, t in rows.dtypes if t in ("string", "binary")]
    return (rows.agg(F.sum(sum(texts, F.lit(64)).cast("bigint"))).first()[0] or 0) <= limit


def _held(rows: DataFrame, limit: int) -> Broadcast | None:
    """Broadcast set of a one-column table, or None when it has more than ``limit`` bytes."""
    if not _fits(rows, limit):
        return None
    return rows.sparkSession.sparkContext.broadcast(frozenset(bytes(r[0]) if isinstance(r[0], bytearray) else r[0] for r in rows.collect()))


def _holders(docs: DataFrame, terms: DataFrame, copied: DataFrame, cfg: Disclosure) -> DataFrame:
    """(term, n_term): how many texts hold each of the candidate terms. Texts whose digest is in ``copied``
    stand in several rows; their terms go out with the digest, so that they count once."""
    held, again = _held(terms, cfg.broadcast_bytes), _held(copied, cfg.broadcast_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, twice = held.value if held else None, again.value if again else None
        done: set[bytes] = set()
        for batch in batches:
            count: dict[str, int] = {}
            out: list[tuple] = []
            for t in batch.column(0):
                text = t.as_py() or ""
                words = lowered(text, pattern_spans(text))
                digest = xxhash.xxh3_128_digest(words)
                own = set(words.split())
                if wanted is not None:
                    own &= wanted
                if twice is not None and digest not in twice:
                    for w in own:
                        count[w] = count.get(w, 0) + 1
                elif digest not in done:
                    done.add(digest)
                    out += [(w, 1, digest) for w in own]
            out += [(w, n, None) for w, n in count.items()]
            columns = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary()))], ["term", "n", "digest"])

    counted = docs.select("text").mapInArrow(run, "term string, n long, digest binary")
    if not held:
        counted = counted.join(terms, "term", "left_semi")
    texts = counted.groupBy("term", "digest").agg(F.when(F.col("digest").isNull(), F.sum("n")).otherwise(F.lit(1)).alias("n"))
    return texts.groupBy("term").agg(F.sum("n").alias("n_term"))


def least_support(texts: int, tests: int, alpha: float) -> int | None:
    """The smallest number of texts that an entity and a term must share to be significant at all."""
    return next((k for k in range(1, int(texts / math.e) + 1) if math.log(tests) + k * math.log(k / texts) <= math.log(alpha)), None)


def _sized(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if _fits(df, limit) else df


def disclosures(docs: DataFrame, cfg: Disclosure) -> DataFrame | None:
    """(entity, term, posterior, bits) of the terms that reveal an entity beyond the thresholds; None when no pair can."""
    found = stage(_found(docs).withColumn("row", F.monotonically_increasing_id()), "pii_found")
    with_finds = found.filter(F.size("entities") > 0)
    evidence = stage(with_finds.select("digest", "row", F.explode("entities").alias("entity")).groupBy("entity", "digest").agg(
        F.min("row").alias("row")), "pii_evidence")
    per_entity = stage(evidence.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")), "pii_entities")
    # copies hold the same terms, so one row speaks for all rows of its digest
    texts = with_finds.groupBy("digest").agg(F.min("row").alias("row"))
    per_term = stage(with_finds.select("row", "terms").join(texts.select("row"), "row", "left_semi").select(
        F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_seen")), "pii_terms")
    total = found.agg(F.countDistinct("digest")).first()[0]
    tests = per_entity.count() * per_term.count()
    least = least_support(total, tests, cfg.alpha) if tests else None
    if least is None:
        return None
    # an entity in more texts than this has too little information for any term
    entities = stage(per_entity.filter((F.col("n_entity") >= least) & (F.col("n_entity") * 2.0**cfg.bits <= total)), "pii_known")
    terms = stage(per_term.filter(F.col("n_seen") >= least).select("term"), "pii_candidates")
    if entities.isEmpty() or terms.isEmpty():
        return None
    copied = stage(found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"), "pii_copied")
    known = stage(_holders(docs, terms, copied, cfg), "pii_holders")
    own = evidence.join(_sized(entities, cfg.broadcast_bytes), "entity").select("entity", "n_entity", "row")
    both = (
        own.join(with_finds.select("row", "terms"), "row").select("entity", "n_entity", F.explode("terms").alias("term"))
        .join(_sized(known, cfg.broadcast_bytes), "term").filter(F.col("n_term") * cfg.posterior <= F.col("n_entity"))
        .groupBy("entity", "term", "n_entity", "n_term").agg(F.count(F.lit(1)).alias("n_both"))
    )
    q, p = F.col("n_both") / F.col("n_term"), F.col("n_entity") / F.lit(total)
    # n_term times the relative entropy of q to p bounds the tail (Hoeffding); a share of 0 adds nothing
    rest = F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - p))).otherwise(0.0)
    log_tail = -F.col("n_term") * (q * F.log(q / p) + rest)
    return both.filter((q >= cfg.posterior) & (F.log2(q / p) >= cfg.bits) & (log_tail + math.log(tests) <= math.log(cfg.alpha))).select(
        "entity", "term", q.alias("posterior"), F.log2(q / p).alias("bits"))


def telling_terms(docs: DataFrame, cfg: Disclosure) -> DataFrame | None:
    """(term, kind) of the terms that reveal any entity, kind as in spans (values before groups); None when none can."""
    told = disclosures(docs, cfg)
    if told is None:
        return None
    return stage(told.groupBy("term").agg(F.min(F.pmod("entity", F.lit(_CODES))).cast("int").alias("kind")), "pii_telling")


TOLD = f"{ROW}: telling terms"


def with_telling(docs: DataFrame, text: str, cfg: Disclosure) -> tuple[DataFrame, Broadcast | None]:
    """Telling terms as one broadcast dictionary while they fit; else ``docs`` with a column ``TOLD``, the
    telling terms of each row's own text, and None."""
    share = docs.sparkSession.sparkContext.broadcast
    telling = telling_terms(docs.select(F.col(text).alias("text")), cfg)
    if telling is None:
        return docs, share({})
    if _fits(telling, cfg.broadcast_bytes):
        return docs, share({r["term"]: r["kind"] for r in telling.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, terms = [], []
            for row, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = t.as_py() or ""
                own = sorted(set(lowered(value, pattern_spans(value)).split()))
                rows += [row] * len(own)
                terms += own
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(terms, pa.string())], ["row", "term"])

    docs = numbered(docs)
    # of all terms of all texts only the telling ones are written
    pairs = stage(docs.select(F.col(ROW).alias("row"), F.col(text).alias("text")).mapInArrow(run, "row long, term string").join(
        telling.select("term"), "term", "left_semi"), "pii_told_rows")
    counted = telling.join(pairs.groupBy("term").agg(F.count(F.lit(1)).alias("n_rows")), "term")
    told = salted_join(pairs, counted, "term", "n_rows", F.xxhash64("row"), "inner").groupBy(F.col("row").alias(ROW)).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias(TOLD))
    return docs.join(told, ROW, "left").drop(ROW), None


def term_spans(text: str, spans: list[tuple[int, int, str, str]], telling: dict[str, int]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every occurrence of a telling term outside the finds."""
    if not telling:
        return []
    return [(s, telling[w], e) for s, e in free_words(text, spans) if (w := text[s:e].lower()) in telling]


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
SPANS = "doc_id long, base array<struct<start int, kind int, end int>>, spans array<struct<start int, kind int, end int>>"


def find_spans(docs: DataFrame, cfg: Disclosure = Disclosure(), *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, base and spans (arrays of start, kind, end; kinds from 4 on are telling terms)."""
    docs, shared = with_telling(workers_import(docs).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), "text", cfg)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed(spans):
            return [{"start": s, "kind": k, "end": e} for s, k, e in spans]

        for batch in batches:
            base, spans = [], []
            own = [shared.value] * batch.num_rows if shared else [dict(t or ()) for t in batch.column(2).to_pylist()]
            for t, telling in zip(batch.column(1), own):
                value = t.as_py() or ""
                finds = pattern_spans(value)
                plain = [f[:3] for f in finds]
                base.append(listed(plain))
                spans.append(listed(sorted(plain + term_spans(value, finds, telling))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.list_(_SPAN)), pa.array(spans, pa.list_(_SPAN))], ["doc_id", "base", "spans"])

    return docs.mapInArrow(run, SPANS)


def _written(spans):
    names = F.array(*[F.lit(k) for k in KINDS], *[F.lit("term")] * (1 + len(GROUPS)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s.getField("kind")), s.getField("start").cast("string"), s.getField("end").cast("string"))), ",")


def span_report(docs: DataFrame, cfg: Disclosure = Disclosure(), **columns: str) -> DataFrame:
    """One row per document: doc_id, counts per kind, digest of the pattern finds, all spans as text."""
    found = find_spans(docs, cfg, **columns)

    def count(of: str, kind: int, name: str, last: int | None = None):
        return F.size(F.filter(of, lambda s: s.getField("kind").between(kind, last or kind))).cast("long").alias(f"n_{name}")

    counts = [count("base", i, k) for i, k in enumerate(KINDS)]
    terms = count("spans", TERM, "term", TERM + len(GROUPS))
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"), terms)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span (start, kind, end) replaced; overlapping finds become one replacement."""
    out, done = [], 0
    for start, kind, end in sorted(spans):
        if end <= done:
            continue
        if start >= done:
            out.append(text[done:start])
            word = "NAME" if text[start].isupper() else "TERM"
            out.append(f"[{KINDS[kind].upper() if kind < TERM else word if kind == TERM else GROUPS[kind - TERM - 1]}]")
        done = end
    return "".join(out) + text[done:]


def sanitise(docs: DataFrame, cfg: Disclosure = Disclosure(), *, text: str = "text") -> DataFrame:
    """``docs`` with the text column sanitised, all other columns as they came. Every row's spans come from
    its own text, so repeated and null identifiers are safe."""
    columns = docs.columns
    docs, shared = with_telling(workers_import(docs), text, cfg)

    def clean(value: str | None, telling: dict[str, int]) -> str | None:
        if value is None:
            return None
        finds = pattern_spans(value)
        return redacted(value, [f[:3] for f in finds] + term_spans(value, finds, telling))

    @F.pandas_udf("string")
    def replace(texts: pd.Series) -> pd.Series:
        return texts.map(lambda value: clean(value, shared.value))

    @F.pandas_udf("string")
    def replace_own(texts: pd.Series, told: pd.Series) -> pd.Series:
        return pd.Series([clean(value, dict(own or ())) for value, own in zip(texts, told)], dtype=object)

    return docs.withColumn(text, replace(F.col(text)) if shared else replace_own(F.col(text), F.col(TOLD))).select(columns)
