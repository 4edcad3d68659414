"""Near duplicates by one-permutation MinHash, optimal densification, banded buckets and stars.

A document's set holds its distinct 3-word shingles (64-bit hashes). Two documents link when
100 * intersection >= 85 * union on the full sets; the result is the component of every document.

1. One permutation: a set's hashes are dealt into 125 bins by their high bits, the least of a bin is its
   value. An empty bin takes the value of the first filled bin of its own fixed random sequence
   (optimal densification), so a bin of two sets agrees with the probability of their similarity.
2. Five bins make a band: 25 buckets a set. A pair at 0.85 shares no bucket with probability
   (1 - 0.85^5)^25 = 4e-7. Equal sets are one class; sets of fewer than six shingles
   link only to equal ones.
3. Star edges: the members of a bucket are paired with its first member, the centre, only, so a
   bucket of m sets gives m - 1 pairs. They are verified on the full sets.
4. What the stars leave open: members of a star that is still in several components. Their differences
   from the centre give the star's consensus (the tokens that most members hold), and D(x), the
   tokens in which x differs from it. Sets x and y differ in |D(x)| + |D(y)| - 2 |D(x) & D(y)| tokens, at most 3/37 of both
   sizes if they link. If |D(x)| + |D(y)| is no more than that, both link to the member closest to the consensus: one
   more star. Else D(x) and D(y) share a token. In each star tokens are ordered by the number of members
   that differ in them, rarest first; the tokens before the first shared one belong to one set only, so its places in the
   two lists add up to 3/37 of both sizes at most. Cells (star, token) with two members that can meet this go
   on: a small cell is compared pair by pair (D(x) and D(y) give the exact similarity), a large one is a new star.
   A cell's centre comes after its star's, so this ends. Nothing is capped.

Only tokens of sets that meet in a bucket are looked at again, their texts travel compressed.

Defined results
* null, empty or wordless text: n_shingles 0, linked with nothing, component_id its own doc_id, kept.
* fewer than three words: the whole sequence is the one shingle.
* equal sets, repeated rows: one component. Rows may share a doc_id; all rows that carry the
  component's smallest doc_id are kept. Null ids only name a component without any other id.
* an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.graph import star_forest
from ..session import drop_staged, stage
from .common import salted_join, workers_import
from .ngram_join import _HASHES, _mixed

SHINGLE = 3
BANDS, ROWS = 25, 5
BINS = BANDS * ROWS
LEAST_SET = 6  # smaller sets link only to equal ones
BROADCAST_REPS = 1_000_000  # sets to fetch whose numbers (8 bytes each) are broadcast; more are joined by a shuffle
PIECE = 1024  # rows that a Python worker holds at a time
SMALL_CELL = 64  # members of a cell that is compared pair by pair: at most 31.5 pairs a member

_MULTIPLIERS = np.array([(int.from_bytes(xxhash.xxh3_128_digest(b"place %d" % i)[:8], "little") | 1) for i in range(max(SHINGLE, ROWS))], np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes (uint64). bytes.lower and bytes.split are exactly A-Z and the six spaces."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    if n < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b"short " + b" ".join(words))], np.uint64)
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    h = np.zeros(n - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        h += w[i:n - SHINGLE + 1 + i] * _MULTIPLIERS[i]
    return np.unique(_mixed(h))


def bin_values(tokens: np.ndarray) -> np.ndarray:
    """The value of every bin of a set that is not empty: its least hash, densified."""
    bins = ((tokens >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    at = np.minimum(np.searchsorted(bins, np.arange(BINS, dtype=np.uint64)), len(tokens) - 1)
    filled = bins[at] == np.arange(BINS, dtype=np.uint64)
    values = tokens[at]
    empty = np.flatnonzero(~filled)
    attempt, width = 0, 8
    while len(empty):
        tried = (empty[:, None] << 32) + np.arange(attempt, attempt + width)
        other = (_mixed(tried.astype(np.uint64)) % np.uint64(BINS)).astype(np.int64)
        hit = filled[other]
        found = hit.any(axis=1)
        values[empty[found]] = tokens[at[other[found, hit[found].argmax(axis=1)]]]
        empty = empty[~found]
        attempt, width = attempt + width, min(2 * width, 1024)
    return values


def band_keys(tokens: np.ndarray) -> np.ndarray:
    """One bucket number per band (int64); the band is part of the number."""
    by_band = bin_values(tokens).reshape(BANDS, ROWS) * _MULTIPLIERS[:ROWS]
    return _mixed(by_band.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def differences(x: np.ndarray, centre: np.ndarray) -> tuple[bool, np.ndarray]:
    """Whether the sets link, and the tokens that only one of them holds (int64)."""
    at = np.minimum(np.searchsorted(centre, x), len(centre) - 1)
    common = centre[at] == x
    both = int(common.sum())
    lacking = np.ones(len(centre), bool)
    lacking[at[common]] = False
    apart = np.concatenate([x[~common], centre[lacking]])
    return 100 * both >= 85 * (len(x) + len(centre) - both), apart.view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(arrays) if arrays else np.empty(0, np.int64))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            yield batch.slice(at, PIECE)


def _signed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n, sig, packed, bands) per document; text and bands only for the first of equal sets in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        pack = zstandard.ZstdCompressor(level=1).compress
        nothing = np.empty(0, np.int64)
        for batch in _pieces(batches):
            sizes, sigs, texts, bands, known = [], [], [], [], set()
            for value in batch.column(1):
                text = value.as_py() or ""
                s = shingle_set(text)
                sig = xxhash.xxh3_128_digest(s.tobytes())
                first = sig not in known and len(s) >= LEAST_SET
                known.add(sig)
                sizes.append(len(s))
                sigs.append(sig)
                texts.append(pack(text.encode("utf-8", "replace")) if first else None)
                bands.append(band_keys(s) if first else nothing)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + len(sizes))), batch.column(0), pa.array(sizes, pa.int64()),
                pa.array(sigs, pa.binary()), pa.array(texts, pa.binary()), _lists(bands),
            ], ["row", "doc_id", "n", "sig", "packed", "bands"])
            row += len(sizes)

    return docs.mapInArrow(run, "row long, doc_id long, n long, sig binary, packed binary, bands array<long>")


def _bucket_stars(rows: DataFrame, reps: DataFrame) -> DataFrame:
    """Distinct (c, x): every set with the first set of each of its buckets."""
    firsts = rows.filter(F.size("bands") > 0).select("row", "bands").join(reps, "row", "left_semi")
    posted = stage(firsts.select(F.explode("bands").alias("bucket"), F.col("row").alias("x")), "minhash_buckets")
    shared = posted.groupBy("bucket").agg(F.min("x").alias("c"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    return salted_join(posted, shared, "bucket", "members", F.col("x"), "inner").filter("c < x").select("c", "x").distinct()


def _compared(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """(c, x, n, linked, apart) for every pair, from the full sets. A centre may be that of very many pairs."""
    wanted = stage(pairs.select(F.col("c").alias("row")).unionByName(pairs.select(F.col("x").alias("row"))).distinct(), "minhash_wanted")
    if wanted.count() <= BROADCAST_REPS:
        wanted = F.broadcast(wanted)
    texts = rows.filter("packed IS NOT NULL").select("row", "packed").join(wanted, "row", "left_semi")
    centres = pairs.groupBy("c").agg(F.count(F.lit(1)).alias("uses")).join(
        texts.select(F.col("row").alias("c"), F.col("packed").alias("centre")), "c")
    sides = salted_join(
        pairs.join(texts.withColumnRenamed("row", "x"), "x"), centres, "c", "uses", F.col("x"), "inner").select("c", "x", "centre", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        last, base = None, None
        for batch in _pieces(batches):
            sizes, linked, apart = [], [], []
            for c, centre, packed in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if c != last:
                    last, base = c, shingle_set(unpack(centre.as_py()).decode())
                x = shingle_set(unpack(packed.as_py()).decode())
                link, tokens = differences(x, base)
                sizes.append(len(x))
                linked.append(link)
                apart.append(tokens)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(linked, pa.bool_()), _lists(apart),
            ], ["c", "x", "n", "linked", "apart"])

    return sides.mapInArrow(run, "c long, x long, n long, linked boolean, apart array<long>")


def _links_of(compared: DataFrame) -> DataFrame:
    return stage(compared.filter("linked").select(F.col("c").alias("src"), F.col("x").alias("dst")), "minhash_links")


def _near_roots(links: DataFrame) -> DataFrame:
    """(x, root): labels that only connected sets share, two steps along the links to smaller sets."""
    first = stage(links.groupBy(F.col("dst").alias("x")).agg(F.min("src").alias("root")), "minhash_first")
    second = first.select(F.col("x").alias("root"), F.col("root").alias("further"))
    return stage(first.join(second, "root", "left").select("x", F.coalesce("further", "root").alias("root")), "minhash_roots")


def _split_stars(compared: DataFrame, roots: DataFrame) -> DataFrame:
    """(c, x, root, n, apart, members) of the stars whose members do not share a label."""
    named = compared.select("c", "x").join(roots, "x", "left").withColumn("root", F.coalesce("root", "x"))
    split = named.groupBy("c").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("members"))
    split = split.filter("least <> most").select("c", "members", F.col("members").alias("size"))
    inside = salted_join(named, split, "c", "size", F.col("x"), "inner").select("c", "x", "root", "members")
    return inside.join(compared.select("c", "x", "n", "apart"), ["c", "x"])


def _from_consensus(stars: DataFrame) -> DataFrame:
    """(c, x, root, n, excess, tokens): |D(x)| over the share that n may differ (37 |D| - 3 n), and D(x). A star's consensus
    differs from its centre in at most twice the tokens that a member differs on average."""
    flips = stars.select("c", "members", F.explode("apart").alias("token")).groupBy("c", "token").agg(
        F.count(F.lit(1)).alias("holders"), F.first("members").alias("members"))
    flips = flips.filter("2 * holders > members").groupBy("c").agg(F.collect_list("token").alias("flipped"), F.first("members").alias("size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.empty(0, np.int64)
        for batch in _pieces(batches):
            excess, lists = [], []
            for n, apart, flipped in zip(batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
                f = flipped.values.to_numpy() if flipped.is_valid else nothing
                d = np.setxor1d(apart.values.to_numpy() if apart.is_valid else nothing, f, assume_unique=True)
                excess.append(37 * len(d) - 3 * n)
                lists.append(d)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(excess, pa.int64()), _lists(lists)], ["c", "x", "root", "n", "excess", "tokens"])

    return salted_join(stars, flips, "c", "size", F.col("x"), "left").select("c", "x", "root", "n", "apart", "flipped").mapInArrow(
        run, "c long, x long, root long, n long, excess long, tokens array<long>")


def _around_consensus(trimmed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Certain links (src, dst) of each star's member closest to the consensus, and the members with the
    component that these links give them."""
    closest = trimmed.groupBy("c").agg(
        F.min(F.struct("excess", "x", "root")).alias("best"), F.count(F.lit(1)).alias("members")).select(
        "c", "members", F.col("best.excess").alias("least"), F.col("best.x").alias("src"), F.col("best.root").alias("src_root"))
    rows = salted_join(trimmed, closest, "c", "members", F.col("x"), "inner").withColumn("near", F.col("excess") + F.col("least") <= 0)
    links = rows.filter("near AND x <> src").select("src", F.col("x").alias("dst")).distinct()
    return links, rows.withColumn("root", F.when(F.col("near"), F.col("src_root")).otherwise(F.col("root"))).select(*trimmed.columns)


def _open_cells(members: DataFrame) -> DataFrame:
    """(cell, star, x, root, n, place, size, c) of the cells (star, token) in which two members of different components can
    have their first shared token; place: the token's place in the member's list."""
    spark = members.sparkSession
    posted = stage(members.select(
        F.col("c").alias("star"), "x", "root", "n", F.size("tokens").alias("d"), F.explode("tokens").alias("token")), "minhash_differences")
    shared = posted.groupBy("star", "token").agg(
        F.count(F.lit(1)).alias("holders"), F.min("root").alias("least"), F.max("root").alias("most")).filter("holders > 1")
    met = posted.join(shared, ["star", "token"])
    own = Window.partitionBy("star", "x")  # one member's tokens
    place = F.col("d") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("holders", "token")) - 1
    listed = met.withColumn("place", place).filter((F.col("place") <= F.floor(3 * F.col("n") / 17)) & (F.col("least") != F.col("most")))
    held = stage(listed.select(F.xxhash64("star", "token").alias("cell"), "star", "x", "root", "n", "place"), "minhash_cells")
    drop_staged(spark, posted)
    firsts = held.groupBy("cell").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.min("place").alias("first"), F.max("n").alias("longest"),
        F.count(F.lit(1)).alias("rows")).filter("least <> most AND 37 * first <= 3 * longest").select("cell", "first", "longest", "rows")
    able = salted_join(held, stage(firsts, "minhash_firsts"), "cell", "rows", F.col("x"), "inner").filter(
        37 * (F.col("place") + F.col("first")) <= 3 * (F.col("n") + F.col("longest")))
    able = stage(able.drop("first", "longest"), "minhash_able")
    drop_staged(spark, held)
    cells = able.groupBy("cell").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("size"), F.min("x").alias("c"))
    cells = cells.filter("least <> most").select("cell", "size", F.col("size").alias("rows"), "c")
    out = stage(salted_join(able, cells, "cell", "rows", F.col("x"), "inner"), "minhash_members")
    drop_staged(spark, able)
    return out


def _large_cells(members: DataFrame) -> DataFrame:
    """Distinct (c, x): the stars of large cells."""
    return members.filter((F.col("size") > SMALL_CELL) & (F.col("c") < F.col("x"))).select("c", "x").distinct()


def _small_cells(members: DataFrame, trimmed: DataFrame) -> DataFrame:
    """(src, dst): the links between components of small cells. Two sets of a star differ in the tokens that only
    one of D(x) and D(y) holds."""
    small = members.filter(F.col("size") <= SMALL_CELL)
    a = small.select("cell", F.col("x").alias("a"), F.col("root").alias("a_root"), F.col("n").alias("a_n"), F.col("place").alias("a_place"))
    b = small.select("cell", "star", F.col("x").alias("b"), F.col("root").alias("b_root"), F.col("n").alias("b_n"), F.col("place").alias("b_place"))
    met = a.join(b, "cell").filter("a < b AND a_root <> b_root AND 37 * (a_place + b_place) <= 3 * (a_n + b_n)")
    met = met.filter("17 * a_n <= 20 * b_n AND 17 * b_n <= 20 * a_n")
    pairs = met.select("star", "a", "a_n", "b", "b_n").distinct()
    d = trimmed.select(F.col("c").alias("star"), "x", "tokens")
    sides = pairs.join(d.toDF("star", "a", "a_tokens"), ["star", "a"]).join(d.toDF("star", "b", "b_tokens"), ["star", "b"])
    apart = F.size("a_tokens") + F.size("b_tokens") - 2 * F.size(F.array_intersect("a_tokens", "b_tokens"))
    return sides.filter(37 * apart <= 3 * (F.col("a_n") + F.col("b_n"))).select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()


def _components(spark: SparkSession, rows: DataFrame, reps: DataFrame) -> DataFrame:
    """Forest (root, member) of the classes' representatives."""
    stars = stage(_bucket_stars(rows, reps), "minhash_stars")
    links = spark.createDataFrame([], "src long, dst long")
    while not stars.isEmpty():
        compared = stage(_compared(stars, rows), "minhash_compared")
        drop_staged(spark, stars)
        links = links.unionByName(_links_of(compared))
        if compared.filter("NOT linked").isEmpty():
            break
        split = stage(_split_stars(compared, _near_roots(links)), "minhash_split")
        drop_staged(spark, compared)
        trimmed = stage(_from_consensus(split), "minhash_trimmed")
        drop_staged(spark, split)
        certain, members = _around_consensus(trimmed)
        open_cells = _open_cells(members)
        stars = stage(_large_cells(open_cells), "minhash_stars")
        links = links.unionByName(stage(certain.unionByName(_small_cells(open_cells, trimmed)), "minhash_links"))
        drop_staged(spark, open_cells)
        drop_staged(spark, trimmed)
    return star_forest(links)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    rows = stage(_signed(workers_import(docs).select(F.col(key).cast("long"), F.col(text))), "minhash_rows")
    classes = stage(rows.filter("n > 0").groupBy("sig").agg(
        F.min("row").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_id")), "minhash_classes")
    forest = _components(spark, rows, classes.select(F.col("rep").alias("row")))
    named = classes.join(forest.withColumnRenamed("member", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    named = stage(named, "minhash_named")
    per_root = named.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    label = salted_join(named, per_root, "root", "classes", F.col("rep"), "inner").select("sig", "component_id", "copies")
    out = salted_join(rows.select("row", "doc_id", "n", "sig"), label, "sig", "copies", F.col("row"), "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
