"""N-gram Jaccard join through a token-group matrix.

A document's set holds its distinct 5-word shingles (64-bit hashes). Two documents link when
100 * intersection >= 75 * union; the result is the component of every document. All links
between different sets are found or implied by a path of verified links - none is estimated:

1. Sets are computed in one pass. Equal sets form a class with one representative.
2. All tokens have one global order: tokens seen in several documents of a hash sample come last
   (any fixed choice of these is exact, it only decides how long lists get), then by hash. Linked
   sets share a token among the first n - ceil(3n/4) + 1 of each, so only these prefixes are
   shuffled, and only tokens that occur in two sets are kept.
3. Grouping: every set is compared with the few sets that lead most of its token lists (one
   by each of three hashes); verified links give the first groups.
4. Token-group matrix: per (token, group) the least and greatest size and the most tokens that any
   member has from there on. The smaller set of a link holds its first common token among its first
   n - ceil(6n/7) + 1, so cells pair those rows with all others, and a pair of groups qualifies
   only if min(rest, rest) reaches the overlap that their smallest sets need. A qualifying pair is
   first tried with one member of each, the one with the most tokens from there on: single sets are settled by
   that, others merge if it links. Pairs with a group of several sets, and one pair of each single set, go first;
   the matrix is then made again from the groups that these form, and all its pairs are tried.
5. Groups of several sets that are still apart are bounded once more by the number of tokens they
   share; pairs that can reach a link are opened: a share of a large group is compared first, then,
   where that gives no link, all members. Every pair is verified exactly. Before any
   verification the common prefix tokens, plus all that lies past a prefix, must reach the
   overlap. Pairs inside a group are never formed.

Defined results
* null, empty or wordless text: n_shingles 0, linked with nothing, component_id its own doc_id.
* fewer than five words: the whole sequence is the one shingle.
* equal sets, repeated rows: one component. Rows may share a doc_id; component_id is the smallest
  doc_id of the component (null ids only count where there is no other).
* an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import star_forest
from ..session import drop_staged, stage
from .common import ROW, numbered, salted_join, workers_import

SHINGLE = 5
FIRST_SHARE = 16  # of a large group, the share of members that is compared before all are
LEADERS = 3  # sets, by hash, that lead a token list
ORDER_SAMPLE = 16  # one text in so many is counted for the order of tokens, which decides nothing else
FREQUENT = 3  # sampled documents
FREQUENT_LIMIT = 2_000_000  # most frequent tokens broadcast (8 bytes each); others are ordered by hash
BROADCAST_REPS = 1_000_000  # sets to fetch whose numbers (8 bytes each) are broadcast; more are joined by a shuffle
MEMO = 500_000  # words remembered per worker

# odd multipliers of the shingle hash
_MULTIPLIERS = [(int.from_bytes(xxhash.xxh3_128_digest(b"word %d" % i)[:8], "little") | 1) for i in range(SHINGLE)]


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[word] = value
        return value


_HASHES = _WordHash()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes (int64). bytes.lower and bytes.split are exactly A-Z and the six spaces."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.int64)
    if n < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b"short " + b" ".join(words))], np.uint64).view(np.int64)
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    h = np.zeros(n - SHINGLE + 1, np.uint64)
    for i, m in enumerate(_MULTIPLIERS):
        h += w[i:n - SHINGLE + 1 + i] * np.uint64(m)
    return np.unique(_mixed(h).view(np.int64))


def _signature(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def frequent_tokens(docs: DataFrame) -> np.ndarray:
    """Tokens that many documents hold, sorted: counted on one text in ORDER_SAMPLE (by a hash of the text), however
    the texts are dealt over files and tasks; equal sets of a batch count once. Bounded by
    FREQUENT_LIMIT. They only decide the order of tokens: any order finds every link."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = {}
            for t in batch.column(0):
                s = shingle_set(t.as_py())
                sets[_signature(s)] = s
            if not sets:
                continue
            tokens, n = np.unique(np.concatenate(list(sets.values())), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(n.astype(np.int64))], ["token", "n"])

    sample = docs.filter(F.pmod(F.xxhash64(docs.columns[0]), F.lit(ORDER_SAMPLE)) == 0)
    seen = sample.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = seen.filter(F.col("n") >= FREQUENT).orderBy(F.col("n").desc(), "token").limit(FREQUENT_LIMIT)
    return np.sort(top.select("token").toPandas()["token"].to_numpy(np.int64))


def _prefixes(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(row, doc_id, n, sig, packed text, prefix) per document; of equal sets in a batch the first has the prefix."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def prefix(s: np.ndarray) -> np.ndarray:
        n = len(s)
        k = n - (3 * n + 3) // 4 + 1
        often = held.value
        if len(often):
            at = np.minimum(np.searchsorted(often, s), len(often) - 1)
            late = often[at] == s
            s = np.concatenate([s[~late], s[late]])
        return s[:k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        nothing = np.empty(0, np.int64)
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            sizes, sigs, texts, lists, known = [], [], [], [], set()
            for t in batch.column(1):
                text = t.as_py() or ""
                s = shingle_set(text)
                sig = _signature(s)
                sizes.append(len(s))
                sigs.append(sig)
                first = sig not in known and len(s) > 0
                texts.append(pack(text.encode("utf-8", "replace")) if first else b"")
                lists.append(prefix(s) if first else nothing)
                known.add(sig)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            flat = np.concatenate(lists) if lists else nothing
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + len(sizes))), batch.column(0), pa.array(sizes, pa.int64()),
                pa.array(sigs, pa.binary()), pa.array(texts, pa.binary()), pa.ListArray.from_arrays(offsets, flat),
            ], ["row", "doc_id", "n", "sig", "packed", "prefix"])
            row += len(sizes)

    return docs.mapInArrow(run, "row long, doc_id long, n long, sig binary, packed binary, prefix array<long>")


def _tokens(packed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, tokens): the whole sets of the wanted representatives, from their packed texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            if batch.num_rows:
                sets = [shingle_set(unpack(t).decode()) for t in batch.column(1).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, np.concatenate(sets))], ["rep", "tokens"])

    if wanted.count() <= BROADCAST_REPS:
        wanted = F.broadcast(wanted)
    return packed.join(wanted, packed["row"] == wanted["rep"], "left_semi").select("row", "packed").mapInArrow(run, "rep long, tokens array<long>")


def _verified(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link: exact intersection of the whole sets."""
    reps = stage(pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct(), "ngram_wanted")
    sets = stage(_tokens(packed, reps), "ngram_sets")
    common = F.size(F.array_intersect("ta", "tb"))
    joined = (
        pairs.join(sets.select(F.col("rep").alias("a"), F.col("tokens").alias("ta")), "a")
        .join(sets.select(F.col("rep").alias("b"), F.col("tokens").alias("tb")), "b")
    )
    out = stage(joined.filter(100 * common >= 75 * (F.size("ta") + F.size("tb") - common)).select("a", "b").distinct(), "ngram_links")
    drop_staged(pairs.sparkSession, sets)
    return out


def _ceil(num: Column, den: int) -> Column:
    return F.floor((num + (den - 1)) / den)


def _groups(links: DataFrame) -> DataFrame:
    """(rep, g) of every set that has a link."""
    stars = star_forest(links, "a", "b")
    return stars.select(F.col("member").alias("rep"), F.col("root").alias("g")).unionByName(
        stars.select(F.col("root").alias("rep"), F.col("root").alias("g")).distinct()
    )


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def link_components(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    docs = workers_import(docs).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spark = docs.sparkSession
    prefixes = stage(_prefixes(docs, frequent_tokens(docs.select("text"))), "ngram_prefixes")
    rows = stage(prefixes.select("row", "doc_id", "n", "sig"), "ngram_rows")
    classes = stage(rows.filter("n > 0").groupBy("sig").agg(
        F.min(F.struct("row", "doc_id")).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n")
    ).select("sig", F.col("first.row").alias("rep"), F.col("first.doc_id").alias("doc_id"), "n", "copies"), "ngram_classes")

    # tokens of two sets or more, by representative; copies of a set in several batches fall together
    packed = prefixes.select("row", "packed")
    listed = prefixes.filter(F.size("prefix") > 0).select("row", F.posexplode("prefix").alias("pos", "token"))
    shared = stage(listed.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("df > 1").drop("df"), "ngram_shared")
    to_rep = rows.select("row", "sig", "n").join(classes.select("sig", "rep"), "sig").select("row", "rep", "n")
    n, pos = F.col("n"), F.col("pos")
    posted = stage(shared.join(to_rep, "row").select("token", "rep", "n", "pos").distinct().withColumn("rest", n - pos), "ngram_posted")
    drop_staged(spark, shared)

    # grouping: every set against the sets that lead most of its lists
    tried = stage(_star_pairs(posted), "ngram_tried")
    links = _verified(tried, packed)
    if not posted.isEmpty():
        lists = stage(posted.groupBy("rep").agg(F.collect_list("token").alias("t"), F.first("n").alias("n")), "ngram_lists")

        def attempt(chosen: DataFrame) -> DataFrame:
            nonlocal links, tried
            # staged, so that few pairs are broadcast to the lists, which then are not shuffled
            untried = stage(chosen.distinct().join(tried, ["a", "b"], "left_anti"), "ngram_untried")
            fresh = stage(_countable(untried, lists), "ngram_fresh")
            found = _verified(fresh, packed)
            links, tried = stage(links.unionByName(found), "ngram_links"), tried.unionByName(fresh)
            return found

        attempt(_first_picks(_matrix(posted, _groups(links))[2]))
        members, cells, pairs = _matrix(posted, _groups(links))
        apart = _still_apart(_openable(members, pairs.filter("multi")), members, attempt(pairs.select("a", "b")))
        # a few members of a large group usually show the link; only pairs still apart are opened in full
        apart = _still_apart(apart, members, attempt(_opened(members, cells, apart, FIRST_SHARE)))
        attempt(_opened(members, cells, apart, 1))
    return _labelled(rows, classes, _groups(links))


def _first_picks(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) that are tried before all others: those of groups of several sets, and for each set without a
    link the one set that shares most cells with it. Near copies that no leader has brought together
    so form groups in a number of tries in proportion to theirs, before the rest of their pairs is formed."""
    alone = pairs.filter(~F.col("multi"))
    ends = alone.select(F.col("a").alias("one"), F.col("b").alias("other"), "shared").unionByName(
        alone.select(F.col("b").alias("one"), F.col("a").alias("other"), "shared"))
    best = ends.groupBy("one").agg(F.max(F.struct("shared", (-F.col("other")).alias("o"))).alias("best"))
    return pairs.filter("multi").select("a", "b").unionByName(best.select(*_pair(F.col("one"), -F.col("best.o"))))


def _index_rows(posted: DataFrame) -> DataFrame:
    return posted.filter(F.col("pos") <= F.col("n") - _ceil(6 * F.col("n"), 7))


def _star_pairs(posted: DataFrame) -> DataFrame:
    """Pairs (a, b) of a set with the leaders that most of its lists share: per list one set by each of
    ``LEADERS`` hashes. At most LEADERS pairs a set; they only form groups."""
    # min_by of plain longs: a hash aggregate; the least struct would be sorted for
    orders = [F.xxhash64("rep", F.lit(r)) for r in range(LEADERS)]
    leaders = posted.groupBy("token").agg(*[F.min_by(c, o).alias(f"{c}{r}") for r, o in enumerate(orders) for c in ("n", "rep")])
    listed = leaders.select("token", F.posexplode(F.array(*[
        F.struct(F.col(f"n{r}").alias("n"), F.col(f"rep{r}").alias("rep")) for r in range(len(orders))])).alias("kind", "l"))
    met = posted.join(listed, "token").filter(F.col("rep") != F.col("l.rep")).groupBy(
        "rep", "n", "kind", F.col("l.rep").alias("l_rep"), F.col("l.n").alias("l_n")
    ).agg(F.count(F.lit(1)).alias("c"))
    fits = (4 * F.col("l_n") >= 3 * F.col("n")) & (4 * F.col("n") >= 3 * F.col("l_n"))
    best = met.filter(fits & _reachable(F.col("c"), "n", "l_n", "n", "l_n")).groupBy("rep", "kind").agg(
        F.max(F.struct("c", (-F.col("l_rep")).alias("l"))).alias("b"))
    return best.select(*_pair(F.col("rep"), -F.col("b.l"))).distinct()


def _reachable(c: Column, a_most: str, b_most: str, a_least: str, b_least: str) -> Column:
    """Can sets of these sizes link, with ``c`` common tokens in their prefixes? Past the prefix that
    ends first at most ceil(3n/4) - 1 tokens are left to share."""
    past = _ceil(3 * F.greatest(a_most, b_most), 4) - 1
    return c + past >= _ceil(3 * (F.col(a_least) + F.col(b_least)), 7)


def _countable(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets whose common prefix tokens are enough for a link. ``lists`` holds (rep, t, n)."""
    side = lambda p: lists.select(F.col("rep").alias(p), F.col("t").alias(f"{p}_t"), F.col("n").alias(f"{p}_n"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = (4 * F.col("a_n") >= 3 * F.col("b_n")) & (4 * F.col("b_n") >= 3 * F.col("a_n"))
    common = F.size(F.array_intersect("a_t", "b_t"))
    return joined.filter(fits & _reachable(common, "a_n", "b_n", "a_n", "b_n")).select("a", "b")


def _matrix(posted: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members with their group, the cells (token, index group, probe group) where a link could have its
    first common token, and the qualifying pairs of groups with one member of each (a, b)."""
    members = stage(
        posted.join(groups, "rep", "left").withColumn("multi", F.col("g").isNotNull()).withColumn("g", F.coalesce("g", "rep")), "ngram_members")

    # the member shown for a group holds the fewest tokens of its own before the cell's: it is nearest to what the
    # group shares, so a set that links with any member most likely links with this one (rest, then size, in one long: both are
    # below 2^31)
    def side(rows: DataFrame, p: str, first: int) -> DataFrame:
        return rows.groupBy("token", "g", "multi").agg(
            F.min("n").alias(f"{p}_least"), F.max("n").alias(f"{p}_most"), F.max("rest").alias(f"{p}_rest"),
            F.max_by("rep", F.shiftleft("rest", 32) + first * F.col("n")).alias(f"{p}_m"),
        ).withColumnsRenamed({"g": f"{p}_g", "multi": f"{p}_multi"})

    # the smaller set holds the token in its index prefix, the larger anywhere in its prefix
    cells = side(_index_rows(members), "i", -1).join(side(members, "p", 1), "token").filter(
        (F.col("i_g") != F.col("p_g")) & (F.col("i_least") <= F.col("p_most")) & (4 * F.col("i_most") >= 3 * F.col("p_least"))
        & (F.least("i_rest", "p_rest") >= _ceil(3 * (F.col("i_least") + F.col("p_least")), 7))
        & (7 * (F.col("i_least") - F.col("i_rest") + F.col("p_least") - F.col("p_rest")) <= F.col("i_most") + F.col("p_most"))
    )
    cells = stage(cells, "ngram_cells")
    pairs = cells.groupBy(F.least("i_g", "p_g").alias("a_g"), F.greatest("i_g", "p_g").alias("b_g")).agg(
        F.max(F.struct(F.least("i_rest", "p_rest").alias("rest"), F.col("i_m").alias("x"), F.col("p_m").alias("y"))).alias("top"),
        F.max(F.col("i_multi") | F.col("p_multi")).alias("multi"), F.max(F.greatest("i_most", "p_most")).alias("most"),
        F.min(F.least("i_least", "p_least")).alias("least"), F.count(F.lit(1)).alias("shared"),
    ).select("a_g", "b_g", "multi", "most", "least", "shared", *_pair(F.col("top.x"), F.col("top.y")))
    return members, cells, stage(pairs, "ngram_pairs")


def _still_apart(pairs: DataFrame, members: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a_g, b_g) of groups that the found links have not brought together."""
    of = members.select("rep", "g").distinct()
    merged = found.join(of.select(F.col("rep").alias("a"), F.col("g").alias("ga")), "a").join(
        of.select(F.col("rep").alias("b"), F.col("g").alias("gb")), "b").select(F.col("ga").alias("a"), F.col("gb").alias("b"))
    root = stage(_groups(stage(merged, "ngram_merged")), "ngram_roots")
    named = lambda p: root.select(F.col("rep").alias(f"{p}_g"), F.col("g").alias(f"{p}_root"))
    joined = pairs.join(named("a"), "a_g", "left").join(named("b"), "b_g", "left")
    return stage(joined.filter(F.coalesce("a_root", "a_g") != F.coalesce("b_root", "b_g")).select("a_g", "b_g"), "ngram_apart")


def _openable(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a_g, b_g) of groups that can reach a link by the number of tokens that they share, counted
    from the side with fewer."""
    rows = members.select("token", "g").distinct()
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("t"))
    named = lambda p: sizes.select(F.col("g").alias(f"{p}_g"), F.col("t").alias(f"{p}_t"))
    sized = pairs.select("a_g", "b_g", "most", "least").join(named("a"), "a_g").join(named("b"), "b_g")
    few = F.when(F.col("a_t") <= F.col("b_t"), F.col("a_g")).otherwise(F.col("b_g"))
    many = F.when(F.col("a_t") <= F.col("b_t"), F.col("b_g")).otherwise(F.col("a_g"))
    shared = (
        sized.select("a_g", "b_g", "most", "least", few.alias("few"), many.alias("many"))
        .join(rows.withColumnRenamed("g", "few"), "few").join(rows.withColumnRenamed("g", "many"), ["token", "many"])
        .groupBy("a_g", "b_g", "most", "least").agg(F.count(F.lit(1)).alias("c"))
    )
    return stage(shared.filter(_reachable(F.col("c"), "most", "most", "least", "least")).select("a_g", "b_g"), "ngram_open")


def _opened(members: DataFrame, cells: DataFrame, open_pairs: DataFrame, share: int) -> DataFrame:
    """Pairs of members of the given pairs of groups that share a token's list, within the size and position
    bounds. ``share`` > 1 takes that part of the members of groups of several sets, by hash."""
    if share > 1:
        members = members.filter(~F.col("multi") | (F.pmod(F.xxhash64("rep"), F.lit(share)) == 0))
    bounds = ["p_least", "p_most", "p_rest"]
    at = cells.select("token", "i_g", "p_g", *bounds, F.least("i_g", "p_g").alias("a_g"), F.greatest("i_g", "p_g").alias("b_g")).join(
        open_pairs, ["a_g", "b_g"], "left_semi").select("token", "i_g", "p_g", *bounds)
    x = _index_rows(members).select("token", F.col("g").alias("i_g"), F.col("rep").alias("x"), F.col("n").alias("xn"), F.col("rest").alias("xr"))
    y = members.select("token", F.col("g").alias("p_g"), F.col("rep").alias("y"), F.col("n").alias("yn"), F.col("rest").alias("yr"))
    # a member must fit some set of the other group before it meets any of them
    fitting = at.join(x, ["token", "i_g"]).filter(
        (F.col("xn") <= F.col("p_most")) & (4 * F.col("xn") >= 3 * F.col("p_least"))
        & (F.least("xr", "p_rest") >= _ceil(3 * (F.col("xn") + F.greatest("xn", "p_least")), 7))
    ).drop(*bounds)
    return fitting.join(y, ["token", "p_g"]).filter(
        (F.col("xn") <= F.col("yn")) & (4 * F.col("xn") >= 3 * F.col("yn"))
        & (F.least("xr", "yr") >= _ceil(3 * (F.col("xn") + F.col("yn")), 7))
        # what stands before the first common token is in one set only: a seventh of both sizes at most
        & (7 * (F.col("xn") - F.col("xr") + F.col("yn") - F.col("yr")) <= F.col("xn") + F.col("yn"))
    ).select(*_pair(F.col("x"), F.col("y")))


def _labelled(rows: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    named = classes.join(groups, "rep", "left").withColumn("g", F.coalesce("g", "rep"))
    # the smallest identifier of a class is that of any of its rows, not of its representative
    ids = rows.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least_id"))
    per_class = stage(named.select("sig", "g", "copies").join(ids, "sig"), "ngram_named")
    per_group = per_class.groupBy("g").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    label = salted_join(per_class, per_group, "g", "classes", F.xxhash64("sig"), "inner").select("sig", "component_id", "copies")
    out = salted_join(rows, label, "sig", "copies", F.col("row"), "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component stays (the smallest identifier, null ones last), all columns as they came.
    Rows without words all stay."""
    rows = numbered(docs)
    out = link_components(rows, key=ROW, text=text).select(F.col("doc_id").alias("row"), F.col("component_id").alias("c"))
    own = rows.select(F.col(ROW).alias("row"), F.col(key).alias("id")).join(out, "row")
    first = own.groupBy("c").agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), "row")).getField("row").alias(ROW))
    return rows.join(stage(first.select(ROW), "ngram_stays"), ROW, "left_semi").select(docs.columns)
