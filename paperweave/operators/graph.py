"""Graph operators on edge DataFrames.

Edges are ``(src, dst)`` bigint pairs. Undirected work uses the canonical
form ``(lo, hi)`` with ``lo < hi``, one row per vertex pair.

Connected components use the alternating large-star / small-star rounds of
Kiveris et al. (SoCC 2014): every half-round is one map-side-combined
``groupBy`` (the per-vertex minimum), one equi-join of the edges with it and
one ``distinct``. Hot vertices (the root of a big star holds most edges as
``lo``) are handled by partial aggregation in the ``groupBy`` and by the
hot-key split join of ``operators.skew``: the minimum side holds one row per
vertex, so a hot key's lookup row is broadcast and its edges stay where they
are. Every half-round is staged to shared storage, which
keeps plans short and gives AQE measured sizes. Convergence is exact: once
small-star rewires nothing, one aggregation checks that every vertex is a
centre or a leaf with a single, smaller centre, i.e. a forest of stars whose
centres are the component minima.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import drop_staged, stage
from .ids import PaperIndex, dense_id, offsets_literal, partition_offsets
from .skew import hot_key_rows, hot_keys, skew_join, stage_nonempty

# Safety net only: the star rounds need O(log^2 n) rounds; hitting this
# bound raises instead of returning a partial answer.
MAX_ROUNDS = 500

# Edges from which a graph is contracted before the star rounds.
CONTRACT_ROWS_CONF = "spark.paperweave.contractRows"
DEFAULT_CONTRACT_ROWS = 1_000_000

# Levels that a breadth-first expansion keeps as files of their own.
OPEN_LEVELS = 32


# ---------------------------------------------------------------------------
# Edge tables
# ---------------------------------------------------------------------------


def resolved_references(references: DataFrame, index: PaperIndex, *, total_rows: int | None = None) -> DataFrame:
    """``(src, dst, n)``: citing and cited paper, and how often the reference is listed (self-references included).

    ``references`` holds ``(paper_id, ref_oa_id)``; references outside the index drop out. The index is
    looked up, not joined row by row (``operators.ids.PaperIndex``), and a paper cited by a large share
    of all references costs no more than any other: partial counts meet before the shuffle.
    """
    pairs = index.attach(references.select(F.col("paper_id").alias("src"), "ref_oa_id"), "ref_oa_id", "dst", total_rows=total_rows)
    return pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def citation_net(resolved: DataFrame) -> DataFrame:
    """Loop-free, distinct citation edges ``(src, dst)``: src cites dst."""
    return resolved.filter(F.col("src") != F.col("dst")).select("src", "dst")


def canonical(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Undirected edge set ``(lo, hi)``, lo < hi, loops removed, one row per pair."""
    return (
        edges.select(F.least(src, dst).alias("lo"), F.greatest(src, dst).alias("hi"))
        .filter(F.col("lo") != F.col("hi"))
        .distinct()
    )


def symmetrize(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Both directions of every edge, distinct, no loops: ``(src, dst)``."""
    und = canonical(edges, src, dst)
    return und.select(F.col("lo").alias("src"), F.col("hi").alias("dst")).unionByName(
        und.select(F.col("hi").alias("src"), F.col("lo").alias("dst"))
    )


def undirected_degree(vertices: DataFrame, edges: DataFrame, vertex: str = "paper_id") -> DataFrame:
    """``(vertex, degree)`` for every vertex: distinct neighbours, either direction."""
    und = canonical(edges)
    ends = und.select(F.col("lo").alias("v")).unionByName(und.select(F.col("hi").alias("v")))
    deg = ends.groupBy("v").agg(F.count(F.lit(1)).alias("degree"))
    return (
        vertices.select(vertex)
        .join(deg, vertices[vertex] == deg["v"], "left")
        .select(vertex, F.coalesce("degree", F.lit(0)).cast("bigint").alias("degree"))
    )


# ---------------------------------------------------------------------------
# Connected components
# ---------------------------------------------------------------------------


def _large_star(e: DataFrame, n_rows: int, min_rows: int | None) -> tuple[DataFrame, Observation, Observation]:
    # m(u) = min(u, smaller neighbours of u); each edge (lo, hi) becomes (m(lo), hi).
    # The join key lo is hot for the root of a big star: split on hot keys.
    mins = e.groupBy(F.col("hi").alias("v")).agg(F.min("lo").alias("m"))
    changed = Observation("large_star")
    rows = Observation("large_star_rows")
    out = (
        skew_join(e, mins, "lo", "v", "left", min_rows=min_rows, total_rows=n_rows)
        .observe(changed, F.count(F.col("m")).alias("changed"))
        .select(F.coalesce("m", "lo").alias("lo"), "hi")
        .distinct()
        .observe(rows, F.count(F.lit(1)).alias("rows"))
    )
    return out, changed, rows


def _small_star(e: DataFrame, n_rows: int, min_rows: int | None) -> tuple[DataFrame, Observation, Observation]:
    # each vertex u with smaller neighbours N: link u and every member of N to min(N)
    mins = e.groupBy(F.col("hi").alias("u")).agg(
        F.min("lo").alias("m"), F.count(F.lit(1)).alias("k")
    )
    threshold = hot_key_rows(e.sparkSession, min_rows)
    hot = None
    if n_rows >= threshold:
        # the per-vertex counts k are the hot-key counts of the join below
        mins = stage(mins, "cc_mins")
        hot = stage_nonempty(mins.filter(F.col("k") >= threshold).select(F.col("u").alias("hi"), F.col("k").alias("rows")), "hot_keys")
    changed = Observation("small_star")
    rows = Observation("small_star_rows")
    leaves = (
        skew_join(e, mins.select("u", "m"), "hi", "u", "inner", hot=hot, min_rows=min_rows)
        .filter(F.col("lo") != F.col("m"))
        .select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    )
    centre = mins.observe(changed, F.count(F.when(F.col("k") > 1, 1)).alias("changed")).select(
        F.col("m").alias("lo"), F.col("u").alias("hi")
    )
    out = leaves.unionByName(centre).distinct().observe(rows, F.count(F.lit(1)).alias("rows"))
    return out, changed, rows


def star_forest(edges: DataFrame, src: str = "src", dst: str = "dst", *, min_rows: int | None = None,
                contract_rows: int | None = None) -> DataFrame:
    """Rewire an undirected graph into stars: ``(root, member)`` per non-root vertex.

    The root is the smallest vertex of the member's component. Vertices
    without edges do not appear. ``min_rows`` sets the hot-key threshold of
    the joins (default: session setting, see ``operators.skew``). Graphs of ``contract_rows`` edges or
    more (default: session setting) are contracted before the rounds; the result is the same.
    """
    e = stage(canonical(edges, src, dst), "cc_edges")
    n_rows = e.count()
    if n_rows == 0:
        return e.select(F.col("lo").alias("root"), F.col("hi").alias("member"))
    limit = int(e.sparkSession.conf.get(CONTRACT_ROWS_CONF, str(DEFAULT_CONTRACT_ROWS))) if contract_rows is None else contract_rows
    if n_rows >= limit:
        return _contracted(e, n_rows, min_rows, limit)
    return _star_rounds(e, n_rows, min_rows)


def _contracted(e: DataFrame, n_rows: int, min_rows: int | None, limit: int) -> DataFrame:
    """Sampled contraction: roots are first found along one edge of each vertex (to its least smaller neighbour, found
    by a partial aggregate), at most one row a vertex. That finds most of a giant component. All edges
    are then rewritten to the roots of their ends once, edges inside a tree vanish, and only what
    leads from one tree to another goes on. Exact: a root is the least vertex of its tree, and trees are joined
    by the remaining edges as their vertices were."""
    spark = e.sparkSession
    least = stage(e.groupBy("hi").agg(F.min("lo").alias("lo")).select("lo", "hi"), "cc_least")
    trees = _roots(least, least.count(), min_rows)
    moved_lo = skew_join(e, trees.select(F.col("member").alias("__m"), F.col("root").alias("__lo")), "lo", "__m", "left",
                         min_rows=min_rows, total_rows=n_rows).select(F.coalesce("__lo", "lo").alias("lo"), "hi")
    # the first join leaves every edge's other end as it is: its hot keys are counted on the edges, not on the joined rows
    threshold = hot_key_rows(spark, min_rows)
    hot_ends = hot_keys(e, "hi", threshold) if n_rows >= threshold else None
    both = skew_join(moved_lo, trees.select(F.col("member").alias("__m"), F.col("root").alias("__hi")), "hi", "__m", "left",
                     hot=hot_ends, min_rows=min_rows).select("lo", F.coalesce("__hi", "hi").alias("hi"))
    rest = stage(canonical(both, "lo", "hi"), "cc_rest")
    drop_staged(spark, e)
    n_rest = rest.count()
    if n_rest == 0:
        return trees
    joined = _contracted(rest, n_rest, min_rows, limit) if limit <= n_rest < n_rows else _star_rounds(rest, n_rest, min_rows)
    upper = joined.select(F.col("member").alias("__tree"), F.col("root").alias("__root"))
    # a root of very many members is a hot key
    moved = skew_join(trees, upper, "root", "__tree", "left", min_rows=min_rows).select(F.coalesce("__root", "root").alias("root"), "member")
    return stage(moved.unionByName(joined.select("root", "member")), "cc_forest")


def _roots(e: DataFrame, n_rows: int, min_rows: int | None) -> DataFrame:
    """``(root, member)`` of a staged forest ``(lo, hi)`` in which every ``hi`` stands once, above its parent ``lo``:
    every vertex takes its parent's parent until no parent has one, so the distance to the root halves in each
    round. A round is one join and one write of the forest's rows; a root with very many members is a hot key."""
    for _ in range(MAX_ROUNDS):
        changed = Observation("roots")
        parents = e.select(F.col("hi").alias("v"), F.col("lo").alias("m"))
        up = (
            skew_join(e, parents, "lo", "v", "left", min_rows=min_rows, total_rows=n_rows)
            .observe(changed, F.count(F.col("m")).alias("changed"))
            .select(F.coalesce("m", "lo").alias("lo"), "hi")
        )
        up = stage(up, "cc_roots")
        drop_staged(e.sparkSession, e)
        e = up
        if changed.get["changed"] == 0:
            return e.select(F.col("lo").alias("root"), F.col("hi").alias("member"))
    raise RuntimeError(f"the roots of a forest were not found in {MAX_ROUNDS} rounds")


def _star_rounds(e: DataFrame, n_rows: int, min_rows: int | None) -> DataFrame:
    """Alternating star rounds on staged canonical edges, until they form stars."""
    for _ in range(MAX_ROUNDS):
        # small-star reads the large-star result twice (minimum and join):
        # staging it makes that two file scans rather than two recomputations
        ls, ls_changed, ls_rows = _large_star(e, n_rows, min_rows)
        ls = stage(ls, "cc_large")
        drop_staged(e.sparkSession, e)
        ss, ss_changed, ss_rows = _small_star(ls, ls_rows.get["rows"], min_rows)
        ss = stage(ss, "cc_small")
        drop_staged(e.sparkSession, ls)
        e = ss
        n_rows = ss_rows.get["rows"]
        # small-star rewiring nothing is the cheap hint that the result may
        # already be stars; the exact check then spares a confirming round
        if ss_changed.get["changed"] == 0 and is_star_forest(e):
            return e.select(F.col("lo").alias("root"), F.col("hi").alias("member"))
    raise RuntimeError(f"connected components did not converge in {MAX_ROUNDS} rounds")


def is_star_forest(e: DataFrame) -> bool:
    """Exact check that canonical edges ``(lo, hi)`` form stars: every vertex is
    either a centre (only larger neighbours) or a leaf with exactly one,
    smaller, neighbour that is a centre. One aggregation; it confirms the
    observed counters, so the result never rests on metrics alone."""
    ends = e.select(F.col("hi").alias("v"), F.lit(1).alias("leaf")).unionByName(
        e.select(F.col("lo").alias("v"), F.lit(0).alias("leaf"))
    )
    per_vertex = ends.groupBy("v").agg(
        F.sum("leaf").alias("parents"), F.min("leaf").alias("centre_side")
    )
    bad = per_vertex.filter((F.col("parents") > 1) | ((F.col("parents") >= 1) & (F.col("centre_side") == 0)))
    return bad.isEmpty()


def connected_components(
    vertices: DataFrame, edges: DataFrame, vertex: str = "paper_id", out: str = "component",
    *, min_rows: int | None = None,
) -> DataFrame:
    """``(vertex, component)`` for every vertex; component = smallest vertex id in it.

    Vertices without edges are components of their own.
    """
    stars = star_forest(edges, min_rows=min_rows)
    return (
        vertices.select(vertex)
        .join(stars, vertices[vertex] == stars["member"], "left")
        .select(vertex, F.coalesce("root", vertex).alias(out))
    )


# a degree and a vertex in one bigint: degrees below 2^31, vertices below 2^32
_VERTEX_BITS = 32


def component_summary(labels: DataFrame, degrees: DataFrame, vertex: str = "paper_id") -> DataFrame:
    """Per component: size, highest degree and its lowest-id holder (the seed).

    Degree and vertex are packed into one bigint (degree first, then the vertex counted downwards), so that the
    pair that wins is a plain ``max``: a hash aggregate with partial sums, whatever a component's size.
    """
    top = (1 << _VERTEX_BITS) - 1
    fits = (F.col("degree") < (1 << 31)) & (F.col(vertex) <= top) & (F.col(vertex) >= 0)
    packed = F.when(fits, F.shiftleft(F.col("degree").cast("bigint"), _VERTEX_BITS) + (F.lit(top) - F.col(vertex))).otherwise(
        F.raise_error(F.lit("a degree or vertex is too large to be packed")).cast("bigint"))
    joined = labels.join(degrees, vertex).select("component", packed.alias("__best"))
    return joined.groupBy("component").agg(F.count(F.lit(1)).cast("bigint").alias("size"), F.max("__best").alias("__best")).select(
        "component",
        "size",
        F.shiftright("__best", _VERTEX_BITS).alias("max_degree"),
        (F.lit(top) - F.col("__best").bitwiseAND(F.lit(top))).cast("bigint").alias("seed"),
    )


def largest_component_exact(labels: DataFrame) -> DataFrame:
    """One row ``(component, size)``: the largest component, ties to the smaller id."""
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).cast("bigint").alias("size"))
    return sizes.orderBy(F.desc("size"), F.asc("component")).limit(1)


def largest_component_seeded(summary: DataFrame, n_repeats: int) -> DataFrame:
    """One row ``(component, size, seed_rank)`` by the seeded search rule.

    The search visits components one at a time starting from the
    highest-degree remaining vertex (lowest id on ties). Removing a whole
    component leaves every other degree unchanged, so the visiting order is
    the order of (max degree desc, seed asc); the largest of the first
    ``n_repeats`` visited wins, the earlier one on ties.
    """
    top = summary.orderBy(F.desc("max_degree"), F.asc("seed")).limit(n_repeats)
    ranked = top.withColumn(
        "seed_rank",
        F.row_number().over(Window.orderBy(F.desc("max_degree"), F.asc("seed"))).cast("bigint"),
    )
    return ranked.orderBy(F.desc("size"), F.asc("seed_rank")).limit(1).select(
        "component", "size", "seed_rank"
    )


def flag_members(labels: DataFrame, chosen: DataFrame, out: str = "is_connected", vertex: str = "paper_id") -> DataFrame:
    """``(vertex, out)``: 1 for members of the single chosen component, else 0."""
    pick = F.broadcast(chosen.select(F.col("component").alias("__chosen")))
    return labels.join(pick, labels["component"] == pick["__chosen"], "left").select(
        vertex, F.col("__chosen").isNotNull().cast("int").alias(out)
    )


# ---------------------------------------------------------------------------
# Reachability
# ---------------------------------------------------------------------------


def reachable(labels: DataFrame, seeds: DataFrame, vertex: str = "paper_id") -> DataFrame:
    """Vertices reachable (ignoring direction) from any seed, via component labels."""
    seed_comps = labels.join(seeds.select(vertex).distinct(), vertex, "left_semi").select(
        F.col("component").alias("__c")
    ).distinct()
    return labels.join(seed_comps, labels["component"] == seed_comps["__c"], "left_semi").select(vertex)


def split_adjacency(edges: DataFrame, *, min_rows: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Undirected adjacency ``(src, part, dst)``, staged, and the parts ``(v, parts)`` of its hubs (None without hubs).

    A vertex with at least ``min_rows`` neighbours (default: the session's hot-key threshold) is a hub: its
    neighbours are dealt over parts of that size. There are at most edges / min_rows hubs.
    """
    limit = hot_key_rows(edges.sparkSession, min_rows)
    sym = stage(symmetrize(edges), "bfs_edges")
    degrees = sym.groupBy("src").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= limit)
    hubs = stage_nonempty(degrees.select(F.col("src").alias("v"), F.ceil(F.col("n") / limit).cast("int").alias("parts")), "bfs_hubs")
    if hubs is None:
        return sym.withColumn("part", F.lit(0)).select("src", "part", "dst"), None
    marked = sym.join(F.broadcast(hubs.withColumnRenamed("v", "src")), "src", "left")
    part = F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("dst"), F.col("parts")).cast("int"))
    return stage(marked.select("src", part.alias("part"), "dst"), "bfs_split"), hubs


def expand(edges: DataFrame, seeds: DataFrame, vertex: str = "paper_id", max_iter: int | None = None,
           *, hop: str | None = None, min_rows: int | None = None) -> DataFrame:
    """Breadth-first frontier expansion over undirected edges until nothing is new.

    ``max_iter`` bounds the number of hops (a k-hop neighbourhood); None runs to the fixpoint. ``hop`` names a
    column for a vertex's distance from the seeds. A hop joins the frontier with its own adjacency (a
    hub's in parts, ``split_adjacency``) and drops what the last two frontiers hold: a neighbour of
    a vertex at distance d is at distance d - 1, d or d + 1, so older levels never come back, and a hop handles
    rows in proportion to its frontier's edges, not to all that was visited. Each frontier is written once,
    its size counted during the write and confirmed on the written rows.
    """
    adjacency, hubs = split_adjacency(edges, min_rows=min_rows)
    frontier = stage(seeds.select(F.col(vertex).cast("bigint").alias("v")).filter(F.col("v").isNotNull()).distinct(), "bfs_frontier")
    levels, older, folded = [frontier], [], 0
    while max_iter is None or len(levels) <= max_iter:
        asked = frontier.withColumn("p", F.lit(0))
        if hubs is not None:
            marked = frontier.join(F.broadcast(hubs), "v", "left")
            asked = marked.select("v", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("p"))
        last = frontier if len(levels) == 1 else frontier.unionByName(levels[-2])
        obs = Observation("bfs")
        nxt = (
            adjacency.join(asked, (adjacency["src"] == asked["v"]) & (adjacency["part"] == asked["p"]))
            .select(F.col("dst").alias("v"))
            .distinct()
            .join(last, "v", "left_anti")
            .observe(obs, F.count(F.lit(1)).alias("n"))
        )
        nxt = stage(nxt, "bfs_frontier")
        if (obs.get.get("n") or 0) == 0 and nxt.isEmpty():
            break
        levels.append(nxt)
        frontier = nxt
        if len(levels) - folded > OPEN_LEVELS:
            older.append(stage(_with_hops(levels, folded, len(levels) - 2), "bfs_levels"))
            folded = len(levels) - 2
    found = _with_hops(levels, folded, len(levels))
    for part in older:
        found = found.unionByName(part)
    return found.select(F.col("v").alias(vertex), *([F.col("__hop").alias(hop)] if hop else []))


def _with_hops(levels: list[DataFrame], first: int, end: int) -> DataFrame:
    """The levels first..end-1 in one frame; they share no vertex, so their union needs no distinct."""
    out = levels[first].withColumn("__hop", F.lit(first))
    for i in range(first + 1, end):
        out = out.unionByName(levels[i].withColumn("__hop", F.lit(i)))
    return out


# ---------------------------------------------------------------------------
# Adjacency (row-compressed view) and induced subgraphs
# ---------------------------------------------------------------------------


def adjacency_offsets(vertices: DataFrame, edges: DataFrame, vertex: str = "paper_id") -> DataFrame:
    """Row pointer of the row-compressed adjacency: ``(row, start, degree)``.

    ``start`` = number of edges whose source is smaller than ``row``; rows
    without edges are included. Together with ``adjacency_entries`` this is
    the sparse matrix, without ever gathering a row's neighbours into one
    value.
    """
    out_deg = edges.groupBy(F.col("src").alias("row")).agg(F.count(F.lit(1)).alias("degree"))
    rows = vertices.select(F.col(vertex).alias("row")).join(out_deg, "row", "left").select(
        "row", F.coalesce("degree", F.lit(0)).cast("bigint").alias("degree")
    )
    return running_total(rows, "row", "degree", "start").select("row", "start", "degree")


def adjacency_entries(edges: DataFrame) -> DataFrame:
    """Column indices in row-major order: ``(pos, src, dst)``, pos = 0..nnz-1."""
    return dense_id(edges.select("src", "dst"), ["src", "dst"], "pos", name="csr").select("pos", "src", "dst")


def running_total(df: DataFrame, order_col: str, weight: str, out: str, num_partitions: int | None = None) -> DataFrame:
    """Exclusive prefix sum of ``weight`` in ascending ``order_col`` (unique).

    Range partitions are summed first (one number per partition, turned into
    an offsets array literal); inside a partition a window keyed by the
    partition number adds the rest, so no task ever holds more than one range
    partition.
    """
    ranged = df.repartitionByRange(num_partitions, order_col) if num_partitions else df.repartitionByRange(order_col)
    part = ranged.withColumn("__pid", F.spark_partition_id())
    frozen = stage(part, "prefix")
    offsets = partition_offsets(frozen.groupBy("__pid").agg(F.sum(weight).alias("__n")))
    inside = Window.partitionBy("__pid").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return (
        frozen.withColumn(
            out,
            (F.element_at(offsets_literal(offsets), (F.col("__pid") + 1).cast("int"))
             + F.coalesce(F.sum(weight).over(inside), F.lit(0))).cast("bigint"),
        )
        .drop("__pid")
    )


def induce(edges: DataFrame, id_map: DataFrame, old: str = "old_id", new: str = "new_id",
           *, total_rows: int | None = None) -> DataFrame:
    """Edges with both ends in ``id_map``, renumbered: two joins filter and remap at once.

    A paper's out-edges are bounded by its one reference list, but its
    in-edges are not: the ``dst`` join is split on hot keys.
    """
    m_src = id_map.select(F.col(old).alias("__s_old"), F.col(new).alias("__s_new"))
    m_dst = id_map.select(F.col(old).alias("__d_old"), F.col(new).alias("__d_new"))
    by_src = edges.join(m_src, edges["src"] == m_src["__s_old"]).select(F.col("__s_new").alias("src"), "dst")
    both = skew_join(by_src, m_dst, "dst", "__d_old", "inner", total_rows=total_rows)
    return both.select("src", F.col("__d_new").alias("dst"))


def graph_shape(edges: DataFrame, n_rows: int, n_cols: int | None = None) -> DataFrame:
    """One row ``(n_rows, n_cols, nnz)``: the declared shape of a sparse matrix."""
    return edges.agg(
        F.lit(n_rows).cast("bigint").alias("n_rows"),
        F.lit(n_rows if n_cols is None else n_cols).cast("bigint").alias("n_cols"),
        F.count(F.lit(1)).cast("bigint").alias("nnz"),
    )
