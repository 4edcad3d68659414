"""Whole-dataset jobs: raw snapshot -> unfiltered dataset -> component dataset.

Layout (one directory per table)::

    <out>_unfiltered/paper_table.csv/  citation_net/{edges,shape}/  author_table.csv/
                     paper_author_net/{edges,shape}/  category_table.csv/
                     paper_category_table.csv/  abstracts.parquet/  source_table.csv/
                     registry/{papers,authors,meta}/  _PUBLISHED.json
    <out>/...        the same nine outputs restricted to the chosen component

Each side is written beside its place and published as a whole (``sources.publish``).

Run with ``spark-submit --py-files paperweave.zip run_job.py --raw <snapshot> --out <dir>``
(or ``python -m paperweave.plans.job`` locally).
"""

from __future__ import annotations

import argparse
import json
import logging
import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..operators import validate
from ..operators.rank import RankBitmap
from ..session import cleanup_staging, get_session, stage
from ..sources import tables as io
from ..sources.publish import building_folder, folder_bytes, publish, published
from ..sources.works import require_nonempty, scan_works, works_dir
from .build import LccBuild, UnfilteredBuild


log = logging.getLogger(__name__)


class Timer:
    """Wall-clock seconds per named step (for logs and benchmarks)."""

    def __init__(self):
        self.steps: dict[str, float] = {}

    @contextmanager
    def step(self, name: str):
        t0 = time.perf_counter()
        try:
            yield
        finally:
            self.steps[name] = self.steps.get(name, 0.0) + time.perf_counter() - t0


def unfiltered_dir(out: str) -> str:
    return out.rstrip("/") + "_unfiltered"


CSV_TABLES = ("paper_table", "author_table", "category_table", "paper_category_table", "source_table")
TABLES = [*(f"{name}.csv" for name in CSV_TABLES), "citation_net/edges", "citation_net/shape", "paper_author_net/edges",
          "paper_author_net/shape", "abstracts.parquet", "registry/papers", "registry/authors", "registry/meta"]
TYPED = "_typed"


def write_dataset(spark: SparkSession, outputs: dict[str, DataFrame], out: str, n_papers: int, n_authors: int,
                  *, global_abstract_sort: bool, typed: bool = False, timer: Timer | None = None) -> None:
    """Write the nine outputs of one dataset side beside ``out`` and publish them together.

    ``typed`` also keeps the CSV tables as Parquet (``_typed/``, with the types of the schema) for
    ``read_unfiltered``, and notes for each of them whether both writes saw the same rows.
    """
    timer = timer or Timer()
    building = building_folder(out)
    papers, authors = ("paper_id", n_papers), ("author_id", n_authors)
    csv_tables = dict(zip(CSV_TABLES, (
        (["paper_id"], papers), (["author_id"], authors), (["class_id"], None), (["paper_id", "sequence"], papers), (["source_id"], None))))
    agreed: dict[str, list[int]] = {}
    for name, (order, dense) in csv_tables.items():
        path = io.table_path(building, name, "csv")
        with timer.step(name):
            if typed:
                if io.write_twice(outputs[name], path, f"{building}/{TYPED}/{name}", sort_by=order, dense=dense):
                    agreed[name] = folder_bytes(spark, path)
            else:
                io.write_table(outputs[name], path, "csv", sort_by=order, dense=dense)
    with timer.step("citation_net"):
        io.write_graph(outputs["citation_net"], f"{building}/citation_net", n_papers)
    with timer.step("paper_author_net"):
        io.write_graph(outputs["paper_author_net"], f"{building}/paper_author_net", n_papers, n_authors)
    with timer.step("abstracts"):
        io.write_abstracts(outputs["abstracts"], io.table_path(building, "abstracts", "parquet"),
                           global_sort=global_abstract_sort, n_papers=n_papers)
    with timer.step("registry"):
        # paper ids follow openalex_id, so both orders have the same bounds
        io.write_table(outputs["registry_papers"], f"{building}/registry/papers", "parquet", sort_by=["openalex_id"], dense=papers)
        io.write_table(outputs["registry_authors"], f"{building}/registry/authors", "parquet", sort_by=["author_id"], dense=authors)
        io.write_table(outputs["registry_meta"], f"{building}/registry/meta", "parquet")
    with timer.step("publish"):
        publish(spark, building, out, TABLES, {"typed": agreed})


def build_unfiltered(works: DataFrame, out: str, *, component_rule: str = "exact",
                     sync_date: str | None = None, timer: Timer | None = None,
                     log_counters: bool = False, on_bad: str = "null", source: str = "", typed: bool = False) -> UnfilteredBuild:
    """Build and write the unfiltered dataset to ``<out>_unfiltered``.

    ``log_counters`` logs the job counters (papers, resolved citation links,
    authorship links, authors, sources, topic rows, abstracts, graph sizes,
    dropped ids). Fails when no record passes the filters; ``source`` names
    the input in that message. ``typed`` keeps typed copies of the CSV tables for a later
    component job (``write_dataset``).
    """
    timer = timer or Timer()
    spark = works.sparkSession
    b = UnfilteredBuild(works, component_rule=component_rule, sync_date=sync_date, on_bad=on_bad)
    with timer.step("index"):
        n_papers = b.n_papers
        if n_papers == 0:
            raise RuntimeError("no work record is left after the id and type filters" + (f" in {source}" if source else ""))
    with timer.step("citation_graph"):
        b.citation_net
    with timer.step("components"):
        b.labels
        if component_rule == "seeded":
            b.component_summary
    with timer.step("entity_tables"):
        b.source_table
        b.author_table
        b.category_table
        n_authors = b.author_table.count()
    with timer.step("link_tables"):
        b.paper_table
        b.paper_author_net
        b.paper_category_table
    with timer.step("plan_outputs"):
        outputs = b.outputs()
    write_dataset(spark, outputs, unfiltered_dir(out), n_papers, n_authors, global_abstract_sort=False, typed=typed, timer=timer)
    # rebuilt once: the component dataset and the counters read the written texts
    b.abstracts = io.read_table(spark, io.table_path(unfiltered_dir(out), "abstracts", "parquet"), "abstracts", "parquet")
    with timer.step("validation"):
        validate.log_venue_validation(b.venue_validation().first())
        log.info("completeness: %s", b.completeness().first().asDict())
    if log_counters:
        with timer.step("counters"):
            log.info("counters: %s", b.counters().first().asDict())
    return b


def read_unfiltered(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The unfiltered dataset as published by ``build_unfiltered``.

    A CSV table is read from its typed copy where there is one that agreed with it when both were written, and
    the CSV's files have not changed since; else the CSV is parsed (multi-line cells: one task a file).
    """
    base = unfiltered_dir(out)
    agreed = published(spark, base).get("typed", {})
    t = {}
    for name in CSV_TABLES:
        path = io.table_path(base, name, "csv")
        if name in agreed and agreed[name] == folder_bytes(spark, path):
            t[name] = io.read_table(spark, f"{base}/{TYPED}/{name}", name, "parquet")
        else:
            t[name] = io.read_table(spark, path, name, "csv")
    t["citation_net"] = io.read_graph(spark, f"{base}/citation_net")[0]
    t["paper_author_net"] = io.read_graph(spark, f"{base}/paper_author_net")[0]
    t["abstracts"] = io.read_table(spark, io.table_path(base, "abstracts", "parquet"), "abstracts", "parquet")
    return t


def build_lcc(spark: SparkSession, out: str, *, sync_date: str | None = None,
              timer: Timer | None = None, keep_flag: bool = False,
              renumber_categories: bool = False, flags: DataFrame | None = None,
              tables: dict[str, DataFrame] | None = None, kept: RankBitmap | None = None) -> LccBuild:
    """Restrict the written unfiltered dataset to the flagged component; write to ``out``.

    In one application ``kept`` (or ``flags``) and ``tables`` are the unfiltered build's staged
    Parquet frames; without them the published dataset is read (``read_unfiltered``).
    """
    timer = timer or Timer()
    lb = LccBuild(tables or read_unfiltered(spark, out), sync_date=sync_date, keep_flag=keep_flag,
                  renumber_categories=renumber_categories, flags=flags, kept=kept)
    with timer.step("maps"):
        n_papers, n_authors = lb.kept_papers.n, lb.kept_authors.n
    with timer.step("plan_outputs"):
        outputs = lb.outputs()
    write_dataset(spark, outputs, out, n_papers, n_authors, global_abstract_sort=True, timer=timer)
    return lb


BYTES_PER_PARTITION = 128 << 20
UNPACKED = 6  # JSON bytes per gzip byte, roughly


def shuffle_partitions(spark: SparkSession, root: str) -> int:
    """Shuffle partitions for a snapshot: its unpacked bytes over the size a partition should have.
    AQE merges what turns out small, so this only has to be large enough."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(works_dir(root))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size * UNPACKED // BYTES_PER_PARTITION))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--raw", help="snapshot root holding data/works/updated_date=*/")
    ap.add_argument("--component-only", action="store_true",
                    help="only the component dataset, from the unfiltered dataset that an earlier run published beside --out")
    ap.add_argument("--typed", action="store_true", help="keep typed copies of the CSV tables for a later --component-only run")
    ap.add_argument("--out", required=True, help="output directory of the component dataset")
    ap.add_argument("--partitions", nargs="*", default=None, help="updated_date=... directories to read")
    ap.add_argument("--component-rule", choices=["exact", "seeded"], default="exact")
    ap.add_argument("--sync-date", default=None)
    ap.add_argument("--counters", action="store_true", help="log the job counters")
    ap.add_argument("--keep-flag", action="store_true", help="keep is_connected in the filtered papers")
    ap.add_argument("--on-bad", choices=["null", "fail"], default="null",
                    help="an id of any kind that is not a number: drop what it names (null) or fail the job")
    ap.add_argument("--renumber-categories", action="store_true",
                    help="contiguous class ids in the filtered dataset (default: old ids kept)")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    if not args.raw and not args.component_only:
        ap.error("--raw is needed, or --component-only")
    spark = get_session()
    timer = Timer()
    lcc_options = {"sync_date": args.sync_date, "timer": timer, "keep_flag": args.keep_flag, "renumber_categories": args.renumber_categories}
    try:
        if args.component_only:
            build_lcc(spark, args.out, **lcc_options)
        else:
            spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(spark, args.raw)))
            with timer.step("scan"):
                # one JSON parse: every later pass reads pruned Parquet columns, and the
                # order key (file position) is frozen with the records
                works = stage(scan_works(spark, args.raw, partitions=args.partitions), "works_scanned")
                require_nonempty(works, args.raw)
            b = build_unfiltered(works, args.out, component_rule=args.component_rule, sync_date=args.sync_date, timer=timer,
                                 log_counters=args.counters, on_bad=args.on_bad, source=args.raw, typed=args.typed)
            build_lcc(spark, args.out, kept=b.connected, tables=b.outputs(), **lcc_options)
    finally:
        cleanup_staging(spark)
    print(json.dumps({k: round(v, 3) for k, v in timer.steps.items()}))



if __name__ == "__main__":
    main()
