"""Benchmark: the whole job, from a raw snapshot to both datasets, at $BENCH_SF_DIR.

Preparation (not in the total, reported as ``prep_snapshot_sec``): derive the work
records from the test tables and write them as a gzip JSON-lines snapshot
(``updated_date=`` partitions), the job's real input format.

Timed steps (seconds, wall clock, Spark start excluded):
  scan      parse the snapshot once (fixed schema, file-order keys) and stage it
  index     clean, de-duplicate and number the works (paper_id)
  citation_graph, components, entity_tables   staged intermediates
  paper_table ... registry   writing the nine unfiltered outputs, venue check
  lcc_*     restricting to the largest component and writing its nine outputs

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paperweave.plans.job import Timer, build_lcc, build_unfiltered  # noqa: E402
from paperweave.session import local_session, stage, staging_path  # noqa: E402
from paperweave.sources.fixture import works_fixture  # noqa: E402
from paperweave.sources.works import require_nonempty, scan_works, write_works  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    spark.sparkContext.setLogLevel("ERROR")
    raw = staging_path(spark, "bench_snapshot")
    out = staging_path(spark, "bench") + "/dataset"

    t_prep = time.perf_counter()
    write_works(works_fixture(spark, sf_dir), raw, rows_per_file=8192)  # more files than cores
    prep = time.perf_counter() - t_prep

    timer = Timer()
    t0 = time.perf_counter()
    with timer.step("scan"):
        works = require_nonempty(stage(scan_works(spark, raw), "works_scanned"), raw)
    b = build_unfiltered(works, out, timer=timer)
    lcc_timer = Timer()
    build_lcc(spark, out, timer=lcc_timer, kept=b.connected, tables=b.outputs())
    total = time.perf_counter() - t0

    queries = {k: round(v, 3) for k, v in timer.steps.items()}
    queries.update({f"lcc_{k}": round(v, 3) for k, v in lcc_timer.steps.items()})
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "dataset_build_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": queries,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "prep_snapshot_sec": round(prep, 3),
    }))


if __name__ == "__main__":
    main()
