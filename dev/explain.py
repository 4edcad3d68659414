"""Print the formatted physical plans of the core operators on the works derived
from a table directory (default sf0.01): python dev/explain.py [sf_dir] [name ...]."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paperweave.operators import graph  # noqa: E402
from paperweave.plans.catalog import context  # noqa: E402
from paperweave.session import local_session  # noqa: E402

PLANS = {
    "paper_index": lambda b: b.index,
    "metadata": lambda b: b.metadata,
    "citation_net": lambda b: graph.resolved_references(b.references, b.paper_index),
    "author_table": lambda b: b.author_table,
    "paper_author_net": lambda b: b.paper_author_net,
    "abstracts": lambda b: b.abstracts,
    "paper_table": lambda b: b.paper_table,
    "labels": lambda b: b.labels,
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(PLANS)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    b = context(spark, sf).build
    for name in names:
        print(f"===== {name}")
        PLANS[name](b).explain("formatted")


if __name__ == "__main__":
    main()
