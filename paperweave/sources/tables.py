"""Table sinks and scans: CSV with header (quoted, multi-line safe) and Parquet.

A dataset directory holds one sub-directory per table. CSV cannot tell an
empty string from a null; both are written as an empty cell and read back as
null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.graph import graph_shape
from ..session import spent_shuffles

# white space belongs to the value: Spark trims it on write unless told not to
_CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


# ids of a written range partition: many for a large table, fewer to keep all cores busy, but no tiny files
MOST_ROWS, LEAST_ROWS = 500_000, 10_000

# ids that a point lookup sends to the scan as a predicate; more are joined
POINT_IDS = 2000
_IN_IDS = 10  # values that the Parquet reader keeps as single values


def table_path(out_dir: str, name: str, fmt: str) -> str:
    ext = {"csv": ".csv", "parquet": ".parquet"}[fmt]
    return f"{out_dir.rstrip('/')}/{name}{ext}"


def by_dense_id(df: DataFrame, key: str, n: int) -> DataFrame:
    """``df`` in range partitions of a dense id 0..n-1: equal stretches of the range, one after the other."""
    wide_enough = max(-(-n // MOST_ROWS), min(df.sparkSession.sparkContext.defaultParallelism, 64))
    parts = max(1, min(wide_enough, -(-n // LEAST_ROWS)))
    return df.repartitionById(parts, F.floor(F.col(key) * parts / F.lit(max(n, 1))).cast("int"))


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    *,
    compression: str | None = None,
    sort_by: list[str] | None = None,
    within_partitions: bool = False,
    max_records_per_file: int | None = None,
    dense: tuple[str, int] | None = None,
    options: dict[str, str] | None = None,
    watch: Observation | None = None,
) -> None:
    """Write ``df`` to ``path`` (overwrite).

    ``sort_by`` sorts the output globally (range-partitioned sort) or, with
    ``within_partitions``, only inside each written file. ``dense`` names a column that holds ids 0..n-1 (or
    some of them) in the order of ``sort_by``, and n: the range bounds are then known, and the
    plan is run once, without the sampling pass of a sort. ``watch`` gets the number of written rows and their
    combined hash.
    """
    if sort_by and dense and not within_partitions:
        df = by_dense_id(df, *dense).sortWithinPartitions(*sort_by)
    elif sort_by:
        df = df.sortWithinPartitions(*sort_by) if within_partitions else df.orderBy(*sort_by)
    if watch:
        df = df.observe(watch, F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64(*_cells(df))).alias("hash"))
    w = df.write.mode("overwrite").options(**(options or {}))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if compression:
        w = w.option("compression", compression)
    if fmt == "csv":
        w = w.options(**{k: v for k, v in _CSV_OPTIONS.items() if k != "multiLine"}).option("emptyValue", "")
    elif fmt != "parquet":
        raise ValueError(f"unknown format {fmt!r}")
    with spent_shuffles(df.sparkSession):
        w.csv(path) if fmt == "csv" else w.parquet(path)


def _cells(df: DataFrame) -> list[Column]:
    """The columns as they come back from CSV: an empty string and a null are the same cell, read as null."""
    return [F.when(F.col(f.name) != "", F.col(f.name)) if f.dataType == T.StringType() else F.col(f.name) for f in df.schema.fields]


def write_twice(df: DataFrame, csv_path: str, typed_path: str, *, sort_by: list[str] | None = None,
                dense: tuple[str, int] | None = None) -> bool:
    """Write ``df`` as CSV and, with its types, as Parquet; whether both writes saw the same rows.

    Rows are counted and their hashes combined (order plays no part) while each is written. A task that is repeated
    may be counted twice; then the two do not agree, and the typed copy is not used.
    """
    typed, csv = Observation("typed"), Observation("csv")
    write_table(df.select(*[c.alias(f.name) for c, f in zip(_cells(df), df.schema.fields)]), typed_path, "parquet", watch=typed)
    write_table(df, csv_path, "csv", sort_by=sort_by, dense=dense, watch=csv)
    return typed.get == csv.get


def read_table(spark: SparkSession, path: str, name: str | None = None, fmt: str = "csv", schema=None) -> DataFrame:
    """Read a table written by ``write_table`` with its fixed schema; a cell that does not fit fails the read."""
    schema = schema or (schemas.TABLES[name] if name else None)
    if fmt == "csv":
        r = spark.read.options(**_CSV_OPTIONS).option("mode", "FAILFAST")
        r = r.schema(schema) if schema is not None else r.option("inferSchema", "true")
        return r.csv(path)
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]) if schema else df
    raise ValueError(f"unknown format {fmt!r}")


def write_abstracts(df: DataFrame, path: str, *, global_sort: bool = False,
                    rows_per_file: int = schemas.ABSTRACT_ROWS_PER_FILE, n_papers: int | None = None,
                    row_group_bytes: int | None = None) -> None:
    """Parquet abstracts: sorted by paper_id inside each file, or globally (``n_papers``: without a sampling pass).

    A Bloom filter on paper_id is written for every row group, so that ``lookup_abstracts`` skips those
    without a wanted id even where their ranges overlap.
    """
    options = {"parquet.bloom.filter.enabled#paper_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    if row_group_bytes:
        options["parquet.block.size"] = str(row_group_bytes)
    write_table(
        df.select("paper_id", "abstract"),
        path,
        "parquet",
        sort_by=["paper_id"],
        within_partitions=not global_sort,
        max_records_per_file=rows_per_file,
        dense=("paper_id", n_papers) if n_papers else None,
        options=options,
    )


def lookup_abstracts(spark: SparkSession, path: str, wanted: DataFrame, *, point_ids: int = POINT_IDS) -> DataFrame:
    """``(paper_id, abstract)`` of the wanted papers (first column of ``wanted``) from written abstracts.

    Up to ``point_ids`` ids become a predicate of single values, which the Parquet reader checks against
    the statistics, Bloom filter and page index of every row group: only pages that can hold a wanted id
    are read. More ids are joined (a scan of the ids' range).
    """
    table = read_table(spark, path, "abstracts", "parquet")
    key = wanted.columns[0]
    ids = wanted.select(F.col(key).cast("bigint").alias("paper_id")).filter(F.col("paper_id").isNotNull()).distinct()
    head = sorted(r[0] for r in ids.limit(point_ids + 1).collect())  # bounded by point_ids
    if len(head) <= point_ids:
        found = F.lit(False)
        for at in range(0, len(head), _IN_IDS):
            found = found | F.col("paper_id").isin(head[at:at + _IN_IDS])
        return table.filter(found) if head else table.limit(0)
    ends = ids.agg(F.min("paper_id").alias("lo"), F.max("paper_id").alias("hi")).first()
    return table.filter(F.col("paper_id").between(ends["lo"], ends["hi"])).join(ids, "paper_id", "left_semi")


def write_graph(edges: DataFrame, path: str, n_rows: int, n_cols: int | None = None) -> None:
    """Edge list as Parquet plus a one-row shape table next to it, counted from the written edges."""
    with spent_shuffles(edges.sparkSession):
        edges.write.mode("overwrite").parquet(f"{path}/edges")
    written = edges.sparkSession.read.parquet(f"{path}/edges")
    graph_shape(written, n_rows, n_cols).coalesce(1).write.mode("overwrite").parquet(f"{path}/shape")


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/edges"), spark.read.parquet(f"{path}/shape")
