"""Scan of a works snapshot: ``<root>/data/works/updated_date=YYYY-MM-DD/*.gz``.

Each line is one JSON record; blank lines are skipped and a malformed line
fails the job. Only the fields in ``schemas.WORK`` are parsed. Every record
gets ``order_key`` = (partition date, file path, split start, running number
inside the split), which orders records the way a sequential reader meets
them: partitions by date, files by name, lines in file order. Gzip files are
not splittable, so a file is read by one task and the running number follows
its lines. ``order_no`` is the same position as one bigint (file, line, room
for a place inside the record), so that minima and maxima over it are hash
aggregates.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.rows import with_computed
from ..session import spent_shuffles

PARTITION_COL = "updated_date"
_PARTITION = re.compile(rf"{PARTITION_COL}=(\d{{4}}-\d{{2}}-\d{{2}})")


def works_dir(root: str) -> str:
    return root.rstrip("/") + "/data/works"


def _read_schema() -> T.StructType:
    return T.StructType(schemas.WORK.fields + [T.StructField(PARTITION_COL, T.DateType())])


def _list_files(spark: SparkSession, base: str, partitions: Iterable[str] | None) -> dict[str, list[str]]:
    """Partition directory name -> sorted data file paths (metadata listing only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base_path = jvm.org.apache.hadoop.fs.Path(base)
    fs = base_path.getFileSystem(conf)
    out: dict[str, list[str]] = {}
    if not fs.exists(base_path):
        return out
    wanted = None if partitions is None else set(partitions)
    for st in fs.listStatus(base_path):
        name = st.getPath().getName()
        if not st.isDirectory() or not name.startswith(PARTITION_COL + "="):
            continue
        if wanted is not None and name not in wanted:
            continue
        files = sorted(
            f.getPath().toString()
            for f in fs.listStatus(st.getPath())
            if f.isFile() and f.getPath().getName().endswith(".gz") and not f.getPath().getName().startswith(("_", "."))
        )
        out[name] = files
    return out


def scan_works(
    spark: SparkSession,
    root: str,
    *,
    partitions: Iterable[str] | None = None,
    files_per_partition: int = 0,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Raw work records with ``updated_date`` and ``order_key``.

    Only ``*.gz`` files count; other files beside them are not read.
    ``partitions`` names the ``updated_date=...`` directories to read: names
    that are missing or no date are ignored, and records keep date order
    whatever the order of the list. The filter sits right on the scan so it
    prunes directories. ``files_per_partition`` > 0 reads only the first files (by
    name) of each partition, a sample for trial runs.
    """
    base = works_dir(root)
    reader = spark.read.schema(_read_schema()).option("mode", mode).option("pathGlobFilter", "*.gz")
    if not _exists(spark, base):
        raise _nothing_found(root)
    if files_per_partition > 0:
        listing = _list_files(spark, base, partitions)
        paths = [p for files in listing.values() for p in files[:files_per_partition]]
        if not paths:
            return require_nonempty(spark.createDataFrame([], _read_schema()), root)
        df = reader.option("basePath", base).json(paths)
    else:
        df = reader.json(base)
        if partitions is not None:
            named = (_PARTITION.fullmatch(p) for p in partitions)
            dates = [F.lit(m[1]).try_cast("date") for m in named if m]
            df = df.filter(F.col(PARTITION_COL).isin(dates) if dates else F.lit(False))
    keyed = df.withColumn(
        "order_key",
        F.struct(
            F.col(PARTITION_COL).alias("updated_date"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ),
    ).withColumn("__name", F.col("_metadata.file_name"))
    numbers = spark.createDataFrame(_numbered_files(spark, base), "__date date, __file string, __no long")
    joined = keyed.join(  # one row per file of the listing that the scan itself plans from
        F.broadcast(numbers), (keyed[PARTITION_COL] == numbers["__date"]) & (keyed["__name"] == numbers["__file"]), "left"
    )
    line = F.col("order_key.line").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn("order_no", order_number(F.col("__no"), line)).drop("__name", "__date", "__file", "__no")


def order_number(file_no: Column, line: Column) -> Column:
    """Position of a record as one bigint: file, line in the file, and room for a place inside the
    record (``schemas.PLACE_BITS``). Numbers that do not fit fail the query."""
    most = F.lit(1 << schemas.LINE_BITS)
    fits = file_no.isNotNull() & (file_no < (1 << schemas.FILE_BITS)) & (line < most)
    number = F.shiftleft(F.shiftleft(file_no.cast("bigint"), schemas.LINE_BITS) + line.cast("bigint"), schemas.PLACE_BITS)
    return F.when(fits, number).otherwise(F.raise_error(F.lit("record position out of range")).cast("bigint"))


def _numbered_files(spark: SparkSession, base: str) -> list[tuple]:
    """(partition date, file name, position) of every data file, by date, then name."""
    files = []
    for name, paths in _list_files(spark, base, None).items():
        m = _PARTITION.fullmatch(name)
        if m:
            files += [(datetime.date.fromisoformat(m[1]), p.rsplit("/", 1)[1]) for p in paths]
    return [(d, f, i) for i, (d, f) in enumerate(sorted(files))]


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def _nothing_found(root: str) -> RuntimeError:
    return RuntimeError(f"the snapshot holds no usable work record: looked for {works_dir(root)}/{PARTITION_COL}=<date>/*.gz")


def require_nonempty(df: DataFrame, root: str) -> DataFrame:
    """Fail with the place that was searched when ``df`` has no rows."""
    if df.isEmpty():
        raise _nothing_found(root)
    return df


# Rows that one task writes, and files: their counter has three digits in the names of Spark's writer, which sort as text
TASK_ROWS, TASK_FILES, MOST_TASKS = 50_000, 1000, 100_000

# Rows of one write job, and jobs: a job's records are shuffled once, and only as many lie on disk twice
JOB_ROWS, MOST_JOBS = 2_000_000, 4


def write_works(works: DataFrame, root: str, *, compression: str = "gzip", rows_per_file: int = 0,
                rows_per_task: int = TASK_ROWS, rows_per_job: int = JOB_ROWS) -> None:
    """Write records as a snapshot: each partition's records in ``order_key`` order, so file names
    (``part-00000...c000``, ``...c001``, then ``part-00001...``) and lines follow that order and a
    re-scan meets the records the same way. ``rows_per_file`` > 0 splits a partition into files of that many lines.

    Only the keys (date, ``order_key``) are ranked; a task writes one stretch of about ``rows_per_task`` ranks of one date,
    which begins at a multiple of ``rows_per_file``. So a date is shared by as many tasks as it has stretches. A
    record finds its task among the stretches' first keys (a binary search). The tasks are run in a few jobs of about
    ``rows_per_job`` records or more, each of which reads ``works`` and shuffles its own records: ``works`` should be staged.
    """
    spark = works.sparkSession
    cols = [f.name for f in schemas.WORK.fields]
    dated = works.select(*cols, F.col(PARTITION_COL).cast("string").alias(PARTITION_COL), "order_key")
    ranked = _ranked(dated.select(PARTITION_COL, "order_key"))
    dates = ranked.groupBy(PARTITION_COL).agg(F.min("__place").alias("first"), F.count(F.lit(1)).alias("rows")).orderBy("first").collect()
    n_rows = sum(d["rows"] for d in dates)
    stretch = max(rows_per_task, -(-n_rows // (MOST_TASKS - len(dates))))
    if rows_per_file > 0:
        stretch = min(max(1, stretch // rows_per_file), TASK_FILES) * rows_per_file
    starts, n_tasks = [], 0
    for d in dates:  # one row per partition of the snapshot
        starts.append((d[PARTITION_COL], d["first"], n_tasks))
        n_tasks += -(-d["rows"] // stretch)
    if n_tasks > MOST_TASKS:
        raise ValueError(f"files of {rows_per_file} rows would need more than {MOST_TASKS} tasks")
    marks = spark.createDataFrame(starts, "__date string, __first long, __task long")

    def met(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(marks), rows[PARTITION_COL].eqNullSafe(marks["__date"])).drop("__date").withColumn(
            "__at", F.col("__place") - F.col("__first"))

    order = [PARTITION_COL, "order_key"]
    cuts = met(ranked).filter(F.col("__at") % stretch == 0)
    if _tied(cuts, met(ranked).filter((F.col("__at") + 1) % stretch == 0)):
        # records with the key that a stretch begins with stand on both sides of it: only their own rank tells them apart
        placed, order = met(_ranked(dated)), [PARTITION_COL, "__place"]
        tasked = placed.withColumn("__task", (F.col("__task") + F.floor(F.col("__at") / F.lit(stretch))).cast("int"))
    else:
        tasked = with_computed(dated, "__task", _last_at_most(cuts.select(*order), F.struct(*order)))
    n_jobs = max(1, min(MOST_JOBS, n_rows // max(rows_per_job, 1), n_tasks))
    for job in range(n_jobs):
        first, end = n_tasks * job // n_jobs, n_tasks * (job + 1) // n_jobs
        own = tasked if n_jobs == 1 else tasked.filter(F.col("__task").between(first, end - 1))
        # sort on the written (string) partition column itself: the writer then
        # needs no sort of its own, which would not keep the order inside a date
        w = (
            own.select(*dict.fromkeys([*cols, *order]), "__task")
            .repartitionById(max(n_tasks, 1), "__task")  # the number of its task is part of a file's name
            .sortWithinPartitions(*order)
            .select(*cols, PARTITION_COL)
            .write.mode("append" if job else "overwrite")
            .partitionBy(PARTITION_COL)
            .option("compression", compression)
        )
        if rows_per_file > 0:
            w = w.option("maxRecordsPerFile", rows_per_file)
        with spent_shuffles(spark):
            w.json(works_dir(root))


def _ranked(dated: DataFrame) -> DataFrame:
    """``dated`` with ``__place``, its rank by (date, ``order_key``), staged."""
    from ..operators.ids import dense_id

    return dense_id(dated, [PARTITION_COL, "order_key"], "__place", name="works_ranked")


def _tied(cuts: DataFrame, ends: DataFrame) -> bool:
    """Whether a stretch begins with the key that the one before it ends with."""
    before = ends.select(F.col(PARTITION_COL).alias("__date"), F.col("order_key").alias("__key"), (F.col("__place") + 1).alias("__next"))
    same = cuts[PARTITION_COL].eqNullSafe(before["__date"]) & cuts["order_key"].eqNullSafe(before["__key"])
    return not cuts.join(before, (cuts["__place"] == before["__next"]) & same).isEmpty()


def _last_at_most(keys: DataFrame, key: Column) -> Column:
    """Number of the last of the sorted ``keys`` (a row a task) that is no greater than ``key``: a binary search in their
    list, which is read from one string literal, folded once."""
    listed = keys.agg(F.sort_array(F.collect_list(F.struct(*keys.columns))).alias("keys"))
    found = listed.select(F.size("keys").alias("n"), F.to_json("keys").alias("text")).first()
    bounds = F.from_json(F.lit(found["text"]), listed.schema["keys"].dataType)
    widths = F.array(*[F.lit(1 << i) for i in range(found["n"].bit_length() - 1, -1, -1)], F.lit(0))

    def search(bound: Column) -> Column:
        def step(at: Column, width: Column) -> Column:
            further = F.when(at + width < found["n"], F.get(bounds, at + width) <= bound).otherwise(F.lit(False))
            return F.when(further, at + width).otherwise(at)

        return F.aggregate(widths, F.lit(0), step)

    return F.transform(F.array(key), search)[0]  # the key is made once a row, not once a step
