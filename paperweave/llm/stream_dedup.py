"""Exact dedup with a stateful stream whose state never expires.

The narrow rows (digest, identifier, code points, content locator) are fed to a Structured
Streaming aggregation keyed by the SHA-256 of the normalised text. Its state lives on disk
(RocksDB store), has no watermark and so never expires, and keeps per digest the stable
identifier of the row that stays, where its content is (hash of the file it came from) and
the number of rows seen. Every micro-batch writes the digests it changed; the last version of
a digest is its verdict. Checkpoints go to the shared folder, so a lost executor reloads its
state from there.

Hits (digests with several rows) are then checked on full bytes: each row's normalised text is
compared with the text of the row that stays. Rows that differ (two texts with one digest) get
groups of their own, formed on the texts themselves, so the result never rests on the digest.

Defined results
* null text counts as empty; all empty texts are equal to each other.
* two rows are equal when their texts are identical without white space; the row with the most
  code points in the original text stays, then the smallest identifier (null last), then, for
  rows that agree in all of that, the first in the scan.
* one row is returned per input row, dropped ones too. An empty table gives an empty result.
* ``docs`` is one source (a table as read; a joined frame is written first), since the locator is the
  file of the row.
* extra columns are ignored; a group with a third of all rows is combined before the shuffle
  and salted in the joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage, staging_path
from .common import ROW, ROW_BITS, numbered, salted_join, without_space

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # many small stores: write change logs, and no space set aside in advance
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def _sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _rank() -> Column:
    return F.struct(
        (-F.col("n_chars")).alias("neg_chars"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"),
        F.col("row"), F.col("locator"),
    )


def digest_state(keyed: DataFrame, files_per_trigger: int | None = None) -> DataFrame:
    """Final state of the stream over ``keyed`` (staged rows): digest, stays (struct), n."""
    spark: SparkSession = keyed.sparkSession
    source, out, state = (staging_path(spark, n) for n in ("dedup_source", "dedup_versions", "dedup_state"))
    keyed.write.parquet(source)
    schema = spark.read.parquet(source).schema
    old = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(schema)
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        best = reader.parquet(source).groupBy("digest").agg(F.min(_rank()).alias("stays"), F.count(F.lit(1)).alias("n"))
        query = (
            best.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True)
            .foreachBatch(lambda changed, batch: changed.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{out}/{batch:06d}"))
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    versions = spark.read.option("recursiveFileLookup", "true").parquet(out)
    if query.lastProgress is not None and (query.lastProgress["batchId"] or 0) > 0:
        versions = versions.groupBy("digest").agg(F.max_by(F.struct("stays", "n"), "batch").alias("last")).select(
            "digest", "last.stays", "last.n"
        )
    return versions.select("digest", "stays", "n")


def dedup_verdicts(docs: DataFrame, *, key: str = "doc_id", text: str = "text", digest=_sha256,
                   files_per_trigger: int | None = None, place: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row (position in the scan).

    ``place`` names a column with the rows' numbers (``common.numbered``), which then are ``row``.
    ``digest`` may be weakened in tests to force collisions."""
    spark = docs.sparkSession
    norm = without_space(F.col("text"))
    row = F.col(place) if place else F.monotonically_increasing_id()
    # a row's number begins with its file
    locator = F.shiftright(place, ROW_BITS) if place else F.xxhash64(F.input_file_name())
    base = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), row.alias("row"), locator.alias("locator"))
    keyed = stage(base.select(
        "doc_id", "row", "locator", digest(norm).alias("digest"),
        F.char_length(F.coalesce("text", F.lit(""))).alias("n_chars"), _sha256(norm).alias("text_sha256"),
    ), "dedup_keys")
    if keyed.isEmpty():
        return _result(keyed.withColumn("stays", _rank()).withColumn("n", F.lit(0).cast("bigint")))
    state = stage(digest_state(keyed.drop("text_sha256"), files_per_trigger), "dedup_index")

    # hits: the rows of digests seen more than once, with their texts, compared byte by byte
    hits = stage(salted_join(
        base.select("doc_id", digest(norm).alias("digest"), norm.alias("norm"), F.col("row")),
        state.filter("n > 1"), "digest", "n", F.col("row"), "inner",
    ), "dedup_hits")
    is_stay = (F.col("row") == F.col("stays.row")) & F.col("doc_id").eqNullSafe(F.col("stays.doc_id"))
    keepers = hits.filter(is_stay).select("digest", F.col("norm").alias("kept_norm")).join(state.select("digest", "n"), "digest")
    compared = salted_join(hits.select("digest", "row", "norm"), keepers, "digest", "n", F.col("row"), "inner")
    differ = stage(compared.filter(~(F.col("norm") == F.col("kept_norm"))).select("digest", "row", "norm"), "dedup_collisions")

    joined = salted_join(keyed, state.withColumn("size", F.col("n")), "digest", "n", F.col("row"), "inner")
    joined = joined.withColumnRenamed("size", "n")
    if not differ.isEmpty():
        joined = _split_collisions(joined, differ)
    return _result(joined)


def _split_collisions(joined: DataFrame, differ: DataFrame) -> DataFrame:
    """Groups on the texts themselves for rows whose digest was met by another text."""
    lost = differ.groupBy("digest").agg(F.count(F.lit(1)).alias("lost"))
    same = (
        joined.join(differ.select("row"), "row", "left_anti").join(lost, "digest", "left")
        .withColumn("n", F.col("n") - F.coalesce("lost", F.lit(0))).drop("lost")
    )
    other = joined.drop("stays", "n").join(differ.select("row", "norm"), "row")
    groups = other.groupBy("digest", "norm").agg(F.min(_rank()).alias("stays"), F.count(F.lit(1)).alias("n"))
    return same.unionByName(other.join(groups, ["digest", "norm"]).drop("norm").select(same.columns))


def _result(rows: DataFrame) -> DataFrame:
    kept = F.col("row") == F.col("stays.row")
    return rows.select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), F.col("n").cast("bigint").alias("group_size"),
        kept.alias("kept"), "text_sha256", "row", "n_chars",
    )


def drop_copies(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, all columns as they came; of rows that agree in everything, the first of the scan."""
    rows = numbered(docs)
    kept = dedup_verdicts(rows, key=key, text=text, place=ROW).filter("kept").select(F.col("row").alias(ROW))
    return rows.join(stage(kept, "dedup_kept"), ROW, "left_semi").select(docs.columns)
