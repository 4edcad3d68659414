"""WARC fixity audit with Merkle trees.

Records of an archive file are ordered by offset. A leaf is the digest of one record and its byte
range; every node above hashes the ranges and digests of up to ``FAN`` consecutive children, up to
one root per file. A tree is a table with one row per node, built level by level with a grouped
aggregation of at most ``FAN`` rows each, so no file is ever collected.

``audit`` compares the roots of two replicas and descends only into branches that differ: at each
level the children of the differing nodes are the only rows joined, down to the records.

Statuses: ``corrupt`` (bytes differ), ``missing`` (not in the replica), ``extra`` (only in the replica),
``moved`` (same bytes, other range).

Defined results
* null url, html or id: written as an empty field; the record is hashed like any other.
* repeated records: each has its own place in the file (ties in the order are broken by content).
* a file that only one replica has differs as a whole: all its records are reported.
* empty archives: nothing to compare, an empty result. Very long records are hashed whole.
* extra columns of the record table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

FAN = 16
PER_FILE = 256  # page ids that share an archive file


def warc_records(pages: DataFrame, *, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Pages as response records: file, ordinal, begin, finish (byte range in the file), record_id, payload."""
    text = F.coalesce(F.col(body), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(F.col(url), F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col(key).cast("string"), F.lit("")),
        F.lit(">\r\nContent-Length: "), F.octet_length(text).cast("string"), F.lit("\r\n\r\n"),
    )
    records = pages.select(
        F.concat(F.lit("pages-"), F.coalesce(F.floor(F.col(key) / PER_FILE).cast("string"), F.lit("none")), F.lit(".warc")).alias("file"),
        F.col(key).alias("record_id"), F.concat(head, text, F.lit("\r\n\r\n")).alias("payload"),
    )
    order = Window.partitionBy("file").orderBy("record_id", F.sha2("payload", 256))
    length = F.octet_length("payload").cast("long")
    finish = F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return records.select(
        "file", (F.row_number().over(order) - 1).cast("long").alias("ordinal"), (finish - length).alias("begin"), finish.alias("finish"),
        "record_id", "payload",
    )


def leaves(records: DataFrame) -> DataFrame:
    """Level 0 of a tree: one node per record with its digest."""
    return records.select(
        "file", F.lit(0).alias("level"), F.col("ordinal").alias("node"), "begin", "finish", "record_id",
        F.sha2(F.coalesce("payload", F.lit("")), 256).alias("digest"),
    )


def _above(nodes: DataFrame, level: int) -> DataFrame:
    """The next level: digest over the ranges and digests of up to FAN consecutive children."""
    child = F.struct("node", F.concat_ws(":", F.col("begin").cast("string"), F.col("finish").cast("string"), F.col("digest")).alias("text"))
    return nodes.groupBy("file", F.floor(F.col("node") / FAN).alias("node")).agg(
        F.sort_array(F.collect_list(child)).alias("children"), F.min("begin").alias("begin"), F.max("finish").alias("finish")
    ).select(
        "file", F.lit(level).alias("level"), "node", "begin", "finish", F.lit(None).cast("long").alias("record_id"),
        F.sha2(F.array_join(F.col("children.text"), "\n"), 256).alias("digest"),
    )


def build_tree(records: DataFrame, height: int) -> list[DataFrame]:
    """Levels 0..height of the trees of all files (``height`` from ``tree_height``)."""
    levels = [stage(leaves(records), "merkle_0")]
    for level in range(1, height + 1):
        levels.append(stage(_above(levels[-1], level), f"merkle_{level}"))
    return levels


def tree_height(*replicas: DataFrame) -> int:
    """Levels above the records so that every file of every replica has a single root."""
    most = max([r.agg(F.max("ordinal")).first()[0] or 0 for r in replicas], default=0) + 1
    height = 1
    while FAN ** height < most:
        height += 1
    return height


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes of one level whose digest or range differs, or that only one side has."""
    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select("file", "node", *[F.col(c).alias(f"{p}_{c}") for c in ("begin", "finish", "record_id", "digest")])

    def same(c: str) -> Column:
        return F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))

    return side(a, "a").join(side(b, "b"), ["file", "node"], "full").filter(~(same("digest") & same("begin") & same("finish")))


def audit(first: list[DataFrame], second: list[DataFrame]) -> DataFrame:
    """Records of the first replica that the second does not hold intact: file, ordinal, begin, finish,
    record_id, expected, found, status."""
    differ = _differing(first[-1], second[-1])
    for level in range(len(first) - 2, -1, -1):
        branch = stage(differ.select("file", F.col("node").alias("__parent")), "merkle_branch")

        def below(nodes: DataFrame, branch: DataFrame = branch) -> DataFrame:
            return nodes.withColumn("__parent", F.floor(F.col("node") / FAN)).join(branch, ["file", "__parent"], "left_semi").drop("__parent")

        differ = _differing(below(first[level]), below(second[level]))
    status = (
        F.when(F.col("b_digest").isNull(), "missing").when(F.col("a_digest").isNull(), "extra")
        .when(F.col("a_digest") == F.col("b_digest"), "moved").otherwise("corrupt")
    )
    return differ.select(
        "file", F.col("node").alias("ordinal"), F.coalesce("a_begin", "b_begin").alias("begin"), F.coalesce("a_finish", "b_finish").alias("finish"),
        F.coalesce("a_record_id", "b_record_id").alias("record_id"), F.col("a_digest").alias("expected"), F.col("b_digest").alias("found"), status.alias("status"),
    )


def damaged(records: DataFrame) -> DataFrame:
    """A replica that lost bits, for drills: records whose digest starts with 00 have their last byte
    overwritten in place, and files whose name's digest starts with 0 have lost their last record."""
    last = F.max("ordinal").over(Window.partitionBy("file"))
    hit = F.startswith(F.sha2("payload", 256), F.lit("00"))
    cut = F.startswith(F.sha2("file", 256), F.lit("0"))
    return records.withColumn("__last", last).filter(~(cut & (F.col("ordinal") == F.col("__last")))).drop("__last").withColumn(
        "payload", F.when(hit, F.concat(F.expr("left(payload, char_length(payload) - 1)"), F.lit("#"))).otherwise(F.col("payload")))
