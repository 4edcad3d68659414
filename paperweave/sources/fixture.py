"""Work records derived from the TPC-H-style test tables (see FIXTURES.md §3).

One order is one work; its line items give references, authorships and
topics, and the document with the same key gives the abstract. The records
have exactly the nested shape of ``schemas.WORK`` plus ``updated_date`` and
``order_key``, so every operator runs on them unchanged. The same derivation
is written in SQL for the DuckDB oracle (``paperweave.oracle``).

Everything is computed by Spark from the given tables; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import with_inverted_index
from .works import order_number

# Fixed values of the fixture (shared with the oracle SQL).
URL_PREFIX = "https://ids.example.org/"
ORCID_PREFIX = "https://orcid.org/"
DOI_PREFIX = "https://doi.org/10.1/"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _url(tag: str, id_col) -> F.Column:
    # a null id gives an URL without digits: an id that is no number
    return F.concat(F.lit(URL_PREFIX + tag), F.coalesce(id_col.cast("string"), F.lit("")))


# What the authorships of orders divisible by 7, which are repeated, are moved by
REPEAT_POS = 100


def fixture_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order ``k`` with ``lines``: its line items in order, each with the reference (``ref``), the
    authorships (``au``) and the topics (``tp``) that it gives, one of the latter two per part of its key.

    A line meets its part once and travels to its order once, with no more than the columns that these are made of.
    Lines that agree in these give the same values, so their other columns need not order them. The lines of an order
    come to its group sorted: ``session.SORTED_GROUPS_CONF`` makes use of that."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").filter(
        F.col("l_orderkey").isNotNull())
    part = _t(spark, sf_dir, "part").filter(F.col("p_partkey").isNotNull())
    parts = part.groupBy("p_partkey").agg(F.collect_list(F.struct("p_name", "p_size")).alias("parts"))
    met = li.join(parts, li["l_partkey"] == parts["p_partkey"], "left").drop("p_partkey")

    # references: one per line. Keys ending in 0-5 cite each other at random; the others stay inside
    # their thousand, where the first line cites one hub. Line 7 holds an id that is no number.
    lk = F.col("l_orderkey")
    block = lk - lk % 1000 + 6
    ref_key = (
        F.when(F.col("l_linenumber") == 7, F.lit(None))
        .when(lk % 10 < 6, F.col("l_partkey") * 10 + F.col("l_suppkey") % 6)
        .when(F.col("l_linenumber") == 1, block)
        .otherwise(block + 10 * (F.col("l_partkey") % 100) + F.col("l_suppkey") % 4)
    )

    # authorships: parts divisible by 37 give an author id that is no number
    def author(p):
        return F.struct(
            F.struct(
                _url("A", F.when(F.col("l_partkey") % 37 != 0, F.lit(500) + F.col("l_partkey")).cast("bigint")).alias("id"),
                p["p_name"].alias("display_name"),
                F.when(F.col("l_partkey") % 3 == 0, F.lit(None))
                .otherwise(F.concat(F.lit(ORCID_PREFIX), F.col("l_partkey").cast("string")))
                .alias("orcid"),
            ).alias("author")
        )

    # topics: field/subfield from the part size; rare works have categories of their own,
    # and some subfield ids are no number
    def topic(p):
        size, own = p["p_size"], lk % 10 == 9
        field_id = F.when(size % 11 == 0, F.lit(None)).when(own, F.lit(60) + size % 3).otherwise(F.lit(10) + size % 10).cast("bigint")
        sub_id = F.when(own, F.lit(9000) + size % 5).otherwise(F.lit(1000) + size).cast("bigint")
        sub_none, sub_bad = size % 13 == 0, size % 13 == 1
        return F.struct(
            F.when(
                field_id.isNotNull(),
                F.struct(
                    _url("fields/", field_id).alias("id"),
                    F.concat(F.lit("Field "), field_id.cast("string")).alias("display_name"),
                ),
            ).alias("field"),
            F.when(
                ~sub_none,
                F.struct(
                    _url("subfields/", F.when(~sub_bad, sub_id)).alias("id"),
                    F.concat(F.lit("Subfield "), sub_id.cast("string")).alias("display_name"),
                ),
            ).alias("subfield"),
        )

    def per_part(value):
        one = F.array(value(F.get("parts", F.lit(0))))
        return (
            F.when(F.size("parts") == 1, one)
            .when(F.size("parts") > 1, F.sort_array(F.transform("parts", value)))
            .otherwise(F.slice(one, 1, 0))
        )

    line = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey",
        _url("W", (F.lit(1000) + 3 * ref_key).cast("bigint")).alias("ref"), per_part(author).alias("au"), per_part(topic).alias("tp"),
    )
    # dealt by the order before the values are made and gathered: only the plain columns are shuffled
    dealt = met.repartition("l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dealt.select(lk.alias("k"), line.alias("line")).groupBy("k").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def works_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested work records for every order of ``sf_dir`` (kept or not)."""
    orders = _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), "text", "lang")
    lines = fixture_lines(spark, sf_dir)

    k = F.col("k")
    oa_id = (F.lit(1000) + F.lit(3) * k).cast("bigint")
    date_str = F.col("o_orderdate").cast("date").cast("string")
    # keys ending in 9 lie in the small components only; they have venues of their own
    rare = k % 10 == 9
    src_id = (
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .when(rare, (F.lit(9000) + k % 7).cast("bigint"))
        .otherwise((F.lit(100) + F.lit(10) * F.col("c_nationkey")).cast("bigint"))
    )
    src_name = (
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .when(rare, F.concat(F.lit(" Rare venue "), (k % 7).cast("string")))
        .when(F.col("c_nationkey") == 0, F.lit("Nature"))
        .when(F.col("c_nationkey") == 1, F.lit("SCIENCE"))
        .otherwise(F.col("n_name"))
    )
    # an order meets its text and lines with its plain columns: the texts of the fields are made after the shuffle
    base = (
        orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
        .join(nation, F.col("c_nationkey") == nation["n_nationkey"])
        .select(F.col("o_orderkey").alias("k"), "o_totalprice", "o_orderdate", "o_orderpriority", "c_nationkey", "c_acctbal", "n_name")
    )
    fields = [
        _url("W", oa_id).alias("id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "article")
        .when(F.col("o_orderpriority") == "2-HIGH", "review")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "preprint")
        .when(F.col("o_orderpriority") == "5-LOW", "letter")
        .otherwise("dataset")
        .alias("type"),
        # some titles begin and end with white space
        F.concat(F.when(k % 23 == 0, F.lit("\t ")).otherwise(F.lit("")), F.lit('Work, "'), k.cast("string"), F.lit('"'),
                 F.when(k % 23 < 2, F.lit(" ")).otherwise(F.lit(""))).alias("title"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit(DOI_PREFIX), k.cast("string"))).alias("doi"),
        F.when(k % 19 == 0, F.lit(None)).otherwise(F.year("o_orderdate")).cast("int").alias("publication_year"),
        F.when(k % 17 == 0, F.lit(None))
        .when(k % 17 == 1, F.substring(date_str, 1, 4))
        .otherwise(date_str)
        .alias("publication_date"),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("cited_by_count"),
        F.when(
            src_id.isNotNull(),
            F.struct(
                F.struct(
                    _url("S", src_id).alias("id"),
                    src_name.alias("display_name"),
                    F.lit(None).cast("string").alias("issn_l"),
                    F.lit("journal").alias("type"),
                ).alias("source")
            ),
        ).alias("primary_location"),
        F.when(k % 3 == 0, "2024-01-01")
        .when(k % 3 == 1, "2024-02-01")
        .otherwise("2024-03-01")
        .cast("date")
        .alias("updated_date"),
    ]

    # one authorship per line and part; orders divisible by 7 repeat them at pos + REPEAT_POS
    every = F.flatten(F.col("lines")["au"])

    def placed(shift):
        return F.flatten(F.transform("lines", lambda x, i: F.transform(x["au"], lambda a: F.struct((i + shift).alias("pos"), a.alias("a")))))

    mixed = F.transform(F.sort_array(F.concat(placed(0), placed(REPEAT_POS))), lambda e: e["a"])
    twice = F.when(F.size("lines") <= REPEAT_POS, F.concat(every, every)).otherwise(mixed)
    topics = F.flatten(F.col("lines")["tp"])
    nested = lines.select(
        "k",
        F.col("lines")["ref"].alias("referenced_works"),
        F.when(F.size(every) > 0, F.when(F.col("k") % 7 == 0, twice).otherwise(every)).alias("authorships"),
        F.when(F.size(topics) > 0, topics).alias("topics"),
    )

    # hash-partition the documents first so the per-row text work is spread over
    # the shuffle partitions, not over the few scan splits of one file
    abstracts = with_inverted_index(
        docs.repartition("k").select("k", F.col("lang").alias("language"), "text"),
        "text",
        "abstract_inverted_index",
    ).drop("text")

    met = base.join(abstracts, "k", "left").join(nested, "k", "left")
    works = met.select("k", *fields, "language", "referenced_works", "authorships", "topics", "abstract_inverted_index")
    return works.select(
        "id",
        "type",
        "title",
        "doi",
        "language",
        "publication_year",
        "publication_date",
        "cited_by_count",
        "primary_location",
        "referenced_works",
        "authorships",
        "topics",
        "abstract_inverted_index",
        "updated_date",
        F.struct(
            F.col("updated_date"),
            F.lit("").alias("file"),
            F.lit(0).cast("bigint").alias("block"),
            F.col("k").cast("bigint").alias("line"),
        ).alias("order_key"),
        order_number(F.col("k") % 3, F.col("k")).alias("order_no"),  # the date follows k % 3
    )
