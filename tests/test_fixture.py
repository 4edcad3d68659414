"""Works from the tables: a line item travels once, and odd keys keep their places."""

from pyspark.sql import functions as F

from paperweave.sources.fixture import works_fixture


def _tables(spark, root):
    lines = [(7, 1 + i % 3, 2, i, 1.0, 1.0) for i in range(130)]  # more than 100 lines, repeated as 7 % 7 = 0
    lines += [(8, 5, 1, 2, 1.0, 1.0), (8, 2, 1, 1, 1.0, 1.0), (8, 2, 1, 1, 1.0, 1.0), (8, 99, 1, 3, 1.0, 1.0), (8, None, 1, 7, 1.0, 1.0),
              (None, 1, 1, 1, 1.0, 1.0), (9, 99, 1, 1, 1.0, 1.0)]
    made = {
        "lineitem": spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                          "l_extendedprice double").withColumn("l_shipdate", F.lit("1998-01-01").cast("timestamp")),
        "orders": spark.createDataFrame([(k, 1, 5000.0, "1-URGENT") for k in (7, 8, 9, 10, None)], "o_orderkey long, o_custkey long, o_totalprice "
                                        "double, o_orderpriority string").withColumn("o_orderdate", F.lit("1997-02-03").cast("timestamp")),
        "customer": spark.createDataFrame([(1, 2, 1.0)], "c_custkey long, c_nationkey long, c_acctbal double"),
        "nation": spark.createDataFrame([(2, "PERU")], "n_nationkey long, n_name string"),
        # part 2 is there twice
        "part": spark.createDataFrame([(1, "one", 4), (2, "two", 5), (2, "deux", 6), (3, "three", 13), (5, "five", 11), (None, "none", 1)],
                                      "p_partkey long, p_name string, p_size int"),
        "documents": spark.createDataFrame([(8, "b a b", "en")], "doc_id long, text string, lang string"),
    }
    for name, df in made.items():
        df.write.parquet(f"{root}/{name}.parquet")
    return lines


_NAMES = {1: ["one"], 2: ["deux", "two"], 3: ["three"], 5: ["five"]}


def test_line_items_are_read_once_and_keep_their_order(spark, tmp_path):
    lines = _tables(spark, str(tmp_path))
    works = works_fixture(spark, str(tmp_path))
    assert works._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey") == 1
    rows = {int(r["id"].rsplit("W", 1)[1]): r for r in works.filter("id like '%W10%'").collect()}
    assert sorted(rows) == [1021, 1024, 1027, 1030]

    def names(row):
        return row["authorships"] and [a["author"]["display_name"] for a in row["authorships"]]

    seven = sorted((x for x in lines if x[0] == 7), key=lambda x: (x[3], x[1]))
    placed = [(pos + shift, n) for pos, x in enumerate(seven) for n in _NAMES[x[1]] for shift in (0, 100)]
    # at one place, the author ids come first in the order
    author = {n: f"https://ids.example.org/A{500 + p}" for p, all_names in _NAMES.items() for n in all_names}
    assert names(rows[1021]) == [n for _, n in sorted(placed, key=lambda x: (x[0], author[x[1]], x[1]))]
    assert names(rows[1024]) == ["deux", "two", "deux", "two", "five"]
    assert [t["subfield"] and t["subfield"]["id"][-4:] for t in rows[1024]["topics"]] == ["1005", "1006", "1005", "1006", "1011"]
    assert len(rows[1024]["referenced_works"]) == 5 and len(rows[1021]["referenced_works"]) == 130
    assert rows[1027]["authorships"] is None and rows[1027]["topics"] is None and len(rows[1027]["referenced_works"]) == 1
    assert rows[1030]["referenced_works"] is None
    assert rows[1024]["abstract_inverted_index"] == {"a": [1], "b": [0, 2]}
