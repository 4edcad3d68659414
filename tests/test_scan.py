"""Snapshot scan: layout, blank and malformed lines, partitions, file cap, duplicates."""

import gzip
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from paperweave.plans.build import UnfilteredBuild
from paperweave.sources.works import scan_works, write_works


def _snapshot(tmp_root, parts):
    for date, files in parts.items():
        d = os.path.join(tmp_root, "data", "works", f"updated_date={date}")
        os.makedirs(d, exist_ok=True)
        for name, lines in files.items():
            with gzip.open(os.path.join(d, name), "wt") as f:
                f.write("\n".join(lines) + "\n")
    return tmp_root


def _w(i, typ="article", **kw):
    rec = {"id": f"https://x.org/W{i}", "type": typ, "title": f"t{i}", "publication_year": 2020}
    rec.update(kw)
    return json.dumps(rec)


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def test_blank_lines_partitions_and_order(spark, root):
    _snapshot(root, {
        "2024-01-01": {"a.gz": [_w(5), "", _w(3)], "b.gz": [_w(9)]},
        "2024-02-01": {"a.gz": [_w(7), "   "]},
    })
    df = scan_works(spark, root)
    rows = df.orderBy("order_key").select("id", F.col("updated_date").cast("string")).collect()
    assert [r[0][-2:] for r in rows] == ["W5", "W3", "W9", "W7"]
    part = scan_works(spark, root, partitions=["updated_date=2024-02-01", "updated_date=2030-01-01"])
    assert [r["id"] for r in part.collect()] == ["https://x.org/W7"]
    cap = scan_works(spark, root, files_per_partition=1)
    assert sorted(r["id"][-2:] for r in cap.collect()) == ["W3", "W5", "W7"]


def test_malformed_line_fails(spark, root):
    _snapshot(root, {"2024-01-01": {"a.gz": [_w(1), '{"id": "https://x.org/W2", "type": ']}})
    with pytest.raises(Exception):
        scan_works(spark, root).collect()


def test_empty_snapshot_names_path(spark, root):
    from paperweave.sources.works import require_nonempty

    with pytest.raises(RuntimeError, match="updated_date"):  # no directory at all
        scan_works(spark, root)
    os.makedirs(os.path.join(root, "data", "works"), exist_ok=True)
    with pytest.raises(RuntimeError, match="updated_date"):
        require_nonempty(scan_works(spark, root, files_per_partition=1), root)


def test_only_gz_files_count(spark, root):
    _snapshot(root, {"2024-01-01": {"a.gz": [_w(1)]}})
    d = os.path.join(root, "data", "works", "updated_date=2024-01-01")
    for name, text in (("extra.json", _w(2)), ("notes.csv", "a,b"), ("manifest", "x")):
        with open(os.path.join(d, name), "w") as f:
            f.write(text + "\n")
    assert [r["id"][-2:] for r in scan_works(spark, root).collect()] == ["W1"]
    assert [r["id"][-2:] for r in scan_works(spark, root, files_per_partition=5).collect()] == ["W1"]


def test_odd_partition_names_are_ignored(spark, root):
    _snapshot(root, {"2024-01-01": {"a.gz": [_w(1)]}, "2024-02-01": {"a.gz": [_w(2)]}})
    part = scan_works(spark, root, partitions=["foo", "updated_date=soon", "updated_date=2024-13-41", "updated_date=2024-02-01"])
    assert [r["id"][-2:] for r in part.collect()] == ["W2"]
    assert scan_works(spark, root, partitions=["foo"]).count() == 0


def test_job_fails_when_no_kept_type_is_left(spark, root):
    from paperweave.plans.job import build_unfiltered

    _snapshot(root, {"2024-01-01": {"a.gz": [_w(1, typ="dataset")]}})
    with pytest.raises(RuntimeError, match="no work record"):
        build_unfiltered(scan_works(spark, root), root + "/out")


_BAD = dict(
    referenced_works=["https://x.org/Wnope", "https://x.org/W2"],
    authorships=[{"author": {"id": "https://x.org/A?"}}, {"author": {"id": "https://x.org/A7"}}],
    topics=[{"field": {"id": "https://x.org/fields/17", "display_name": "F"}, "subfield": {"id": "https://x.org/subfields/x", "display_name": "S"}},
            {"field": {"id": "https://x.org/fields/y", "display_name": "G"}, "subfield": None}],
    primary_location={"source": {"id": "https://x.org/Sx", "display_name": "V"}},
)


def test_bad_ids_are_counted_and_a_bad_subfield_keeps_its_field(spark, root):
    _snapshot(root, {"2024-01-01": {"a.gz": [_w(1, **_BAD), _w(2), json.dumps({"id": "https://x.org/Wno", "type": "article"})]}})
    b = UnfilteredBuild(scan_works(spark, root))
    counts = b.counters().first().asDict()
    assert {k: v for k, v in counts.items() if k.startswith("n_bad")} == {
        "n_bad_references": 1, "n_bad_authors": 1, "n_bad_fields": 1, "n_bad_subfields": 1, "n_bad_sources": 1, "n_bad_works": 1}
    assert [tuple(r) for r in b.topics.select("field_id", "subfield_id", "sequence").collect()] == [(17, -1, 0)]
    assert b.authorships.count() == 1 and b.references.count() == 1


@pytest.mark.parametrize("part", ["references", "authorships", "topics", "source_table"])
def test_bad_ids_fail_the_job_when_asked(spark, root, part):
    _snapshot(root, {"2024-01-01": {"a.gz": [_w(1, **_BAD), _w(2)]}})
    with pytest.raises(Exception, match="bad id"):
        getattr(UnfilteredBuild(scan_works(spark, root), on_bad="fail"), part).collect()


def test_duplicates_nulls_and_dropped_types(spark, root):
    auth = [{"author": {"id": "https://x.org/A1", "display_name": "Ann"}}, {"author": {"id": None}}, {"author": None}]
    _snapshot(root, {
        "2024-01-01": {"a.gz": [
            _w(10, title="old title"),
            _w(20, typ="dataset"),
            _w(30, referenced_works=["https://x.org/W20", "https://x.org/W10", "https://x.org/W30"],
               authorships=auth, topics=None, primary_location={"source": {}}),
            json.dumps({"id": None, "type": "article"}),
            json.dumps({"id": "https://x.org/W40"}),
        ]},
        "2024-02-01": {"a.gz": [_w(10, title="new title", topics=[
            {"field": {"display_name": "NoId"}, "subfield": None},
            {"field": None, "subfield": {"id": "https://x.org/subfields/9", "display_name": "S9"}},
        ])]},
    })
    b = UnfilteredBuild(scan_works(spark, root))
    papers = {r["openalex_id"]: r for r in b.paper_table.collect()}
    assert sorted(papers) == [10, 30]
    assert papers[10]["title"] == "new title" and papers[10]["paper_id"] == 0
    assert papers[30]["source_id"] == -1
    assert [tuple(r) for r in b.citation_net.collect()] == [(1, 0)]
    assert [tuple(r) for r in b.author_table.collect()] == [(0, 1, "Ann", None)]
    topics = [tuple(r) for r in b.topics.select("paper_id", "field_id", "subfield_id", "sequence").collect()]
    assert topics == [(0, -1, -1, 0)]
    assert b.category_table.count() == 0


def test_bad_work_id_dropped_or_fails(spark, root):
    from paperweave.operators.extract import clean_works

    _snapshot(root, {"2024-01-01": {"a.gz": [_w(1), json.dumps({"id": "https://x.org/Wabc", "type": "article"})]}})
    works = scan_works(spark, root)
    assert [r["oa_id"] for r in clean_works(works).collect()] == [1]
    with pytest.raises(Exception):
        clean_works(works, on_bad="fail").collect()


def test_subfield_of_field_without_id_is_still_a_category(spark, root):
    topics = [{"field": {"display_name": "NoId"}, "subfield": {"id": "https://x.org/subfields/9", "display_name": "S9"}},
              {"field": {"id": "https://x.org/fields/4", "display_name": "F4"}, "subfield": None}]
    _snapshot(root, {"2024-01-01": {"a.gz": [_w(1, topics=topics)]}})
    b = UnfilteredBuild(scan_works(spark, root))
    cats = sorted(tuple(r) for r in b.category_table.collect())
    assert cats == [(0, "main", "F4", 4), (1, "sub", "S9", 9)]
    # the field without id has no main class, so only the second topic is assigned
    assert [tuple(r) for r in b.paper_category_table.collect()] == [(0, 0, -1, 1)]


def _records(spark, n, dates):
    """``n`` records dealt over ``dates`` in turn, in no order, with their order key."""
    from paperweave import schemas

    line = F.col("id") * 7919 % n  # 7919 is prime: every line once
    own = {"id": F.concat(F.lit("https://x.org/W"), line.cast("string")), "type": F.lit("article")}
    fields = [own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.WORK.fields]
    date = F.element_at(F.array(*[F.lit(d).cast("date") for d in dates]), (line % len(dates) + 1).cast("int"))
    rows = spark.range(n).repartition(5).select(*fields, date.alias("updated_date"), line.alias("__line"))
    key = F.struct("updated_date", F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"), F.col("__line").alias("line"))
    return rows.withColumn("order_key", key).drop("__line")


def _written(root):
    """(date, file name, ids of the lines) of every written file, by date, then name."""
    base = os.path.join(root, "data", "works")
    found = []
    for d in sorted(x for x in os.listdir(base) if x.startswith("updated_date=")):
        for name in sorted(x for x in os.listdir(os.path.join(base, d)) if x.endswith(".gz")):
            with gzip.open(os.path.join(base, d, name), "rt") as f:
                found.append((d[-10:], name, [int(json.loads(x)["id"].rsplit("W", 1)[1]) for x in f]))
    return found


def test_a_date_is_written_by_many_tasks_in_order(spark, root):
    write_works(_records(spark, 1000, ["2024-01-01", "2024-02-01"]), root, rows_per_file=30, rows_per_task=100)
    files = _written(root)
    for date, rest in (("2024-01-01", 0), ("2024-02-01", 1)):
        mine = [f for f in files if f[0] == date]
        assert [i for f in mine for i in f[2]] == [i for i in range(1000) if i % 2 == rest]
        assert [len(f[2]) for f in mine] == [30] * 16 + [20]  # stretches of 90: files stay whole
        assert len({f[1].split("-")[1] for f in mine}) == 6  # tasks
    ids = scan_works(spark, root).orderBy("order_no").select("id").collect()
    assert [int(r[0].rsplit("W", 1)[1]) for r in ids] == [*range(0, 1000, 2), *range(1, 1000, 2)]


def test_more_than_a_thousand_files_of_a_date_keep_their_order(spark, root):
    write_works(_records(spark, 1005, ["2024-01-01"]), root, rows_per_file=1)
    assert [f[2] for f in _written(root)] == [[i] for i in range(1005)]


def test_equal_order_keys_and_a_snapshot_without_records(spark, root):
    some = _records(spark, 50, ["2024-01-01"])
    write_works(some.unionByName(some), root, rows_per_file=7)
    assert sorted(i for f in _written(root) for i in f[2]) == sorted([*range(50)] * 2)
    write_works(some.limit(0), root)
    assert _written(root) == []


def test_only_keys_are_ranked_and_jobs_share_the_tasks(spark, root):
    from paperweave.session import staged_paths

    with staged_paths() as paths:
        write_works(_records(spark, 1000, ["2024-01-01", "2024-02-01"]), root, rows_per_file=30, rows_per_task=100, rows_per_job=150)
    kept = {c for p in paths for c in spark.read.parquet(p).columns}
    assert kept == {"updated_date", "order_key", "__mid"}  # no record lies on disk a second time
    files = _written(root)
    for date, rest in (("2024-01-01", 0), ("2024-02-01", 1)):
        mine = [f for f in files if f[0] == date]
        assert [i for f in mine for i in f[2]] == [i for i in range(1000) if i % 2 == rest]
        assert [len(f[2]) for f in mine] == [30] * 16 + [20]
    assert len({f[1].split("-", 2)[2].split(".")[0] for f in files}) > 1  # written by several jobs


def test_files_stay_whole_where_a_stretch_begins_with_an_equal_key(spark, root):
    some = _records(spark, 50, ["2024-01-01"])
    write_works(some.unionByName(some), root, rows_per_file=7, rows_per_task=7, rows_per_job=20)
    files = _written(root)
    assert [len(f[2]) for f in files] == [7] * 14 + [2]
    assert [i for f in files for i in f[2]] == [i // 2 for i in range(100)]


def test_a_record_finds_its_task_among_many(spark, root):
    from paperweave.sources.works import _last_at_most

    keys = spark.range(0, 300, 3).select(F.lit(None).cast("string").alias("a"), F.struct(F.col("id").alias("n"), F.lit('"').alias("t")).alias("b"))
    rows = spark.range(300).select("id", F.lit(None).cast("string").alias("a"), F.struct(F.col("id").alias("n"), F.lit('"').alias("t")).alias("b"))
    found = rows.select("id", _last_at_most(keys, F.struct("a", "b")).alias("at")).collect()
    assert all(r["at"] == r["id"] // 3 for r in found) and len(found) == 300
