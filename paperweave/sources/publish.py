"""Publishing a dataset folder as a whole, and checking that a folder is a published one.

A dataset is written beside its target (``<target>.building-<id>``), gets a marker file that lists its tables and is
then renamed into place; the folder that it replaces is renamed aside first and deleted last. So a
run that fails while writing leaves the old dataset untouched, readers never see a half-written one, and a run that ends
between the two renames leaves the old folder complete beside the target, from where the next reader or writer puts it
back. Renames are metadata operations on a file system; object stores without an atomic rename should get a
file system with one (or a table format) under ``--out``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

MARKER = "_PUBLISHED.json"
_BUILDING, _REPLACED = ".building-", ".replaced-"


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _fs(spark, old)
    if not fs.rename(p, _fs(spark, new)[1]):
        raise OSError(f"cannot rename {old} to {new}")


def folder_bytes(spark: SparkSession, path: str) -> list[int]:
    """[files, bytes] below a folder."""
    fs, p = _fs(spark, path)
    summary = fs.getContentSummary(p)
    return [summary.getFileCount(), summary.getLength()]


def building_folder(target: str) -> str:
    """A new folder beside ``target`` for a dataset that is being written."""
    return f"{target.rstrip('/')}{_BUILDING}{uuid.uuid4().hex[:12]}"


def _beside(spark: SparkSession, target: str, infix: str) -> list[str]:
    fs, p = _fs(spark, target)
    parent = p.getParent()
    if not fs.exists(parent):
        return []
    names = [st.getPath() for st in fs.listStatus(parent)]
    return sorted(str(q.toString()) for q in names if q.getName().startswith(p.getName() + infix))


def recover(spark: SparkSession, target: str) -> None:
    """Put a replaced dataset back where a run ended before the new one took its place."""
    target = target.rstrip("/")
    if not exists(spark, target):
        whole = [old for old in _beside(spark, target, _REPLACED) if exists(spark, f"{old}/{MARKER}")]
        if whole:
            _rename(spark, whole[-1], target)


def publish(spark: SparkSession, building: str, target: str, tables: list[str], notes: dict | None = None) -> None:
    """Make ``building`` the dataset at ``target``. Every listed table must be there."""
    target = target.rstrip("/")
    lacking = [t for t in tables if not exists(spark, f"{building}/{t}")]
    if lacking:
        raise RuntimeError(f"not published: {building} lacks {', '.join(lacking)}")
    fs, marker = _fs(spark, f"{building}/{MARKER}")
    out = fs.create(marker, True)
    out.write(bytearray(json.dumps({"tables": sorted(tables), **(notes or {})}, sort_keys=True).encode()))
    out.close()
    recover(spark, target)
    aside = f"{target}{_REPLACED}{uuid.uuid4().hex[:12]}"
    if exists(spark, target):
        _rename(spark, target, aside)
    _rename(spark, building, target)
    for old in _beside(spark, target, _REPLACED):
        delete(spark, old)


def published(spark: SparkSession, target: str) -> dict:
    """The marker of the dataset at ``target``; fails where no whole dataset is published there."""
    target = target.rstrip("/")
    recover(spark, target)
    if not exists(spark, f"{target}/{MARKER}"):
        raise RuntimeError(f"no published dataset at {target}: it holds no {MARKER}")
    fs, marker = _fs(spark, f"{target}/{MARKER}")
    stream = fs.open(marker)
    found = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    lacking = [t for t in found["tables"] if not exists(spark, f"{target}/{t}")]
    if lacking:
        raise RuntimeError(f"the dataset at {target} lacks {', '.join(lacking)}")
    return found
