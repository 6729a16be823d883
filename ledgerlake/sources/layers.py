"""The layer store: ``<root>/<layer>/<entity>/date=YYYY-MM-DD/version=<id>/part-*.parquet``.

A write puts the whole result into a new version folder, counts the rows that lie
there (from the Parquet footers) and then switches the date to it: a small manifest
(``_manifest/<date>.json``: version and rows) is written beside the old one and takes its
place in one rename. So a date always reads as one whole write, old or new:

* a job that fails before the switch leaves the old day as it was,
* where a file system replaces a file in two steps (delete, rename) and a job fails between
  them, the new manifest is found under its staged name: the day reads as new,
* re-running a date replaces that date only (an idempotent re-run),
* a result without rows is a version like any other: the day counts as written.

The version before the current one is kept for readers that have already begun;
older ones, and those of failed writes, are deleted by the next write of the date. Reads
list and scan the folder of the current version of the requested date, nothing else.
Dates written by ``ingest_new_dates`` (many dates in one job) have no versions: for them,
the files of ``date=YYYY-MM-DD`` are the day.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import DATE, with_date

VERSION = "version"
STAGED = ".staged"


def layer_path(root: str, layer: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{entity}"


def _date_lit(run_date: str) -> Column:
    return F.lit(run_date).cast("date")


def partition_path(root: str, layer: str, entity: str, run_date: str) -> str:
    return f"{layer_path(root, layer, entity)}/{DATE}={run_date}"


def _version_path(root: str, layer: str, entity: str, run_date: str, version: str) -> str:
    return f"{partition_path(root, layer, entity, run_date)}/{VERSION}={version}"


def _manifest_path(root: str, layer: str, entity: str, run_date: str) -> str:
    return f"{layer_path(root, layer, entity)}/_manifest/{run_date}.json"


# --------------------------------------------------------------------------- files

def _hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) of ``path`` through the session's Hadoop configuration.

    A path that cannot be reached (permission, network) raises; it is never
    taken for one that is not there.
    """
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist on its file system (local, HDFS, object store)?

    A metadata call through the session's Hadoop configuration: no job is
    run and no failed query is raised for a missing path.
    """
    fs, hpath = _hadoop_fs(spark, path)
    return bool(fs.exists(hpath))


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, hpath = _hadoop_fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(hpath)] if fs.exists(hpath) else []


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, hpath = _hadoop_fs(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _hadoop_fs(spark, path)
    source = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and what lies under it."""
    fs, hpath = _hadoop_fs(spark, path)
    fs.delete(hpath, True)


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename ``source`` over ``target`` in one step (readers see the one or the other)."""
    jvm = spark.sparkContext._jvm
    fs, hsource = _hadoop_fs(spark, source)
    _, htarget = _hadoop_fs(spark, target)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
    context.rename(hsource, htarget, options)


# --------------------------------------------------------------------------- manifests

@dataclass(frozen=True)
class Manifest:
    """The current version of a date: its folder name, its rows, and the version before it."""

    version: str
    rows: int
    previous: str | None = None


def read_manifest(spark: SparkSession, root: str, layer: str, entity: str, run_date: str) -> Manifest | None:
    """The manifest of ``run_date``; None if the date was not written with versions."""
    path = _manifest_path(root, layer, entity, run_date)
    if path_exists(spark, path):
        return Manifest(**json.loads(_read_text(spark, path)))
    folder, _, name = path.rpartition("/")
    for staged in _names(spark, folder):
        if staged.startswith(name) and staged.endswith(STAGED):  # its version was whole before it was written
            try:
                found = Manifest(**json.loads(_read_text(spark, f"{folder}/{staged}")))
            except ValueError:  # cut off while it was written
                continue
            if path_exists(spark, _version_path(root, layer, entity, run_date, found.version)):
                return found
    return None


def _switch(spark: SparkSession, root: str, layer: str, entity: str, run_date: str, manifest: Manifest) -> None:
    """Make ``manifest`` the current one of its date."""
    path = _manifest_path(root, layer, entity, run_date)
    staged = f"{path}.{manifest.version}{STAGED}"
    _write_text(spark, staged, json.dumps(manifest.__dict__))
    _replace(spark, staged, path)


def _clean(spark: SparkSession, root: str, layer: str, entity: str, run_date: str, manifest: Manifest) -> None:
    """Delete what neither the current nor the previous version of the date needs."""
    day = partition_path(root, layer, entity, run_date)
    keep = {f"{VERSION}={v}" for v in (manifest.version, manifest.previous)}
    for name in _names(spark, day):
        if name not in keep:
            delete_folder(spark, f"{day}/{name}")
    folder, _, name = _manifest_path(root, layer, entity, run_date).rpartition("/")
    for staged in _names(spark, folder):
        if staged.startswith(name) and staged != name:
            delete_folder(spark, f"{folder}/{staged}")


def forget_versions(spark: SparkSession, root: str, layer: str, entity: str, run_date: str) -> None:
    """The files of ``date=...`` are the day from now on (they were written without a version)."""
    path = _manifest_path(root, layer, entity, run_date)
    if path_exists(spark, path):
        delete_folder(spark, path)


# --------------------------------------------------------------------------- write and read

def write_layer_counted(
    df: DataFrame,
    root: str,
    layer: str,
    entity: str,
    run_date: str,
    sort_by: list[Column] | None = None,
    bounded: bool = False,
) -> tuple[str, int]:
    """Write ``df`` as the ``run_date`` partition of ``layer/entity``; return the dataset path and the rows.

    The rows are those of the files written, however often Spark ran a task or
    a stage for them. ``sort_by`` gives the order of the rows over the files.
    ``bounded`` marks a result whose size is fixed by a domain (one row per channel, a
    one-row summary): it is written as one file sorted locally, without the
    sampling job and range shuffle of a global sort.
    """
    spark = df.sparkSession
    old = read_manifest(spark, root, layer, entity, run_date)
    version = f"v{uuid.uuid4().hex[:12]}"
    folder = _version_path(root, layer, entity, run_date, version)
    out = df
    if bounded:
        out = out.coalesce(1)
        out = out.sortWithinPartitions(*sort_by) if sort_by else out
    elif sort_by:
        out = out.orderBy(*sort_by)
    out.write.parquet(folder)
    # No column is read: the counts of the files' footers.
    manifest = Manifest(version, spark.read.schema(df.schema).parquet(folder).count(), old.version if old else None)
    _switch(spark, root, layer, entity, run_date, manifest)
    _clean(spark, root, layer, entity, run_date, manifest)
    return layer_path(root, layer, entity), manifest.rows


def write_layer(df: DataFrame, root: str, layer: str, entity: str, run_date: str,
                sort_by: list[Column] | None = None, bounded: bool = False) -> str:
    """``write_layer_counted`` for callers that need only the dataset path."""
    return write_layer_counted(df, root, layer, entity, run_date, sort_by, bounded)[0]


def read_layer(
    spark: SparkSession,
    root: str,
    layer: str,
    entity: str,
    run_date: str,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The ``run_date`` partition of ``layer/entity``, without the partition columns."""
    manifest = read_manifest(spark, root, layer, entity, run_date)
    path, day = layer_path(root, layer, entity), partition_path(root, layer, entity, run_date)
    reader = spark.read.option("basePath", path)
    if schema is not None:
        fields = with_date(schema)
        reader = reader.schema(fields.add(VERSION, "string") if manifest else fields)
    if manifest:
        day = _version_path(root, layer, entity, run_date, manifest.version)
    elif not path_exists(spark, day):
        day = path  # no such date: no rows
    df = reader.parquet(day)
    return df.where(F.col(DATE) == _date_lit(run_date)).drop(DATE, VERSION)


def partition_exists(spark: SparkSession, root: str, layer: str, entity: str, run_date: str) -> bool:
    """Has ``run_date`` been written for ``layer/entity``?

    A day without rows has a version with an empty file, so it counts; a version
    that no manifest names (a write that failed) does not.
    """
    if read_manifest(spark, root, layer, entity, run_date) is not None:
        return True
    names = _names(spark, partition_path(root, layer, entity, run_date))
    return any(not name.startswith(f"{VERSION}=") for name in names)


def stored_dates(spark: SparkSession, root: str, layer: str, entity: str) -> DataFrame:
    """Stored partition dates of ``layer/entity`` (empty when nothing is stored).

    Read from directory listings (no data file is opened), so the cost grows with
    the number of dates, not with the data.
    """
    path = layer_path(root, layer, entity)
    prefix, suffix = f"{DATE}=", ".json"
    found = {n[: -len(suffix)] for n in _names(spark, f"{path}/_manifest") if n.endswith(suffix)}
    for name in _names(spark, path):
        value = name[len(prefix):]
        if name.startswith(prefix) and value not in found and partition_exists(spark, root, layer, entity, value):
            found.add(value)
    return spark.createDataFrame([(v,) for v in sorted(found)], f"{DATE} string").select(
        F.col(DATE).cast("date").alias(DATE))
