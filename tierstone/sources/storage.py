"""Paths: the shared working folder and the few file-system calls the jobs need."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def workspace(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a
    cluster a machine-local folder would vanish with the machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = "file:" + tempfile.mkdtemp(prefix="tierstone-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def _runs(spark: SparkSession) -> str:
    return f"{workspace(spark)}/tierstone-runs/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder for one run of a job."""
    return f"{_runs(spark)}/{label}-{uuid.uuid4().hex}"


def clear_runs(spark: SparkSession) -> bool:
    """Delete the run folders of this application, once their results are read."""
    return delete(spark, _runs(spark))


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target) and fs.delete(target, True)


def delete_if_empty(spark: SparkSession, path: str) -> bool:
    """Remove a folder without files; one that got a file meanwhile stays."""
    fs, target = _filesystem(spark, path)
    try:
        return fs.exists(target) and not fs.listStatus(target) and fs.delete(target, False)
    except Py4JJavaError:  # not empty any more
        return False


def rename(spark: SparkSession, source: str, destination: str) -> bool:
    fs, origin = _filesystem(spark, source)
    target = spark._jvm.org.apache.hadoop.fs.Path(destination)
    fs.mkdirs(target.getParent())
    return fs.rename(origin, target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``: partition folders, never data rows."""
    fs, target = _filesystem(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def modified(spark: SparkSession, path: str) -> float | None:
    """When a file or folder last changed, in seconds; None if there is none."""
    fs, target = _filesystem(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000 if fs.exists(target) else None


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, target = _filesystem(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file in full and then give it its name; False if that is taken."""
    fs, target = _filesystem(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    try:  # without the option to overwrite
        options = spark.sparkContext._gateway.new_array(rename, 0)
        context.rename(fs.makeQualified(aside), fs.makeQualified(target), options)
        return True
    except Py4JJavaError:
        fs.delete(aside, False)
        if fs.exists(target):
            return False
        raise


def stored_bytes(spark: SparkSession, paths: list[str]) -> int:
    total = 0
    for path in paths:
        fs, target = _filesystem(spark, path)
        total += fs.getContentSummary(target).getLength()
    return total


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Changes when the size, file count or date of an input changes."""
    parts = []
    for path in paths:
        fs, target = _filesystem(spark, path)
        summary = fs.getContentSummary(target)
        modified = fs.getFileStatus(target).getModificationTime()
        parts.append(f"{path}:{summary.getLength()}:{summary.getFileCount()}:{modified}")
    return hashlib.md5("|".join(parts).encode()).hexdigest()


def build_once(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Write a derived table unless a complete copy is already there.

    The copy is written aside and renamed, so a run that dies leaves nothing
    that looks complete, and a run that loses a race uses its own copy.
    """
    if exists(spark, f"{path}/_SUCCESS"):
        return path
    aside = f"{path}-{uuid.uuid4().hex}"
    write(aside)
    if not exists(spark, path) and rename(spark, aside, path):
        return path
    return aside
