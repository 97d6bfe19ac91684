"""Small file operations on the shared file system; data itself is read and written by Spark."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def filesystem(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = filesystem(spark, path)
    return fs.exists(target)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, without a trailing slash."""
    target, fs = filesystem(spark, path)
    return fs.makeQualified(target).toString().rstrip("/")


def content_size(spark: SparkSession, paths: list[str]) -> tuple[int, int]:
    """Total bytes and number of files below the paths, from the file system's own summary."""
    total = files = 0
    for path in paths:
        target, fs = filesystem(spark, path)
        found = [s.getPath() for s in fs.globStatus(target) or []]
        for summary in map(fs.getContentSummary, found):
            total += summary.getLength()
            files += summary.getFileCount()
    return total, files


def children(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Names below a folder, hidden ones left out, in name order."""
    target, fs = filesystem(spark, path)
    found = [s.getPath() for s in fs.listStatus(target)]
    return sorted(p.toString() for p in found if p.getName()[0] not in "._" and p.getName().endswith(suffix))


def walk(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """Path and size of every file below a folder, empty ones included, hidden ones left out."""
    target, fs = filesystem(spark, root)
    found = fs.listFiles(target, True)
    files = []
    while found.hasNext():
        status = found.next()
        if status.getPath().getName()[0] not in "._":
            files.append((status.getPath().toString(), status.getLen()))
    return sorted(files)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file completely or not at all; False when the name is already taken."""
    context = spark.sparkContext
    target, fs = filesystem(spark, path)
    part, _ = filesystem(spark, f"{path}.{uuid.uuid4().hex[:12]}.part")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    rename = context._jvm.org.apache.hadoop.fs.Options.Rename
    options = context._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    files = context._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), context._jsc.hadoopConfiguration()
    )
    try:
        files.rename(fs.makeQualified(part), fs.makeQualified(target), options)
        return True
    except Exception as error:
        fs.delete(part, False)
        if "FileAlreadyExistsException" in str(error):
            return False
        raise


def read_text(spark: SparkSession, path: str) -> str:
    target, fs = filesystem(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
