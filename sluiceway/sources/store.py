"""Small files of the table's own metadata, over any file system that Spark can reach.

A record is put once or not at all: it is written under another name first and then takes its place in one step, which fails if the place is taken. On
HDFS and its like that step is a rename that replaces nothing, on local disks a hard link. A store whose rename is neither (plain object
stores) needs one that is, such as a table-aware layer, for several loaders to write at once.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files, files.makeQualified(found)


def _cause(error: Py4JJavaError) -> str:
    return error.java_exception.getClass().getSimpleName()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    files, path = _path(spark, folder)
    try:
        return sorted(s.getPath().getName() for s in files.listStatus(path))
    except Py4JJavaError as e:
        if _cause(e) == "FileNotFoundException":
            return []
        raise


def read_text(spark: SparkSession, path: str) -> str:
    files, found = _path(spark, path)
    stream = files.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Whether the text is now the whole content of `path`; False, and nothing changed, if the path was taken."""
    jvm = spark.sparkContext._jvm
    files, target = _path(spark, path)
    if files.exists(target):
        return False
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    stream = files.create(staged, False)
    try:
        jvm.org.apache.commons.io.IOUtils.write(text, stream, "UTF-8")
    finally:
        stream.close()
    try:
        if files.getScheme() == "file":
            nio = jvm.java.nio.file
            nio.Files.createLink(nio.Path.of(target.toUri()), nio.Path.of(staged.toUri()))
            files.delete(staged, False)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(staged, target, none)
    except Py4JJavaError as e:
        files.delete(staged, False)
        if _cause(e) == "FileAlreadyExistsException":
            return False
        raise
    return True


def move_into(spark: SparkSession, source: str, folder: str, prefix: str) -> dict[str, tuple[str, int]]:
    """Moves the data files of `source` into `folder` under names with `prefix`; old name to new path and bytes."""
    files, path = _path(spark, source)
    _, target = _path(spark, folder)
    files.mkdirs(target)
    moved = {}
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, f"{prefix}-{name}")
        if not files.rename(status.getPath(), to):
            raise OSError(f"{status.getPath()} could not be moved to {to}")
        moved[name] = (f"{folder}/{to.getName()}", status.getLen())
    return moved


def remove(spark: SparkSession, path: str) -> None:
    files, found = _path(spark, path)
    files.delete(found, True)


def modified(spark: SparkSession, folder: str) -> dict[str, float]:
    """Names in a folder with their time of change in seconds."""
    files, path = _path(spark, folder)
    try:
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in files.listStatus(path)}
    except Py4JJavaError as e:
        if _cause(e) == "FileNotFoundException":
            return {}
        raise
