"""Intermediate tables in the folder that the cluster shares, and columns by their exact names."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.errors import settled
from sluiceway.sources.store import remove


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def packed(columns: Iterable[str]) -> Column:
    """The columns as one struct, so that names of an operator's own cannot clash with them."""
    return F.struct(*[col(c) for c in columns])


def where_last(frame: DataFrame, condition: Column) -> DataFrame:
    """A filter that Spark does not move below the projections that compute its columns, where it would compute them anew for each use."""
    return settled(frame.withColumn("_passes", condition)).where("_passes").drop("_passes")


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a temporary folder is made only for a session in one process, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not _one_process(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="sluiceway-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _one_process(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def importable(spark: SparkSession) -> None:
    """Sends this package to Python workers that would not find it by themselves."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    context = spark.sparkContext
    if root not in map(os.path.abspath, known) and not any(p.startswith("sluiceway-") for p in context._python_includes):
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), f"sluiceway-{os.getpid()}"), "zip", root, "sluiceway")
        context.addPyFile(archive)


def written(frame: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again: later jobs do not depend on what made them."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}.parquet"
    frame.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(frame.schema).parquet(path)
    _paths[table] = path
    return table


#: Where the tables of this process that are still held lie.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `written` gave, once all that is made from them is written itself."""
    for table in tables:
        path = _paths.pop(table, None)
        if path is not None:
            remove(table.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nobody holds any more, before the next large shuffle."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
