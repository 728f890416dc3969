"""A directory of JSON Schemas that grows while loaders run, and the versions of its compiled form.

Layout below ``root``: ``_versions`` is a log whose records each name a folder; ``<folder>/schemas`` holds the compiled schemas as of that version and
``<folder>/files`` the schema files they were read from, with their time of change and size. A version never changes once its record is put. So all tasks
of a batch resolve against the same schemas whatever is added meanwhile, and loaders that share ``root`` share the work.

A refresh lists the directory and compiles only files that are new or have changed since the last version; all other rows are copied. A file that is
gone leaves its schema in place, as events of it may still come. A file whose name is no schema key is remembered and not read again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.registry import compiled_schemas, registry_from_directory
from sluiceway.sources import log

# Fixed value: the least time between two looks for schemas that were not there the last time.
LOOK_AGAIN = timedelta(seconds=60)

FILE_KEY = ("source", "modified", "n_bytes")


class SchemaVersion(NamedTuple):
    """A compiled registry and its number."""

    number: int
    compiled: DataFrame


class SchemaDirectory:
    """The schemas below ``path``; compiled versions are kept in ``root``, a folder that all loaders share."""

    def __init__(self, spark: SparkSession, path: str, root: str, every: timedelta = LOOK_AGAIN, clock: Callable[[], float] = time.monotonic):
        self.spark, self.path, self.root = spark, path, root
        self.every, self.clock = every.total_seconds(), clock
        self._looked: float | None = None
        self._version: SchemaVersion | None = None

    @property
    def _log(self) -> str:
        return f"{self.root}/_versions"

    def _folder(self, number: int) -> str:
        return f"{self.root}/{json.loads(log.record(self.spark, self._log, number))['folder']}"

    def version(self, number: int) -> SchemaVersion:
        """A version as it was put."""
        return SchemaVersion(number, self.spark.read.parquet(f"{self._folder(number)}/schemas"))

    def current(self) -> SchemaVersion:
        """The version this loader uses; the newest one, or the first, if it has used none yet."""
        if self._version is None:
            newest = log.position(self.spark, self._log).version
            self._version = self.version(newest) if newest >= 0 else self.refresh(force=True)
        return self._version

    def refresh(self, force: bool = False) -> SchemaVersion:
        """The newest version, after a look at the directory; without ``force`` at most one look in ``every``.

        A version that another loader has put meanwhile is taken over, and only what it lacks is compiled.
        """
        now = self.clock()
        if not force and self._looked is not None and now - self._looked < self.every:
            return self.current()
        put = log.commit(self.spark, self._log, self._next)
        self._looked = now
        newest = log.position(self.spark, self._log).version if put is None else put
        if self._version is None or self._version.number != newest:
            self._version = self.version(newest)
        return self._version

    def _listed(self) -> DataFrame:
        """All files below the directory. Their content is not read, as the column is pruned."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.path)
        return files.select(F.col("path").alias("source"), F.col("modificationTime").alias("modified"), F.col("length").alias("n_bytes"))

    def _next(self, number: int) -> str | None:
        """Writes the version after the newest one and gives its record; None if nothing has changed."""
        folder = f"{self.root}/v{number}-{uuid.uuid4().hex}"
        listed = self._listed()
        if number == 0:
            listed.write.parquet(f"{folder}/files")
            self._compile(registry_from_directory(self.spark, self.path), f"{folder}/schemas")
        else:
            before = self._folder(number - 1)
            known = self.spark.read.parquet(f"{before}/files")
            fresh = listed.join(known, list(FILE_KEY), "left_anti")
            # The names of schema files are metadata, like the schemas themselves, which grow with the events' variety and not with their number.
            changed = [r["source"] for r in fresh.select("source").collect()]
            if not changed:
                return None
            # Times of change are taken before the content: a file that changes in between is compiled again the next time.
            kept = known.join(fresh.select("source"), "source", "left_anti").select(*FILE_KEY)
            kept.unionByName(fresh).write.parquet(f"{folder}/files")
            self._compile(registry_from_directory(self.spark, changed), f"{folder}/schemas", self.spark.read.parquet(f"{before}/schemas"))
        return json.dumps({"version": number, "folder": folder.rsplit("/", 1)[1]}) + "\n"

    def _compile(self, docs: DataFrame, target: str, before: DataFrame | None = None) -> None:
        levels: list[DataFrame] = []
        compiled = compiled_schemas(docs, levels)
        try:
            if before is not None:
                compiled = compiled.persist()
                levels.append(compiled)
                others = before.join(compiled.select("uri"), "uri", "left_anti").select(*compiled.columns)
                compiled = others.unionByName(compiled)
            compiled.write.parquet(target)
        finally:
            for level in levels:
                level.unpersist()
