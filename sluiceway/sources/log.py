"""A log of versions that several writers share, each version put once; and the index of the table's files on top of it.

Versions count up without gaps. A writer that finds its version taken reads what came before it and tries again with the next. Every `SNAPSHOT_EVERY`
versions the state so far is written down, so a reader starts there and reads the versions after it only.

Index: each commit states which files it adds and which it removes, with the batch they belong to and, per file, the number of rows and the
least and greatest `event_name` and `collector_tstamp`. A file that no commit names does not exist for readers, so whatever a crash leaves behind is
invisible, and a commit takes effect as a whole.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.sources import store

# Fixed value: versions after which the state is written down again.
SNAPSHOT_EVERY = 50

METRICS = {
    "load_tstamp": "timestamp", "n_events": "long", "n_good": "long", "n_bad": "long", "n_bytes": "long",
    "earliest_collector_tstamp": "timestamp", "latency_millis": "long", "e2e_latency_millis": "long",
}
FILE = {
    "version": "long", "kind": "string", "path": "string", "load_date": "date", "n_rows": "long", "n_bytes": "long",
    "low_name": "string", "high_name": "string", "low_tstamp": "timestamp", "high_tstamp": "timestamp", "batches": "array<string>",
}
BATCH = {"version": "long", "batch_id": "string", "at": "timestamp", "metrics": f"struct<{','.join(f'{k}:{v}' for k, v in METRICS.items())}>"}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


_LINE_SCHEMA = _ddl(FILE | BATCH | {"action": "string"})

ROWS, FAILED, OVERSIZED = "rows", "failed", "oversized"


class Position(NamedTuple):
    """Newest version (-1: none), the snapshot to start from (None: the beginning) and the versions after it."""

    version: int
    snapshot: int | None
    later: tuple[int, ...]


def _name(version: int, ending: str = "json") -> str:
    return f"{version:020d}.{ending}"


def position(spark: SparkSession, folder: str) -> Position:
    found = [n.split(".") for n in store.names(spark, folder) if not n.startswith(("_", ".")) and "." in n]
    versions = sorted(int(n) for n, ending in found if ending == "json")
    snapshots = [int(n) for n, ending in found if ending == "snapshot"]
    start = max(snapshots, default=None)
    newest = max([*versions, *snapshots], default=-1)
    return Position(newest, start, tuple(v for v in versions if start is None or v > start))


def commit(spark: SparkSession, folder: str, make: Callable[[int], str | None], known: int | None = None) -> int | None:
    """Puts the text that `make(version)` gives as the next version, which is returned.

    `make` is called again with a later version if another writer was first, so it can look at what has changed; None gives up. `known` is a version that is
    known to exist and spares looking for it.
    """
    version = (position(spark, folder).version if known is None else known) + 1
    while True:
        text = make(version)
        if text is None:
            return None
        if store.put_if_absent(spark, f"{folder}/{_name(version)}", text):
            return version
        version = max(version, position(spark, folder).version) + 1


def record(spark: SparkSession, folder: str, version: int, ending: str = "json") -> str:
    return store.read_text(spark, f"{folder}/{_name(version, ending)}")


def put_snapshot(spark: SparkSession, folder: str, version: int, text: str) -> bool:
    return store.put_if_absent(spark, f"{folder}/{_name(version, 'snapshot')}", text)


def forget(spark: SparkSession, folder: str) -> None:
    """Deletes versions and snapshots that the newest snapshot stands for."""
    at = position(spark, folder).snapshot
    for name in store.names(spark, folder) if at is not None else ():
        number, _, ending = name.partition(".")
        if number.isdigit() and (int(number) < at or (int(number) == at and ending == "json")):
            store.remove(spark, f"{folder}/{name}")


# The index of files

def folder_of(root: str) -> str:
    return f"{root}/_log"


def entry(version: int, batch_id: str | None, added: list[dict], removed: list[str], metrics: dict | None = None) -> str:
    """A commit as lines of JSON: what it is, then one line for each file."""
    def plain(value):
        return value.astimezone(timezone.utc).isoformat() if isinstance(value, datetime) else str(value)

    lines = [{"version": version, "action": "commit", "batch_id": batch_id, "at": datetime.now(timezone.utc), "metrics": metrics}]
    lines += [{"version": version, "action": "add", **a} for a in added]
    lines += [{"version": version, "action": "remove", "path": p} for p in removed]
    return "\n".join(json.dumps(x, default=plain) for x in lines) + "\n"


def _lines(spark: SparkSession, folder: str, versions: tuple[int, ...]) -> DataFrame:
    if not versions:
        return spark.createDataFrame([], _LINE_SCHEMA)
    return spark.read.schema(_LINE_SCHEMA).json([f"{folder}/{_name(v)}" for v in versions])


def live_files(spark: SparkSession, root: str, at: Position | None = None) -> DataFrame:
    """The files that readers see, with their zone maps and the batches whose rows they hold."""
    folder = folder_of(root)
    at = at or position(spark, folder)
    lines = _lines(spark, folder, at.later)
    added = lines.where("action = 'add'").select(*FILE)
    if at.snapshot is not None:
        base = json.loads(record(spark, folder, at.snapshot, "snapshot"))["path"]
        added = spark.read.schema(_ddl(FILE)).parquet(f"{base}/files").unionByName(added)
    return added.join(lines.where("action = 'remove'").select("path"), "path", "left_anti")


def batches(spark: SparkSession, root: str, at: Position | None = None) -> DataFrame:
    """The newest commit of every batch, with its metrics."""
    folder = folder_of(root)
    at = at or position(spark, folder)
    found = _lines(spark, folder, at.later).where("action = 'commit' AND batch_id IS NOT NULL").select(*BATCH)
    if at.snapshot is not None:
        base = json.loads(record(spark, folder, at.snapshot, "snapshot"))["path"]
        found = spark.read.schema(_ddl(BATCH)).parquet(f"{base}/batches").unionByName(found)
    newest = found.groupBy("batch_id").agg(F.max_by(F.struct(*BATCH), "version").alias("x"))
    return newest.select("x.*")


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> int | None:
    """Writes the state down, at the newest version or the given one if nothing came after it."""
    folder = folder_of(root)
    at = position(spark, folder)
    if at.version < 0 or at.snapshot == at.version or (version is not None and at.version != version):
        return None
    base = f"{folder}/_snapshots/{at.version:020d}-{uuid.uuid4().hex}"
    live_files(spark, root, at).write.parquet(f"{base}/files")
    batches(spark, root, at).write.parquet(f"{base}/batches")
    return at.version if put_snapshot(spark, folder, at.version, json.dumps({"path": base})) else None


def matching(files: DataFrame, kind: str = ROWS, days=None, event_names=None, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """The files that may hold rows of these days, names and times; a file without values of a column has none to match."""
    found = files.where(F.col("kind") == kind)
    if days is not None:
        found = found.where(F.col("load_date").isin([F.lit(d).cast("date") for d in days]) if days else F.lit(False))
    if event_names is not None:
        within = F.lit(False)
        for name in event_names:
            within = within | ((F.col("low_name") <= name) & (F.col("high_name") >= name))
        found = found.where(within)
    if since is not None:
        found = found.where(F.col("high_tstamp") >= F.lit(since))
    if until is not None:
        found = found.where(F.col("low_tstamp") < F.lit(until))
    return found
