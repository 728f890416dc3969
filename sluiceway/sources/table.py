"""The event table: Parquet files by load day, a log of commits that names them, and a log of its schema.

Layout below ``root``: ``events/load_date=<day>/<attempt>-part-...`` holds rows, ``failed`` failed events and ``failed_oversized`` whole payloads above a size
cap, by load day as well; ``_log`` the commits, ``schema_log`` the changes of the schema, ``alerts`` setup failures. Every attempt to load a batch writes
its files beside those that are there and then commits them in one step, which also takes back what earlier attempts of the batch had committed.
Readers take files from the log alone, so they see a batch as it was before or as it is after, whatever crashes in between.

The table schema is the merge of all records of its log in order. Changes only add fields or relax them, and each takes the next free version, so two
loaders that evolve the table at once both keep their columns; old files read with the newer schema give nulls for what they lack. A record also says which
schema each new column belongs to, so a column never takes values of another schema whose name becomes the same.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import datetime, timedelta, timezone
from types import MappingProxyType
from typing import NamedTuple

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.operators.fields import changes, column_count, fields_to_alter, merge_columns, table_field
from sluiceway.sources import log, store

# Fixed value: with a cap on columns, the wait before trying to add more.
TOO_MANY_COLUMNS_DELAY = timedelta(seconds=300)

OVERSIZED_SCHEMA = "key string, kind string, errors array<struct<error:string,schema_key:string,value:string,expected:string>>, payload string"
ALERT_SCHEMA = "at timestamp, alert string, columns array<string>, cause string"
# Bytes that compaction aims at for a file, and how long files that nobody names any more are kept.
COMPACTED_BYTES = 128 << 20
RETENTION = timedelta(days=7)
PARTITIONS = T.StructType([
    T.StructField("batch_id", T.StringType()), T.StructField("load_date", T.DateType()),
])


class TableState(NamedTuple):
    schema: T.StructType
    version: int
    disabled_until: datetime | None = None
    owners: Mapping[str, str] = MappingProxyType({})

    def yields(self, owners: Mapping[str, str]) -> bool:
        """Whether none of these columns belongs to another schema already."""
        return all(self.owners.get(column, owner) == owner for column, owner in owners.items())


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _utc(moment: datetime | None) -> datetime | None:
    # Collected timestamps are naive in the local zone of the Python process.
    return None if moment is None else moment.astimezone(timezone.utc)


def one_row(spark: SparkSession, values: dict, schema: str) -> DataFrame:
    """A record as a DataFrame of one row in one partition, made without Python workers."""
    fields = T.StructType.fromDDL(schema).fields
    return spark.range(1, numPartitions=1).select(*[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in fields])


def initial_schema(atomic: T.StructType, unstruct: str = "unstruct_event",
                   contexts: tuple[str, ...] = ("contexts", "derived_contexts")) -> T.StructType:
    """Table schema before any entity was seen: atomic fields without entity JSON, and the load time."""
    fields = [table_field(f) for f in atomic.fields if f.name != unstruct and f.name not in contexts]
    return T.StructType(fields + [T.StructField("load_tstamp", T.TimestampType(), True)])


def _schema_log(root: str) -> str:
    return f"{root}/schema_log"


def _shown(moment: datetime | None) -> str | None:
    return None if moment is None else moment.astimezone(timezone.utc).isoformat()


def _read_moment(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def load_state(spark: SparkSession, root: str) -> TableState | None:
    """Schema of the table as of now, or None if there is no table. Reads the newest snapshot and the few records after it."""
    folder = _schema_log(root)
    at = log.position(spark, folder)
    if at.version < 0:
        return None
    state = TableState(T.StructType([]), -1)
    if at.snapshot is not None:
        known = json.loads(log.record(spark, folder, at.snapshot, "snapshot"))
        state = TableState(T.StructType.fromJson(known["schema"]), at.snapshot, _read_moment(known["disabled_until"]), known.get("owners", {}))
    for version in at.later:
        change = json.loads(log.record(spark, folder, version))
        merged = merge_columns(state.schema, T.StructType.fromJson(change["fields"]).fields)
        state = TableState(merged, version, _read_moment(change["disabled_until"]), {**state.owners, **change.get("owners", {})})
    return state


def _schema_record(version: int, fields: list[T.StructField], disabled_until: datetime | None, at: datetime, owners: Mapping[str, str] | None = None) -> str:
    named = {"owners": dict(owners)} if owners else {}
    return json.dumps({"version": version, "at": _shown(at), "fields": T.StructType(fields).jsonValue(), "disabled_until": _shown(disabled_until), **named}) + "\n"


def _schema_snapshot(spark: SparkSession, root: str, state: TableState) -> None:
    if state.version and state.version % log.SNAPSHOT_EVERY == 0:
        known = {"schema": state.schema.jsonValue(), "disabled_until": _shown(state.disabled_until), "owners": dict(state.owners)}
        log.put_snapshot(spark, _schema_log(root), state.version, json.dumps(known))


def create_if_missing(spark: SparkSession, root: str, schema: T.StructType, now: datetime | None = None) -> TableState:
    """Create the table unless it exists.

    A table created by another loader meanwhile is fine, and if looking it up fails, creating it is
    still tried: the first version of the schema log can be put only once.
    """
    try:
        known = load_state(spark, root)
    except (PySparkException, Py4JError) as e:
        _setup_alert(spark, root, "failed_to_get_table", [], e, now)
        known = None
    if known is not None:
        return known
    try:
        log.commit(spark, _schema_log(root), lambda version: None if version else _schema_record(0, schema.fields, None, now or _now()), known=-1)
        return load_state(spark, root)
    except (PySparkException, Py4JError) as e:
        _setup_alert(spark, root, "failed_to_create_events_table", schema.fieldNames(), e, now)
        raise


def raise_alert(spark: SparkSession, root: str, alert: str, columns: Iterable[str], cause: str, at: datetime) -> None:
    row = {"at": at, "alert": alert, "columns": list(columns), "cause": cause}
    one_row(spark, row, ALERT_SCHEMA).write.mode("append").json(f"{root}/alerts")


def _setup_alert(spark: SparkSession, root: str, alert: str, columns: Iterable[str], cause: Exception, now: datetime | None) -> None:
    """An alert about a folder that may not take alerts either; the cause itself must not be hidden by that."""
    try:
        raise_alert(spark, root, alert, columns, str(cause), now or _now())
    except (PySparkException, Py4JError) as e:
        cause.add_note(f"{alert} could not be written: {e}")


def evolve(spark: SparkSession, root: str, known: TableState, batch: list[T.StructField],
           max_columns: int | None = None, delay: timedelta = TOO_MANY_COLUMNS_DELAY,
           now: datetime | None = None, owners: Mapping[str, str] | None = None) -> TableState:
    """Add what a batch needs to the table schema.

    ``owners`` are the schemas that the columns of the batch belong to. If another loader has given one of the columns to another schema, nothing is
    changed and the state returned no longer ``yields`` to them: the batch has to find other names.

    ``known`` is the schema the loader last saw; the log is read again only when something has to
    change. There is no cap on columns unless the caller sets one. Above it nothing is added, an alert is written, and further attempts wait for
    ``delay``; rows that need the columns fail until then. If another loader changes the schema first, the change is worked out again on top of that.
    """
    now = now or _now()

    def paused(state: TableState) -> bool:
        return max_columns is not None and state.disabled_until is not None and now < state.disabled_until

    owners = owners or {}
    if not (fields_to_alter(known.schema, batch) or owners.keys() - known.owners.keys()) or paused(known):
        return known
    found: dict[str, TableState | str | list] = {}

    def change(version: int) -> str | None:
        latest = load_state(spark, root) or known
        wanted = changes(latest.schema, batch)
        found.clear()
        found["state"] = latest
        claimed = {c: o for c, o in owners.items() if c not in latest.owners}
        if not (wanted or claimed) or paused(latest) or not latest.yields(owners):
            return None
        merged = merge_columns(latest.schema, wanted)
        count = column_count(merged)
        if max_columns is not None and count > max_columns:
            found["cause"] = f"too many total leaf fields: {count}, allowed: {max_columns}"
            found["names"] = [f.name for f in wanted]
            found["state"] = TableState(latest.schema, version, now + delay, latest.owners)
            return _schema_record(version, [], now + delay, now)
        found["state"] = TableState(merged, version, None, {**latest.owners, **claimed})
        return _schema_record(version, wanted, None, now, claimed)

    if log.commit(spark, _schema_log(root), change) is not None:
        _schema_snapshot(spark, root, found["state"])
        if "cause" in found:
            raise_alert(spark, root, "failed_to_add_columns", found["names"], found["cause"], now)
    return found["state"]


# Files of a batch

def begin() -> str:
    """Name of a new attempt to load a batch."""
    return uuid.uuid4().hex


def _zones(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows and zone maps of each Parquet file in a folder; reads two columns only."""
    kinds = {f.name: f.dataType for f in schema.fields}
    read = spark.read.schema(schema).parquet(path)
    name = F.col("event_name") if isinstance(kinds.get("event_name"), T.StringType) else F.lit(None).cast("string")
    moment = F.col("collector_tstamp") if isinstance(kinds.get("collector_tstamp"), T.TimestampType) else F.lit(None).cast("timestamp")
    return read.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("n_rows"), F.min(name).alias("low_name"), F.max(name).alias("high_name"),
        # As text, so that neither the driver's time zone nor its clock takes part.
        *[F.date_format(F.to_utc_timestamp(f(moment), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(n) for f, n in ((F.min, "low_tstamp"), (F.max, "high_tstamp"))])


def _settle(spark: SparkSession, root: str, attempt: str, kind: str, load_date: str, batches: list[str], schema: T.StructType | None) -> list[dict]:
    """Moves what an attempt has written to its place and describes the files."""
    staged = f"{root}/_staging/{attempt}/{kind}"
    zones = {} if schema is None else {r["file"]: r.asDict() for r in _zones(spark, staged, schema).collect()}
    below = f"{_FOLDERS[kind]}/load_date={load_date}"
    moved = store.move_into(spark, staged, f"{root}/{below}", attempt)
    store.remove(spark, staged)
    out = []
    for name, (path, size) in moved.items():
        if schema is not None and name not in zones:  # written by a task without rows
            store.remove(spark, path)
            continue
        zone = {k: v for k, v in zones.get(name, {}).items() if k != "file"}
        out.append({"kind": kind, "path": f"{below}/{path.rsplit('/', 1)[1]}", "load_date": load_date, "n_bytes": size, "batches": batches, **zone})
    return out


_FOLDERS = {log.ROWS: "events", log.FAILED: "failed", log.OVERSIZED: "failed_oversized"}


def put_rows(rows: DataFrame, root: str, load_date: str | Callable[[], str | None], batch_id: str, attempt: str, cluster_by: str | None = "event_name",
             spread: int | None = None) -> list[dict]:
    """Write the good rows of one batch for a commit.

    A ``load_date`` that is only known from the rows themselves may be a function: it is called once they are written, and gives None if there were none.

    A batch has one load time, so no dynamic partitioning is needed. Rows are
    sorted inside each task, which gives files and row groups narrow ``event_name`` ranges without a shuffle.
    With ``spread`` the rows are range-partitioned first into that many files; a hash of the row as
    second key splits an event name that holds a large share of the rows.
    """
    if cluster_by is not None and cluster_by in rows.columns:
        if spread is not None:
            scalars = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType))]
            rows = rows.repartitionByRange(spread, F.col(cluster_by), F.xxhash64(*scalars))
        rows = rows.sortWithinPartitions(cluster_by)
    rows = rows.withColumn("batch_id", F.lit(batch_id))
    staged = f"{root}/_staging/{attempt}/{log.ROWS}"
    rows.write.mode("overwrite").parquet(staged)
    day = load_date() if callable(load_date) else load_date
    if day is None:
        store.remove(rows.sparkSession, staged)
        return []
    return _settle(rows.sparkSession, root, attempt, log.ROWS, day, [batch_id], rows.schema)


def put_failed(serialised: DataFrame, root: str, load_date: str, batch_id: str, attempt: str) -> list[dict]:
    """The records as text, and whole events above the size cap beside them, for a commit."""
    spark, added = serialised.sparkSession, []
    over = serialised.where("oversized IS NOT NULL").select("oversized.*")
    if not over.isEmpty():
        over.write.mode("overwrite").parquet(f"{root}/_staging/{attempt}/{log.OVERSIZED}")
        added += _settle(spark, root, attempt, log.OVERSIZED, load_date, [batch_id], over.schema)
    serialised.select("value").write.mode("overwrite").text(f"{root}/_staging/{attempt}/{log.FAILED}")
    return added + _settle(spark, root, attempt, log.FAILED, load_date, [batch_id], None)


def commit_batch(spark: SparkSession, root: str, batch_id: str, added: list[dict], metrics: dict | None, fresh: bool = False) -> int | None:
    """Make the files of an attempt the batch's only ones.

    What earlier attempts of the batch had committed is taken back in the same step, on whatever day it lies. Rows that have been compacted with those of other
    batches are left out of new copies of these files. ``fresh`` says that the batch cannot have been committed before, which spares looking.
    An attempt without any files commits nothing unless it replaces one.
    """
    def make(version: int) -> str | None:
        more, removed = [], []
        if not fresh:
            at = log.position(spark, log.folder_of(root))
            held = log.live_files(spark, root, at).where(F.array_contains("batches", batch_id)).select("kind", "path", "load_date", "batches")
            old = held.collect() if at.version >= 0 else []
            removed = [r["path"] for r in old]
            for (kind, day) in sorted({(r["kind"], r["load_date"]) for r in old if len(r["batches"]) > 1}):
                mixed = [r for r in old if (r["kind"], r["load_date"]) == (kind, day) and len(r["batches"]) > 1]
                more += _without(spark, root, kind, day.isoformat(), mixed, batch_id)
        if not (added or removed or metrics):
            return None
        return log.entry(version, batch_id, added + more, removed, metrics)

    version = log.commit(spark, log.folder_of(root), make)
    if version and version % log.SNAPSHOT_EVERY == 0:
        log.snapshot(spark, root, version)
    return version


def _without(spark: SparkSession, root: str, kind: str, day: str, files: list, batch_id: str) -> list[dict]:
    """Copies of compacted files of a day without the rows of a batch."""
    attempt, rest = begin(), sorted({b for r in files for b in r["batches"]} - {batch_id})
    kept = _read_rows(spark, root, [r["path"] for r in files]).where(F.col("batch_id") != batch_id).drop("load_date")
    kept.write.mode("overwrite").parquet(f"{root}/_staging/{attempt}/{kind}")
    return _settle(spark, root, attempt, kind, day, rest, kept.schema)


def compact(spark: SparkSession, root: str, day: str, target_bytes: int = COMPACTED_BYTES, cluster_by: str = "event_name") -> int | None:
    """Join the small files of a day into few, each with a narrow range of event names; the version of the commit, None if there was nothing to do.

    The new files take the place of the old ones in one commit. If one of these has gone meanwhile, as its batch was loaded again, nothing changes.
    """
    files = log.matching(log.live_files(spark, root), days=[day]).where(F.col("n_bytes") < target_bytes).select("path", "n_bytes", "batches").collect()
    if len(files) < 2:
        return None
    paths, attempt = [r["path"] for r in files], begin()
    count = max(1, math.ceil(sum(r["n_bytes"] for r in files) / target_bytes))
    rows = _read_rows(spark, root, paths).drop("load_date")
    if cluster_by in rows.columns:
        keys = [F.col(cluster_by), *([F.col("collector_tstamp")] if "collector_tstamp" in rows.columns else [])]
        rows = rows.repartitionByRange(count, *keys, F.xxhash64("batch_id")).sortWithinPartitions(*keys)
    rows.write.mode("overwrite").parquet(f"{root}/_staging/{attempt}/{log.ROWS}")
    added = _settle(spark, root, attempt, log.ROWS, day, sorted({b for r in files for b in r["batches"]}), rows.schema)

    def make(version: int) -> str | None:
        live = log.live_files(spark, root).where(F.col("load_date") == F.lit(day).cast("date")).select("path").collect()
        return log.entry(version, None, added, paths) if set(paths) <= {r["path"] for r in live} else None

    return log.commit(spark, log.folder_of(root), make)


def vacuum(spark: SparkSession, root: str, days: Iterable[str], older_than: timedelta = RETENTION) -> int:
    """Delete files of these days that no commit names any more, and staged ones, once they are old enough for no reader and no loader to need them."""
    limit, deleted = time.time() - older_than.total_seconds(), 0
    live = log.live_files(spark, root)
    for day in days:
        named = {r["path"] for r in live.where(F.col("load_date") == F.lit(day).cast("date")).select("path").collect()}
        for folder in _FOLDERS.values():
            below = f"{folder}/load_date={day}"
            for name, changed in store.modified(spark, f"{root}/{below}").items():
                if f"{below}/{name}" not in named and changed <= limit:
                    store.remove(spark, f"{root}/{below}/{name}")
                    deleted += 1
    for name, changed in store.modified(spark, f"{root}/_staging").items():
        if changed <= limit:
            store.remove(spark, f"{root}/_staging/{name}")
    return deleted


def nullable(dtype: T.DataType) -> T.DataType:
    """Read schema of a stored type: Parquet columns all read as nullable."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True, f.metadata) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(nullable(dtype.elementType), True)
    return dtype


def _read_schema(spark: SparkSession, root: str) -> T.StructType:
    return T.StructType(nullable(load_state(spark, root).schema).fields + PARTITIONS.fields)


def _read_rows(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    schema = _read_schema(spark, root)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/events").parquet(*[f"{root}/{p}" for p in paths])


def read_table(spark: SparkSession, root: str, days: Iterable[str] | None = None, event_names: Iterable[str] | None = None,
               since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """The table under its current schema, as the newest commit has it.

    With ``days`` (ISO dates), ``event_names`` or a span of ``collector_tstamp`` only files are read that may hold such rows by their
    zone maps; nothing is listed. Filters on ``load_date`` of the result prune files as well.
    """
    days, event_names = (None if x is None else list(x) for x in (days, event_names))
    files = log.matching(log.live_files(spark, root), log.ROWS, days, event_names, since, until)
    rows = _read_rows(spark, root, [r["path"] for r in files.select("path").collect()])
    if event_names is not None:
        rows = rows.where(F.col("event_name").isin(event_names))
    if since is not None:
        rows = rows.where(F.col("collector_tstamp") >= F.lit(since))
    return rows if until is None else rows.where(F.col("collector_tstamp") < F.lit(until))


def _paths(spark: SparkSession, root: str, kind: str) -> list[str]:
    return [f"{root}/{r['path']}" for r in log.matching(log.live_files(spark, root), kind).select("path").collect()]


def read_failed(spark: SparkSession, root: str) -> DataFrame:
    paths = _paths(spark, root, log.FAILED)
    return spark.read.text(paths) if paths else spark.createDataFrame([], "value string")


def read_oversized(spark: SparkSession, root: str) -> DataFrame:
    paths = _paths(spark, root, log.OVERSIZED)
    return spark.read.schema(OVERSIZED_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], OVERSIZED_SCHEMA)


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The metrics of every batch, from its newest commit."""
    return log.batches(spark, root).where("metrics IS NOT NULL").select("batch_id", "metrics.*")
