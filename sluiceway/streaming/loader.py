"""Loading batches and streams of event lines into the table."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluiceway.functions.errors import INVALID_SCHEMA, NOT_FOUND
from sluiceway.functions.sql import one_of
from sluiceway.operators.conform import conform
from sluiceway.operators.entities import entity_versions, with_style
from sluiceway.operators.failed import MAX_RECORD_BYTES, failed_events, processor, serialised
from sluiceway.operators.metrics import batch_summary, summary_columns
from sluiceway.operators.parse import parse_lines
from sluiceway.operators.registry import Resolved, match_registry, resolve_matched
from sluiceway.operators.transform import good_rows, transform_events
from sluiceway.sources import store, table
from sluiceway.sources.schemas import SchemaDirectory, SchemaVersion

class MissingSchemaError(RuntimeError):
    """A batch names schemas the registry cannot give, and the loader is set to stop on that."""


def configure(spark: SparkSession) -> None:
    """Session settings the loader relies on: UTC, and the last of duplicate JSON keys wins."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _day(moment: datetime) -> str:
    return moment.astimezone(timezone.utc).date().isoformat()


def _millis_since(moment: datetime | None, now: datetime) -> int | None:
    if moment is None:
        return None
    return int((now - moment.astimezone(timezone.utc)) / timedelta(milliseconds=1))


def load_batch(lines: DataFrame, batch_id: str, root: str, registry: DataFrame | SchemaDirectory, atomic: T.StructType, *,
               unstruct: str = "unstruct_event", contexts: tuple[str, ...] = ("contexts", "derived_contexts"),
               enveloped: bool = True, skip_schemas=(), legacy_schemas=(), legacy_mode: bool = False,
               exit_on_missing_schema: bool = True, known: table.TableState | None = None,
               resolutions: dict[tuple, Resolved] | None = None,
               max_columns: int | None = None, column_delay: timedelta = table.TOO_MANY_COLUMNS_DELAY,
               max_failed_bytes: int = MAX_RECORD_BYTES, app: tuple[str, str] = ("sluiceway", "0.1.0"),
               storage: StorageLevel | None = StorageLevel.MEMORY_AND_DISK, spread: int | None = None,
               send_failed: Callable[[DataFrame, str, str], None] | None = None, fresh: bool = False) -> table.TableState:
    """Load one batch of lines with a constant ``load_tstamp`` column and return the table state.

    Order: resolve, stop on missing schemas, evolve, write rows, send failed events, commit.
    Rows, failed events and metrics appear together with the commit, and what the batch id had before goes with it. So running it again
    replaces it even if rows change their class or the load time falls on another day, and a crash at any point leaves it as it was. ``fresh`` says that
    the batch id cannot have been committed before. ``send_failed`` takes failed events elsewhere instead; it is called before the commit, so at least once.

    ``registry`` is a compiled registry, or a directory of schemas, which is looked at again when a batch names a schema that it does not have. Either
    way the whole batch resolves against one version.

    The lines are read twice: once for the schema keys only, once for the rows. The rows are kept
    (spilling to disk) because three outputs use them; ``storage=None`` recomputes them instead.
    ``known`` and ``resolutions`` carry table and column metadata from one batch to the next.
    """
    spark = lines.sparkSession
    parsing = {"unstruct": unstruct, "contexts": contexts, "enveloped": enveloped}
    criteria = {"skip_schemas": skip_schemas, "legacy_schemas": legacy_schemas, "legacy_mode": legacy_mode}
    state = known or table.create_if_missing(spark, root, table.initial_schema(atomic, unstruct, contexts))
    sourced = "source_tstamp" in lines.columns
    parsed = parse_lines(lines, atomic, **parsing)

    versions = entity_versions(parse_lines(lines, atomic, **parsing, with_data=False))
    matched, pinned = _matched(with_style(versions, **criteria), registry, exit_on_missing_schema)
    try:
        while True:
            resolved = resolve_matched(matched, pinned.compiled, resolutions, state.owners, pinned.number)
            if exit_on_missing_schema:
                _stop_on_missing(spark, root, matched, resolved.invalid)
            state = table.evolve(spark, root, state, resolved.fields, max_columns, column_delay, owners=resolved.owners)
            if state.yields(resolved.owners):
                break
            # Another loader has given one of the columns to another schema meanwhile.
            if resolutions is not None:
                resolutions.clear()
    finally:
        matched.unpersist()

    transformed = transform_events(
        parsed, atomic, resolved, F.col("load_tstamp"), **parsing, **criteria,
        keep=("load_tstamp", "collector_tstamp", *(("source_tstamp",) if sourced else ())),
    )
    conformed = conform(transformed, state.schema)
    if storage is not None:
        conformed = conformed.persist(storage)
    try:
        _write_batch(conformed, batch_id, root, app, max_failed_bytes, sourced, spread, send_failed, fresh)
    finally:
        if storage is not None:
            conformed.unpersist()
    return state


def _matched(styled: DataFrame, registry: DataFrame | SchemaDirectory, exit_on_missing: bool) -> tuple[DataFrame, SchemaVersion]:
    """The versions of a batch, kept, with whether each is found, and the version of the registry that the whole batch uses.

    Before a stream stops on a missing schema the directory is looked at whenever the last look was.
    """
    if isinstance(registry, DataFrame):
        return match_registry(styled, registry).persist(), SchemaVersion(0, registry)
    pinned = registry.current()
    matched = match_registry(styled, pinned.compiled).persist()
    if matched.where("NOT found").isEmpty():
        return matched, pinned
    newest = registry.refresh(force=exit_on_missing)
    if newest.number == pinned.number:
        return matched, pinned
    again = match_registry(matched.drop("found"), newest.compiled).persist()
    again.count()
    matched.unpersist()
    return again, newest


def _stop_on_missing(spark: SparkSession, root: str, matched: DataFrame, invalid: tuple[str, ...]) -> None:
    """Stop if the batch names a schema that is missing or invalid. The whole list is written to the table's alerts."""
    problem = F.when(~F.col("found"), F.lit(NOT_FOUND)).when(F.expr(one_of("uri", invalid)), F.lit(INVALID_SCHEMA))
    problems = matched.select("uri", problem.alias("problem")).where("problem IS NOT NULL").distinct()
    total = problems.count()
    if total:
        at = F.lit(datetime.now(timezone.utc)).alias("at")
        cause = F.concat_ws(": ", "problem", "uri").alias("cause")
        listed = problems.select(at, F.lit("missing_schema").alias("alert"), F.array().cast("array<string>").alias("columns"), cause)
        listed.write.mode("append").json(f"{root}/alerts")
        first = problems.orderBy("uri").first()
        raise MissingSchemaError(
            f"{total} schemas cannot be resolved; add them to the registry, skip them, or load with exit_on_missing_schema=False. "
            f"All are listed in {root}/alerts, the first is {first['problem']}: {first['uri']}"
        )


def _write_batch(conformed: DataFrame, batch_id: str, root: str, app: tuple[str, str], max_failed_bytes: int,
                 sourced: bool, spread: int | None, send_failed, fresh: bool) -> None:
    """Write and commit a batch. Its measures are observed while the good rows are written, so they cost no job of their own.

    With ``spread`` they do: tasks before a shuffle may run again, and the bounds of its ranges are sampled in a job before, so what is observed there may count twice.
    """
    spark, attempt, began = conformed.sparkSession, table.begin(), datetime.now(timezone.utc)
    moment = F.col("source_tstamp") if sourced else F.lit(None).cast("timestamp")
    extra = [F.max(moment).alias("newest"), F.min("load_tstamp").alias("load_tstamp")]
    if spread is None:
        observation = Observation()
        rows = conformed.observe(observation, *summary_columns(extra))
        found = lambda: observation.get
    else:
        rows, summary = conformed, batch_summary(conformed, extra=extra).first().asDict()
        found = lambda: summary

    def day() -> str | None:
        return _day(found()["load_tstamp"]) if found()["n_good"] > 0 else None

    added = table.put_rows(good_rows(rows), root, day, batch_id, attempt, spread=spread)
    measures = found()
    if measures["n_events"] == 0:
        table.commit_batch(spark, root, batch_id, [], None, fresh)
        return
    if measures["n_bad"] > 0:
        failed = serialised(failed_events(conformed, processor(*app)), max_failed_bytes)
        if send_failed is None:
            added += table.put_failed(failed, root, _day(measures["load_tstamp"]), batch_id, attempt)
        else:
            send_failed(failed, root, batch_id)
    now = datetime.now(timezone.utc)
    latencies = {"latency_millis": _millis_since(measures["newest"], began), "e2e_latency_millis": _millis_since(measures["earliest_collector_tstamp"], now)}
    metrics = {k: v for k, v in measures.items() if k != "newest"} | latencies
    table.commit_batch(spark, root, batch_id, added, metrics, fresh)


def load_lines(lines: DataFrame, batch_id: str, root: str, registry: DataFrame | SchemaDirectory, atomic: T.StructType,
               load_tstamp: datetime, **options) -> table.TableState:
    """Backfill: load a DataFrame of lines as one batch with the given load time."""
    configure(lines.sparkSession)
    return load_batch(lines.withColumn("load_tstamp", F.lit(load_tstamp)), batch_id, root, registry, atomic, **options)


def run_stream(lines: DataFrame, root: str, registry: DataFrame | SchemaDirectory, atomic: T.StructType, checkpoint: str, *,
               loader: str = "main", trigger: dict | None = None, **options) -> StreamingQuery:
    """Load a stream of lines in micro-batches.

    The load time is the time Spark records for the micro-batch in its offset log, so a batch that
    runs again after a crash keeps its load time and replaces its own files. Offsets are committed
    only after a batch has been fully handled. A batch is named by ``loader``, the id that Spark keeps for the query in its checkpoint, and its number, so streams
    with other checkpoints never take each other's batches for their own.
    """
    spark = lines.sparkSession
    configure(spark)
    state = {"known": table.create_if_missing(spark, root, table.initial_schema(
        atomic, options.get("unstruct", "unstruct_event"), options.get("contexts", ("contexts", "derived_contexts"))
    ))}
    resolutions: dict[tuple, Resolved] = {}
    stamped = lines.withColumn("load_tstamp", F.current_timestamp())

    def load(batch: DataFrame, number: int) -> None:
        if "query" not in state:
            state["query"] = json.loads(store.read_text(spark, f"{checkpoint}/metadata"))["id"]
        # Only the first batch of a run may be one that a run before has committed already.
        state["known"] = load_batch(
            batch, f"{loader}-{state['query']}-{number}", root, registry, atomic, known=state["known"],
            resolutions=resolutions, fresh=state.get("started", False), **options
        )
        state["started"] = True

    return (
        stamped.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
