"""The query catalogue: one query per operator, over the whole of the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions import errors as E
from sluiceway.functions.casting import LEGACY as LEGACY_STYLE
from sluiceway.functions.casting import V2, cast_errors, cast_ok, cast_value, compacted, json_text_type, members_of, narrowed
from sluiceway.functions.keys import column_name, key_columns, legacy_column_name
from sluiceway.operators.conform import conform
from sluiceway.operators.entities import entity_occurrences, entity_versions, with_style
from sluiceway.operators.failed import failed_events, processor, serialised
from sluiceway.operators.fields import fields_to_alter, flat_paths, has_fields, legacy_type, merge_columns
from sluiceway.operators.metrics import (
    METRIC_BAD, METRIC_E2E_LATENCY, METRIC_GOOD, METRIC_LATENCY, NEWEST_SOURCE, batch_summary, every_period, latency_millis, per_period, unhealthy,
)
from sluiceway.operators.parse import bad_lines, good_events, parse_lines, payload_text
from sluiceway.operators.registry import Resolved, match_registry, resolve, unresolved
from sluiceway.operators.transform import failures, good_rows, transform_events
from sluiceway.plans import fixtures as X
from sluiceway.sources import log
from sluiceway.sources.lines import since, text_stream
from sluiceway.sources.schemas import SchemaDirectory
from sluiceway.sources.table import ALERT_SCHEMA, compact, initial_schema, read_failed, read_metrics, read_table
from sluiceway.streaming.loader import configure, load_lines, run_stream

# Fixed values of the queries: moments that would otherwise come from the clock, and size caps.
LOAD_TSTAMP = datetime(2024, 2, 1, tzinfo=timezone.utc)
SECOND_LOAD = datetime(2024, 2, 2, 12, 30, tzinfo=timezone.utc)
START = datetime(2024, 1, 10, 6, 0, tzinfo=timezone.utc)
STAMP = ("sluiceway", "0.1.0")
SMALL_CAP = 380
FEW_COLUMNS = 8
FIRST_TYPES = ("click", "error", "purchase")

_registries: dict[tuple, DataFrame] = {}


def _registry(spark: SparkSession, build: Callable[[SparkSession], DataFrame] = X.acme_registry) -> DataFrame:
    """A compiled registry, built once per application like the loader does."""
    key = (spark.sparkContext.applicationId, build.__name__)
    if key not in _registries:
        _registries[key] = build(spark)
    return _registries[key]


def scratch(spark: SparkSession) -> str:
    """A new folder for a table, in the folder that the cluster shares; a session in one process may use its warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/sluiceway-{uuid.uuid4().hex}"


def _parsed(spark: SparkSession, sf_dir: str, with_data: bool = True) -> DataFrame:
    configure(spark)
    return parse_lines(X.enriched_lines(spark, sf_dir), X.ATOMIC, **X.LAYOUT, with_data=with_data)


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_versions(_parsed(spark, sf_dir, with_data=False))


def _resolved(keys: DataFrame, registry: DataFrame, **criteria) -> Resolved:
    versions = entity_versions(keys).persist()
    try:
        return resolve(versions, registry, **criteria)
    finally:
        versions.unpersist()


def _transformed(spark: SparkSession, sf_dir: str, registry: DataFrame | None = None, **criteria) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    keys = _parsed(spark, sf_dir, with_data=False)
    resolved = _resolved(keys, registry or _registry(spark), **criteria)
    return transform_events(parsed, X.ATOMIC, resolved, F.lit(LOAD_TSTAMP), **X.LAYOUT, **criteria,
                            keep=("event_id", "collector_tstamp"))


# Parsing

def parse_good_bad(spark, sf_dir):
    status = F.when(F.size("parse_errors") == 0, "good").otherwise("bad").alias("status")
    return _parsed(spark, sf_dir, with_data=False).groupBy(status).agg(F.count("*").alias("n_events"))


def parse_failures(spark, sf_dir):
    error = F.get("parse_errors", F.lit(0))
    return bad_lines(_parsed(spark, sf_dir, with_data=False)).select(
        "payload", error["error"].alias("error"), error["value"].alias("found"), error["expected"].alias("expected")
    )


def payload_bytes(spark, sf_dir):
    status = F.when(F.size("parse_errors") == 0, "good").otherwise("bad").alias("status")
    return _parsed(spark, sf_dir, with_data=False).groupBy(status).agg(F.sum("n_bytes").alias("n_bytes"))


def payload_as_utf8(spark, sf_dir):
    """Documents as raw lines that end in a byte that is no UTF-8."""
    raw = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")))
    text = payload_text(raw, T.BinaryType())
    return X.table(spark, sf_dir, "documents").select(
        "doc_id", F.length(text).cast("long").alias("n_chars"),
        F.substring(text, -1, 1).alias("last_char"), F.octet_length(raw).cast("long").alias("n_bytes"),
    )


def unstruct_extract(spark, sf_dir):
    good = good_events(_parsed(spark, sf_dir), "event_id", "unstruct_entity")
    uri = F.col("unstruct_entity.schema")
    return good.select("event_id", *[c.alias(n) for n, c in key_columns(uri).items()],
                       F.variant_get("unstruct_entity.data", "$.k", "string").alias("k"))


def start_position(spark, sf_dir):
    good = good_events(_parsed(spark, sf_dir), "collector_tstamp", "event_name")
    return since(good, START).groupBy("event_name").agg(F.count("*").alias("n_events"))


def contexts_concat(spark, sf_dir):
    configure(spark)
    parsed = parse_lines(X.enveloped_lines(spark, sf_dir), X.ENVELOPED_ATOMIC)
    return entity_occurrences(parsed, "event_id").select(
        "event_id", F.col("position").cast("long").alias("position"), "entity", "uri"
    )


# Entities and naming

def entity_counts(spark, sf_dir):
    return _versions(spark, sf_dir).drop("uri")


def column_names_v2(spark, sf_dir):
    versions = _versions(spark, sf_dir)
    name = column_name(*[F.col(c) for c in ("entity", "vendor", "name", "model")])
    return versions.groupBy(name.alias("column_name")).agg(F.sum("occurrences").alias("occurrences"))


def column_names_legacy(spark, sf_dir):
    versions = _versions(spark, sf_dir)
    parts = [F.col(c) for c in ("entity", "vendor", "name", "model", "revision", "addition")]
    return versions.select(legacy_column_name(*parts).alias("column_name"), "occurrences")


def skip_schemas(spark, sf_dir):
    kept = with_style(_versions(spark, sf_dir), X.SKIP, X.LEGACY)
    return kept.select("uri", "style", "occurrences")


def legacy_selection(spark, sf_dir):
    versions = _versions(spark, sf_dir)
    chosen = with_style(versions, X.SKIP, X.LEGACY).filter(F.col("style") == LEGACY_STYLE)
    everything = with_style(versions, X.SKIP, X.LEGACY, legacy_mode=True)
    return chosen.select(F.lit("criteria").alias("chosen_by"), "uri", "occurrences").unionByName(
        everything.select(F.lit("mode").alias("chosen_by"), "uri", "occurrences")
    )


# Registry

def resolve_schemas(spark, sf_dir):
    versions = _versions(spark, sf_dir)
    return match_registry(versions, _registry(spark)).select("uri", "found", "occurrences")


def unresolved_schemas(spark, sf_dir):
    return unresolved(_versions(spark, sf_dir), _registry(spark)).select("uri", "occurrences")


def any_unresolved(spark, sf_dir):
    matched = match_registry(_versions(spark, sf_dir), _registry(spark))
    return matched.agg(F.bool_or(~F.col("found")).alias("any_unresolved"))


def registry_fields(spark, sf_dir):
    """Fields of the schemas in the data, with the number of entities that carry them."""
    configure(spark)
    parsed = parse_lines(X.enveloped_lines(spark, sf_dir), X.ENVELOPED_ATOMIC)
    present = entity_versions(parsed).groupBy("uri").agg(F.sum("occurrences").alias("occurrences"))
    fields = _registry(spark, X.place_registry).select("uri", F.inline("nodes"))
    return fields.join(present, "uri").select(
        "uri", F.concat_ws(".", "path").alias("path"), "name", "kind", "nullable", "occurrences"
    )


# Casting

def strict_cast_int(spark, sf_dir):
    good = good_events(_parsed(spark, sf_dir), "event_id", "unstruct_entity")
    dtype = T.StructType([T.StructField("k", T.IntegerType(), False)])
    data = "unstruct_entity.data"
    cast = good.withColumn("value_", F.expr(cast_value(data, dtype, members=members_of(data, dtype))))
    errors = F.expr(cast_errors("value_", data, dtype, False, "unstruct_entity.schema"))
    wrong = F.get(errors, F.lit(0))
    return cast.select("event_id", F.col("value_.k").alias("k"), wrong["error"].alias("error"),
                       wrong["value"].alias("wrong_value"), wrong["expected"].alias("expected"))


def _typed(spark, sf_dir, dtype, mode, *fields):
    """The shipping records cast to the fields that the query shows."""
    configure(spark)
    dtype = narrowed(dtype, *fields)
    texts = json_text_type(dtype)
    rows = X.typed_json(spark, sf_dir).select("l_orderkey", "l_linenumber", "j", F.parse_json("j").alias("v"))
    text = [] if texts is None else [F.from_json("j", texts).alias("text")]
    prepared = rows.select("l_orderkey", "l_linenumber", "v", *text, F.expr(members_of("v", dtype)).alias("m"))
    cast = prepared.select("l_orderkey", "l_linenumber", F.expr(cast_value("v", dtype, mode, "text" if text else None, members="m")).alias("r"))
    return cast.select("l_orderkey", "l_linenumber", F.expr(compacted("r", dtype)).alias("r"))


def cast_all_types(spark, sf_dir):
    r = F.col("r")
    shown = ("order", "price", "rates", "label.flag", "returned", "shipped_on", "packed_at", "remark")
    return _typed(spark, sf_dir, X.TYPED, V2, *shown).select(
        "l_orderkey", "l_linenumber", r["order"]["number"].alias("order_number"), r["order"]["line"].alias("order_line"),
        r["price"].alias("price"), F.get(r["rates"], F.lit(0)).alias("first_rate"), F.get(r["rates"], F.lit(1)).alias("second_rate"),
        F.size(r["rates"]).alias("n_rates"), r["label"]["flag"].alias("flag"), r["returned"].alias("returned"),
        F.unix_date(r["shipped_on"]).alias("shipped_on"), F.unix_micros(r["packed_at"]).alias("packed_at"), r["remark"].alias("remark"),
    )


def json_text_v2(spark, sf_dir):
    r = F.col("r")
    return _typed(spark, sf_dir, X.TYPED, V2, "label.stage", "extras").select(
        "l_orderkey", "l_linenumber", r["label"]["stage"].alias("stage_json"), r["extras"].alias("extras_json"),
    )


def json_text_legacy(spark, sf_dir):
    r = F.col("r")
    dtype = legacy_type(T.StructType([
        f if f.name != "label" else T.StructField("label", T.VariantType(), False) for f in X.TYPED.fields
    ]))
    return _typed(spark, sf_dir, dtype, LEGACY_STYLE, "shipped_on", "label", "extras", "price").select(
        "l_orderkey", "l_linenumber", r["shipped_on"].cast("string").alias("shipped_on"), r["label"].alias("label_json"),
        r["extras"].alias("extras_json"), r["price"].cast("decimal(12,2)").alias("price"),
    )


def array_null_drop(spark, sf_dir):
    configure(spark)
    dtype = T.StructType([T.StructField("a", T.ArrayType(T.LongType(), True), False)])
    parsed = X.array_json(spark, sf_dir).select("event_id", F.parse_json("j").alias("v"))
    cast = parsed.select("event_id", F.expr(cast_value("v", dtype)).alias("r"))
    cast = cast.select("event_id", F.expr(compacted("r", dtype)).alias("r"))
    a = F.col("r.a")
    return cast.select("event_id", F.size(a).alias("n_items"),
                       F.aggregate(a, F.lit(0).cast("long"), lambda s, e: s + e).alias("total"))


def array_of_records(spark, sf_dir):
    """Arrays of records with arrays inside: members of a wrong type are errors, nulls are dropped, all errors of an event are reported."""
    configure(spark)
    parsed = X.record_json(spark, sf_dir).select("event_id", F.parse_json("j").alias("v"))
    members = members_of("v", X.RECORDS)
    cast = parsed.withColumn("r", F.expr(cast_value("v", X.RECORDS, members=members)))
    checked = cast.select("event_id", F.expr(cast_ok("r", "v", X.RECORDS, False, members=members)).alias("ok"),
                          F.expr(cast_errors("r", "v", X.RECORDS, False, "'records'")).alias("errors"), F.expr(compacted("r", X.RECORDS)).alias("r"))
    rows = F.col("r.rows")
    return checked.select(
        "event_id", "ok", F.size(rows).alias("n_rows"), F.array_join(F.transform(rows, lambda x: x["n"].cast("string")), ",", "-").alias("ns"),
        F.array_join(F.flatten(F.transform(rows, lambda x: x["tags"])), ",").alias("tags"),
        F.array_join(F.transform("errors", lambda e: F.concat_ws("/", e["error"], e["value"], e["expected"])), ";").alias("errors"))


# Transform and failures

def _flat_rows(rows: DataFrame) -> DataFrame:
    k = {e: F.col(f"unstruct_event_com_acme_{e}_1.k").cast("long").alias(f"{e}_k") for e in ("click", "purchase", "signup")}
    versions = [F.col(f"unstruct_event_com_acme_view_1_0_{i}.k").alias(f"view_k_{i}") for i in range(3)]
    user = F.col("contexts_com_acme_user_ctx_1")
    return rows.select(
        "event_id", F.unix_micros("collector_tstamp").alias("collector_micros"), "event_name",
        F.unix_micros("load_tstamp").alias("load_micros"), *k.values(), *versions,
        F.size(user).alias("n_users"), F.get(user, F.lit(0))["user_id"].alias("user_id"),
    )


def transform_rows(spark, sf_dir):
    return _flat_rows(good_rows(_transformed(spark, sf_dir, skip_schemas=X.SKIP, legacy_schemas=X.LEGACY)))


def transform_legacy_mode(spark, sf_dir):
    rows = good_rows(_transformed(spark, sf_dir, skip_schemas=X.SKIP, legacy_mode=True))
    picked = [F.col(f"unstruct_event_com_acme_{e}_1_0_{i}.k") for e in X.EVENT_TYPES for i in range(3)]
    user = F.get("contexts_com_acme_user_ctx_1_0_0", F.lit(0))
    return rows.select("event_id", F.unix_micros("load_tstamp").alias("load_micros"),
                       F.coalesce(*picked).alias("k"), user["user_id"].alias("user_id"))


def transform_nested(spark, sf_dir):
    """Nested records, decimals, JSON and repeated contexts of both context columns."""
    configure(spark)
    parsed = parse_lines(X.enveloped_lines(spark, sf_dir), X.ENVELOPED_ATOMIC)
    keys = parse_lines(X.enveloped_lines(spark, sf_dir), X.ENVELOPED_ATOMIC, with_data=False)
    resolved = _resolved(keys, _registry(spark, X.place_registry))
    rows = good_rows(transform_events(parsed, X.ENVELOPED_ATOMIC, resolved, F.lit(LOAD_TSTAMP)))
    users = F.col("contexts_com_acme_user_ctx_1")
    place = F.get("contexts_com_acme_place_seen_1", F.lit(0))
    clicks = [F.col(f"unstruct_event_com_acme_{e}_1.k") for e in ("click", "error", "signup", "view")]
    return rows.select(
        "event_id", "value", "is_sale", F.coalesce(*clicks).cast("long").alias("k"),
        F.size(users).alias("n_users"), F.get(users, F.lit(1))["user_id"].alias("second_user"),
        place["amount"].alias("amount"), place["detail"].alias("detail_json"),
        place["spot"]["site_id"].alias("site_id"), F.array_join(place["spot"]["tags"], ",").alias("tags"),
    )


def merged_versions(spark, sf_dir):
    """Versions of one family in one widened column, and the version that does not fit in its own."""
    rows = good_rows(_transformed(spark, sf_dir, _registry(spark, X.drifting_registry)))
    merged = [F.col(f"unstruct_event_com_acme_{e}_1.k") for e in X.EVENT_TYPES]
    recovered = [F.col(f"unstruct_event_com_acme_{e}_1_recovered_0_2.k") for e in X.EVENT_TYPES]
    return rows.select("event_id", F.coalesce(*merged).alias("merged_k"), F.coalesce(*recovered).alias("recovered_k"))


def missing_schema_lenient(spark, sf_dir):
    failed = failures(_transformed(spark, sf_dir), "event_id").filter(F.col("failure.kind") == E.SCHEMA)
    return failed.select("event_id", F.inline("failure.errors"))


def _faulty(spark, sf_dir):
    configure(spark)
    lines = X.faulty_lines(spark, sf_dir)
    resolved = _resolved(parse_lines(lines, X.ATOMIC, **X.LAYOUT, with_data=False), _registry(spark, X.faulty_registry), legacy_schemas=X.FAULTY_LEGACY)
    return transform_events(parse_lines(lines, X.ATOMIC, **X.LAYOUT), X.ATOMIC, resolved, F.lit(LOAD_TSTAMP), **X.LAYOUT,
                            legacy_schemas=X.FAULTY_LEGACY, keep=("event_id",))


def error_details(spark, sf_dir):
    """Every error of every event in order: missing members and nulls, several at once, unknown and invalid schemas, and what hides what."""
    failed = failures(_faulty(spark, sf_dir), "event_id")
    return failed.select("event_id", "failure.kind", F.posexplode("failure.errors").alias("position", "e")).select(
        "event_id", "kind", "position", "e.error", "e.schema_key", F.col("e.value").alias("found"), "e.expected")


def moments_cast(spark, sf_dir):
    """Moments with offsets and with more digits than are kept."""
    rows = good_rows(_faulty(spark, sf_dir))
    order = F.col("unstruct_event_com_acme_order_1")
    return rows.select("event_id", F.unix_micros(order["at"]).alias("at_micros"), order["extra"].alias("extra_json"),
                       F.get("contexts_com_acme_note_1_0_0", F.lit(0))["text"].alias("note_json"))


def failed_records(spark, sf_dir):
    return serialised(failed_events(_transformed(spark, sf_dir), processor(*STAMP))).select("kind", "value")


def failed_records_capped(spark, sf_dir):
    capped = serialised(failed_events(_transformed(spark, sf_dir), processor(*STAMP)), SMALL_CAP)
    return capped.select("kind", F.octet_length("value").cast("long").alias("record_bytes"),
                         F.get_json_object("value", "$.failure.actual_bytes").cast("long").alias("actual_bytes"))


# Table schema, conformance and loading

def _narrow_table(resolved: Resolved) -> T.StructType:
    """A table without the purchase column and with ``click.k`` as text."""
    base = initial_schema(X.ATOMIC, X.LAYOUT["unstruct"], X.LAYOUT["contexts"])
    kept = [f for f in resolved.fields if "purchase" not in f.name and "click" not in f.name]
    click = T.StructField("unstruct_event_com_acme_click_1", T.StructType([T.StructField("k", T.StringType(), True)]))
    return T.StructType(merge_columns(base, kept).fields + [click])


def row_conformance(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    resolved = _resolved(_parsed(spark, sf_dir, with_data=False), _registry(spark))
    transformed = transform_events(parsed, X.ATOMIC, resolved, F.lit(LOAD_TSTAMP), **X.LAYOUT, keep=("event_id",))
    failed = failures(conform(transformed, _narrow_table(resolved)), "event_id")
    return failed.filter(F.col("failure.kind") == E.RUNTIME).select("event_id", F.inline("failure.errors"))


def _occurrences_by_column(parsed: DataFrame) -> DataFrame:
    name = column_name(*[F.col(c) for c in ("entity", "vendor", "name", "model")])
    return entity_versions(parsed).groupBy(name.alias("column_name")).agg(F.sum("occurrences").alias("occurrences"))


def schema_diff(spark, sf_dir):
    """Columns for which the table has to change, with the entities in the data that need them."""
    parsed = _parsed(spark, sf_dir, with_data=False)
    resolved = _resolved(parsed, _registry(spark))
    wanted = [f.name for f in fields_to_alter(_narrow_table(resolved), resolved.fields)]
    return _occurrences_by_column(parsed).filter(F.col("column_name").isin(wanted))


def schema_merge(spark, sf_dir):
    """Paths of the merged table schema, with the entities in the data that fill them."""
    parsed = _parsed(spark, sf_dir, with_data=False)
    resolved = _resolved(parsed, _registry(spark))
    merged = merge_columns(_narrow_table(resolved), resolved.fields)
    paths = spark.createDataFrame(flat_paths(merged), "path string, type string, nullable boolean")
    column = F.regexp_extract("path", r"^([^.\[]+)", 1)
    counts = _occurrences_by_column(parsed)
    return paths.withColumn("column_name", column).join(counts, "column_name").select(
        "path", "type", "nullable", "occurrences"
    )


def _split_lines(spark, sf_dir):
    lines = X.enriched_lines(spark, sf_dir)
    first = F.coalesce(F.get(F.split("value", "\t"), F.lit(2)), F.lit("click")).isin(list(FIRST_TYPES))
    return lines.filter(first), lines.filter(~first)


def _load_two_days(spark, sf_dir, **options) -> str:
    """Load the events as two batches on two days; the second one brings new columns."""
    root = scratch(spark)
    options = {**X.LAYOUT, "exit_on_missing_schema": False, "skip_schemas": X.SKIP, "legacy_schemas": X.LEGACY, **options}
    first, second = _split_lines(spark, sf_dir)
    state = load_lines(first, "first-0", root, _registry(spark), X.ATOMIC, LOAD_TSTAMP, **options)
    load_lines(second, "second-0", root, _registry(spark), X.ATOMIC, SECOND_LOAD, known=state, **options)
    return root


def append_evolved(spark, sf_dir):
    return _flat_rows(read_table(spark, _load_two_days(spark, sf_dir)))


def daily_partitions(spark, sf_dir):
    rows = read_table(spark, _load_two_days(spark, sf_dir))
    return rows.groupBy(F.date_format("load_date", "yyyy-MM-dd").alias("load_day"), "event_name").agg(
        F.count("*").alias("n_rows"))


def rerun_replaces(spark, sf_dir):
    """A batch that was loaded with too many lines on the wrong day, loaded again: rows by batch and day, and all failed events."""
    root = scratch(spark)
    options = {**X.LAYOUT, "exit_on_missing_schema": False, "skip_schemas": X.SKIP, "legacy_schemas": X.LEGACY}
    first, second = _split_lines(spark, sf_dir)
    state = load_lines(X.enriched_lines(spark, sf_dir), "first-0", root, _registry(spark), X.ATOMIC, SECOND_LOAD, **options)
    state = load_lines(second, "second-0", root, _registry(spark), X.ATOMIC, SECOND_LOAD, known=state, **options)
    load_lines(first, "first-0", root, _registry(spark), X.ATOMIC, LOAD_TSTAMP, known=state, **options)
    loaded = read_table(spark, root).groupBy("batch_id", F.date_format("load_date", "yyyy-MM-dd").alias("load_day")).agg(F.count("*").alias("n"))
    failed = read_failed(spark, root).agg(F.lit("failed").alias("batch_id"), F.lit("failed").alias("load_day"), F.count("*").alias("n"))
    return loaded.unionByName(failed)


def pruned_read(spark, sf_dir):
    """Two days in many files, joined into few of narrow ranges; of these only the ones that may hold some event names from a moment on are read."""
    root = _load_two_days(spark, sf_dir, spread=8)
    days = ["2024-02-01", "2024-02-02"]
    for day in days:
        compact(spark, root, day, target_bytes=1 << 20)
    rows = read_table(spark, root, days=days, event_names=["click", "signup"], since=START)
    return rows.groupBy(F.date_format("load_date", "yyyy-MM-dd").alias("load_day"), "event_name").agg(
        F.count("*").alias("n_rows"), F.sum("event_id").alias("event_ids"))


def loaded_metrics(spark, sf_dir):
    metrics = read_metrics(spark, _load_two_days(spark, sf_dir))
    return metrics.select("batch_id", "n_events", "n_good", "n_bad", "n_bytes",
                          F.unix_micros("earliest_collector_tstamp").alias("earliest_micros"))


def column_cap(spark, sf_dir):
    """With room for few columns nothing is added, and only rows that need a new column fail."""
    root = _load_two_days(spark, sf_dir, max_columns=FEW_COLUMNS, column_delay=timedelta(days=1))
    failed = read_failed(spark, root)
    return failed.groupBy(F.get_json_object("value", "$.kind").alias("kind")).agg(F.count("*").alias("n_failed"))


def alerts_raised(spark, sf_dir):
    """What the cap on columns has alerted, with the entities in the data that need each column."""
    root = _load_two_days(spark, sf_dir, max_columns=FEW_COLUMNS, column_delay=timedelta(days=1))
    alerts = spark.read.schema(ALERT_SCHEMA).json(f"{root}/alerts")
    counts = _occurrences_by_column(_parsed(spark, sf_dir, with_data=False))
    return alerts.select("alert", "cause", F.explode("columns").alias("column_name")).join(counts, "column_name")


def relaxed_columns(spark, sf_dir):
    """A number that the first batch's schemas require and those of the second do not: whether each table schema holds the other one's column."""
    configure(spark)
    root, lines, registry = scratch(spark), X.relaxing_lines(spark, sf_dir), _registry(spark, X.relaxing_registry)
    first = load_lines(lines.where("NOT later").select("value"), "first-0", root, registry, X.ATOMIC, LOAD_TSTAMP, **X.LAYOUT)
    last = load_lines(lines.where("later").select("value"), "second-0", root, registry, X.ATOMIC, SECOND_LOAD, known=first, **X.LAYOUT)
    names = sorted(last.owners)
    facts = [
        (n, first.schema[n].dataType["k"].nullable, last.schema[n].dataType["k"].nullable,
         has_fields(first.schema, [last.schema[n]]), has_fields(last.schema, [first.schema[n]]))
        for n in names
    ]
    rows = read_table(spark, root)
    counted = rows.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.col(n).isNotNull().alias("there"), (F.col(n).isNotNull() & F.col(n)["k"].isNull()).alias("lacks"))
        for n in names
    ])).alias("x")).select("x.*").groupBy("column_name").agg(F.count_if("there").alias("n_values"), F.count_if("lacks").alias("n_without"))
    described = spark.createDataFrame(facts, "column_name string, nullable_first boolean, nullable_last boolean, first_has_last boolean, last_has_first boolean")
    return described.join(counted, "column_name")


def colliding_names(spark, sf_dir):
    """Schemas whose columns would have the same name, the second of them in a later batch, and a legacy version beside a schema that is named like it."""
    configure(spark)
    root, lines, registry = scratch(spark), X.twin_lines(spark, sf_dir), _registry(spark, X.twin_registry)
    options = {**X.LAYOUT, "legacy_schemas": X.TWIN_LEGACY}
    first = F.col("event_type") == "view"
    state = load_lines(lines.where(first).select("value"), "first-0", root, registry, X.ATOMIC, LOAD_TSTAMP, **options)
    state = load_lines(lines.where(~first).select("value"), "second-0", root, registry, X.ATOMIC, SECOND_LOAD, known=state, **options)
    other = {plain: next(c for c in state.owners if c.startswith(f"{plain}_")) for plain in (X.PAGE_VIEW, X.ITEM)}
    k = lambda column, kind: F.col(column)["k"].cast(kind)
    return read_table(spark, root).select(
        "event_id", k(X.PAGE_VIEW, "string").alias("page_view_k"), k(other[X.PAGE_VIEW], "long").alias("page_view_other_k"),
        k(X.ITEM, "long").alias("item_k"), k(other[X.ITEM], "string").alias("item_other_k"))


def refreshed_registry(spark, sf_dir):
    """Schemas of sign-ups are put into the directory after the first of two batches; the same loader uses them for the second."""
    configure(spark)
    root, lines = scratch(spark), X.enriched_lines(spark, sf_dir)
    options = {**X.LAYOUT, "exit_on_missing_schema": False}
    signups = [row for row in X.acme_schemas() if "/signup/" in row[0]]
    X.put_schemas(spark, f"{root}/schemas", [row for row in X.acme_schemas() if row not in signups])
    registry = SchemaDirectory(spark, f"{root}/schemas", f"{root}/registry", every=timedelta(0))
    even = F.regexp_extract("value", "^[a-z]*([0-9]+)", 1).cast("long") % 2 == 0
    state = load_lines(lines.where(even), "before", f"{root}/table", registry, X.ATOMIC, LOAD_TSTAMP, **options)
    X.put_schemas(spark, f"{root}/schemas", signups)
    load_lines(lines.where(~even), "after", f"{root}/table", registry, X.ATOMIC, SECOND_LOAD, known=state, **options)
    rows = read_table(spark, f"{root}/table").groupBy("batch_id", "event_name").agg(F.count("*").alias("n"))
    failed = read_metrics(spark, f"{root}/table").select("batch_id", F.lit("failed").alias("event_name"), F.col("n_bad").alias("n"))
    return rows.unionByName(failed)


def outputs_by_batch(spark, sf_dir):
    """A batch without bad lines, one of bad lines only and one without lines: which outputs each has."""
    root, lines = scratch(spark), X.enriched_lines(spark, sf_dir)
    malformed = F.col("value").startswith("nonsense")
    fine = ~malformed & ~F.col("value").contains("com.unknown") & ~F.col("value").contains("xyz")
    for batch_id, some in {"good": fine, "bad": malformed, "none": F.lit(False)}.items():
        load_lines(lines.where(some), batch_id, root, _registry(spark), X.ATOMIC, LOAD_TSTAMP, **X.LAYOUT)
    kind = F.col("kind")
    files = log.live_files(spark, root).select(F.explode("batches").alias("batch_id"), "kind", "n_rows").groupBy("batch_id").agg(
        F.coalesce(F.sum(F.when(kind == log.ROWS, F.col("n_rows"))), F.lit(0)).alias("n_rows"), F.bool_or(kind == log.ROWS).alias("has_rows"),
        F.bool_or(kind == log.FAILED).alias("has_failed"))
    return read_metrics(spark, root).select("batch_id", "n_events").join(files, "batch_id")


# Metrics

def summary_of_batch(spark, sf_dir):
    transformed = _transformed(spark, sf_dir)
    summary = batch_summary(transformed)
    e2e = latency_millis(F.lit(LOAD_TSTAMP), F.col("earliest_collector_tstamp"))
    return summary.select("n_events", "n_good", "n_bad", "n_bytes",
                          F.unix_micros("earliest_collector_tstamp").alias("earliest_micros"), e2e.alias("e2e_millis"))


def _hourly_batches(spark, sf_dir):
    """Every hour of the source taken as one batch, with its malformed lines, that is loaded when the hour is over."""
    configure(spark)
    parsed = parse_lines(X.sourced_lines(spark, sf_dir), X.ATOMIC, **X.LAYOUT)
    resolved = _resolved(_parsed(spark, sf_dir, with_data=False), _registry(spark))
    transformed = transform_events(parsed, X.ATOMIC, resolved, F.lit(LOAD_TSTAMP), **X.LAYOUT, keep=("collector_tstamp", "source_tstamp"))
    loaded = F.date_trunc("hour", "source_tstamp") + F.expr("interval 1 hour")
    batches = batch_summary(transformed.withColumn("load_tstamp", loaded), "load_tstamp", extra=[F.max("source_tstamp").alias("newest")])
    return batches.withColumns({
        "e2e_latency_millis": latency_millis(F.col("load_tstamp"), F.col("earliest_collector_tstamp")),
        "latency_millis": latency_millis(F.col("load_tstamp"), F.col("newest")),
    })


def metrics_by_period(spark, sf_dir):
    return per_period(_hourly_batches(spark, sf_dir), "1 day").drop(NEWEST_SOURCE).withColumn(
        "period_start", F.unix_micros("period_start"))


def unhealthy_periods(spark, sf_dir):
    periods = per_period(_hourly_batches(spark, sf_dir), "1 hour")
    return unhealthy(periods).select(F.unix_micros("period_start").alias("period_start"), METRIC_LATENCY, METRIC_E2E_LATENCY)


def stalled_source(spark, sf_dir):
    """Every hour until a day after the last batch, of which those are shown whose lag is too long; in the last ones nothing came."""
    batches = _hourly_batches(spark, sf_dir)
    periods = every_period(per_period(batches, "1 hour"), "1 hour", F.max("period_start") + F.expr("interval 24 hours"))
    return unhealthy(periods).select(F.unix_micros("period_start").alias("period_start"), METRIC_GOOD, METRIC_BAD, METRIC_LATENCY)


# Streaming

def stream_equals_batch(spark, sf_dir):
    """The lines as a stream of files, loaded in micro-batches until none are left."""
    configure(spark)
    root = scratch(spark)
    X.enriched_lines(spark, sf_dir).write.text(f"{root}/lines")
    query = run_stream(
        text_stream(spark, f"{root}/lines"), f"{root}/table", _registry(spark), X.ATOMIC, f"{root}/checkpoint",
        trigger={"availableNow": True}, exit_on_missing_schema=False, skip_schemas=X.SKIP, legacy_schemas=X.LEGACY,
        **X.LAYOUT,
    )
    query.awaitTermination()
    rows = read_table(spark, f"{root}/table")
    # A stream stamps its rows with the clock; the load time is checked to be there and then set.
    stamped = F.when(F.col("load_tstamp").isNotNull(), F.lit(LOAD_TSTAMP))
    return _flat_rows(rows.withColumn("load_tstamp", stamped))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        parse_good_bad, parse_failures, payload_bytes, payload_as_utf8, unstruct_extract, start_position,
        contexts_concat, entity_counts, column_names_v2, column_names_legacy, skip_schemas, legacy_selection,
        resolve_schemas, unresolved_schemas, any_unresolved, registry_fields, strict_cast_int, cast_all_types,
        json_text_v2, json_text_legacy, array_null_drop, array_of_records, transform_rows, transform_legacy_mode, transform_nested,
        merged_versions, missing_schema_lenient, failed_records, failed_records_capped, row_conformance, schema_diff,
        schema_merge, append_evolved, daily_partitions, rerun_replaces, pruned_read, loaded_metrics, column_cap, summary_of_batch,
        metrics_by_period, unhealthy_periods, stalled_source, stream_equals_batch, error_details, moments_cast, alerts_raised, relaxed_columns,
        colliding_names, refreshed_registry, outputs_by_batch,
    )}
