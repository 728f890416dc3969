import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway import MissingSchemaError, load_lines, run_stream
from sluiceway.operators.fields import column_count
from sluiceway.operators.metrics import batch_summary, every_period, latency_millis, per_period, unhealthy
from sluiceway.sources import table
from sluiceway.sources.lines import kafka_options, parquet_lines, since, text_lines, text_stream
from tests.conftest import ATOMIC, entity, line, lines_of

UTC = datetime.timezone.utc
NOW = datetime.datetime(2024, 6, 1, 23, 59, tzinfo=UTC)
CART = "unstruct_event_org_shop_cart_1"


def load(spark, root, registry, batch_id, *lines, at=NOW, **options):
    return load_lines(lines_of(spark, *lines), batch_id, str(root), registry, ATOMIC, at, **options)


def metrics(spark, root):
    return {r["batch_id"]: r for r in table.read_metrics(spark, str(root)).collect()}


def cart(event_id, count, version="1-0-0", **more):
    return line(event_id, unstruct=entity("cart", {"itemCount": count, **more}, version))


# Batches

def test_good_batch(spark, registry, tmp_path):
    load(spark, tmp_path, registry, "b-0", line("a"), cart("b", 2))
    got = {r["event_id"]: r for r in table.read_table(spark, str(tmp_path)).collect()}
    assert got["b"][CART]["item_count"] == 2 and got["a"][CART] is None
    assert got["a"]["load_date"] == datetime.date(2024, 6, 1) and got["a"]["batch_id"] == "b-0"
    assert got["a"]["load_tstamp"] == datetime.datetime(2024, 6, 1, 23, 59)
    row = metrics(spark, tmp_path)["b-0"]
    assert (row["n_events"], row["n_good"], row["n_bad"]) == (2, 2, 0)
    assert row["e2e_latency_millis"] > 0
    assert table.read_failed(spark, str(tmp_path)).count() == 0


def test_batch_of_bad_lines_only(spark, registry, tmp_path):
    load(spark, tmp_path, registry, "b-0", "x", "yy")
    assert table.read_table(spark, str(tmp_path)).count() == 0
    assert table.read_failed(spark, str(tmp_path)).count() == 2
    row = metrics(spark, tmp_path)["b-0"]
    assert (row["n_good"], row["n_bad"], row["n_bytes"]) == (0, 2, 3)
    assert row["earliest_collector_tstamp"] is None and row["e2e_latency_millis"] is None


def test_empty_batch_writes_nothing(spark, registry, tmp_path):
    load(spark, tmp_path, registry, "b-0")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["schema_log"]


def test_missing_schema_stops_before_any_write(spark, registry, tmp_path):
    with pytest.raises(MissingSchemaError) as e:
        load(spark, tmp_path, registry, "b-0", line("a"), line("b", unstruct=entity("gone", {})),
             line("c", contexts=[entity("broken", {})]))
    assert "2 schemas" in str(e.value)
    causes = {r["cause"] for r in spark.read.schema(table.ALERT_SCHEMA).json(f"{tmp_path}/alerts").collect()}
    assert causes == {"SchemaNotFound: iglu:org.shop/gone/jsonschema/1-0-0", "InvalidSchema: iglu:org.shop/broken/jsonschema/1-0-0"}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["alerts", "schema_log"]


def test_missing_schema_can_be_sent_to_failed_events(spark, registry, tmp_path):
    load(spark, tmp_path, registry, "b-0", line("a"), line("b", unstruct=entity("gone", {})), exit_on_missing_schema=False)
    assert [r["event_id"] for r in table.read_table(spark, str(tmp_path)).collect()] == ["a"]
    record, = table.read_failed(spark, str(tmp_path)).collect()
    assert json.loads(record["value"])["errors"][0]["error"] == "SchemaNotFound"


def test_skipped_missing_schema_does_not_stop(spark, registry, tmp_path):
    load(spark, tmp_path, registry, "b-0", line("b", unstruct=entity("gone", {})),
         skip_schemas=["iglu:org.shop/gone/jsonschema/*-*-*"])
    assert table.read_table(spark, str(tmp_path)).count() == 1


def test_running_a_batch_again_replaces_it(spark, registry, tmp_path):
    for _ in range(2):
        load(spark, tmp_path, registry, "b-0", line("a"), "bad")
    load(spark, tmp_path, registry, "b-1", line("b"))
    assert table.read_table(spark, str(tmp_path)).count() == 2
    assert table.read_failed(spark, str(tmp_path)).count() == 1
    assert set(metrics(spark, tmp_path)) == {"b-0", "b-1"}


@pytest.mark.parametrize("first,second", [(("gone", "cart"), ("cart", "gone")), (("cart", "gone"), ("gone", "cart"))])
def test_running_again_moves_rows_between_outputs(spark, registry, tmp_path, first, second):
    """Rows that change their class leave nothing behind, nor does another load day."""
    for names, at in ((first, NOW), (second, NOW + datetime.timedelta(days=2))):
        lines = [line(i, unstruct=entity(n, {"itemCount": 1})) for i, n in zip("ab", names)]
        load(spark, tmp_path, registry, "b-0", *lines, at=at, exit_on_missing_schema=False)
    got = table.read_table(spark, str(tmp_path)).collect()
    assert [(r["event_id"], r["load_date"].day) for r in got] == [("b" if second[1] == "cart" else "a", 3)]
    assert table.read_failed(spark, str(tmp_path)).count() == 1
    load(spark, tmp_path, registry, "b-0", line("a"), line("b"))
    assert table.read_table(spark, str(tmp_path)).count() == 2 and table.read_failed(spark, str(tmp_path)).count() == 0


def test_oversized_payload_is_kept_whole(spark, registry, tmp_path):
    bad = "x" * 5000
    load(spark, tmp_path, registry, "b-0", bad, max_failed_bytes=1000)
    whole, = table.read_oversized(spark, str(tmp_path)).collect()
    record = json.loads(table.read_failed(spark, str(tmp_path)).first()["value"])
    assert whole["payload"] == bad and whole["kind"] == record["failure"]["original_kind"] and whole["key"] == record["failure"]["key"]
    assert [e["error"] for e in whole["errors"]] == ["FieldCountMismatch"]


def test_recomputing_gives_the_same_as_keeping(spark, registry, tmp_path):
    lines = [cart("a", 1), cart("b", "x"), "bad", line("c", contexts=[entity("cart", {"itemCount": 1})])]
    load(spark, tmp_path / "x", registry, "b-0", *lines)
    load(spark, tmp_path / "y", registry, "b-0", *lines, storage=None, spread=2)
    x, y = [sorted(table.read_table(spark, str(tmp_path / d)).collect()) for d in "xy"]
    assert x == y and len(x) == 2


def test_failure_of_the_failed_event_sink_stops_the_batch(spark, registry, tmp_path):
    def broken(*_):
        raise OSError("no sink")
    with pytest.raises(OSError):
        load(spark, tmp_path, registry, "b-0", "bad", send_failed=broken)
    assert table.read_metrics(spark, str(tmp_path)).count() == 0


# Evolution

def test_new_columns_and_nested_fields(spark, registry, tmp_path):
    load(spark, tmp_path, registry, "b-0", cart("a", 1))
    load(spark, tmp_path, registry, "b-1", cart("b", 2, "1-0-1", note="n"),
         line("c", contexts=[entity("any-thing", {"q": 1})]))
    got = {r["event_id"]: r for r in table.read_table(spark, str(tmp_path)).collect()}
    assert got["a"][CART].asDict() == {"item_count": 1, "note": None}
    assert got["b"][CART].asDict() == {"item_count": 2, "note": "n"}
    assert got["c"]["contexts_org_shop_any_thing_1"] == ['{"q":1}']
    records = [json.loads(p.read_text()) for p in sorted((tmp_path / "schema_log").glob("0*.json"))]
    assert [r["version"] for r in records] == [0, 1, 2]
    # A record holds what is new, not the whole schema.
    new = {f["name"]: f["type"] for f in records[2]["fields"]["fields"]}
    assert set(new) == {CART, "contexts_org_shop_any_thing_1"} and [f["name"] for f in new[CART]["fields"]] == ["note"]


def test_known_columns_change_nothing(spark, registry, tmp_path):
    load(spark, tmp_path, registry, "b-0", cart("a", 1, "1-0-1"))
    load(spark, tmp_path, registry, "b-1", cart("b", 2))
    assert table.load_state(spark, str(tmp_path)).version == 1


def test_two_loaders_keep_each_others_columns(spark, tmp_path):
    root = str(tmp_path)
    base = T.StructType([T.StructField("a", T.StringType(), False)])
    first = table.create_if_missing(spark, root, base, NOW)
    assert table.create_if_missing(spark, root, T.StructType([]), NOW) == first
    x, y = [T.StructField(n, T.StructType([T.StructField("k", T.LongType())])) for n in "xy"]
    table.evolve(spark, root, first, [x], now=NOW)
    stale = table.evolve(spark, root, first, [y], now=NOW)
    assert stale.schema.fieldNames() == ["a", "x", "y"]
    assert set(table.load_state(spark, root).schema.fieldNames()) == {"a", "x", "y"}
    again = table.create_if_missing(spark, root, base).schema.fieldNames()
    assert again == table.load_state(spark, root).schema.fieldNames() and again[0] == "a"


def test_a_denied_lookup_falls_back_to_creating(spark, tmp_path, monkeypatch):
    root, base = str(tmp_path), T.StructType([T.StructField("a", T.StringType(), False)])
    lookup, calls = table.load_state, []

    def denied_once(*args):
        calls.append(args)
        if len(calls) == 1:
            raise table.PySparkException("access denied")
        return lookup(*args)

    monkeypatch.setattr(table, "load_state", denied_once)
    assert table.create_if_missing(spark, root, base, NOW).schema == base


def test_column_cap_pauses_evolution(spark, tmp_path):
    root, delay = str(tmp_path), datetime.timedelta(seconds=300)
    state = table.create_if_missing(spark, root, T.StructType([T.StructField("a", T.StringType())]), NOW)
    many = [T.StructField(f"f{i}", T.LongType()) for i in range(3)]
    one = many[:1]

    def attempt(known, fields, seconds):
        return table.evolve(spark, root, known, fields, max_columns=2, delay=delay, now=NOW + datetime.timedelta(seconds=seconds))

    stopped = attempt(state, many, 0)
    assert stopped.schema == state.schema and stopped.disabled_until == NOW + delay
    assert attempt(stopped, one, 10).schema == state.schema
    assert attempt(state, one, 10).schema == state.schema  # another loader sees the pause in the log
    assert attempt(stopped, one, 310).schema.fieldNames() == ["a", "f0"]
    alert, = spark.read.schema(table.ALERT_SCHEMA).json(f"{root}/alerts").collect()
    assert alert["alert"] == "failed_to_add_columns" and alert["columns"] == ["f0", "f1", "f2"]


def test_rows_that_need_a_capped_column_fail(spark, registry, tmp_path):
    room = column_count(table.initial_schema(ATOMIC))
    load(spark, tmp_path, registry, "b-0", line("a"), cart("b", 1), max_columns=room)
    assert [r["event_id"] for r in table.read_table(spark, str(tmp_path)).collect()] == ["a"]
    record, = table.read_failed(spark, str(tmp_path)).collect()
    assert json.loads(record["value"])["kind"] == "loader_runtime_error"


def test_reads_list_only_the_days_asked_for(spark, registry, tmp_path):
    load(spark, tmp_path, registry, "b-0", line("a"))
    load(spark, tmp_path, registry, "b-1", line("b"), at=NOW + datetime.timedelta(days=1))
    rows = table.read_table(spark, str(tmp_path), days=["2024-06-02"])
    assert [(r["event_id"], r["load_date"].day) for r in rows.collect()] == [("b", 2)]
    assert all("load_date=2024-06-02" in f for f in rows.inputFiles())


def test_a_failed_lookup_raises_an_alert(spark, tmp_path, monkeypatch):
    real, calls = table.load_state, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 1:
            raise table.PySparkException("no access")
        return real(*args)

    monkeypatch.setattr(table, "load_state", failing)
    table.create_if_missing(spark, str(tmp_path), T.StructType([T.StructField("a", T.StringType())]), NOW)
    alert, = spark.read.schema(table.ALERT_SCHEMA).json(f"{tmp_path}/alerts").collect()
    assert alert["alert"] == "failed_to_get_table" and "no access" in alert["cause"]


def test_reads_prune_days_and_push_filters(spark, registry, tmp_path):
    load(spark, tmp_path, registry, "b-0", line("a"))
    load(spark, tmp_path, registry, "b-1", line("b"), at=NOW + datetime.timedelta(days=1))
    got = table.read_table(spark, str(tmp_path)).filter("load_date = date'2024-06-02' and event_name = 'page'").select("event_id")
    assert [r[0] for r in got.collect()] == ["b"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan and "EqualTo(event_name,page)" in plan
    assert "ReadSchema: struct<event_id:string,event_name:string>" in plan


# Streams

def stream(spark, source, root, registry, **options):
    query = run_stream(text_stream(spark, str(source)), str(root / "t"), registry, ATOMIC, str(root / "c"),
                       trigger={"availableNow": True}, **options)
    query.awaitTermination()


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_stream_loads_and_goes_on(spark, registry, tmp_path):
    put(tmp_path / "in", "1.txt", line("a"), cart("b", 1), "bad")
    stream(spark, tmp_path / "in", tmp_path, registry)
    put(tmp_path / "in", "2.txt", cart("c", 1, "1-0-1", note="n"))
    stream(spark, tmp_path / "in", tmp_path, registry)
    rows = table.read_table(spark, str(tmp_path / "t")).collect()
    query = json.loads((tmp_path / "c" / "metadata").read_text())["id"]
    assert sorted((r["event_id"], r["batch_id"]) for r in rows) == [("a", f"main-{query}-0"), ("b", f"main-{query}-0"), ("c", f"main-{query}-1")]
    assert len({r["load_tstamp"] for r in rows}) == 2
    got = metrics(spark, tmp_path / "t")[f"main-{query}-0"]
    assert got["n_bad"] == 1 and got["latency_millis"] is not None


def test_crashed_batch_runs_again_with_its_load_time(spark, registry, tmp_path):
    put(tmp_path / "in", "1.txt", line("a"), "bad")
    seen = []

    def broken(failed, *_):
        raise OSError("no sink")

    with pytest.raises(Exception):
        stream(spark, tmp_path / "in", tmp_path, registry, send_failed=broken)
    assert table.read_table(spark, str(tmp_path / "t")).count() == 0
    seen = json.loads((tmp_path / "c" / "offsets" / "0").read_text().split("\n")[1])["batchTimestampMs"]
    put(tmp_path / "in", "2.txt", line("b"))
    stream(spark, tmp_path / "in", tmp_path, registry)
    rows = {r["event_id"]: r for r in table.read_table(spark, str(tmp_path / "t")).collect()}
    assert set(rows) == {"a", "b"} and rows["a"]["batch_id"].endswith("-0")
    assert rows["a"]["load_tstamp"].replace(tzinfo=UTC).timestamp() == pytest.approx(seen / 1000, abs=1e-3)
    assert table.read_failed(spark, str(tmp_path / "t")).count() == 1


def test_stream_stops_on_a_missing_schema_without_commit(spark, registry, tmp_path):
    put(tmp_path / "in", "1.txt", line("a", unstruct=entity("gone", {})))
    with pytest.raises(Exception, match="gone"):
        stream(spark, tmp_path / "in", tmp_path, registry)
    assert not list((tmp_path / "c" / "commits").glob("[0-9]*"))
    stream(spark, tmp_path / "in", tmp_path, registry, exit_on_missing_schema=False)
    assert table.read_failed(spark, str(tmp_path / "t")).count() == 1


# Sources

def test_file_sources(spark, tmp_path):
    put(tmp_path / "in", "1.txt", "a\tb", "c\rd")
    got = text_lines(spark, str(tmp_path / "in")).collect()
    assert sorted(r["value"] for r in got) == ["a\tb", "c\rd"] and got[0]["source_tstamp"] is not None
    lines_of(spark, "x").write.parquet(str(tmp_path / "pq"))
    assert [r["value"] for r in parquet_lines(spark, str(tmp_path / "pq")).collect()] == ["x"]


def test_stream_can_start_at_a_moment(spark, tmp_path):
    put(tmp_path / "in", "1.txt", "old")
    later = datetime.datetime.now(UTC) + datetime.timedelta(hours=1)
    for name, at, expected in (("all", None, 1), ("none", later, 0)):
        query = text_stream(spark, str(tmp_path / "in"), since=at).writeStream.format("memory").queryName(name).option(
            "checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        query.awaitTermination()
        assert spark.table(name).count() == expected


def test_kafka_options():
    assert kafka_options("b:1", "events") == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "events", "startingOffsets": "earliest"}
    got = kafka_options("b:1", "events", datetime.datetime(2024, 1, 1, tzinfo=UTC), 5000, {"kafka.security.protocol": "SASL_SSL"})
    assert got["startingTimestamp"] == "1704067200000" and got["maxOffsetsPerTrigger"] == "5000"
    assert "startingOffsets" not in got and got["kafka.security.protocol"] == "SASL_SSL"
    with pytest.raises(ValueError):
        kafka_options("b:1", "events", "middle")


def test_since(spark):
    frame = spark.sql("select timestamp'2024-01-01 00:00:00' collector_tstamp union all select timestamp'2024-01-02 00:00:00'")
    assert since(frame, datetime.datetime(2024, 1, 2)).count() == 1


# Metrics

def test_summary_counts_every_line_and_only_parsed_times(spark):
    frame = spark.sql("""
        select 10L n_bytes, cast(null as struct<kind:string>) failure, timestamp'2024-01-02 00:00:00' collector_tstamp
        union all select 5L, struct('bad'), null
        union all select 7L, struct('bad'), timestamp'2024-01-01 00:00:00'""")
    row = batch_summary(frame).first()
    assert (row["n_events"], row["n_good"], row["n_bad"], row["n_bytes"]) == (3, 1, 2, 22)
    assert row["earliest_collector_tstamp"] == datetime.datetime(2024, 1, 1)
    empty = batch_summary(frame.limit(0)).first()
    assert (empty["n_events"], empty["n_bytes"], empty["earliest_collector_tstamp"]) == (0, 0, None)


def test_latency(spark):
    frame = spark.sql("select timestamp'2024-01-01 00:00:42.123' now, timestamp'2024-01-01 00:00:00' t, cast(null as timestamp) n")
    got = frame.select(latency_millis(F.col("now"), F.col("t")), latency_millis(F.col("now"), F.col("n"))).first()
    assert tuple(got) == (42123, None)


def test_periods_start_afresh(spark):
    batches = spark.createDataFrame([
        (datetime.datetime(2024, 1, 1, 0, 0, 1), 5, 1, 10, 50), (datetime.datetime(2024, 1, 1, 0, 0, 59), 2, 0, 400000, None),
        (datetime.datetime(2024, 1, 1, 0, 1, 0), 0, 3, None, None),
    ], "load_tstamp timestamp, n_good long, n_bad long, latency_millis long, e2e_latency_millis long")
    periods = per_period(batches)
    got = [tuple(r)[1:5] for r in periods.sort("period_start").collect()]
    assert got == [(7, 1, 400000, 50), (0, 3, 0, None)]
    assert unhealthy(periods).count() == 1


def test_periods_without_batches_lag_ever_more(spark):
    """A source that stalls for three minutes, and one that never comes back."""
    batches = spark.createDataFrame([
        (datetime.datetime(2024, 1, 1, 0, 0, 30), 5, 0, 10_000, 50), (datetime.datetime(2024, 1, 1, 0, 4, 10), 1, 1, 2_000, None),
    ], "load_tstamp timestamp, n_good long, n_bad long, latency_millis long, e2e_latency_millis long")
    periods = every_period(per_period(batches), until=F.lit(datetime.datetime(2024, 1, 1, 0, 10, 0)))
    got = [(r["period_start"].minute, r["events_good"], r["events_bad"], r["latency_millis"]) for r in periods.sort("period_start").collect()]
    waits = [(m, 0, 0, 60_000 * (m + 1) - 20_000) for m in (1, 2, 3)] + [(m, 0, 0, 60_000 * (m + 1) - 248_000) for m in range(5, 11)]
    assert got == sorted([(0, 5, 0, 10_000), (4, 1, 1, 2_000), *waits])
    assert [r["period_start"].minute for r in unhealthy(periods).collect()] == [9, 10]
    assert every_period(per_period(batches.limit(0))).count() == 0 and every_period(per_period(batches)).count() == 5
