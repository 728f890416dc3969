"""Schemas that arrive while a loader runs, and columns whose names become the same."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway import load_lines, run_stream
from sluiceway.operators import registry as registry_module
from sluiceway.operators.entities import entity_versions
from sluiceway.operators.parse import parse_lines
from sluiceway.operators.registry import compile_registry, other_name, registry_from_rows, resolve
from sluiceway.sources import log, schemas, table
from sluiceway.sources.lines import text_stream
from sluiceway.sources.schemas import SchemaDirectory
from tests.conftest import ATOMIC, INT, entity, line, lines_of, schema, uri

NOW = datetime.datetime(2024, 6, 1, 12, tzinfo=datetime.timezone.utc)


def put(folder, name, version="1-0-0", doc=None, vendor="org.shop"):
    place = folder / vendor / name / "jsonschema"
    place.mkdir(parents=True, exist_ok=True)
    (place / version).write_text(doc or schema({"n": INT}, ["n"]))


class Clock:
    now = 0.0

    def __call__(self):
        return self.now


@pytest.fixture
def directory(spark, tmp_path):
    put(tmp_path / "schemas", "cart")
    clock = Clock()
    found = SchemaDirectory(spark, str(tmp_path / "schemas"), str(tmp_path / "registry"), clock=clock)
    found.ticks = clock
    return found


def uris(version):
    return sorted(r["uri"] for r in version.compiled.collect())


def test_versions_grow_with_the_directory(directory, tmp_path):
    first = directory.current()
    assert (first.number, uris(first)) == (0, [uri("cart")])
    put(tmp_path / "schemas", "cart", "1-0-1")
    second = directory.refresh(force=True)
    assert (second.number, uris(second)) == (1, [uri("cart"), uri("cart", "1-0-1")])
    assert uris(first) == [uri("cart")] == uris(directory.version(0))


def test_only_new_and_changed_files_are_compiled(directory, tmp_path, monkeypatch):
    directory.current()
    read, real = [], schemas.registry_from_directory
    monkeypatch.setattr(schemas, "registry_from_directory", lambda spark, path: read.append(path) or real(spark, path))
    assert directory.refresh(force=True).number == 0 and not read
    put(tmp_path / "schemas", "cart", doc=schema({"n": {"type": "string"}}, ["n"]))
    put(tmp_path / "schemas", "item")
    put(tmp_path / "schemas", "no", "version")
    newest = directory.refresh(force=True)
    assert newest.number == 1 and len(read) == 1 and len(read[0]) == 3
    kinds = {r["uri"]: {n["name"]: n["kind"] for n in r["nodes"]} for r in newest.compiled.collect()}
    assert kinds == {uri("cart"): {None: "struct", "n": "string"}, uri("item"): {None: "struct", "n": "int"}}
    assert directory.refresh(force=True).number == 1 and len(read) == 1


def test_a_schema_stays_when_its_file_goes(directory, tmp_path):
    directory.current()
    (tmp_path / "schemas" / "org.shop" / "cart" / "jsonschema" / "1-0-0").unlink()
    put(tmp_path / "schemas", "item")
    assert uris(directory.refresh(force=True)) == [uri("cart"), uri("item")]


def test_looks_are_apart_in_time(directory, tmp_path):
    directory.current()
    put(tmp_path / "schemas", "item")
    directory.ticks.now = 59.0
    assert directory.refresh().number == 0
    directory.ticks.now = 61.0
    assert directory.refresh().number == 1


def test_loaders_share_versions(spark, directory, tmp_path, monkeypatch):
    other = SchemaDirectory(spark, directory.path, directory.root)
    directory.current()
    assert other.current().number == 0
    put(tmp_path / "schemas", "item")
    # Both see the new file; the second to put its version finds it taken, and nothing left to do.
    real, raced = log.store.put_if_absent, []

    def late(spark, path, text):
        if path.endswith(".json") and "_versions" in path and not raced:
            raced.append(path)
            directory.refresh(force=True)
        return real(spark, path, text)

    monkeypatch.setattr(log.store, "put_if_absent", late)
    assert other.refresh(force=True).number == 1 == directory.current().number
    assert uris(other.current()) == [uri("cart"), uri("item")]
    assert log.position(spark, f"{directory.root}/_versions").version == 1


def test_a_stream_uses_a_schema_added_while_it_runs(spark, directory, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "t")
    source.mkdir()
    (source / "1.txt").write_text(line("a", unstruct=entity("cart", {"n": 1})) + "\n" + line("b", unstruct=entity("item", {"n": 2})) + "\n")

    def send(failed, *_):
        # Between the first batch and the second.
        assert failed.count() == 1
        put(tmp_path / "schemas", "item")
        (source / "2.txt").write_text(line("c", unstruct=entity("item", {"n": 3})) + "\n")
        directory.ticks.now += 100

    query = run_stream(text_stream(spark, str(source)), root, directory, ATOMIC, str(tmp_path / "c"), exit_on_missing_schema=False, send_failed=send,
                       trigger={"processingTime": "100 milliseconds"})
    try:
        for _ in range(200):
            query.processAllAvailable()
            rows = {r["event_id"]: r for r in table.read_table(spark, root).collect()}
            if len(rows) == 2:
                break
    finally:
        query.stop()
    assert rows["a"]["unstruct_event_org_shop_cart_1"]["n"] == 1 and rows["c"]["unstruct_event_org_shop_item_1"]["n"] == 3


def test_before_stopping_the_directory_is_looked_at(spark, directory, tmp_path):
    directory.refresh(force=True)
    put(tmp_path / "schemas", "item")
    load_lines(lines_of(spark, line("b", unstruct=entity("item", {"n": 2}))), "b", str(tmp_path / "t"), directory, ATOMIC, NOW)
    assert table.read_table(spark, str(tmp_path / "t")).count() == 1


def test_a_higher_version_is_not_used_before_data_holds_it(spark, directory, tmp_path):
    """A new version of the registry drops what was resolved before, and columns still follow the data."""
    resolutions = {}
    load = lambda name, n, version: load_lines(
        lines_of(spark, line(name, unstruct=entity("cart", {"n": n}, version))), name, str(tmp_path / "t"), directory, ATOMIC, NOW, resolutions=resolutions)
    load("a", 1, "1-0-0")
    put(tmp_path / "schemas", "cart", "1-0-1", schema({"n": {"type": "string"}}, ["n"]))
    directory.refresh(force=True)
    state = load("b", 2, "1-0-0")
    assert [v for v, _ in resolutions] == [1] and len(state.owners) == 1
    state = load("c", "x", "1-0-1")
    assert set(state.owners) == {"unstruct_event_org_shop_cart_1", "unstruct_event_org_shop_cart_1_recovered_0_1"}


# Columns whose names become the same

TWINS = [
    (uri("pageView"), schema({"n": INT}, ["n"])),
    (uri("page_view"), schema({"n": {"type": "string"}}, ["n"])),
    (uri("page_view", "1-0-1"), schema({"n": INT}, ["n"])),
    (uri("item", "1-0-1"), schema({"n": INT}, ["n"])),
    (uri("item_1_0"), schema({"n": {"type": "string"}}, ["n"])),
]
VIEW, ITEM = "unstruct_event_org_shop_page_view_1", "unstruct_event_org_shop_item_1_0_1"
LEGACY = ["iglu:org.shop/item/jsonschema/*-*-*"]


@pytest.fixture(scope="module")
def twins(spark):
    return compile_registry(registry_from_rows(spark, TWINS))


def columns(spark, registry, *lines, **options):
    resolved = resolve(entity_versions(parse_lines(lines_of(spark, *lines), ATOMIC)), registry, **options)
    return {c.name: c.uris for c in resolved.columns}, resolved.owners


def camel(event_id="a"):
    return line(event_id, unstruct=entity("pageView", {"n": 1}))


def snake(event_id="b", version="1-0-0", n="x"):
    return line(event_id, unstruct=entity("page_view", {"n": n}, version))


def test_two_families_get_two_columns(spark, twins):
    found, owners = columns(spark, twins, camel(), snake())
    other = other_name(VIEW, owners[next(c for c in owners if c != VIEW)])
    assert found == {VIEW: (uri("pageView"),), other: (uri("page_view"),)}


def test_the_family_that_has_the_column_keeps_it(spark, twins):
    _, owners = columns(spark, twins, snake())
    found, later = columns(spark, twins, camel(), snake(), owners=owners)
    assert found[VIEW] == (uri("page_view"),) and len(found) == 2
    # The name of the other one is the same whoever comes first or alone.
    alone, _ = columns(spark, twins, camel(), owners=owners)
    assert set(alone) == set(found) - {VIEW} and later[VIEW] == owners[VIEW]


def test_a_recovery_follows_the_name_of_its_family(spark, twins):
    _, owners = columns(spark, twins, camel())
    found, _ = columns(spark, twins, snake(), snake("c", "1-0-1", 2), owners=owners)
    base = next(c for c, of in found.items() if of == (uri("page_view"),))
    assert base != VIEW and found[f"{base}_recovered_0_1"] == (uri("page_view", "1-0-1"),)


def test_legacy_comes_first(spark, twins):
    found, _ = columns(spark, twins, line(unstruct=entity("item", {"n": 1}, "1-0-1")), line(unstruct=entity("item_1_0", {"n": "x"})), legacy_schemas=LEGACY)
    assert found[ITEM] == (uri("item", "1-0-1"),) and len(found) == 2


def test_no_value_displaces_another(spark, twins, tmp_path):
    root = str(tmp_path)
    load_lines(lines_of(spark, snake("b")), "b-0", root, twins, ATOMIC, NOW)
    state = load_lines(lines_of(spark, camel("a"), snake("c", n="y")), "b-1", root, twins, ATOMIC, NOW)
    other = next(c for c in state.owners if c != VIEW)
    rows = {r["event_id"]: (r[VIEW] and r[VIEW]["n"], r[other] and r[other]["n"]) for r in table.read_table(spark, root).collect()}
    assert rows == {"b": ("x", None), "c": ("y", None), "a": (None, 1)}
    assert table.load_state(spark, root).owners == state.owners


def test_a_loader_that_was_too_late_takes_another_name(spark, twins, tmp_path):
    root = str(tmp_path)
    initial = table.create_if_missing(spark, root, table.initial_schema(ATOMIC))
    load_lines(lines_of(spark, snake("b")), "b-0", root, twins, ATOMIC, NOW, known=initial)
    late = load_lines(lines_of(spark, camel("a")), "b-1", root, twins, ATOMIC, NOW, known=initial, resolutions={})
    other = next(c for c in late.owners if c != VIEW)
    rows = {r["event_id"]: (r[VIEW] is None, r[other] is None) for r in table.read_table(spark, root).collect()}
    assert rows == {"a": (True, False), "b": (False, True)}


def test_owners_are_in_snapshots(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(log, "SNAPSHOT_EVERY", 2)
    root, kind = str(tmp_path), T.StructType([T.StructField("n", T.LongType())])
    state = table.create_if_missing(spark, root, T.StructType([T.StructField("a", T.StringType())]), NOW)
    for i in range(5):
        state = table.evolve(spark, root, state, [T.StructField(f"x{i}", kind)], now=NOW, owners={f"x{i}": f"family {i}"})
    log.forget(spark, f"{root}/schema_log")
    assert table.load_state(spark, root) == state and state.owners == {f"x{i}": f"family {i}" for i in range(5)}


def test_a_table_without_owners_gets_them(spark, tmp_path):
    root, x = str(tmp_path), T.StructField("x", T.LongType())
    state = table.create_if_missing(spark, root, T.StructType([x]), NOW)
    state = table.evolve(spark, root, state, [x], now=NOW, owners={"x": "one"})
    assert state.owners == {"x": "one"} and table.evolve(spark, root, state, [x], now=NOW, owners={"x": "one"}).version == state.version
    late = table.evolve(spark, root, state, [x], now=NOW, owners={"x": "two"})
    assert late == state and not late.yields({"x": "two"})


def test_levels_of_the_walk_are_released(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    compiled = registry_module.compile_registry(registry_from_rows(spark, TWINS))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before + 1
    compiled.unpersist()
