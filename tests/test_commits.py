"""The commit log: crashes, re-runs, several writers, zone maps and compaction."""

import datetime
import json
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway import load_lines, run_stream
from sluiceway.sources import log, store, table
from sluiceway.sources.lines import text_stream
from tests.conftest import ATOMIC, entity, line, lines_of

UTC = datetime.timezone.utc
NOW = datetime.datetime(2024, 6, 1, 12, 0, tzinfo=UTC)


def load(spark, root, registry, batch_id, *lines, at=NOW, **options):
    return load_lines(lines_of(spark, *lines), batch_id, str(root), registry, ATOMIC, at, **options)


def ids(spark, root, **options):
    return sorted(r["event_id"] for r in table.read_table(spark, str(root), **options).collect())


def failed(spark, root):
    return table.read_failed(spark, str(root)).count()


STEPS = ("put_rows", "put_failed", "commit_batch", "_zones")


@pytest.mark.parametrize("step", [*STEPS, "move_into", "put_if_absent", "after commit"])
def test_a_crash_leaves_the_old_or_the_new_batch_whole(spark, registry, tmp_path, monkeypatch, step):
    """Whatever step fails, before or after it has done its work, readers see one attempt only; running again gives the new one."""
    load(spark, tmp_path, registry, "b-0", line("a"), line("b"), "bad")
    old, new = (["a", "b"], 1), (["c"], 2)
    again = (line("c"), "worse", "worst")

    class Crash(RuntimeError):
        pass

    for late in (False, True):
        with monkeypatch.context() as m:
            home = store if step in ("move_into", "put_if_absent") else table
            name = "commit_batch" if step == "after commit" else step
            real = getattr(home, name)

            def crashing(*args, **options):
                if late or step == "after commit":
                    real(*args, **options)
                raise Crash

            m.setattr(home, name, crashing)
            with pytest.raises(Crash):
                load(spark, tmp_path, registry, "b-0", *again, at=NOW + datetime.timedelta(days=1))
        committed = step == "after commit" or (late and step in ("commit_batch", "put_if_absent"))
        assert (ids(spark, tmp_path), failed(spark, tmp_path)) == (new if committed else old)
        counts = [(r["n_good"], r["n_bad"]) for r in table.read_metrics(spark, str(tmp_path)).collect()]
        assert counts == [(1, 2) if committed else (2, 1)]
        if committed:
            break
    load(spark, tmp_path, registry, "b-0", *again, at=NOW + datetime.timedelta(days=1))
    assert (ids(spark, tmp_path), failed(spark, tmp_path)) == new


def test_any_batch_id_takes_only_its_own(spark, registry, tmp_path):
    """Ids are no patterns and no paths."""
    for batch, event in (("day-1", "a"), ("day-2", "b"), ("day-*", "c"), ("../{x}", "d"), ("day-*", "e")):
        load(spark, tmp_path, registry, batch, line(event))
    assert ids(spark, tmp_path) == ["a", "b", "d", "e"]


def test_streams_with_other_checkpoints_keep_both(spark, registry, tmp_path):
    for n in "12":
        (tmp_path / f"in{n}").mkdir()
        (tmp_path / f"in{n}" / "x.txt").write_text(line(f"e{n}") + "\n")
        run_stream(text_stream(spark, str(tmp_path / f"in{n}")), str(tmp_path / "t"), registry, ATOMIC, str(tmp_path / f"c{n}"),
                   trigger={"availableNow": True}).awaitTermination()
    assert ids(spark, tmp_path / "t") == ["e1", "e2"]


def test_a_batch_that_is_empty_now_takes_back_what_it_had(spark, registry, tmp_path):
    load(spark, tmp_path, registry, "b-0", line("a"), "bad")
    load(spark, tmp_path, registry, "b-0")
    assert ids(spark, tmp_path) == [] and failed(spark, tmp_path) == 0


def test_writers_at_once_take_one_version_each(spark, tmp_path):
    folder, taken = str(tmp_path / "log"), []

    def write(name):
        for i in range(6):
            taken.append(log.commit(spark, folder, lambda version, i=i: json.dumps({"by": name, "n": i, "version": version})))

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(taken) == list(range(24))
    records = [json.loads(log.record(spark, folder, v)) for v in range(24)]
    assert [r["version"] for r in records] == list(range(24)) and len({(r["by"], r["n"]) for r in records}) == 24
    assert not [n for n in store.names(spark, folder) if n.startswith(".") and not n.endswith(".crc")]


def column(name):
    return T.StructField(name, T.StructType([T.StructField("k", T.LongType())]))


def test_loaders_in_threads_keep_each_others_columns(spark, tmp_path):
    root = str(tmp_path)
    first = table.create_if_missing(spark, root, T.StructType([T.StructField("a", T.StringType())]), NOW)
    states = {}

    def evolve(loader):
        states[loader] = first
        for i in range(5):
            states[loader] = table.evolve(spark, root, states[loader], [column(f"x_{loader}_{i}"), column("shared")], now=NOW)

    threads = [threading.Thread(target=evolve, args=(n,)) for n in "pq"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    expected = {"a", "shared", *[f"x_{n}_{i}" for n in "pq" for i in range(5)]}
    state = table.load_state(spark, root)
    assert set(state.schema.fieldNames()) == expected and len(state.schema.fieldNames()) == len(expected)
    assert state.version == 10


def test_a_state_is_read_from_a_snapshot_and_few_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(log, "SNAPSHOT_EVERY", 4)
    root = str(tmp_path)
    state = table.create_if_missing(spark, root, T.StructType([T.StructField("a", T.StringType())]), NOW)
    for i in range(10):
        state = table.evolve(spark, root, state, [column(f"x{i}")], now=NOW)
    reads, real = [], store.read_text
    monkeypatch.setattr(store, "read_text", lambda spark, path: reads.append(path) or real(spark, path))
    assert table.load_state(spark, root) == state and len(reads) <= 4
    log.forget(spark, f"{root}/schema_log")
    assert table.load_state(spark, root) == state and len(store.names(spark, f"{root}/schema_log")) <= 4


def test_the_index_goes_on_from_a_snapshot(spark, registry, tmp_path, monkeypatch):
    monkeypatch.setattr(log, "SNAPSHOT_EVERY", 3)
    for i in range(8):
        load(spark, tmp_path, registry, f"b-{i % 6}", line(f"e{i}"), f"bad{i}")
    root = str(tmp_path)
    at = log.position(spark, log.folder_of(root))
    assert (at.version, at.snapshot, at.later) == (7, 6, (7,))
    log.forget(spark, log.folder_of(root))
    assert ids(spark, root) == [f"e{i}" for i in range(2, 8)] and failed(spark, root) == 6
    assert sorted(r["batch_id"] for r in table.read_metrics(spark, root).collect()) == [f"b-{i}" for i in range(6)]


def test_reads_take_only_files_that_may_match(spark, registry, tmp_path):
    hours = [f"2024-05-01 {h:02d}:00:00.123" for h in range(4)]
    for i, (name, moment) in enumerate((n, t) for n in ("click", "view") for t in hours):
        load(spark, tmp_path, registry, f"b-{i}", line(f"e{i}", tstamp=moment, name=name))
    load(spark, tmp_path, registry, "none", line("x", name=""))
    root = str(tmp_path)
    pruned = table.read_table(spark, root, event_names=["view"], since=datetime.datetime(2024, 5, 1, 1, 0, 0, 123000, UTC), until=datetime.datetime(2024, 5, 1, 3, 0, 0, 123000, UTC))
    assert sorted(r["event_id"] for r in pruned.collect()) == ["e5", "e6"] and len(pruned.inputFiles()) == 2
    assert ids(spark, root, event_names=["absent"]) == [] and ids(spark, root, days=[]) == []
    assert len(table.read_table(spark, root, days=["2024-06-01"]).inputFiles()) == 9
    assert ids(spark, root, days=["2024-06-02"]) == []


def test_compaction_and_running_a_compacted_batch_again(spark, registry, tmp_path):
    """Many small batches become few files; a batch among them can still be replaced, on another day even."""
    root = str(tmp_path)
    for i in range(6):
        unstruct = entity("cart", {"itemCount": i}, "1-0-1" if i == 5 else "1-0-0")
        load(spark, tmp_path, registry, f"b-{i}", line(f"e{i}", name="click" if i % 2 else "view", unstruct=unstruct), f"bad{i}")
    before = sorted(table.read_table(spark, root).collect())
    assert table.compact(spark, root, "2024-06-01") == 6
    assert sorted(table.read_table(spark, root).collect()) == before
    assert len(table.read_table(spark, root).inputFiles()) == 1 and table.compact(spark, root, "2024-06-01") is None
    assert sorted(p.name for p in (tmp_path / "events").iterdir()) == ["load_date=2024-06-01"]
    load(spark, tmp_path, registry, "b-3", line("new"), at=NOW + datetime.timedelta(days=1))
    assert ids(spark, root) == ["e0", "e1", "e2", "e4", "e5", "new"] and failed(spark, root) == 5
    held = log.live_files(spark, root).where("kind = 'rows' AND size(batches) > 1").first()
    assert sorted(held["batches"]) == ["b-0", "b-1", "b-2", "b-4", "b-5"] and held["n_rows"] == 5 and (held["low_name"], held["high_name"]) == ("click", "view")
    assert table.vacuum(spark, root, ["2024-06-01", "2024-06-02"], datetime.timedelta(0)) >= 7
    assert ids(spark, root) == ["e0", "e1", "e2", "e4", "e5", "new"] and failed(spark, root) == 5


def test_compaction_gives_way_to_a_batch_that_runs_again(spark, registry, tmp_path, monkeypatch):
    root = str(tmp_path)
    for i in range(3):
        load(spark, tmp_path, registry, f"b-{i}", line(f"e{i}"))
    real, calls = table._settle, []

    def overtaken(*args):
        if not calls:
            calls.append(1)
            load(spark, tmp_path, registry, "b-1", line("new"))
        return real(*args)

    monkeypatch.setattr(table, "_settle", overtaken)
    assert table.compact(spark, root, "2024-06-01") is None
    assert ids(spark, root) == ["e0", "e2", "new"]


def test_put_once(spark, tmp_path):
    path = str(tmp_path / "a" / "b.json")
    assert store.put_if_absent(spark, path, "é 1") and not store.put_if_absent(spark, path, "2")
    assert store.read_text(spark, path) == "é 1" and store.names(spark, str(tmp_path / "none")) == []
    frame = spark.range(1, numPartitions=1).select(F.lit("x").alias("value"))
    frame.write.text(str(tmp_path / "staged"))
    moved = store.move_into(spark, str(tmp_path / "staged"), str(tmp_path / "to"), "p")
    assert [spark.read.text(p).first()[0] for p, _ in moved.values()] == ["x"]


@pytest.mark.parametrize("spread", [None, 2])
def test_measures_of_a_batch_are_those_of_all_its_rows(spark, registry, tmp_path, spread):
    """Observed while the good rows are written: unparseable lines count too, a batch of bad lines alone leaves no files of rows, an empty one nothing."""
    load(spark, tmp_path, registry, "b-0", line("a"), line("b"), "bad", spread=spread)
    load(spark, tmp_path, registry, "b-1", "worse", "worst", spread=spread)
    load(spark, tmp_path, registry, "b-2", spread=spread)
    found = {r["batch_id"]: r for r in table.read_metrics(spark, str(tmp_path)).collect()}
    size = len(line("a").encode()) + len(line("b").encode())
    assert {k: (r["n_events"], r["n_good"], r["n_bad"], r["n_bytes"]) for k, r in found.items()} == {"b-0": (3, 2, 1, size + 3), "b-1": (2, 0, 2, 10)}
    assert all(r["load_tstamp"].astimezone(UTC) == NOW for r in found.values())
    assert found["b-0"]["earliest_collector_tstamp"] is not None and found["b-1"]["earliest_collector_tstamp"] is None
    assert ids(spark, tmp_path) == ["a", "b"] and failed(spark, tmp_path) == 3


def test_a_batch_is_written_without_a_job_for_its_measures(spark, registry, tmp_path, monkeypatch):
    from sluiceway.streaming import loader

    def never(*args, **options):
        raise AssertionError("a job of its own")

    monkeypatch.setattr(loader, "batch_summary", never)
    load(spark, tmp_path, registry, "b-0", line("a"), "bad")
    assert ids(spark, tmp_path) == ["a"] and failed(spark, tmp_path) == 1
