"""Snapshot tables: upserts, crashes, conflicts, the key index, versions."""

import random
from datetime import date

import pytest

from fleetlake.operators.sets import upsert
from fleetlake.session import scratch_path
from fleetlake.warehouse import snapshots

SCHEMA = "id int, d date, v double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(df):
    return sorted(((r.id, str(r.d), r.v) for r in df.collect()), key=repr)


@pytest.fixture
def table(spark):
    root = scratch_path(spark, "snapshot-test")
    snapshots.create(frame(spark, [(1, date(2024, 1, 5), 1.0), (2, date(2024, 1, 9), 2.0), (3, date(2024, 2, 2), 3.0), (4, date(2024, 3, 3), 4.0)]), root, "d", ["id"], buckets=8)
    return root


DELTA = [(1, date(2024, 2, 20), 10.0), (4, date(2024, 2, 21), 40.0), (5, date(2024, 4, 1), 5.0)]
MERGED = [(1, "2024-02-20", 10.0), (2, "2024-01-09", 2.0), (3, "2024-02-02", 3.0), (4, "2024-02-21", 40.0), (5, "2024-04-01", 5.0)]


def test_moved_rows_and_emptied_months(spark, table):
    entry = snapshots.merge(frame(spark, DELTA), table)
    assert content(snapshots.read(spark, table)) == MERGED
    assert sorted(entry["months"]) == ["2024-01", "2024-02", "2024-04"]  # March lost its only row
    assert content(snapshots.read(spark, table, months=["2024-04"])) == MERGED[-1:]
    snapshots.merge(frame(spark, DELTA), table)
    assert content(snapshots.read(spark, table)) == MERGED


def test_a_run_that_dies_leaves_the_table_as_it_was(spark, table, monkeypatch):
    before = content(snapshots.read(spark, table))
    write, commit = snapshots._write, snapshots._commit
    for step in range(3):
        calls = []

        def dies(*args, calls=calls, step=step, real=None):
            calls.append(1)
            if len(calls) > step:
                raise RuntimeError("executor lost")
            return write(*args)

        def no_commit(*args):
            raise RuntimeError("driver lost")

        # before the data, between data and index, before the manifest
        monkeypatch.setattr(snapshots, "_write", dies if step < 2 else write)
        monkeypatch.setattr(snapshots, "_commit", no_commit if step == 2 else commit)
        with pytest.raises(RuntimeError, match="lost"):
            snapshots.merge(frame(spark, DELTA), table)
        assert content(snapshots.read(spark, table)) == before
        assert snapshots.versions(spark, table) == [1]
    monkeypatch.setattr(snapshots, "_write", write)
    monkeypatch.setattr(snapshots, "_commit", commit)
    snapshots.merge(frame(spark, DELTA), table)
    assert content(snapshots.read(spark, table)) == MERGED
    assert snapshots.vacuum(spark, table) == 2  # what the dead runs had written
    assert content(snapshots.read(spark, table)) == MERGED


def test_of_two_loads_at_once_one_fails(spark, table, monkeypatch):
    commit = snapshots._commit

    def late(spark_, root, entry):
        monkeypatch.setattr(snapshots, "_commit", commit)
        snapshots.merge(frame(spark_, [(9, date(2024, 5, 1), 9.0)]), root)
        commit(spark_, root, entry)

    monkeypatch.setattr(snapshots, "_commit", late)
    with pytest.raises(snapshots.Conflict):
        snapshots.merge(frame(spark, DELTA), table)
    assert 9 in {r.id for r in snapshots.read(spark, table).collect()}
    snapshots.merge(frame(spark, DELTA), table)
    assert content(snapshots.read(spark, table)) == [*MERGED, (9, "2024-05-01", 9.0)]
    with pytest.raises(snapshots.Conflict):
        snapshots.create(frame(spark, DELTA), table, "d", ["id"])


def test_a_run_is_applied_once(spark, table):
    first = snapshots.merge(frame(spark, DELTA), table, run="r1")
    again = snapshots.merge(frame(spark, [(1, date(2020, 1, 1), 0.0)]), table, run="r1")
    assert again == first and content(snapshots.read(spark, table)) == MERGED
    assert snapshots.merge(frame(spark, []), table, run="r2")["version"] == first["version"]


def test_only_touched_months_and_buckets_are_rewritten(spark, table):
    before = snapshots.manifest(spark, table)
    entry = snapshots.merge(frame(spark, [(3, date(2024, 2, 3), 33.0)]), table)
    assert entry["touched"] == ["2024-02"] and entry["read_buckets"] == 1
    assert entry["months"]["2024-01"] == before["months"]["2024-01"]
    assert sum(entry["index"][b] == p for b, p in before["index"].items()) == len(before["index"]) - 1


def test_the_index_knows_every_key(spark, table):
    snapshots.merge(frame(spark, DELTA), table)
    got = snapshots.find(spark, table, spark.createDataFrame([(i,) for i in range(8)], "id int"))
    assert {r.id: r.month_key for r in got.collect()} == {1: "2024-02", 2: "2024-01", 3: "2024-02", 4: "2024-02", 5: "2024-04"}


def test_versions_and_vacuum(spark, table):
    snapshots.merge(frame(spark, DELTA), table, run="a")
    snapshots.merge(frame(spark, [(2, date(2024, 1, 9), 22.0)]), table, run="b")
    assert {r.id: r.v for r in snapshots.read(spark, table, version=1).collect()} == {1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0}
    got = [(r.version, r.months, r.rewritten_months, r.run) for r in snapshots.history(spark, table).orderBy("version").collect()]
    assert got == [(1, 3, 3, None), (2, 3, 4, "a"), (3, 3, 1, "b")]
    snapshots.vacuum(spark, table, keep=1)
    assert snapshots.versions(spark, table) == [3]
    assert len(content(snapshots.read(spark, table))) == 5
    with pytest.raises(ValueError, match="no version"):
        snapshots.read(spark, table, version=1)


def test_null_keys_null_dates_and_repeated_keys(spark):
    root = scratch_path(spark, "snapshot-nulls")
    snapshots.create(frame(spark, [(None, date(2024, 1, 1), 1.0), (1, None, 2.0)]), root, "d", ["id"], buckets=3)
    snapshots.merge(frame(spark, [(None, date(2024, 2, 1), 5.0), (1, date(2024, 2, 2), 6.0), (1, date(2024, 2, 1), 7.0), (2, None, 8.0)]), root)
    assert content(snapshots.read(spark, root)) == sorted([(None, "2024-02-01", 5.0), (1, "2024-02-02", 6.0), (2, "None", 8.0)], key=repr)


def test_many_loads_equal_one_upsert_after_another(spark):
    rng = random.Random(7)
    root = scratch_path(spark, "snapshot-random")
    want = frame(spark, [(i, date(2024, 1 + i % 12, 1 + i % 28), float(i)) for i in range(300)])
    snapshots.create(want, root, "d", ["id"], buckets=4)
    for n in range(3):
        delta = frame(spark, [(i, date(2024, rng.randint(1, 12), rng.randint(1, 28)), float(1000 * n + i)) for i in rng.sample(range(400), 60)])
        want = upsert(want, delta, ["id"])
        snapshots.merge(delta, root)
    assert content(snapshots.read(spark, root)) == content(want)
