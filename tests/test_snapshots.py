import json

import pytest
from frames import got
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mercata.session import scratch_folder
from mercata.sources import snapshots, writers


@pytest.fixture
def store(spark):
    return snapshots.Store(spark, scratch_folder(spark, "store"))


def test_a_run_that_fails_while_it_writes_leaves_the_old_rows(spark, store, frame):
    old = frame("a INT, b STRING", [(1, "x"), (2, "y")])
    run = store.begin()
    run.replace("t", old)
    run.replace("u", old)
    assert store.tables() == [] and run.commit() == 1
    run = store.begin()
    run.replace("t", frame("a INT, b STRING", [(3, "z")]))
    broken = old.repartition(2).withColumn("b", F.when(F.col("a") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("b")))
    with pytest.raises(PySparkException, match="lost"):
        run.replace("u", broken)
    assert store.current() == 1
    assert got(store.read("t")) == got(store.read("u")) == [(1, "x"), (2, "y")]


def test_tables_of_a_run_appear_together_and_readers_keep_their_version(store, frame):
    first = store.begin()
    for t in ("t", "u"):
        first.replace(t, frame("a INT", [(1,)]))
    first.commit()
    bound = store.read("t")
    second = store.begin()
    for t in ("t", "u"):
        assert got(second.replace(t, frame("a INT", [(2,)]))) == [(2,)]
        assert got(store.read(t)) == [(1,)]
    assert second.commit() == 2
    assert got(store.read("t")) == got(store.read("u")) == [(2,)]
    assert got(bound) == got(store.read("t", 1)) == [(1,)]


def test_a_repeated_run_appends_once(store, frame):
    for run, rows in (("mon", [(1,)]), ("tue", [(2,), (2,)]), ("mon", [(1,), (3,)])):
        r = store.begin(run)
        r.append("log", frame("a INT", rows))
        r.commit()
    assert got(store.read("log")) == [(1,), (2,), (2,), (3,)]
    lost = store.begin("wed")
    lost.append("log", frame("a INT", [(9,)]))  # never committed
    again = store.begin("wed")
    again.append("log", frame("a INT", [(4,)]))
    again.append("log", frame("a INT", [(5,)]))
    again.commit()
    assert got(store.read("log")) == [(1,), (2,), (2,), (3,), (4,), (5,)]


def test_two_runs_at_once(store, frame):
    a, b, c = store.begin("a"), store.begin("b"), store.begin("c")
    a.replace("t", frame("x INT", [(1,)]))
    a.append("log", frame("x INT", [(1,)]))
    b.replace("u", frame("x INT", [(2,)]))
    b.append("log", frame("x INT", [(2,)]))
    c.replace("t", frame("x INT", [(3,)]))
    assert (a.commit(), b.commit()) == (1, 2)  # other tables: both stay
    assert store.tables() == ["log", "t", "u"] and got(store.read("log")) == [(1,), (2,)]
    with pytest.raises(snapshots.Conflict, match="t"):
        c.commit()
    assert got(store.read("t")) == [(1,)]


def test_a_taken_number_is_refused_by_the_file_system(store):
    name = f"{store.root}/manifests/{1:012d}.json"
    assert store.files.create(name, json.dumps({"version": 1, "run": "a", "tables": {}}))
    assert not store.files.create(name, "other")
    assert store.manifest(1)["run"] == "a"
    assert [n for n in store.files.children(f"{store.root}/manifests") if not n.endswith(".crc")] == [f"{1:012d}.json"]


def test_schema_may_grow_and_empty_tables_stay(store, frame):
    for rows in (frame("a INT", [(1,)]), frame("a INT, b STRING", [(2, "x")]), frame("a INT", [])):
        r = store.begin()
        r.append("log", rows)
        r.commit()
    assert got(store.read("log")) == [(1, None), (2, "x")]
    r = store.begin()
    r.replace("none", frame("a INT, d DATE", []))
    r.commit()
    assert store.read("none").dtypes == [("a", "int"), ("d", "date")] and store.read("none").count() == 0
    with pytest.raises(KeyError):
        store.read("absent")


def test_partitioned_tables_are_pruned(store, frame):
    r = store.begin()
    r.replace("t", frame("a INT, d STRING", [(i, f"2024010{i % 3}") for i in range(9)]), "d")
    r.commit()
    day = store.read("t").where("d = '20240101'")
    assert got(day) == [(1, "20240101"), (4, "20240101"), (7, "20240101")]
    assert "PartitionFilters: [isnotnull(d" in day._jdf.queryExecution().executedPlan().toString()


def test_expire_keeps_what_is_used_or_new(store, frame):
    for i in range(4):
        r = store.begin()
        r.replace("t", frame("a INT", [(i,)]))
        if not i:
            r.replace("k", frame("a INT", [(7,)]))
        r.commit()
    open_run = store.begin()
    open_run.replace("t", frame("a INT", [(9,)]))
    assert store.expire(2) == [] and store.versions() == [3, 4]  # folders are too new
    gone = store.expire(2, older_than=-60)
    assert len(gone) == 3 and got(store.read("t", 3)) == [(2,)] and got(store.read("t")) == [(3,)] and got(store.read("k")) == [(7,)]


def test_run_ids_are_names(store):
    with pytest.raises(ValueError):
        store.begin("a/b")


def test_full_refresh_versions(spark, frame):
    path = scratch_folder(spark, "one")
    assert [writers.full_refresh(frame("a INT", [(i,)]), path) for i in (5, 6)] == [1, 2]
    assert got(writers.read_table(spark, path)) == [(6,)] and got(writers.read_table(spark, path, 1)) == [(5,)]
