"""Keyed tables: results, what a change writes, failures between the steps, and writers that meet."""

import os
import random
from pathlib import Path
from unittest import mock

import pytest
from pyspark.sql import functions as F

from docweir.operators import keyed_table
from docweir.operators.keyed_table import Conflict, KeyedTable

SCHEMA = "k string, tier string, v long, note string"


def rows(spark, *given):
    return spark.createDataFrame(list(given), SCHEMA)


def content(table):
    return {(r.k, r.tier): (r.v, r.note) for r in table.read().collect()}


def size_of(path, since=frozenset()):
    return sum(p.stat().st_size for p in Path(path).rglob("*") if p.is_file() and p not in since)


def test_changes_against_a_dict(spark, tmp_path):
    rnd = random.Random(1)
    table = KeyedTable(spark, str(tmp_path / "t"), ["k", "tier"], ["note"])
    expected = {}
    with mock.patch.object(keyed_table, "RANGE_ROWS", 5), mock.patch.object(keyed_table, "MAX_DELTAS", 2):
        for step in range(9):
            if step % 4 == 3:
                gone = {(f"k{rnd.randrange(40)}", rnd.choice(["a", None])) for _ in range(8)}
                table.delete(spark.createDataFrame([(*g, 1) for g in gone], "k string, tier string, extra int"))
                for g in gone:
                    expected.pop(g, None)
            else:
                batch = [(f"k{rnd.randrange(40)}", rnd.choice(["a", None]), rnd.randrange(99), rnd.choice(["", None, "x", "y"])) for _ in range(30 if step == 0 else 6)]
                table.upsert(rows(spark, *batch).withColumn("at", F.lit(step)).withColumn("s", F.monotonically_increasing_id()), ["s"])
                last, given = {}, {}
                for k, tier, v, note in batch:
                    last[k, tier] = v
                    given[k, tier] = note or given.get((k, tier))
                for key, v in last.items():
                    expected[key] = (v, given[key] or expected.get(key, (None, None))[1])
            assert content(table) == expected
            if step % 2:
                table.compact(max_deltas=1)
                assert content(table) == expected
        table.compact(max_share=0.0)
        state = table.state()
        assert content(table) == expected and all(s.base for s in state.segments) and state.bits > 0
        table.vacuum(1, 0)
        assert content(table) == expected and len(list((tmp_path / "t" / "data").iterdir())) == len(state.segments)


def test_a_small_batch_writes_little(spark, tmp_path):
    path = str(tmp_path / "t")
    table = KeyedTable(spark, path, ["k"])
    many = spark.range(100_000).selectExpr("CAST(id AS string) AS k", "id AS v", "sha2(CAST(id AS string), 256) AS text")
    table.upsert(many)
    table.compact()
    table.vacuum(1, 0)
    before, whole = frozenset(Path(path).rglob("*")), size_of(path)
    table.upsert(many.where("v % 1000 = 7").withColumn("v", F.lit(-1).cast("long")))
    table.compact()
    assert size_of(path, before) < whole / 100
    got = table.read()
    assert got.count() == 100_000 and got.where("v = -1").count() == 100 and got.where("v >= 0").count() == 99_900


def test_compaction_reads_and_writes_the_ranges_that_are_due(spark, tmp_path):
    with mock.patch.object(keyed_table, "RANGE_ROWS", 500):
        table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
        first = spark.range(4000).selectExpr("CAST(id AS string) AS k", "id AS v")
        table.upsert(first)
        state = table.compact()
        assert state.bits == 3 and [s.base for s in state.segments] == [True]
        token = F.shiftrightunsigned(F.xxhash64("k"), 1)
        one_range = first.where(F.shiftrightunsigned(token, 60) == 5).withColumn("v", -F.col("v"))
        table.upsert(one_range)
        state = table.compact()
        new = next(s for s in state.segments if set(s.rows) == {5})
        assert new.base and new.rows[5] == one_range.count() and len(state.segments) == 2
        assert sorted(r for s in state.segments for r in s.rows) == list(range(8))
        assert table.read().agg(F.count("*"), F.sum("v")).first() == (4000, sum(range(4000)) + 2 * one_range.agg(F.sum("v")).first()[0])


@pytest.mark.parametrize("action", ["upsert", "delete", "compact"])
@pytest.mark.parametrize("step", ["_write", "_commit"])
def test_failures_between_steps_leave_the_table_as_it_was(spark, tmp_path, action, step):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k", "tier"], ["note"])
    table.upsert(rows(spark, ("a", "x", 1, "n"), ("b", None, 2, "m")))
    table.upsert(rows(spark, ("a", "x", 3, ""), ("c", "x", 4, "")))
    before = content(table)
    act = {"upsert": lambda: table.upsert(rows(spark, ("a", "x", 9, "z"))), "delete": lambda: table.delete(rows(spark, ("a", "x", 0, ""))), "compact": table.compact}[action]
    whole = getattr(KeyedTable, step)

    def failing(self, *args, **kwargs):
        if step == "_write":
            whole(self, *args, **kwargs)  # files are there, and nobody knows of them
        raise RuntimeError("lost")

    with mock.patch.object(KeyedTable, step, failing), pytest.raises(RuntimeError):
        act()
    assert content(table) == before
    act()
    after = content(table)
    assert after == {"upsert": before | {("a", "x"): (9, "z")}, "delete": {k: v for k, v in before.items() if k != ("a", "x")}, "compact": before}[action]
    assert len(table.vacuum(1, 0)) >= 1 and content(table) == after


def test_writers_that_meet_take_turns(spark, tmp_path):
    path = str(tmp_path / "t")
    table, other = KeyedTable(spark, path, ["k", "tier"]), KeyedTable(spark, path, ["k", "tier"])
    table.upsert(rows(spark, ("a", "x", 1, "")))
    stale = table.state()
    other.upsert(rows(spark, ("b", "x", 2, "")))
    with pytest.raises(Conflict):
        table._commit(keyed_table.replace(stale, version=stale.version + 1))
    # A writer that saw the older version appends to the newer one.
    whole, met = KeyedTable._commit, []

    def late(self, state):
        if not met:
            met.append(True)
            other.upsert(rows(spark, ("c", "x", 3, "")))
        whole(self, state)

    with mock.patch.object(KeyedTable, "_commit", late):
        table.upsert(rows(spark, ("d", "x", 4, "")))
    assert {k for k, _ in content(table)} == {"a", "b", "c", "d"}
    # A compaction that was overtaken by appends keeps them; one that was overtaken by another gives way.
    met.clear()
    with mock.patch.object(KeyedTable, "_commit", late):
        table.compact()
    assert {k for k, _ in content(table)} == {"a", "b", "c", "d"}
    version = table.state().version
    old = [s for s in table.state().segments]
    other.compact()
    overtaken = keyed_table.replace(stale, segments=[*old[:0], *stale.segments])
    assert table._replaced(overtaken, list(stale.segments), {0}, True).version == other.state().version >= version
    assert {k for k, _ in content(table)} == {"a", "b", "c", "d"}


def test_readers_keep_their_version(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k", "tier"])
    with pytest.raises(ValueError):
        table.read()
    table.upsert(rows(spark, ("a", "x", 1, "")))
    old, version = table.read(), table.state().version
    table.upsert(rows(spark, ("a", "x", 2, "")).withColumn("more", F.lit("m")))
    table.compact()
    table.vacuum(3, 0)
    assert old.first().v == 1 and table.read(version).first().v == 1 and table.read().first().more == "m"
    # What was replaced a moment ago stays, however old its files are, until its time is over.
    for segment in (tmp_path / "t" / "data").iterdir():
        os.utime(segment, (1, 1))
    assert table.vacuum(1) == [] and table.read(version).first().v == 1
    assert len(table.vacuum(1, 0)) >= 1 and table.versions() == [table.state().version] and table.read().count() == 1


def test_a_batch_counts_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k", "tier"])
    for _ in range(2):
        table.upsert(rows(spark, ("a", "x", 1, "")), writer="s", batch=0)
    table.upsert(rows(spark, ("a", "x", 5, "")))
    table.upsert(rows(spark, ("a", "x", 1, "")), writer="s", batch=0)
    table.upsert(rows(spark).limit(0), writer="s", batch=1)
    assert content(table) == {("a", "x"): (5, "")} and table.state().applied == {"s": 1}
