"""Refreshing tables by what has changed in a folder."""

import os
from unittest import mock

import pytest
from pyspark.sql import functions as F

from docweir.operators.keyed_table import KeyedTable
from docweir.plans import refresh as plan
from docweir.plans.refresh import refresh


def texts(spark, out):
    return {(r.path, r.chunk_index): r.text for r in KeyedTable(spark, f"{out}/chunks").read().collect()}


def put(path, text, at):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    os.utime(path, (at, at))


def test_changed_files_retire_their_old_chunks(spark, tmp_path):
    inputs, out = tmp_path / "in", str(tmp_path / "out")
    long = " ".join(f"w{k}" for k in range(2500))
    put(inputs / "a.txt", long, 1000)
    put(inputs / "sub" / "a.md", "same stem", 1000)
    put(inputs / "b.txt", "bee", 1000)
    assert refresh(spark, inputs, out, "text") == {"changed": 3, "gone": 0, "written": 5, "retired": 0}
    first = texts(spark, out)
    assert len(first) == 5 and refresh(spark, inputs, out, "text") == {"changed": 0, "gone": 0, "written": 0, "retired": 0}
    # Tables beside the chunks: one row per chunk_id, and edges.
    ids = KeyedTable(spark, f"{out}/chunks").read().select("chunk_id").distinct()
    KeyedTable(spark, f"{out}/vector_points", ["chunk_id"]).upsert(ids.withColumn("v", F.lit(1)))
    edges = KeyedTable(spark, f"{out}/g_has_chunk", ["doc_id", "chunk_id", "tier", "farm_key"])
    edges.upsert(ids.select(F.lit("d").alias("doc_id"), "chunk_id", F.lit("public").alias("tier"), F.lit(None).cast("string").alias("farm_key"), F.lit("t").alias("created_at")))
    put(inputs / "a.txt", "short now", 2000)
    (inputs / "b.txt").write_text("")
    assert refresh(spark, inputs, out, "text") == {"changed": 1, "gone": 1, "written": 1, "retired": 3}
    assert texts(spark, out) == {("a.txt", 0): "short now", ("sub/a.md", 0): "same stem"}
    left = {r.chunk_id for r in KeyedTable(spark, f"{out}/vector_points").read().collect()}
    assert left == {"a#t0"} == {r.chunk_id for r in edges.read().collect()}


def test_only_changed_files_are_parsed_and_failures_are_made_good(spark, tmp_path):
    inputs, out = tmp_path / "in", str(tmp_path / "out")
    put(inputs / "a.txt", "one", 1000)
    put(inputs / "b.txt", "two", 3000)
    refresh(spark, inputs, out, "text")
    put(inputs / "a.txt", "uno", 2000)
    parsed = []
    whole = plan.parsed_segments

    def seen(files, parser):
        parsed.append({r.path for r in files.select("path").collect()})
        return whole(files, parser)

    with mock.patch.object(plan, "parsed_segments", seen), mock.patch.object(KeyedTable, "compact", side_effect=RuntimeError("lost")), pytest.raises(RuntimeError):
        refresh(spark, inputs, out, "text")
    with mock.patch.object(KeyedTable, "upsert", side_effect=RuntimeError("lost")), pytest.raises(RuntimeError):
        put(inputs / "b.txt", "dos", 4000)
        refresh(spark, inputs, out, "text")
    assert refresh(spark, inputs, out, "text")["changed"] == 1
    assert parsed == [{"a.txt"}] and texts(spark, out) == {("a.txt", 0): "uno", ("b.txt", 0): "dos"}
