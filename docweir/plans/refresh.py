"""Extension: bring the tables of a folder up to date, by what has changed in it."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.operators.chunking import chunk_segments
from docweir.operators.keyed_table import KeyedTable
from docweir.plans.ingest import GRAPH_KEYS
from docweir.sources.files import scanned_files
from docweir.sources.parsers import Parser, parsed_segments
from docweir.storage import materialize

#: Tables beside the chunks that hold rows of single chunks, and their keys.
OF_CHUNKS = {"vector_points": ["chunk_id"]} | {t: keys for t, keys in GRAPH_KEYS.items() if "chunk_id" in keys}


def refresh(spark: SparkSession, input_dir: str | Path, output_dir: str, parser: str | list[Parser] = "auto") -> dict[str, int]:
    """Update the keyed tables ``files`` and ``chunks`` under ``output_dir`` from a folder, and retire from all others what is gone.

    A file counts as changed if its size or time differ from those noted; only changed
    files are read and parsed. Chunks that a changed file no longer gives, and those of
    files that are gone or empty now, leave the table; of ``OF_CHUNKS``, tables that are
    there lose the rows of chunk_ids that no file gives any more. Files are noted last, so
    a run that fails half-way is made good by the next. The result says how many files
    were changed and gone, and how many chunks were written and retired.
    """
    files = KeyedTable(spark, f"{output_dir}/files", ["path"])
    chunks = KeyedTable(spark, f"{output_dir}/chunks", ["path", "chunk_index"])
    listed = materialize(scanned_files(spark, input_dir).select("path", "modified", "length"), "refresh-listed")
    known = files.read() if files.exists() else listed.limit(0)
    changed = materialize(listed.join(known, ["path", "modified", "length"], "left_anti"), "refresh-changed")
    gone = materialize(known.join(listed, "path", "left_anti").select("path"), "refresh-gone")
    since = changed.agg(F.min("modified")).first()[0]
    counts = {"changed": changed.count(), "gone": gone.count(), "written": 0, "retired": 0}
    if not counts["changed"] and not counts["gone"]:
        return counts
    new = None
    if since is not None:
        # The time is pushed to the scan, so older files aren't opened.
        contents = scanned_files(spark, input_dir).where(F.col("modified") >= F.lit(since)).join(changed.select("path"), "path", "left_semi")
        new = materialize(chunk_segments(parsed_segments(contents.select("path", "content"), parser)), "refresh-chunks")
        counts["written"] = new.count()
    if chunks.exists():
        stale = chunks.read().join(changed.select("path").union(gone), "path", "left_semi").select("path", "chunk_index", "chunk_id")
        if new is not None:
            stale = stale.join(new, ["path", "chunk_index"], "left_anti")
        stale = materialize(stale, "refresh-stale")
        counts["retired"] = stale.count()
        if counts["retired"]:
            chunks.delete(stale)
    if counts["written"]:
        chunks.upsert(new)
    if counts["retired"]:
        retire(spark, output_dir, stale.select("chunk_id").distinct().join(chunks.read(), "chunk_id", "left_anti"))
    if counts["gone"]:
        files.delete(gone)
    files.upsert(changed)
    for table in (files, chunks):
        table.compact()
        table.vacuum()
    return counts


def retire(spark: SparkSession, output_dir: str, chunk_ids: DataFrame) -> None:
    """Delete the rows of some chunks from the tables of ``OF_CHUNKS`` that are there."""
    for name, keys in OF_CHUNKS.items():
        table = KeyedTable(spark, f"{output_dir}/{name}")
        if table.exists():
            table.delete(table.read().join(chunk_ids, "chunk_id", "left_semi").select(*keys))
            table.compact()
