"""Calls of models from tasks: each distinct text is embedded once, each chunk is asked about once."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.functions.text import strip, text_or_empty
from docweir.operators.chunking import image_basis
from docweir.operators.extraction import prompt
from docweir.operators.keyed_table import KeyedTable
from docweir.operators.ontology import Ontology
from docweir.sources.providers import Embedder, Extractor
from docweir.storage import materialize


def embedding_cache(spark: SparkSession, path: str) -> KeyedTable:
    """Vectors of earlier requests, by model and hash of the text."""
    return KeyedTable(spark, path, ["model", "text_hash"])


def embedded(texts: DataFrame, embedder: Embedder, cache: KeyedTable | DataFrame | None = None) -> DataFrame:
    """(text_hash, vector) of the distinct values of column ``text``.

    A text that ``cache``, a table of such rows or a kept one, has a vector of isn't sent. The result is written once, so that a
    lost executor repeats no request of a finished table. A request that fails, or gives a
    vector of another length than the embedder's, ends the requests of its task, but not
    the job: what was answered goes into the cache first, then the failure is raised. So
    the same call again sends only what is missing.
    """
    distinct = texts.select(text_or_empty(F.col("text")).alias("text")).distinct().withColumn("text_hash", F.sha2("text", 256))
    kept = cache if isinstance(cache, KeyedTable) else None
    known = cache if kept is None else kept.read().where(F.col("model") == embedder.model) if kept.exists() else None
    if known is not None:
        known = known.select("text_hash", "vector")
        asked = materialize(distinct.select("text_hash"), "embedding-hashes")
        distinct = distinct.join(known.select("text_hash"), "text_hash", "left_anti")

    def run(batches):
        error = None
        step = max(1, embedder.batch_size)
        for batch in batches:
            # A request at a time: texts and vectors of a whole batch are never Python objects at once.
            for part in (batch.slice(k, step) for k in range(0, batch.num_rows, step)):
                try:
                    found = None if error else embedder.embed(part.column("text").to_pylist())
                    wrong = next((len(v) for v in found or [] if len(v) != embedder.dim), None)
                    if wrong is not None:
                        raise RuntimeError(f"a vector has {wrong} dimensions, not {embedder.dim}")
                except Exception as failure:  # told below, when what was answered is safe
                    found, error = None, f"{type(failure).__name__}: {failure}"
                vectors = pa.array(found or [None] * part.num_rows, pa.list_(pa.float64()))
                errors = pa.array([None if found else error] * part.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([part.column("text_hash"), vectors, errors], names=["text_hash", "vector", "error"])

    answered = materialize(distinct.mapInArrow(run, "text_hash string, vector array<double>, error string"), "embeddings")
    new = answered.where("error IS NULL").select("text_hash", "vector")
    if kept is not None:
        kept.upsert(new.withColumn("model", F.lit(embedder.model)))
        kept.compact()
    failed = answered.where("error IS NOT NULL").agg(F.count(F.lit(1)).alias("n"), F.min("error").alias("error")).first()
    if failed.n:
        raise RuntimeError(f"no vectors of {failed.n} texts: {failed.error}")
    return new if known is None else known.join(asked, "text_hash", "left_semi").union(new)


def dense_vectors(chunks: DataFrame, embedder: Embedder, cache: KeyedTable | DataFrame | None = None) -> DataFrame:
    """(chunk_id, dense_text, dense_image); an image's second vector is that of its reference and text."""
    basis = image_basis(F.col("modality"), F.col("asset_ref"), F.col("text"))
    named = chunks.select("chunk_id", text_or_empty(F.col("text")).alias("text"), text_or_empty(basis).alias("_basis"))
    vectors = embedded(named.select("text").union(named.select("_basis")), embedder, cache)
    hashed = named.select("chunk_id", F.sha2("text", 256).alias("_t"), F.sha2("_basis", 256).alias("_b"))
    as_text = vectors.select(F.col("text_hash").alias("_t"), F.col("vector").alias("dense_text"))
    as_image = vectors.select(F.col("text_hash").alias("_b"), F.col("vector").alias("dense_image"))
    return hashed.join(as_text, "_t").join(as_image, "_b").select("chunk_id", "dense_text", "dense_image")


def model_replies(chunks: DataFrame, extractor: Extractor, ontology: Ontology, require_success: bool = False) -> DataFrame:
    """(chunk_id, reply, model, error) of chunks with a text that is not blank, written once."""
    asked = chunks.withColumn("_prompt", prompt(chunks, ontology)).where(strip(F.col("text")) != "")

    def run(batches):
        for pdf in batches:
            replies = [extractor.reply(p, t) for p, t in zip(pdf["_prompt"], pdf["text"], strict=True)]
            if require_success and (failed := next((r for r in replies if r.error), None)):
                raise RuntimeError(f"all models failed: {failed.error}")
            yield pd.DataFrame(
                {"chunk_id": pdf["chunk_id"], "reply": [r.content for r in replies], "model": [r.model for r in replies], "error": [r.error for r in replies]}
            )

    return materialize(asked.select("chunk_id", "text", "_prompt").mapInPandas(run, "chunk_id string, reply string, model string, error string"), "replies")
