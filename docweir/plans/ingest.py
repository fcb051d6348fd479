"""The public ingest: files to chunks, vectors, graph tables and the merged vocabulary."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.config import EMBEDDING_DIM
from docweir.operators import graph
from docweir.operators.chunking import canonical_ids, chunk_segments, payload, payload_defaults
from docweir.operators.extraction import exploded, parsed_replies, typed_relations, valid_entities, valid_relations
from docweir.operators.models import dense_vectors, embedding_cache, model_replies
from docweir.operators.ontology import Ontology, build_ontology, load_ontology
from docweir.operators.keyed_table import KeyedTable
from docweir.operators.upsert import last_wins
from docweir.operators.vectors import ensure_collection, sparse_vectors
from docweir.sources.files import EXTENSIONS, read_listed_files
from docweir.sources.parsers import Parser, element_segments, parse_failures, parsed_elements
from docweir.sources.providers import Embedder, Extractor
from docweir.storage import materialize

GRAPH_KEYS = {
    "g_chunk": ["chunk_id", *graph.SCOPE],
    "g_document": ["doc_id", *graph.SCOPE],
    "g_has_chunk": ["doc_id", "chunk_id", *graph.SCOPE],
    "g_entity": ["label", "canonical_id", *graph.SCOPE],
    "g_mentions": ["chunk_id", "label", "canonical_id", *graph.SCOPE],
    "g_relation": ["src_label", "src", "rel_type", "tgt_label", "tgt", *graph.SCOPE],
}


@dataclass
class IngestResult:
    """The tables of a run and what it saw."""

    chunks: DataFrame
    vector_points: DataFrame
    tables: dict[str, DataFrame]
    entities: DataFrame
    relations: DataFrame
    ontology: dict
    totals: dict[str, int]
    failures: DataFrame

    def summary(self) -> str:
        t, o = self.totals, self.ontology
        hints = o.get("relation_hint_tokens") or {}
        return (
            f"[ontology-build] entities={len(o.get('allowed_entity_labels', []))} relations={len(o.get('allowed_relation_types', []))} "
            f"keywords_ko={len(hints.get('ko', []))} keywords_en={len(hints.get('en', []))}\n"
            f"[public-ingest] done chunks={t['chunks']} entities={t['entities']} relations={t['relations']}"
        )


def sequenced(chunks: DataFrame) -> DataFrame:
    """Chunks with ``seq``: files by extension and path, then chunks in order. It orders upserts."""
    suffix = F.substring_index("path", ".", -1)
    rank = F.coalesce(*[F.when(suffix == e, F.lit(k)) for k, e in enumerate(EXTENSIONS)], F.lit(len(EXTENSIONS)))
    return chunks.withColumn("seq", F.struct(rank.alias("kind"), F.col("path"), F.col("chunk_index")))


def vector_points(chunks: DataFrame, embedder: Embedder, created_at: str, cache: KeyedTable | None = None) -> DataFrame:
    """One row per chunk_id: payload and three vectors; of chunks with one id the last stays. Vectors of texts that ``cache`` has aren't asked for."""
    points = payload_defaults(payload(chunks, created_at), embedder.model)
    points = canonical_ids(points.withColumn("raw_chunk_id", F.col("chunk_id")))
    unique = last_wins(points, ["chunk_id"], ["seq"]).drop("seq", "raw_chunk_id")
    return unique.join(dense_vectors(unique, embedder, cache), "chunk_id").join(sparse_vectors(unique), "chunk_id")


def graph_tables(chunks: DataFrame, entities: DataFrame, relations: DataFrame, ontology: Ontology, scope: graph.Scope) -> dict[str, DataFrame]:
    g_chunk = graph.chunk_nodes(chunks, scope)
    return {
        "g_chunk": g_chunk.drop("seq"),
        "g_document": graph.document_nodes(chunks, scope).drop("seq"),
        "g_has_chunk": graph.has_chunk_edges(chunks, g_chunk, scope).drop("seq"),
        "g_entity": graph.entity_nodes(entities, relations, scope, ontology),
        "g_mentions": graph.mention_edges(entities, g_chunk, scope, ontology),
        "g_relation": graph.relation_edges(relations, scope, ontology),
    }


def run_ingest(
    spark: SparkSession,
    input_dir: str | Path,
    *,
    extractor: Extractor,
    embedder: Embedder,
    parser: str | list[Parser] = "auto",
    ontology_path: str | Path,
    created_at: str | None = None,
    scope: graph.Scope | None = None,
    output_dir: str | None = None,
) -> IngestResult:
    """Ingest all input files of a folder and merge what they show into the vocabulary file.

    Parsed elements, chunks, replies, and what is found in those are written once, since
    several tables read them and replies cost requests. Parsers that failed on a file are
    in ``failures``. With ``output_dir`` the tables are upserted into it.
    """
    created_at = created_at or datetime.now(timezone.utc).isoformat()
    scope = scope or graph.Scope(created_at=created_at)
    ontology = load_ontology(ontology_path)
    elements = materialize(parsed_elements(read_listed_files(spark, input_dir), parser), "elements")
    chunks = sequenced(materialize(chunk_segments(element_segments(elements)), "chunks"))
    # Chunks of files with one stem share ids; what is extracted from each counts, in order.
    numbered = chunks.withColumn("_key", F.concat_ws("|", "path", "chunk_index")).withColumn("_id", F.col("chunk_id"))
    replies = model_replies(numbered.withColumn("chunk_id", F.col("_key")), extractor, ontology)
    parsed = materialize(parsed_replies(replies), "extractions")
    places = numbered.select(F.col("_key").alias("chunk_id"), F.col("_id"), "seq")
    found = materialize(valid_entities(exploded(parsed, "entities"), ontology).where("confidence IS NOT NULL"), "entities-by-key")
    typed = typed_relations(valid_relations(exploded(parsed, "relations"), ontology).where("confidence IS NOT NULL"), found)
    entities, relations = (
        materialize(df.join(places, "chunk_id").withColumn("chunk_id", F.col("_id")).drop("_id"), name) for df, name in ((found, "entities"), (typed, "relations"))
    )
    tables = graph_tables(chunks, entities, relations, ontology, scope)
    cache = embedding_cache(spark, f"{output_dir}/embedding_cache") if output_dir else None
    points = vector_points(chunks, embedder, created_at, cache)
    merged = build_ontology(ontology_path, chunks, entities, relations)
    result = IngestResult(chunks, points, tables, entities, relations, merged, graph.run_totals(chunks, entities, relations).first().asDict(), parse_failures(elements))
    if output_dir:
        save(spark, result, output_dir)
    return result


def save(spark: SparkSession, result: IngestResult, output_dir: str) -> None:
    """Upsert a run's tables into keyed tables under a folder, and state the contract of the vectors beside them."""
    dims = result.vector_points.select(F.max(F.size("dense_text"))).first()[0]
    ensure_collection(spark, f"{output_dir}/vector_points.collection.json", dims or EMBEDDING_DIM)
    for name, df in {"vector_points": result.vector_points, **result.tables}.items():
        save_table(spark, df, f"{output_dir}/{name}", GRAPH_KEYS.get(name, ["chunk_id"]), graph.OPTIONAL if name == "g_entity" else None)


def save_table(spark: SparkSession, incoming: DataFrame, path: str, keys: list[str], sticky: list[str] | None = None, writer: str | None = None, batch: int | None = None) -> None:
    """Upsert ``incoming`` into the keyed table at a path: what is written is its rows, and ranges in which such rows have grown many."""
    table = KeyedTable(spark, path, keys, sticky)
    table.upsert(incoming.withColumn("updated_at", F.current_timestamp()), writer=writer, batch=batch)
    table.compact()
    table.vacuum()
