"""Property-graph tables: nodes and edges as keyed upserts."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docweir.functions.text import graph_confidence, graph_id, once, relation_name, text_or_empty
from docweir.operators.ontology import FALLBACK_LABEL, Ontology
from docweir.operators.upsert import last_wins

#: Attributes of an entity that an empty value doesn't erase.
OPTIONAL = ["scientific_name", "growth_stage", "metric", "unit", "aliases_json", "symptom_keywords_json"]
SCOPE = ["tier", "farm_key"]


@dataclass
class Scope:
    """Whose graph rows belong to; only private rows are told apart by ``farm_id``."""

    tier: str = "public"
    farm_id: str = ""
    created_at: str = ""

    def columns(self) -> dict[str, Column]:
        farm = self.farm_id if self.tier == "private" else None
        return {"tier": F.lit(self.tier), "farm_key": F.lit(farm).cast("string"), "created_at": F.lit(self.created_at)}


def entity_label(value: Column, ontology: Ontology) -> Column:
    """An allowed label as it is, anything else the fallback."""
    stripped = text_or_empty(value)
    return F.when(stripped.isin(*ontology.labels), stripped).otherwise(FALLBACK_LABEL)


@F.pandas_udf(StringType())
def json_list(values):
    """A list as JSON with Python's separators; null gives null."""
    return values.map(lambda v: None if v is None else json.dumps([str(x) for x in v], ensure_ascii=False))


def chunk_nodes(chunks: DataFrame, scope: Scope) -> DataFrame:
    """g_chunk: the last row of each chunk_id by ``seq``."""
    source = F.coalesce("source_type", F.lit("document")) if "source_type" in chunks.columns else F.lit("document")
    rows = chunks.select("chunk_id", "text", source.alias("source_type"), "seq").withColumns(scope.columns())
    return last_wins(rows, ["chunk_id", *SCOPE], ["seq"])


def document_nodes(chunks: DataFrame, scope: Scope) -> DataFrame:
    """g_document: one per non-empty source_doc."""
    rows = chunks.where(text_or_empty(F.col("source_doc")) != "").select(F.col("source_doc").alias("doc_id"), "source_doc", "seq")
    return last_wins(rows.withColumns(scope.columns()), ["doc_id", *SCOPE], ["seq"])


def has_chunk_edges(chunks: DataFrame, g_chunk: DataFrame, scope: Scope) -> DataFrame:
    """g_has_chunk: from documents to those of their chunks that the graph has."""
    rows = chunks.where(text_or_empty(F.col("source_doc")) != "").select(F.col("source_doc").alias("doc_id"), "chunk_id", "seq")
    found = rows.join(_present(g_chunk, scope), "chunk_id", "left_semi").withColumns(scope.columns())
    return last_wins(found, ["doc_id", "chunk_id", *SCOPE], ["seq"])


def _present(g_chunk: DataFrame, scope: Scope) -> DataFrame:
    """The identifiers of the chunks that the graph has in a scope."""
    own = scope.columns()
    same = F.lit(True)
    for c in SCOPE:
        same = same & F.col(c).eqNullSafe(own[c])
    return g_chunk.where(same).select("chunk_id")


def _entity_rows(entities: DataFrame, scope: Scope, ontology: Ontology) -> DataFrame:
    """(keys, name, confidence, optional attributes that are given, chunk_id, seq, phase, ord) of entities with an identifier."""
    given = F.coalesce(F.nullif(F.col("canonical_id"), F.lit("")), F.col("text"))
    label = entity_label(F.coalesce(F.nullif(F.col("type"), F.lit("")), F.lit(FALLBACK_LABEL)), ontology)
    listed = {n: json_list(F.col(c)) for n, c in (("aliases_json", "aliases"), ("symptom_keywords_json", "symptom_keywords")) if c in entities.columns}
    identified = once(
        entities.withColumns(listed),
        label.alias("label"),
        graph_id(given).alias("canonical_id"),
        F.col("text").alias("name"),
        graph_confidence(F.col("confidence")).alias("confidence"),
        *[c for c in OPTIONAL if c in [*entities.columns, *listed]],
        "chunk_id",
        "seq",
        F.lit(0).alias("phase"),
        "ord",
    ).where("canonical_id != ''")
    return identified.withColumns({"name": F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("canonical_id"))} | scope.columns())


def _relation_rows(relations: DataFrame, scope: Scope, ontology: Ontology) -> DataFrame:
    def label(column: str) -> Column:
        return entity_label(F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(FALLBACK_LABEL)), ontology)

    return (
        once(
            relations,
            label("source_type").alias("src_label"),
            graph_id(F.col("source")).alias("src"),
            relation_name(F.coalesce(F.nullif(F.col("type"), F.lit("")), F.lit("MENTIONS"))).alias("rel_type"),
            label("target_type").alias("tgt_label"),
            graph_id(F.col("target")).alias("tgt"),
            graph_confidence(F.col("confidence")).alias("confidence"),
            text_or_empty(F.col("evidence")).alias("evidence"),
            "source_text",
            "target_text",
            "seq",
            F.lit(1).alias("phase"),
            "ord",
        )
        .where("src != '' AND tgt != ''")
        .withColumns(scope.columns())
    )


def entity_nodes(entities: DataFrame, relations: DataFrame, scope: Scope, ontology: Ontology) -> DataFrame:
    """g_entity from entities and from the endpoints of relations.

    Rows come in the order of their chunk (``seq``), entities before relations of a chunk
    (``phase``), then item (``ord``). An endpoint sets type, and name if it has a text;
    all else of an entity stays as it was.
    """
    full = _entity_rows(entities, scope, ontology).drop("chunk_id", "created_at")
    full = full.withColumn("ord", F.col("ord") * 2).withColumn("_made", F.lit(True))
    ends = _relation_rows(relations, scope, ontology)
    two = F.array(
        *[
            F.struct(F.col(label).alias("label"), F.col(key).alias("canonical_id"), F.col(name).alias("name"), (F.col("ord") * 2 + step).alias("ord"))
            for step, (label, key, name) in enumerate((("src_label", "src", "source_text"), ("tgt_label", "tgt", "target_text")))
        ]
    )
    stubs = ends.select(*SCOPE, "seq", "phase", F.inline(two))
    rows = full.unionByName(stubs, allowMissingColumns=True)
    given = [c for c in OPTIONAL if c in full.columns]
    nodes = last_wins(rows, ["label", "canonical_id", *SCOPE], ["seq", "phase", "ord"], keep=[], sticky=["name", "confidence", "_made", *given])
    # An endpoint that no entity names has no creation time; the type is the label, as every row has it.
    made = F.when(F.col("_made"), scope.columns()["created_at"])
    absent = {c: F.lit(None).cast("string") for c in OPTIONAL if c not in given}
    return nodes.withColumns({"type": F.col("label"), "created_at": made} | absent).drop("seq", "phase", "ord", "_made")


def mention_edges(entities: DataFrame, g_chunk: DataFrame, scope: Scope, ontology: Ontology) -> DataFrame:
    """g_mentions: from chunks that the graph has to the entities found in them."""
    rows = _entity_rows(entities, scope, ontology).where(text_or_empty(F.col("chunk_id")) != "")
    found = rows.join(_present(g_chunk, scope), "chunk_id", "left_semi")
    edges = last_wins(found, ["chunk_id", "label", "canonical_id", *SCOPE], ["seq", "ord"], keep=["confidence"]).drop("seq", "ord")
    return edges.withColumns({"evidence": F.lit("entity_extraction"), "created_at": scope.columns()["created_at"]})


def relation_edges(relations: DataFrame, scope: Scope, ontology: Ontology) -> DataFrame:
    """g_relation: typed edges between entities."""
    keys = ["src_label", "src", "rel_type", "tgt_label", "tgt", *SCOPE]
    rows = _relation_rows(relations, scope, ontology)
    edges = last_wins(rows, keys, ["seq", "ord"], keep=["confidence", "evidence"]).drop("seq", "ord")
    return edges.withColumn("created_at", scope.columns()["created_at"])


def run_totals(chunks: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """One row: chunks, entities, relations."""
    parts = None
    for k, df in enumerate((chunks, entities, relations)):
        one = df.select(*[F.lit(1 if k == j else 0).cast("bigint").alias(n) for j, n in enumerate(("chunks", "entities", "relations"))])
        parts = one if parts is None else parts.union(one)
    return parts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("chunks", "entities", "relations")])
