"""The reproducibility run: what the inputs give, as digests."""

from __future__ import annotations

from pathlib import Path
from typing import TextIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.operators.chunking import chunk_segments
from docweir.operators.extraction import exploded, parsed_replies, valid_entities, valid_relations
from docweir.operators.manifests import chunk_digests, repro_manifest, repro_rollup, stream_repro_manifest
from docweir.operators.models import model_replies
from docweir.operators.ontology import Ontology
from docweir.sources.files import list_input_files, read_listed_files
from docweir.sources.parsers import Parser, element_segments, parsed_elements
from docweir.sources.providers import Extractor
from docweir.storage import materialize


def extracted_digests(chunks: DataFrame, extractor: Extractor, ontology: Ontology) -> DataFrame:
    """Digests that cover what a model finds in each chunk. It is asked about the text alone, without modality or references."""
    keyed = chunks.withColumn("_key", F.concat_ws("|", "path", "chunk_index"))
    asked = keyed.select(F.col("_key").alias("chunk_id"), "text", F.lit("text").alias("modality"))
    parsed = materialize(parsed_replies(model_replies(asked, extractor, ontology)), "extractions")
    entities = valid_entities(exploded(parsed, "entities"), ontology).where("confidence IS NOT NULL")
    relations = valid_relations(exploded(parsed, "relations"), ontology).where("confidence IS NOT NULL")
    return chunk_digests(keyed, entities, relations, key="_key").drop("_key")


def repro_files(
    spark: SparkSession, input_dir: str | Path, parser: str | list[Parser] = "auto", extractor: Extractor | None = None, ontology: Ontology | None = None
) -> DataFrame:
    """(path, chunks, entities, relations, chunk_digests) of the files of a folder; with an extractor, digests cover entities and relations."""
    elements = materialize(parsed_elements(read_listed_files(spark, input_dir), parser), "elements")
    chunks = chunk_segments(element_segments(elements))
    if extractor is None:
        return repro_rollup(chunk_digests(chunks))
    return repro_rollup(extracted_digests(materialize(chunks, "chunks"), extractor, ontology or Ontology()))


def repro_run(
    spark: SparkSession, input_dir: str | Path, parser: str | list[Parser] = "auto", extractor: Extractor | None = None, ontology: Ontology | None = None
) -> dict:
    """The manifest of a folder."""
    files = repro_files(spark, input_dir, parser, extractor, ontology)
    return repro_manifest(files, input_dir, len(list_input_files(spark, input_dir)), extractor is not None)


def write_repro_run(
    spark: SparkSession, input_dir: str | Path, out: TextIO, parser: str | list[Parser] = "auto", extractor: Extractor | None = None, ontology: Ontology | None = None
) -> dict:
    """Write the manifest of a folder file by file, and return it without its files."""
    files = repro_files(spark, input_dir, parser, extractor, ontology)
    return stream_repro_manifest(files, input_dir, len(list_input_files(spark, input_dir)), out, extractor is not None)
