"""From raw documents to packed training sequences, in five stages.

What holds for every stage: a null text counts as empty, texts of any length are read
whole, repeated rows and equal doc_ids are documents of their own, nulls in other columns
and columns of any name, such as those that operators use inside, pass through as they
are, and an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.llm.exact_dedup import exact_dedup
from docweir.llm.packing import pack_documents
from docweir.llm.quality import fit_quality, quality_scores
from docweir.llm.simhash import first_of_each_group
from docweir.llm.similar_texts import similar_groups
from docweir.llm.toxicity import fit_toxicity, toxicity_scores
from docweir.storage import materialize


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The raw documents and their labels, which the classifiers learn from."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def _packed(docs: DataFrame) -> Column:
    """All columns of a document as one, out of the way of other names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")


def _text_scores(docs: DataFrame, score, model) -> DataFrame:
    """(doc, text, score, predicted) of every document."""
    return score(docs.select(_packed(docs), "text"), model)


def _numbered(docs: DataFrame) -> DataFrame:
    """(row_id, doc): every row under a number of its own, which is fixed by being written."""
    return materialize(docs.select(F.monotonically_increasing_id().alias("row_id"), _packed(docs)), "pipeline-numbered")


def _kept(numbered: DataFrame, row_ids: DataFrame) -> DataFrame:
    """The documents whose numbers are given."""
    return numbered.join(row_ids.select("row_id").hint("shuffle_hash"), "row_id", "left_semi").select("doc.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; a text without words has the score of an empty one.

    Where labels are missing, or all alike, nothing tells documents apart and all stay.
    """
    model = fit_quality(*_labelled(spark, sf_dir))
    return docs if model.center is None else _text_scores(docs, quality_scores, model).where("predicted = 1").select("doc.*")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't flag; a text without words has the score of an empty one.

    Where labels are missing, or all alike, nothing tells documents apart and all stay.
    """
    model = fit_toxicity(*_labelled(spark, sf_dir))
    return docs if model.weights is None else _text_scores(docs, toxicity_scores, model).where("predicted = 0").select("doc.*")


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal without white space: most code points, then smallest doc_id (null last).

    Of ties one stays. Empty texts are one group.
    """
    numbered = _numbered(docs)
    found = exact_dedup(numbered.select("row_id", "doc.doc_id", "doc.text"), row_id="row_id")
    return _kept(numbered, found.where("kept"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id (null last) of each group of near-duplicates: shingles of five words, linked at a similarity of 0.8 or more.

    Texts without words are one group; of ties one document stays.
    """
    numbered = _numbered(docs)
    groups = similar_groups(numbered.select("row_id", "doc.doc_id", "doc.text"), row_id="row_id")
    return _kept(numbered, first_of_each_group(groups))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all remaining documents in sequences. A text without tokens has a row without a bin; a null source conflicts with nothing."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("best_fit_packing", packing_stage),
]

#: Trained classifiers, fingerprints and packing have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
