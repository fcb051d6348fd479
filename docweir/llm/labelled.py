"""Bounded samples of labelled documents, and the split that holds rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GRAIN = 1 << 30


def is_held_out() -> Column:
    """Rows whose crc32 of doc_id as text leaves 2 when divided by 4; a null doc_id is not held out."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def training_documents(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(y, part, text) of about ``bound`` labelled documents at most that are not held out.

    Which rows are taken depends on a hash of doc_id only. The sample of (doc_id, label)
    pairs is broadcast; its size is bounded by ``bound``. A doc_id with several labels
    takes the largest; null labels and null doc_ids don't count. ``part`` (0 to 3) splits
    the sample for steps that need rows of their own.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out()).select(
        "doc_id", F.col(label).cast("int").alias("y")
    )
    share = min(1.0, bound / max(known.count(), 1))
    picked = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(_GRAIN)) < int(share * _GRAIN)
    sample = known.where(picked).groupBy("doc_id").agg(F.max("y").alias("y"))
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .select("y", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)).cast("int").alias("part"), "text")
    )
