"""Token ids as ORC files: sorted by document, run-length encoded, with row indexes and Bloom filters."""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

from docweir.llm.batches import bounded
from docweir.llm.pieces import PieceTable, Vocabulary

#: Rows between two entries of the row index.
INDEX_STRIDE = 1000
STRIPE_BYTES = 16 << 20


@lru_cache(maxsize=2)
def library_table(vocabulary_path: str) -> PieceTable:
    """The table of a worker process, kept from task to task; the tokenizer library encodes new pieces.

    Pieces are already normalized and split, so they go to the library as one text with
    blanks between them. The last token of a piece is one with a word end, which tells
    the pieces apart again.
    """
    vocabulary = Vocabulary(vocabulary_path)
    if not vocabulary.word_end:
        raise ValueError("token files are written with a tokenizer that marks word ends")
    library = Tokenizer(Tokenizer.from_file(vocabulary_path).model)
    library.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
    ends_word = np.array([t.endswith(vocabulary.word_end) for t in vocabulary.tokens()])

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.array(library.encode(" ".join(pieces), add_special_tokens=False).ids, dtype=np.int32)
        return flat, np.diff(np.flatnonzero(ends_word[flat]) + 1, prepend=0)

    return PieceTable(vocabulary, encode)


def write_token_files(docs: DataFrame, vocabulary_path: str, path: str, end_id: int = 2, files: int | None = None) -> None:
    """Encode every whole text and write its ids, with ``end_id`` after them, as ORC.

    Columns: doc_id, part, pos, n_tokens, ids (int array, run-length encoded by the
    format). ``part`` ascends with doc_id over the files and ``pos`` counts the rows of a
    part, so (part, pos) is the global order: ascending doc_id, nulls first, equal ids in
    any order. Texts are range-partitioned before they are encoded, so that the range
    bounds come from the scan and each text is encoded once. Within a file the rows lie
    sorted, with row-index entries every ``INDEX_STRIDE`` rows and a Bloom filter on
    doc_id, which let readers skip stripes and row groups. A null text counts as empty:
    the end id alone. An empty table gives files without rows; repeated rows are written
    as often as they come; other columns are ignored. Memory is bounded by a part of a
    batch and the longest text.
    """
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        table = library_table(vocabulary_path)
        end = np.array([end_id], dtype=np.int32)
        pos = 0
        for batch in bounded(batches):
            rows = []
            for codes in table.codes(batch.column("text").to_pylist()):
                rows += [table.ids(codes), end]
            flat = np.concatenate(rows)
            lengths = np.fromiter(map(len, rows), dtype=np.int64).reshape(-1, 2).sum(axis=1)
            ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.array(flat))
            place = np.arange(pos, pos + len(lengths), dtype=np.int64)
            pos += len(lengths)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(place), pa.array(lengths), ids], names=["doc_id", "pos", "n_tokens", "ids"]
            )

    (
        docs.select("doc_id", "text")
        .repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(encode, f"doc_id {doc_type}, pos bigint, n_tokens bigint, ids array<int>")
        .select("doc_id", F.spark_partition_id().alias("part"), "pos", "n_tokens", "ids")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", str(INDEX_STRIDE))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("compression", "lz4")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The written rows; a condition on doc_id is pushed to the files' indexes and filters."""
    rows = spark.read.orc(path)
    return rows if where is None else rows.where(where)


def token_file_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` is the number of ids of all documents before. Only the n_tokens column is
    read for it: totals per part (one row each) give every part its start, and the rows
    of a part are summed in order within the part.
    """
    rows = read_token_files(spark, path)
    doc_type = rows.schema["doc_id"].dataType.simpleString()

    def checksum(batches):
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "part", "pos", "n_tokens")] + [pa.array(crc, pa.int64())],
                names=["doc_id", "part", "pos", "n_tokens", "ids_crc32"],
            )

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        rows.groupBy("part")
        .agg(F.sum("n_tokens").alias("total"))
        .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))
    )
    within = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.mapInArrow(checksum, f"doc_id {doc_type}, part int, pos bigint, n_tokens bigint, ids_crc32 bigint")
        .withColumn("inner_start", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(parts, "part")
        .select("doc_id", (F.col("part_start") + F.col("inner_start")).alias("start"), "n_tokens", "ids_crc32")
    )
