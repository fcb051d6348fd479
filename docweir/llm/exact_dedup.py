"""Exact deduplication by content hash, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweir.storage import materialize

#: The characters that do not count when texts are compared.
IGNORED = r"[\x20\x09-\x0D]+"
#: Marks in the filter of hashes that occur more than once: 8 MB, whatever the size of the input.
FILTER_BITS = 1 << 26


def normalized(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), IGNORED, "")


def content_hash(norm: Column) -> Column:
    """128 bits of the content."""
    return F.unhex(F.md5(norm))


def _preference() -> Column:
    """Sorts first the row that stays: most code points, smallest doc_id (null last)."""
    return F.struct(
        (-F.col("n_cp")).alias("neg_cp"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"
    )


def _groups(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min(_preference()).alias("best"), F.count(F.lit(1)).alias("group_size"))


def _mark() -> Column:
    """The mark of a hash, from 1 on; never null by its form, so that no filter for nulls computes the hash of a text once more."""
    return F.xxhash64("h").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1


def _possible_copies(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of (h, ...) whose hash occurs more than once, and a few others.

    The filter has one bit for each mark. It is broadcast, since its size is fixed; where
    very many hashes occur more than once it fills up and lets more rows through, but
    never holds one back that it should not.
    """
    repeated = groups.where("group_size > 1").select(_mark().alias("mark"))
    bitmap = repeated.groupBy(F.bitmap_bucket_number("mark").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("mark")).alias("_bits")
    )
    byte = F.conv(F.hex(F.expr("substring(_bits, CAST(_at DIV 8 AS int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("shiftright(_byte, CAST(_at % 8 AS int)) & 1")
    marked = texts.withColumn("_mark", _mark()).withColumns({"_bucket": F.bitmap_bucket_number("_mark"), "_at": F.bitmap_bit_position("_mark")})
    return marked.join(F.broadcast(bitmap), "_bucket").withColumn("_byte", byte).where(bit == 1).drop("_bucket", "_bits", "_mark", "_at", "_byte")


def exact_dedup(docs: DataFrame, hash128=content_hash, row_id: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row_id.

    Rows are grouped by a 128-bit hash of the normalized text. The texts of each hash that
    occurs more than once are compared by their bytes; a hash with more than one text (a
    collision) is resolved by the texts. A text moves only if a filter of fixed size says
    that its hash may occur again, and copies are summed before each shuffle, so a group's
    text moves once per task; the join back to the rows is a plain sort-merge join of
    hashes whose large partitions the engine can split: one group may hold any share of
    rows.

    Null texts count as empty and form one group with texts of white space only. Of rows
    with equal texts, code points and doc_id, exactly one stays. A null doc_id is the
    last choice; if its row stays, keep_id is null. Other columns are ignored, whatever
    their names. An empty table gives an empty result. ``row_id`` names a column that tells
    rows apart; without one, rows are numbered as they are scanned, which is of use only
    within the result. ``hash128`` is replaceable so that tests can force collisions.
    """
    number = F.monotonically_increasing_id() if row_id is None else F.col(row_id)
    source = docs.select(number.alias("row_id"), "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("norm", normalized(F.col("text")))
    rows = materialize(
        source.select(
            "row_id",
            "doc_id",
            F.char_length("text").alias("n_cp"),
            hash128(F.col("norm")).alias("h"),
            F.unhex(F.sha2("norm", 256)).alias("sha"),
        ),
        "exact-rows",
    )
    groups = materialize(_groups(rows, "h"), "exact-groups")
    collided = materialize(
        _possible_copies(source.select(hash128(F.col("norm")).alias("h"), "norm"), groups)
        .groupBy("h", "norm")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("n_texts"))
        .where("n_texts > 1")
        .select("h"),
        "exact-collisions",
    )
    plain = rows.join(groups, "h")
    if not collided.isEmpty():
        # Rows of collided hashes are taken from the texts anew, and no row of both scans meets another.
        clash = materialize(
            source.withColumn("h", hash128(F.col("norm")))
            .withColumn("n_cp", F.char_length("text"))
            .join(collided, "h", "left_semi")
            .select("row_id", "doc_id", "n_cp", "h", "norm", F.unhex(F.sha2("norm", 256)).alias("sha")),
            "exact-clashes",
        )
        split = clash.join(_groups(clash, "h", "norm"), ["h", "norm"]).drop("norm")
        plain = plain.join(collided, "h", "left_anti").unionByName(split)
    return plain.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "row_id",
    )
