"""From parsed segments to numbered chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweir.functions.text import blank_to_null, file_name, file_stem, strip, text_or_empty, words

CHUNK_TOKENS, CHUNK_OVERLAP = 1200, 100
#: Words in an element's category or class that tell its modality, in order of precedence.
CATEGORY_WORDS = {"table": ["table"], "image": ["image", "figure", "picture"], "formula": ["formula", "equation", "math"]}
CLASS_WORDS = {"table": ["table"], "image": ["picture", "figure", "image"], "formula": ["formula", "equation"]}
WHOLE = ("table", "image", "formula")


def modality(category: Column, known: dict[str, list[str]] = CATEGORY_WORDS) -> Column:
    """``text`` unless the lower-case category holds a word of another modality."""
    lowered = F.lower(text_or_empty(category))
    found = F.lit("text")
    for name, parts in reversed(known.items()):
        found = F.when(F.greatest(*[lowered.contains(p) for p in parts], F.lit(False)), name).otherwise(found)
    return found


def segment_text(text: Column, kind: Column, table_html: Column, latex: Column) -> Column:
    """Stripped text; an empty table is its HTML and an empty formula its LaTeX; null if nothing is there."""
    instead = F.when(kind == "table", blank_to_null(table_html)).when(kind == "formula", blank_to_null(latex))
    return F.coalesce(blank_to_null(text), instead)


def asset_ref(kind: Column, page: Column, position: Column) -> Column:
    """Where a segment other than text lies; ``position`` counts all elements, dropped ones too."""
    page_text = text_or_empty(page)
    place = F.when(page_text != "", F.concat(F.lit("page:"), page_text, F.lit("#idx:"), position)).otherwise(F.concat(F.lit("asset:"), position))
    return F.when(kind.isin(*WHOLE), place)


def window_count(n: Column, size: int, overlap: int) -> Column:
    """Windows over n tokens; the last is the first that reaches the end."""
    step = max(1, size - min(overlap, max(0, size - 1)))
    return F.when(n == 0, 0).when(n <= size, 1).otherwise(1 + F.ceil((n - size) / F.lit(step))).cast("int")


def chunk_segments(segments: DataFrame, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Chunks of segments (path, seg_ord, text, modality, asset_ref, table_html, formula_latex, image_b64).

    Text is cut into windows of ``size`` tokens that overlap; other modalities give one
    chunk. Chunks of a file are numbered through all its segments. Adds chunk_id,
    chunk_index and the file's name and stem. The numbering deals (path, seg_ord, count)
    by path, never texts, and its result is joined back by path and position, so that a
    file with very many segments doesn't gather their texts in one task. Segments are read
    twice for it, so they should be a written table. ``seg_ord`` tells a file's segments
    apart.
    """
    step = max(1, size - min(overlap, max(0, size - 1)))
    kept = segments.withColumn("text", strip(text_or_empty(F.col("text")))).where("text != ''")
    split = F.when(~F.col("modality").isin(*WHOLE), words(F.col("text")))
    n_chunks = F.coalesce(window_count(F.size(split), size, overlap), F.lit(1))
    before = Window.partitionBy("path").orderBy("seg_ord").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.select("path", "seg_ord", n_chunks.alias("_k")).withColumn("_seed", F.coalesce(F.sum("_k").over(before), F.lit(0)))
    part = F.slice("_words", F.col("_i") * step + 1, size)
    return (
        kept.join(starts, ["path", "seg_ord"])
        .withColumn("_words", split)
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .withColumn("text", F.coalesce(F.array_join(part, " "), F.col("text")))
        .withColumn("chunk_index", (F.col("_seed") + F.col("_i")).cast("int"))
        .select(
            F.concat(file_stem(F.col("path")), F.lit("#"), F.substring("modality", 1, 1), "chunk_index").alias("chunk_id"),
            "path",
            file_stem(F.col("path")).alias("doc_stem"),
            file_name(F.col("path")).alias("source_doc"),
            "seg_ord",
            "chunk_index",
            "text",
            "modality",
            "asset_ref",
            F.col("table_html").alias("table_html_ref"),
            F.col("formula_latex").alias("formula_latex_ref"),
            F.col("image_b64").alias("image_b64_ref"),
        )
    )


def chunk_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Windows of whole texts, one document a row: (key, chunk_id, chunk_index, n_tokens, text). No shuffle."""
    step = max(1, size - min(overlap, max(0, size - 1)))
    cut = docs.select(F.col(key), words(F.col(text)).alias("_words")).withColumn("_k", window_count(F.size("_words"), size, overlap))
    part = F.slice("_words", F.col("chunk_index") * step + 1, size)
    return (
        # An outer generator: for others the engine filters rows by their number of words, for which it splits all texts twice.
        cut.withColumn("chunk_index", F.explode_outer(F.when(F.col("_k") > 0, F.sequence(F.lit(0), F.col("_k") - 1))))
        .where("chunk_index IS NOT NULL")
        .select(
            key,
            F.concat(F.col(key).cast("string"), F.lit("#t"), "chunk_index").alias("chunk_id"),
            "chunk_index",
            F.size(part).alias("n_tokens"),
            F.array_join(part, " ").alias("text"),
        )
    )


def payload(chunks: DataFrame, created_at: str, tier: str = "public") -> DataFrame:
    """The payload of each chunk: one creation time for the whole run unless the chunk has its own."""
    source = F.coalesce(blank_to_null(F.col("source_doc")), file_name(F.col("path")))
    own_time = blank_to_null(F.col("created_at")) if "created_at" in chunks.columns else F.lit(None)
    ids = {c: source for c in ("source_doc", "source_doc_id", "doc_id", "canonical_doc_id")}
    return chunks.withColumns(
        ids
        | {
            "tier": F.lit(tier),
            "source_type": F.lit("document"),
            "canonical_chunk_id": F.col("chunk_id"),
            "modality": F.coalesce("modality", F.lit("text")),
            "created_at": F.coalesce(own_time, F.lit(created_at)),
        }
    )


def canonical_ids(points: DataFrame, raw: str = "raw_chunk_id") -> DataFrame:
    """Replace chunk_id, doc_id and their canonical forms by the first that is not blank of their sources."""
    given = {c: blank_to_null(F.col(c)) for c in ("chunk_id", "canonical_chunk_id", "canonical_doc_id", "source_doc_id", "source_doc", "doc_id")}
    raw_id = F.coalesce(strip(F.col(raw)), F.lit(""))
    chunk = F.coalesce(given["canonical_chunk_id"], given["chunk_id"], raw_id)
    named = [given[c] for c in ("canonical_doc_id", "source_doc_id", "source_doc", "doc_id")]
    doc = F.coalesce(*named, blank_to_null(F.substring_index(chunk, "#", 1)), raw_id)
    return points.withColumns(
        {
            "canonical_doc_id": doc,
            "canonical_chunk_id": chunk,
            "doc_id": F.coalesce(given["doc_id"], doc),
            "chunk_id": F.coalesce(given["chunk_id"], F.nullif(raw_id, F.lit("")), chunk),
        }
    )


def payload_defaults(points: DataFrame, embedding_model: str) -> DataFrame:
    """Normal modality and asset reference, and the columns that a payload may lack."""
    absent = {"embedding_model": F.lit(embedding_model)}
    absent |= {c: F.lit(None).cast("string") for c in ("table_html_ref", "image_b64_ref", "formula_latex_ref")}
    kind = F.lower(strip(F.coalesce(F.nullif(F.col("modality"), F.lit("")), F.lit("text"))))
    return points.withColumns(
        {"modality": kind, "asset_ref": blank_to_null(F.col("asset_ref"))} | {c: v for c, v in absent.items() if c not in points.columns}
    )


def image_basis(kind: Column, ref: Column, text: Column) -> Column:
    """The text that stands for an image when it is embedded."""
    has_ref = (kind == "image") & (text_or_empty(ref) != "")
    return F.when(has_ref, strip(F.concat(ref, F.lit("\n"), text_or_empty(text)))).otherwise(text)
