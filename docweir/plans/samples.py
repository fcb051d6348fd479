"""Inputs of the ingest operators made from the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Orders in one part, about.
ORDER_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines, dealt out by order before texts are made of them: a small table may be one row group, which one task reads."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus").repartition("l_orderkey")


def raw_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and suppliers as entities of the orders that name them; some types are not allowed."""
    lines, parts, suppliers = order_lines(spark, sf_dir), table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    kinds = F.array(*[F.lit(k) for k in ("crop", "Disease", "PEST", "Environment", "unknown", "Category")])
    order = F.concat(F.lit("order#t"), "l_orderkey")
    as_part = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        order.alias("chunk_id"),
        (F.col("l_linenumber") * 2).alias("ord"),
        F.concat(F.lit(" "), "p_name").alias("text"),
        F.element_at(kinds, (F.col("p_size") % 6 + 1).cast("int")).alias("type"),
        F.concat(F.lit("Part "), "p_partkey").alias("canonical_id"),
        F.col("l_discount").cast("string").alias("confidence"),
    )
    as_supplier = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        order.alias("chunk_id"),
        (F.col("l_linenumber") * 2 + 1).alias("ord"),
        F.col("s_name").alias("text"),
        F.lit("practice").alias("type"),
        F.concat(F.lit("Supplier "), "s_suppkey").alias("canonical_id"),
        F.lit("").alias("confidence"),
    )
    return as_part.union(as_supplier)


def raw_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the supplier to the part of each order line; one of the types is not allowed."""
    lines = order_lines(spark, sf_dir)
    kind = F.when(F.col("l_returnflag") == "A", "affects").when(F.col("l_returnflag") == "R", " Requires ").otherwise("sold_with")
    return lines.select(
        F.concat(F.lit("order#t"), "l_orderkey").alias("chunk_id"),
        F.col("l_linenumber").alias("ord"),
        F.concat(F.lit("Supplier "), "l_suppkey").alias("source"),
        F.concat(F.lit("Part "), "l_partkey").alias("target"),
        kind.alias("type"),
        F.col("l_tax").cast("string").alias("confidence"),
        F.concat(F.lit(" "), "l_linestatus", F.lit(" ")).alias("evidence"),
    )


def order_chunks(spark: SparkSession, sf_dir: str, text: Column | None = None) -> DataFrame:
    """Orders as chunks of the documents that customers are, dealt out by order as order lines are; ``text`` is another text of theirs."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    # A number of parts that is given stays: left to the engine, parts grow with the table, and what tasks sort grows with them.
    orders = orders.repartition(-(-orders.count() // ORDER_ROWS) or 1, "o_orderkey")
    return orders.select(
        F.concat(F.lit("order#t"), "o_orderkey").alias("chunk_id"),
        (F.concat_ws(" ", "o_orderpriority", "o_orderstatus") if text is None else text).alias("text"),
        F.concat(F.lit("customer-"), "o_custkey").alias("source_doc"),
        F.col("o_orderkey").alias("seq"),
    )


def file_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as segments of the files that source and language name; every seventh is a table."""
    docs = table(spark, sf_dir, "documents")
    kind = F.when(F.col("doc_id") % 7 == 3, "table").otherwise("text")
    nothing = F.lit(None).cast("string")
    return docs.select(
        F.concat("lang", F.lit("/"), "source", F.lit(".md")).alias("path"),
        F.col("doc_id").alias("seg_ord"),
        "text",
        kind.alias("modality"),
        nothing.alias("asset_ref"),
        nothing.alias("table_html"),
        nothing.alias("formula_latex"),
        nothing.alias("image_b64"),
    )


# Categories of elements, one for each rule of the modality.
CATEGORIES = ("Table", "FigureCaption", "Image", "MathFormula", "Formula", "NarrativeText", "TableOfPictures", "")


def _by_remainder(key: str, values: list[Column]) -> Column:
    """The value whose place is the key's remainder by their number."""
    out = values[-1]
    for k, value in list(enumerate(values))[-2::-1]:
        out = F.when(F.col(key) % len(values) == k, value).otherwise(out)
    return out


def _every(key: str, n: int, value: Column) -> Column:
    """The value where the key is a multiple of n, else null."""
    return F.when(F.col(key) % n == 0, value)


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as parsed elements of all categories; texts, pages and formulas are missing from some."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seg_ord"),
        _by_remainder("doc_id", [F.lit(c) for c in CATEGORIES]).alias("category"),
        F.coalesce(_every("doc_id", 3, F.lit(" \u3000")), "text").alias("text"),
        F.coalesce(_every("doc_id", 2, (F.col("doc_id") % 50).cast("string")), F.lit("")).alias("page"),
        F.concat(F.lit("<table><tr><td>"), "lang", F.lit("</td></tr></table>")).alias("table_html"),
        F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit(" x^"), "doc_id", F.lit(" "))).alias("latex"),
    )


def identified_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as points that lack some or all of their identifiers, or have blank ones."""
    key = "o_orderkey"
    return table(spark, sf_dir, "orders").select(
        key,
        F.coalesce(_every(key, 7, F.lit("")), F.concat(F.lit(" "), "o_orderpriority", F.lit("#t"), key, F.lit(" "))).alias("raw_chunk_id"),
        _every(key, 3, F.concat(F.lit("c"), key, F.lit("#i2"))).alias("chunk_id"),
        F.coalesce(_every(key, 4, F.lit(" ")), _every(key, 11, F.concat(F.lit("k"), key, F.lit("#x#y")))).alias("canonical_chunk_id"),
        _every(key, 5, F.concat(F.lit("doc-"), "o_custkey")).alias("canonical_doc_id"),
        _every(key, 2, F.lit("")).alias("source_doc_id"),
        _every(key, 9, F.lit("s.md")).alias("source_doc"),
        _every(key, 6, F.concat(F.lit("d"), key)).alias("doc_id"),
    )


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts' names, short, long, blank at the ends, and in other scripts."""
    name = F.concat(F.lit("  "), "p_name", F.lit(" "))
    berry = F.lit("딸기")
    kinds = [name, F.col("p_type"), F.concat("p_brand", F.lit(" "), berry), F.repeat(F.concat("p_type", F.lit("  ")), 8), F.substring("p_brand", 1, 2), berry]
    return table(spark, sf_dir, "part").select("p_partkey", _by_remainder("p_partkey", kinds).alias("v"))


def confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of order lines, below 0, above 1 and missing ones too."""
    kinds = [F.lit(None).cast("double"), F.col("l_tax") - 0.04, F.col("l_quantity") / 10, F.col("l_discount")]
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _by_remainder("l_linenumber", kinds).alias("v"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies about orders in all the shapes that models give them."""
    kinds = [
        F.concat(F.lit('ok\n```JSON\n{"entities":[{"text":"'), "o_orderpriority", F.lit('"}]}\n```')),
        F.concat(F.lit('note {"entities":[],"relations":[{"source":"'), "o_custkey", F.lit('"}]} end')),
        F.lit('{"a":1} {"b":2}'),
        F.lit("{'a':1}"),
        F.lit('{"entities":1,"entities":[{"text":"b"},3]}'),
        F.concat(F.lit("["), "o_custkey", F.lit("]")),
        F.lit(""),
        F.lit('{"entities":[{"confidence":NaN},{"confidence":"high"}]}'),
    ]
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chunk_id"), _by_remainder("o_orderkey", kinds).alias("reply"))


def hinting_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts about orders with words that hint at relations, and words that only look like them."""
    kinds = [
        F.concat(F.lit("Why? "), "o_orderpriority", F.lit(" BECAUSE causes how_")),
        F.lit("왜why 원인과 이유"),
        F.concat(F.lit("compare, Compare versus; increased "), "o_orderstatus"),
        F.lit("증가 감소 개선 증가"),
        F.lit("how how"),
    ]
    return table(spark, sf_dir, "orders").select(_by_remainder("o_orderkey", kinds).alias("text"))
