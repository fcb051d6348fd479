"""All queries over the supplied tables, by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweir.functions import text as T
from docweir.operators import chunking, graph, manifests, ontology, search, vectors
from docweir.operators import extraction as X
from docweir.operators.keyed_table import KeyedTable
from docweir.operators.upsert import last_wins
from docweir.plans import samples
from docweir.plans.samples import table
from docweir.sources import graph_statements as statements
from docweir.storage import materialize, new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
SCOPE = graph.Scope(created_at="2024-01-01T00:00:00+00:00")
VOCABULARY = ontology.Ontology()


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, dealt out: a small table may be one row group, which one task reads."""
    return table(spark, sf_dir, "documents").repartition("doc_id")


def _doc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunk_texts(_docs(spark, sf_dir))


CHUNKS = r"""
    words AS (
        SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda w: w <> '') AS ws FROM documents
    ), counted AS (
        SELECT *, CASE WHEN len(ws) = 0 THEN 0 WHEN len(ws) <= 1200 THEN 1 ELSE 1 + CAST(ceil((len(ws) - 1200) / 1100.0) AS INT) END AS k
        FROM words
    ), chunks AS (
        SELECT doc_id, doc_id || '#t' || i AS chunk_id, CAST(i AS INT) AS chunk_index,
               ws[i * 1100 + 1 : i * 1100 + 1200] AS part
        FROM (SELECT *, unnest(range(k)) AS i FROM counted)
    )"""
TERMS = (
    CHUNKS
    + r""", tokens AS (
        SELECT chunk_id, unnest(toks) AS token, unnest(range(len(toks))) AS place
        FROM (SELECT chunk_id, regexp_extract_all(lower(array_to_string(part, ' ')), '[A-Za-z0-9_가-힣]+') AS toks FROM chunks)
    ), tf AS (
        SELECT chunk_id, token, count(*) AS tf, min(place) AS pos,
               CAST('0x' || substr(md5(token), 5, 4) AS INT) AS slot, 1 + ln(1 + count(*)) AS raw
        FROM tokens GROUP BY ALL
    ), terms AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY chunk_id)) AS weight FROM tf)"""
)


@query(f"WITH {CHUNKS} SELECT doc_id, chunk_id, chunk_index, len(part) AS n_tokens, md5(array_to_string(part, ' ')) AS text_md5 FROM chunks")
def chunk_documents(spark, sf_dir):
    return _doc_chunks(spark, sf_dir).select("doc_id", "chunk_id", "chunk_index", "n_tokens", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(f"WITH {CHUNKS} SELECT doc_id, k AS n_chunks, len(ws) AS n_words FROM counted")
def chunk_count_by_doc(spark, sf_dir):
    n = F.size(T.words(F.col("text")))
    count = chunking.window_count(n, chunking.CHUNK_TOKENS, chunking.CHUNK_OVERLAP)
    return _docs(spark, sf_dir).select("doc_id", count.alias("n_chunks"), n.alias("n_words"))


@query(
    r"""WITH seg AS (
        SELECT lang || '/' || source || '.md' AS path, source AS stem, doc_id AS seg_ord, doc_id % 7 = 3 AS is_table,
               list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda w: w <> '') AS ws
        FROM documents
    ), counted AS (
        SELECT *, CASE WHEN is_table OR len(ws) <= 1200 THEN 1 ELSE 1 + CAST(ceil((len(ws) - 1200) / 1100.0) AS INT) END AS k
        FROM seg WHERE len(ws) > 0
    ), seeded AS (
        SELECT *, coalesce(sum(k) OVER (PARTITION BY path ORDER BY seg_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seed FROM counted
    )
    SELECT path, seg_ord, CAST(seed + i AS INT) AS chunk_index, stem || '#t' || CAST(seed + i AS INT) AS chunk_id,
           CASE WHEN is_table THEN 'table' ELSE 'text' END AS modality
    FROM (SELECT *, unnest(range(k)) AS i FROM seeded)"""
)
def chunk_numbering(spark, sf_dir):
    return chunking.chunk_segments(samples.file_segments(spark, sf_dir)).select("path", "seg_ord", "chunk_index", "chunk_id", "modality")


@query(
    f"""WITH {CHUNKS}, toks AS (
        SELECT chunk_id, regexp_extract_all(lower(array_to_string(part, ' ')), '[A-Za-z0-9_가-힣]+') AS t FROM chunks)
    SELECT chunk_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct, md5(array_to_string(t, ' ')) AS tokens_md5 FROM toks"""
)
def tokenize_chunks(spark, sf_dir):
    t = T.tokens(F.col("text"))
    return _doc_chunks(spark, sf_dir).select(
        "chunk_id",
        F.size(t).alias("n_tokens"),
        F.size(F.array_distinct(t)).alias("n_distinct"),
        F.md5(F.array_join(t, " ").cast("binary")).alias("tokens_md5"),
    )


@query(f"WITH {TERMS} SELECT chunk_id, token, CAST(pos AS INT) AS pos, tf, slot, round(weight, 9) AS weight FROM terms")
def sparse_terms(spark, sf_dir):
    return vectors.sparse_terms(_doc_chunks(spark, sf_dir)).withColumn("weight", F.round("weight", 9))


@query(
    f"""WITH {TERMS} SELECT chunk_id, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_tokens,
        count(DISTINCT slot) AS n_slots, round(sqrt(sum(raw * raw)), 6) AS norm FROM terms GROUP BY chunk_id"""
)
def chunk_sparse_summary(spark, sf_dir):
    return vectors.sparse_summary(_doc_chunks(spark, sf_dir))


@query(
    f"""WITH {TERMS} SELECT chunk_id, CAST(count(token) AS INT) AS n,
        md5(coalesce(string_agg(slot, ',' ORDER BY pos), '')) AS slots_md5, round(coalesce(sum(weight * weight), 0), 6) AS squared
    FROM chunks LEFT JOIN terms USING (chunk_id) GROUP BY chunk_id"""
)
def sparse_vectors(spark, sf_dir):
    v = vectors.sparse_vectors(_doc_chunks(spark, sf_dir))
    squares = F.aggregate("sparse.values", F.lit(0.0), lambda a, x: a + x * x)
    slots = F.array_join("sparse.indices", ",").cast("binary")
    return v.select("chunk_id", F.size("sparse.indices").alias("n"), F.md5(slots).alias("slots_md5"), F.round(squares, 6).alias("squared"))


@query(
    f"""WITH {TERMS} SELECT chunk_id, slot, count(*) AS n_tokens, string_agg(token, ' ' ORDER BY token) AS tokens
    FROM terms GROUP BY chunk_id, slot HAVING count(*) > 1"""
)
def sparse_slot_collisions(spark, sf_dir):
    return vectors.slot_collisions(_doc_chunks(spark, sf_dir))


@query(
    r"""WITH e AS (
        SELECT doc_id, ['Table', 'FigureCaption', 'Image', 'MathFormula', 'Formula', 'NarrativeText', 'TableOfPictures', ''][doc_id % 8 + 1] AS category,
               CASE WHEN doc_id % 3 = 0 THEN '' ELSE regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') END AS own,
               CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id % 50 AS VARCHAR) END AS page,
               '<table><tr><td>' || lang || '</td></tr></table>' AS html, CASE WHEN doc_id % 5 <> 0 THEN 'x^' || doc_id END AS latex
        FROM documents
    ), k AS (
        SELECT *, CASE WHEN category LIKE 'Table%' THEN 'table' WHEN category IN ('FigureCaption', 'Image') THEN 'image'
                       WHEN category LIKE '%Formula' THEN 'formula' ELSE 'text' END AS modality FROM e
    ), t AS (
        SELECT *, coalesce(nullif(own, ''), CASE modality WHEN 'table' THEN html WHEN 'formula' THEN latex END) AS found FROM k
    )
    SELECT doc_id AS seg_ord, modality, md5(found) AS text_md5,
           CASE WHEN modality <> 'text' THEN CASE WHEN page IS NULL THEN 'asset:' || doc_id ELSE 'page:' || page || '#idx:' || doc_id END END AS asset_ref
    FROM t WHERE found IS NOT NULL"""
)
def segment_rules(spark, sf_dir):
    raw = samples.elements(spark, sf_dir)
    kind = chunking.modality(F.col("category"))
    text = chunking.segment_text(F.col("text"), kind, F.col("table_html"), F.col("latex"))
    rows = raw.select("seg_ord", kind.alias("modality"), text.alias("text"), chunking.asset_ref(kind, F.col("page"), F.col("seg_ord")).alias("asset_ref"))
    return rows.where("text IS NOT NULL").select("seg_ord", "modality", F.md5(F.col("text").cast("binary")).alias("text_md5"), "asset_ref")


@query(
    f"""WITH {CHUNKS} SELECT chunk_id, 'doc-' || doc_id || '.txt' AS doc_id, 'doc-' || doc_id || '.txt' AS canonical_doc_id,
        chunk_id AS canonical_chunk_id, 'public' AS tier, 'text' AS modality, 'BAAI/bge-m3' AS embedding_model,
        '2024-01-01T00:00:00+00:00' AS created_at, md5(array_to_string(part, ' ')) AS basis_md5 FROM chunks"""
)
def payload(spark, sf_dir):
    chunks = _doc_chunks(spark, sf_dir).select(
        "chunk_id", F.concat(F.lit("doc-"), "doc_id", F.lit(".txt")).alias("source_doc"), F.lit("").alias("path"), "text", F.lit(" Text ").alias("modality"), F.lit(" ").alias("asset_ref")
    )
    points = chunking.payload_defaults(chunking.payload(chunks, SCOPE.created_at), "BAAI/bge-m3")
    points = chunking.canonical_ids(points.withColumn("raw_chunk_id", F.col("chunk_id")))
    basis = chunking.image_basis(F.col("modality"), F.col("asset_ref"), F.col("text"))
    return points.select("chunk_id", "doc_id", "canonical_doc_id", "canonical_chunk_id", "tier", "modality", "embedding_model", "created_at", F.md5(basis.cast("binary")).alias("basis_md5"))


@query(
    """WITH p AS (
        SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority || '#t' || o_orderkey END AS raw,
               CASE WHEN o_orderkey % 3 = 0 THEN 'c' || o_orderkey || '#i2' END AS c,
               CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 11 = 0 THEN 'k' || o_orderkey || '#x#y' END AS cc,
               CASE WHEN o_orderkey % 5 = 0 THEN 'doc-' || o_custkey END AS cd, CASE WHEN o_orderkey % 9 = 0 THEN 's.md' END AS sd,
               CASE WHEN o_orderkey % 6 = 0 THEN 'd' || o_orderkey END AS d
        FROM orders
    ), n AS (SELECT *, coalesce(cc, c, raw) AS chunk FROM p), m AS (SELECT *, coalesce(cd, sd, d, nullif(split_part(chunk, '#', 1), ''), raw) AS doc FROM n)
    SELECT k AS o_orderkey, doc AS canonical_doc_id, chunk AS canonical_chunk_id, coalesce(d, doc) AS doc_id, coalesce(c, nullif(raw, ''), chunk) AS chunk_id FROM m"""
)
def canonical_ids(spark, sf_dir):
    raw = samples.identified_points(spark, sf_dir)
    return chunking.canonical_ids(raw).select("o_orderkey", "canonical_doc_id", "canonical_chunk_id", "doc_id", "chunk_id")


@query(
    r"""SELECT p_partkey, regexp_replace(regexp_replace(lower(trim(v)), '\s+', '_', 'g'), '[^a-z0-9_\-:.]+', '', 'g') AS id
    FROM (SELECT p_partkey, p_type || ' / ' || p_name || ' ' || p_brand AS v FROM part)"""
)
def squeezed_ids(spark, sf_dir):
    value = F.concat("p_type", F.lit(" / "), "p_name", F.lit(" "), "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", T.extracted_id(value).alias("id"))


@query(
    r"""WITH n AS (
        SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '  ' || p_name || ' ' WHEN 1 THEN p_type WHEN 2 THEN p_brand || ' 딸기' WHEN 3 THEN repeat(p_type || '  ', 8)
                                             WHEN 4 THEN substr(p_brand, 1, 2) ELSE '딸기' END AS v FROM part
    ), q AS (
        SELECT *, regexp_replace(regexp_replace(lower(trim(v)), '\s+', '_', 'g'), '[^a-z0-9_\-:.]+', '', 'g') AS id FROM n
    )
    SELECT p_partkey, CASE WHEN length(id) BETWEEN 3 AND 120 THEN id ELSE '' END AS extracted, substr(id, 1, 120) AS graph,
           coalesce(nullif(regexp_replace(upper(v), '[^A-Z_]+', '', 'g'), ''), 'MENTIONS') AS relation FROM q"""
)
def identifier_rules(spark, sf_dir):
    v = F.col("v")
    return samples.names(spark, sf_dir).select("p_partkey", T.extracted_id(v).alias("extracted"), T.graph_id(v).alias("graph"), T.relation_name(v).alias("relation"))


@query(
    """WITH v AS (
        SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN l_tax - 0.04 WHEN 2 THEN l_quantity / 10 ELSE l_discount END AS v FROM lineitem
    ) SELECT l_orderkey, l_linenumber, CASE WHEN v IS NULL OR v = 0 THEN 0.5 ELSE round(greatest(0.0, least(1.0, v)), 4) END AS confidence FROM v""".replace("0.04", "CAST(0.04 AS DOUBLE)")
)
def confidence_rules(spark, sf_dir):
    return samples.confidences(spark, sf_dir).select("l_orderkey", "l_linenumber", T.graph_confidence(F.col("v")).alias("confidence"))


@query(
    """SELECT o_orderkey AS chunk_id, ['ok', 'ok', 'empty', 'empty', 'ok', 'bad_shape', 'empty', 'ok'][o_orderkey % 8 + 1] AS status,
        [1, 0, 0, 0, 1, 0, 0, 2][o_orderkey % 8 + 1] AS n_entities, [0, 1, 0, 0, 0, 0, 0, 0][o_orderkey % 8 + 1] AS n_relations,
        CASE o_orderkey % 8 WHEN 0 THEN o_orderpriority WHEN 1 THEN CAST(o_custkey AS VARCHAR) WHEN 4 THEN 'b' WHEN 7 THEN '' END AS first_value FROM orders"""
)
def reply_recovery(spark, sf_dir):
    parsed = X.parsed_replies(samples.replies(spark, sf_dir))
    first = F.coalesce(F.get("entities", F.lit(0))["text"], F.get("relations", F.lit(0))["source"])
    return parsed.select("chunk_id", "status", F.size("entities").alias("n_entities"), F.size("relations").alias("n_relations"), first.alias("first_value"))


_PROMPT = (
    "You are an agriculture knowledge extractor. Return ONLY JSON with keys: entities, relations. Allowed entity types: "
    + VOCABULARY.labels_csv
    + ". Allowed relation types: "
    + VOCABULARY.relations_csv
    + ". Entity fields: text,type,canonical_id,confidence,scientific_name,aliases,symptom_keywords,growth_stage,metric,unit. "
    "Relation fields: source,target,type,confidence,evidence. Focus on text evidence when present.\n\nINPUT:\n"
)


@query(f"WITH {CHUNKS} SELECT chunk_id, md5('{_PROMPT}' || array_to_string(part, ' ') || E'\\n\\nSOURCE_DOC: d' || doc_id) AS prompt_md5 FROM chunks")
def prompts(spark, sf_dir):
    chunks = _doc_chunks(spark, sf_dir).withColumns({"modality": F.lit("text"), "source_doc": F.concat(F.lit("d"), "doc_id")})
    return chunks.select("chunk_id", F.md5(X.prompt(chunks, VOCABULARY).cast("binary")).alias("prompt_md5"))


ENTITIES = """
    raw_entities AS (
        SELECT 'order#t' || l_orderkey AS chunk_id, l_linenumber * 2 AS ord, trim(p_name) AS text,
               ['Crop', 'Disease', 'Pest', 'Environment', NULL, 'Category'][p_size % 6 + 1] AS type,
               'part_' || p_partkey AS canonical_id, l_discount AS confidence
        FROM lineitem JOIN part ON l_partkey = p_partkey
        UNION ALL
        SELECT 'order#t' || l_orderkey, l_linenumber * 2 + 1, s_name, 'Practice', 'supplier_' || s_suppkey, 0.0
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    ), entities AS (SELECT * FROM raw_entities WHERE type IS NOT NULL)"""
RELATIONS = """
    relations AS (
        SELECT 'order#t' || l_orderkey AS chunk_id, l_linenumber AS ord, 'supplier_' || l_suppkey AS source, 'part_' || l_partkey AS target,
               CASE l_returnflag WHEN 'A' THEN 'AFFECTS' ELSE 'REQUIRES' END AS type, l_tax AS confidence, l_linestatus AS evidence
        FROM lineitem WHERE l_returnflag IN ('A', 'R')
    )"""
TYPED = f"""{ENTITIES}, {RELATIONS}, known AS MATERIALIZED (
        SELECT chunk_id, map_from_entries(list(struct_pack(k := canonical_id, v := last))) AS found
        FROM (SELECT chunk_id, canonical_id, max(struct_pack(ord := ord, type := type, text := text)) AS last FROM entities GROUP BY chunk_id, canonical_id) GROUP BY chunk_id
    ), typed AS (
        SELECT r.chunk_id, r.ord, r.source, r.target, r.type, r.confidence, r.evidence, found[source].type AS source_type, found[source].text AS source_text,
               found[target].type AS target_type, found[target].text AS target_text
        FROM relations r LEFT JOIN known k ON r.chunk_id = k.chunk_id
    )"""


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.valid_entities(samples.raw_entities(spark, sf_dir), VOCABULARY)


def _relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.valid_relations(samples.raw_relations(spark, sf_dir), VOCABULARY)


def _found(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Entities and typed relations; the former are written once, as in an ingest, since both ends of relations and the graph read them."""
    entities = materialize(_entities(spark, sf_dir), "entities")
    return entities, X.typed_relations(_relations(spark, sf_dir), entities)


def _with_seq(df: DataFrame) -> DataFrame:
    return df.withColumn("seq", F.substring_index("chunk_id", "#t", -1).cast("bigint"))


@query(f"WITH {ENTITIES} SELECT * FROM entities")
def validate_entities(spark, sf_dir):
    return _entities(spark, sf_dir)


@query(f"WITH {RELATIONS} SELECT * FROM relations")
def validate_relations(spark, sf_dir):
    return _relations(spark, sf_dir)


@query(
    f"""WITH {TYPED} SELECT chunk_id, ord, source, target, type, confidence, evidence, source_type, source_text, target_type, target_text FROM typed"""
)
def typed_relations(spark, sf_dir):
    return _found(spark, sf_dir)[1]


@query(
    f"""WITH {TYPED}, rows AS (
        SELECT type AS label, canonical_id, text AS name, CASE WHEN confidence = 0 THEN 0.5 ELSE round(confidence, 4) END AS confidence,
               CAST(replace(chunk_id, 'order#t', '') AS BIGINT) AS seq, 0 AS phase, ord * 2 AS ord FROM entities
        UNION ALL SELECT coalesce(source_type, 'Condition'), source, source_text, NULL, CAST(replace(chunk_id, 'order#t', '') AS BIGINT), 1, ord * 2 FROM typed
        UNION ALL SELECT coalesce(target_type, 'Condition'), target, target_text, NULL, CAST(replace(chunk_id, 'order#t', '') AS BIGINT), 1, ord * 2 + 1 FROM typed
    )
    SELECT label, canonical_id, 'public' AS tier, arg_max(name, (seq, phase, ord, name)) FILTER (name <> '') AS name,
           arg_max(confidence, (seq, phase, ord, confidence)) FILTER (confidence IS NOT NULL) AS confidence, label AS type
    FROM rows GROUP BY label, canonical_id"""
)
def graph_entities(spark, sf_dir):
    entities, typed = map(_with_seq, _found(spark, sf_dir))
    nodes = graph.entity_nodes(entities, typed, SCOPE, VOCABULARY)
    return nodes.select("label", "canonical_id", "tier", "name", "confidence", "type")


@query(
    f"""WITH {ENTITIES} SELECT chunk_id, type AS label, canonical_id, 'entity_extraction' AS evidence,
        max_by(c, (ord, c)) AS confidence
    FROM (SELECT *, CASE WHEN confidence = 0 THEN 0.5 ELSE round(confidence, 4) END AS c FROM entities)
    WHERE chunk_id IN (SELECT 'order#t' || o_orderkey FROM orders) GROUP BY ALL"""
)
def graph_mentions(spark, sf_dir):
    g_chunk = graph.chunk_nodes(samples.order_chunks(spark, sf_dir), SCOPE)
    edges = graph.mention_edges(_with_seq(_entities(spark, sf_dir)), g_chunk, SCOPE, VOCABULARY)
    return edges.select("chunk_id", "label", "canonical_id", "evidence", "confidence")


@query(
    f"""WITH {TYPED} SELECT coalesce(source_type, 'Condition') AS src_label, source AS src, type AS rel_type,
        coalesce(target_type, 'Condition') AS tgt_label, target AS tgt,
        arg_max(c, (seq, ord, c, evidence)) AS confidence, arg_max(evidence, (seq, ord, c, evidence)) AS evidence
    FROM (SELECT *, CASE WHEN confidence = 0 THEN 0.5 ELSE round(confidence, 4) END AS c, CAST(replace(chunk_id, 'order#t', '') AS BIGINT) AS seq FROM typed)
    GROUP BY ALL"""
)
def graph_relations(spark, sf_dir):
    edges = graph.relation_edges(_with_seq(_found(spark, sf_dir)[1]), SCOPE, VOCABULARY)
    return edges.select("src_label", "src", "rel_type", "tgt_label", "tgt", "confidence", "evidence")


@query(
    """SELECT 'order#t' || o_orderkey AS chunk_id, o_orderpriority || ' ' || o_orderstatus AS text, 'document' AS source_type, 'public' AS tier,
        '2024-01-01T00:00:00+00:00' AS created_at FROM orders"""
)
def graph_chunks(spark, sf_dir):
    return graph.chunk_nodes(samples.order_chunks(spark, sf_dir), SCOPE).select("chunk_id", "text", "source_type", "tier", "created_at")


@query("SELECT DISTINCT 'customer-' || o_custkey AS doc_id, 'customer-' || o_custkey AS source_doc, 'public' AS tier FROM orders")
def graph_documents(spark, sf_dir):
    return graph.document_nodes(samples.order_chunks(spark, sf_dir), SCOPE).select("doc_id", "source_doc", "tier")


@query("SELECT 'customer-' || o_custkey AS doc_id, 'order#t' || o_orderkey AS chunk_id, 'public' AS tier FROM orders")
def graph_has_chunk(spark, sf_dir):
    chunks = samples.order_chunks(spark, sf_dir)
    return graph.has_chunk_edges(chunks, graph.chunk_nodes(chunks, SCOPE), SCOPE).select("doc_id", "chunk_id", "tier")


@query(
    f"""WITH {ENTITIES}, {RELATIONS}
    SELECT (SELECT count(*) FROM orders) AS chunks, (SELECT count(*) FROM entities) AS entities, (SELECT count(*) FROM relations) AS relations"""
)
def run_totals(spark, sf_dir):
    return graph.run_totals(samples.order_chunks(spark, sf_dir), _entities(spark, sf_dir), _relations(spark, sf_dir))


@query(f"WITH {ENTITIES}, {RELATIONS} SELECT DISTINCT 'entity' AS kind, type AS name FROM entities UNION SELECT DISTINCT 'relation', type FROM relations")
def observed_types(spark, sf_dir):
    return ontology.observed_types(_entities(spark, sf_dir), _relations(spark, sf_dir))


@query(
    f"""WITH {ENTITIES}, {RELATIONS}
    SELECT DISTINCT 'entity' AS kind, type AS name FROM entities UNION SELECT 'entity', 'Soil' UNION SELECT 'relation', 'CAUSES'
    UNION SELECT DISTINCT 'relation', type FROM relations"""
)
def ontology_merge(spark, sf_dir):
    baseline = spark.createDataFrame([("entity", "Soil"), ("entity", "Pest"), ("relation", "CAUSES")], "kind string, name string")
    return ontology.merged_names(baseline, observed_types(spark, sf_dir))


_WHOLE = ["the", "and", "with", "der", "une"]
_PARTS = ["tion", "ung", "eau"]


@query(
    r"""WITH found AS (
        SELECT 'ko' AS lang, unnest(regexp_extract_all(text, 'tion|ung|eau')) AS keyword FROM documents
        UNION ALL
        SELECT 'en', unnest(regexp_extract_all(lower(text), '(?:^|[^\p{L}\p{N}_])(the|and|with|der|une)(?:$|[^\p{L}\p{N}_])', 1))
        FROM (SELECT replace(regexp_replace(text, '[^\p{L}\p{N}_]+', '  ', 'g'), ' ', ' ') AS text FROM documents)
    ) SELECT lang, keyword, count(*) AS n FROM found GROUP BY ALL"""
)
def keyword_mining(spark, sf_dir):
    return ontology.mined_keywords(_docs(spark, sf_dir), _PARTS, _WHOLE)


@query(
    """SELECT lang, keyword, CAST(sum(times) AS BIGINT) AS n FROM orders JOIN (VALUES (0, 'en', 'why', 1), (0, 'en', 'because', 1), (1, 'ko', '왜', 1), (1, 'ko', '원인', 1),
        (1, 'ko', '이유', 1), (2, 'en', 'compare', 2), (2, 'en', 'versus', 1), (3, 'ko', '증가', 2), (3, 'ko', '감소', 1), (3, 'ko', '개선', 1), (4, 'en', 'how', 2))
        v(kind, lang, keyword, times) ON o_orderkey % 5 = kind GROUP BY ALL"""
)
def keyword_rules(spark, sf_dir):
    return ontology.mined_keywords(samples.hinting_texts(spark, sf_dir))


@query(
    r"""WITH found AS (
        SELECT 'ko' AS lang, doc_id, unnest(ks) AS keyword, unnest(range(len(ks))) AS place FROM (SELECT doc_id, regexp_extract_all(text, 'tion|ung|eau') AS ks FROM documents)
        UNION ALL
        SELECT 'en', doc_id, unnest(ks), unnest(range(len(ks))) FROM (
            SELECT doc_id, regexp_extract_all(lower(regexp_replace(text, '[^\p{L}\p{N}_]+', '  ', 'g')), '(?:^|[^\p{L}\p{N}_])(the|and|with|der|une)(?:$|[^\p{L}\p{N}_])', 1) AS ks
            FROM documents)
    ), counted AS (SELECT lang, keyword, count(*) AS n, min({'d': doc_id, 'p': place}) AS first FROM found GROUP BY ALL)
    SELECT lang, keyword, n, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, first) AS INT) AS rank FROM counted"""
)
def keyword_ranking(spark, sf_dir):
    return ontology.ranked_keywords(_docs(spark, sf_dir), "doc_id", _PARTS, _WHOLE)


@query(
    """SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) FILTER (value > 50) AS large_value,
        max((ts, event_id)).event_id AS event_id FROM (SELECT *, {'ts': ts, 'event_id': event_id} AS s FROM events) GROUP BY user_id""".replace(
        "max((ts, event_id)).event_id", "max(s).event_id"
    )
)
def upsert_last_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.when(F.col("value") > 50, F.col("value")).alias("large_value"), "ts", "event_id")
    return last_wins(rows, ["user_id"], ["ts", "event_id"], sticky=["large_value"]).select("user_id", "event_type", "large_value", "event_id")


@query("SELECT page_id || '.html' AS path, strlen(html) AS size_bytes, sha256(html) AS sha256 FROM pages")
def file_manifest(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.concat("page_id", F.lit(".html")).alias("path"), F.col("html").cast("binary").alias("content"))
    return manifests.content_digests(pages)


def _digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests.chunk_digests(chunking.chunk_segments(samples.file_segments(spark, sf_dir)))


DIGESTS = r"""
    seg AS (
        SELECT lang || '/' || source || '.md' AS path, source AS stem, doc_id AS seg_ord, doc_id % 7 = 3 AS is_table,
               regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') AS own, list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda w: w <> '') AS ws
        FROM documents
    ), counted AS (
        SELECT *, CASE WHEN is_table OR len(ws) <= 1200 THEN 1 ELSE 1 + CAST(ceil((len(ws) - 1200) / 1100.0) AS INT) END AS k FROM seg WHERE len(ws) > 0
    ), seeded AS (
        SELECT *, coalesce(sum(k) OVER (PARTITION BY path ORDER BY seg_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seed FROM counted
    ), numbered AS (
        SELECT *, CAST(seed + i AS INT) AS chunk_index, stem || '#t' || CAST(seed + i AS INT) AS chunk_id,
               CASE WHEN is_table THEN own ELSE array_to_string(ws[i * 1100 + 1 : i * 1100 + 1200], ' ') END AS part
        FROM (SELECT *, unnest(range(k)) AS i FROM seeded)
    ), digested AS (
        SELECT path, chunk_id, chunk_index, sha256('{"chunk_id":' || to_json(chunk_id) || ',"entities":[],"metadata":{"asset_ref":null,"formula_latex_ref":null,"image_b64_ref":null,"modality":"'
            || CASE WHEN is_table THEN 'table' ELSE 'text' END || '","source_doc":' || to_json(stem || '.md') || ',"table_html_ref":null},"relations":[],"text":' || to_json(part) || '}') AS digest
        FROM numbered
    )"""


@query(f"WITH {DIGESTS} SELECT chunk_id, path, digest FROM digested")
def chunk_digests(spark, sf_dir):
    return _digests(spark, sf_dir).select("chunk_id", "path", "digest")


@query(
    f"""WITH {DIGESTS} SELECT path, count(*) AS chunks, 0 AS entities, 0 AS relations, md5(string_agg(digest, ',' ORDER BY chunk_index)) AS digests_md5
    FROM digested GROUP BY path"""
)
def repro_rollup(spark, sf_dir):
    rollup = manifests.repro_rollup(_digests(spark, sf_dir))
    return rollup.withColumn("digests_md5", F.md5(F.array_join("chunk_digests", ",").cast("binary"))).drop("chunk_digests")


@query()
def page_segments(spark, sf_dir):
    from docweir.sources.parsers import parsed_segments

    pages = table(spark, sf_dir, "pages").select(F.concat("page_id", F.lit(".html")).alias("path"), F.col("html").cast("binary").alias("content"))
    return parsed_segments(pages, "offline").select("path", "seg_ord", "text", "modality", "asset_ref")


@query(
    r"""WITH w AS (
        SELECT DISTINCT sha256(coalesce(text, '')) AS text_hash, list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda w: w <> '') AS ws FROM documents
    ), h AS (SELECT text_hash, md5(unnest(ws)) AS m FROM w), s AS (
        SELECT text_hash, CAST(CAST('0x' || substr(m, 1, 8) AS BIGINT) % 64 AS INT) AS place, sum(CASE WHEN substr(m, 9, 1) < '8' THEN 1 ELSE -1 END) AS v FROM h GROUP BY ALL
    ), f AS (SELECT text_hash, place, v FROM s WHERE v <> 0 UNION ALL SELECT text_hash, 0, 1 FROM w WHERE text_hash NOT IN (SELECT text_hash FROM s WHERE v <> 0))
    SELECT text_hash, place, round(v / sqrt(sum(v * v) OVER (PARTITION BY text_hash)), 9) AS value FROM f"""
)
def embedded_texts(spark, sf_dir):
    from docweir.operators.models import embedded
    from docweir.sources.providers import HashingEmbedder

    vectors_ = embedded(_docs(spark, sf_dir).select("text"), HashingEmbedder(dim=64))
    return vectors_.select("text_hash", F.posexplode("vector").alias("place", "value")).where("value != 0").withColumn("value", F.round("value", 9))


@query(
    r"""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
    scored AS (
        SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.e, v.e) AS score FROM v AS q JOIN v ON len(q.e) = len(v.e) WHERE q.vec_id % 100 = 0
    ) SELECT query_id, vec_id, round(score, 6) AS score, CAST(row_number() OVER w AS INT) AS rank FROM scored
    WINDOW w AS (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) QUALIFY row_number() OVER w <= 10"""
)
def dense_search(spark, sf_dir):
    """Every row whose id is a multiple of 100 as a query against all vectors."""
    vectors_ = table(spark, sf_dir, "embeddings")
    found = search.DenseIndex(vectors_, "vec_id", "embedding").nearest(vectors_.where("vec_id % 100 = 0"), 10, "vec_id", "embedding")
    return found.select("query_id", F.col("item").alias("vec_id"), F.round("score", 6).alias("score"), "rank")


@query(
    f"""WITH {TERMS}, summed AS (SELECT chunk_id, slot, sum(weight) AS weight FROM terms GROUP BY ALL),
    scales AS (SELECT slot, ln(1 + ((SELECT count(DISTINCT chunk_id) FROM summed) - count(*) + 0.5) / (count(*) + 0.5)) AS scale FROM summed GROUP BY slot),
    asked AS (SELECT chunk_id AS query_id, slot, weight * scale AS q FROM summed JOIN scales USING (slot) WHERE CAST(string_split(chunk_id, '#')[1] AS BIGINT) % 100 = 0),
    scored AS (SELECT query_id, s.chunk_id, sum(q * weight) AS score FROM asked JOIN summed s USING (slot) GROUP BY ALL)
    SELECT query_id, chunk_id, round(score, 6) AS score, CAST(row_number() OVER w AS INT) AS rank FROM scored
    WINDOW w AS (PARTITION BY query_id ORDER BY round(score, 9) DESC, chunk_id) QUALIFY row_number() OVER w <= 10"""
)
def sparse_search(spark, sf_dir):
    """The chunks of every document whose id is a multiple of 100 as queries against all chunks, weighted by inverse document frequency."""
    terms = materialize(vectors.sparse_terms(_doc_chunks(spark, sf_dir)).select("chunk_id", "slot", "weight"), "terms")
    queries = terms.where(F.substring_index("chunk_id", "#", 1).cast("bigint") % 100 == 0).withColumnRenamed("chunk_id", "query_id")
    found = search.SparseIndex(terms).nearest(queries, 10)
    return found.select("query_id", F.col("item").alias("chunk_id"), F.round("score", 6).alias("score"), "rank")


@query(
    """WITH live AS (SELECT * FROM events WHERE event_id % 3 = 2 OR user_id % 10 <> 3)
    SELECT user_id, arg_max(event_type, (event_id % 3, ts, event_id)) AS event_type, arg_max(value, (event_id % 3, ts, event_id)) FILTER (value > 50) AS large_value
    FROM live GROUP BY user_id"""
)
def keyed_table_changes(spark, sf_dir):
    """Events as three batches of changes to a table of users; before the last, every tenth user is deleted, and what deltas have grown is compacted."""
    events = table(spark, sf_dir, "events").withColumn("large_value", F.when(F.col("value") > 50, F.col("value")))
    users = KeyedTable(spark, new_path(spark, "users"), ["user_id"], ["large_value"])
    for batch in range(3):
        if batch == 2:
            users.delete(events.where("user_id % 10 = 3"))
            users.compact()
        users.upsert(events.where(F.col("event_id") % 3 == batch).select("user_id", "event_type", "large_value", "ts", "event_id"), ["ts", "event_id"])
    return users.read().select("user_id", "event_type", "large_value")


_QUOTED = r"""'''' || replace(replace(replace(%s, '\', '\\'), '''', '\'''), chr(10), '\n') || ''''"""
_SCOPED = r""", tier:''public''}"""


@query(
    rf"""WITH c AS (
        SELECT 'order#t' || o_orderkey AS chunk_id, o_orderpriority || ' ''quoted'' \ ' || o_orderstatus || chr(10) || 'end' AS text, 'customer-' || o_custkey AS doc FROM orders
    ), s AS (
        SELECT 'MERGE (n:Chunk {{chunk_id:' || {_QUOTED % 'chunk_id'} || '{_SCOPED}) SET n.text=' || {_QUOTED % 'text'} || ', n.source_type=''document'', n.created_at=''2024-01-01T00:00:00+00:00''' AS statement FROM c
        UNION ALL SELECT DISTINCT 'MERGE (n:Document {{doc_id:' || {_QUOTED % 'doc'} || '{_SCOPED}) SET n.source_doc=' || {_QUOTED % 'doc'} || ', n.created_at=''2024-01-01T00:00:00+00:00''' FROM c
        UNION ALL SELECT 'MATCH (a:Document {{doc_id:' || {_QUOTED % 'doc'} || '{_SCOPED}), (b:Chunk {{chunk_id:' || {_QUOTED % 'chunk_id'}
            || '{_SCOPED}) MERGE (a)-[r:HAS_CHUNK {{tier:''public''}}]->(b) SET r.created_at=''2024-01-01T00:00:00+00:00''' FROM c
    ) SELECT md5(statement) AS statement_md5, CAST(length(statement) AS INT) AS length FROM s"""
)
def graph_statements(spark, sf_dir):
    text = F.concat(F.col("o_orderpriority"), F.lit(" 'quoted' \\ "), F.col("o_orderstatus"), F.lit("\nend"))
    chunks = samples.order_chunks(spark, sf_dir, text)
    # Written once, as in an ingest, since its statements and its edges read it.
    g_chunk = materialize(graph.chunk_nodes(chunks, SCOPE), "g_chunk")
    tables = {"g_chunk": g_chunk, "g_document": graph.document_nodes(chunks, SCOPE), "g_has_chunk": graph.has_chunk_edges(chunks, g_chunk, SCOPE)}
    made = statements.node_statements(tables).union(statements.edge_statements(tables))
    return made.select(F.md5(F.col("statement").cast("binary")).alias("statement_md5"), F.char_length("statement").alias("length"))
