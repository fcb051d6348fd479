"""Rules of single operators."""

import pytest
from pyspark.sql import functions as F

from docweir.functions import text as T
from docweir.operators import chunking, graph, ontology
from docweir.operators.extraction import parse_reply, prompt, recovered_json
from docweir.operators.upsert import last_wins, upsert
from docweir.operators.vectors import sparse_summary, sparse_terms, sparse_vectors


@pytest.mark.parametrize(
    "n, size, overlap, windows",
    [
        (0, 4, 1, []),
        (4, 4, 1, [(0, 4)]),
        (5, 4, 1, [(0, 4), (3, 5)]),
        (7, 4, 1, [(0, 4), (3, 7)]),
        (8, 4, 1, [(0, 4), (3, 7), (6, 8)]),
        (3, 1, 5, [(0, 1), (1, 2), (2, 3)]),
        (2400, 1200, 100, [(0, 1200), (1100, 2300), (2200, 2400)]),
    ],
)
def test_windows(spark, n, size, overlap, windows):
    docs = spark.createDataFrame([(1, "  ".join(str(k) for k in range(n)))], "doc_id long, text string")
    rows = chunking.chunk_texts(docs, size=size, overlap=overlap).orderBy("chunk_index").collect()
    assert [r.text for r in rows] == [" ".join(str(k) for k in range(a, b)) for a, b in windows]


def test_windows_cover_all_words(spark):
    docs = spark.createDataFrame([(n, " ".join(str(k) for k in range(n))) for n in range(40)], "doc_id long, text string")
    for size in (1, 3, 7):
        for overlap in (0, 2, 9):
            for r in chunking.chunk_texts(docs, size=size, overlap=overlap).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("chunk_index", "text"))).alias("c")).collect():
                parts = [c.text.split() for c in r.c]
                assert {w for p in parts for w in p} == {str(k) for k in range(r.doc_id)}
                kept = min(overlap, size - 1)
                assert all(a[len(a) - kept :] == b[:kept] for a, b in zip(parts, parts[1:], strict=False))


def test_chunk_ids_run_through_a_file(spark):
    rows = [("x/a.md", k, "word", m) for k, m in enumerate(["text", "table", "image", "text"])]
    segments = spark.createDataFrame(rows, "path string, seg_ord int, text string, modality string").selectExpr(
        "*", *[f"CAST(NULL AS string) AS {c}" for c in ("asset_ref", "table_html", "formula_latex", "image_b64")]
    )
    got = chunking.chunk_segments(segments).orderBy("chunk_index").collect()
    assert [r.chunk_id for r in got] == ["a#t0", "a#t1", "a#i2", "a#t3"]


def test_white_space_is_that_of_python(spark):
    import sys

    points = spark.range(1, sys.maxunicode + 1).where("id NOT BETWEEN 55296 AND 57343")
    c = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    found = points.select("id", c.alias("c")).where(F.regexp_replace("c", T.SPACE, "") == "")
    stripped = points.select("id", c.alias("c")).where(T.strip(F.col("c")) == "")
    spaces = {i for i in range(1, sys.maxunicode + 1) if chr(i).isspace()}
    # A byte order mark is no character to the decoder.
    assert {r.id for r in found.collect()} - {0xFEFF} == {r.id for r in stripped.collect()} - {0xFEFF} == spaces == set(map(ord, T.SPACES))


def test_numbering_shuffles_no_texts(spark, tmp_path):
    rows = [(f"f{k % 2}", k, f"word{k} " * 30, "text") for k in range(20)]
    spark.createDataFrame(rows, "path string, seg_ord int, text string, modality string").selectExpr(
        "*", *[f"CAST(NULL AS string) AS {c}" for c in ("asset_ref", "table_html", "formula_latex", "image_b64")]
    ).write.parquet(str(tmp_path / "s"))
    chunks = chunking.chunk_segments(spark.read.parquet(str(tmp_path / "s")), size=10, overlap=0)
    assert chunks.count() == 60 and chunks.select("path", "chunk_index").distinct().count() == 60
    plan = chunks._jdf.queryExecution().optimizedPlan()
    windows, todo = [], [plan]
    while todo:
        node = todo.pop()
        windows += [node] if node.nodeName() == "Window" else []
        todo += [node.children().apply(k) for k in range(node.children().size())]
    below = windows[0].children().apply(0).output()
    assert [below.apply(k).name() for k in range(below.size())] == ["path", "seg_ord", "_k"]


def test_relations_are_shuffled_once(spark):
    from docweir.operators.extraction import typed_relations

    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        entities = spark.range(50).selectExpr("CAST(id % 3 AS string) AS chunk_id", "id AS ord", "CAST(id AS string) AS text", "'Crop' AS type", "CAST(id % 7 AS string) AS canonical_id")
        relations = spark.range(50).selectExpr("CAST(id % 4 AS string) AS chunk_id", "id AS ord", "CAST(id % 9 AS string) AS source", "CAST(id % 5 AS string) AS target", "'CAUSES' AS type")
        out = typed_relations(relations, entities)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(chunk_id") == plan.count("Exchange") == 2
        # Chunks with many entities take another way to the same rows.
        for crowded in (0, 16):
            other = typed_relations(relations, entities, crowded)
            assert other.columns == out.columns and sorted(map(str, other.collect())) == sorted(map(str, out.collect()))
    finally:
        spark.conf.set(conf, before)


def test_ranked_keywords(spark):
    texts = spark.createDataFrame([(2, "how why how"), (1, "why trigger 원인"), (3, "cause cause 이유")], "seq int, text string")
    got = ontology.ranked_keywords(texts, "seq").orderBy("lang", "rank").collect()
    assert [(r.lang, r.keyword, r.n) for r in got] == [("en", "why", 2), ("en", "how", 2), ("en", "cause", 2), ("en", "trigger", 1), ("ko", "원인", 1), ("ko", "이유", 1)]


def test_stated_queries_against_all_chunks(spark):
    from docweir.operators import vectors

    chunks = spark.createDataFrame([("a", "red apple"), ("b", "green apple"), ("c", "stone")], "chunk_id string, text string")
    terms = sparse_terms(chunks)
    weights = vectors.idf(terms, 3)
    got = {(r.query_id, r.chunk_id): r.score for r in vectors.sparse_dot(terms.where("chunk_id = 'a'"), terms, weights).collect()}
    assert set(got) == {("a", "a"), ("a", "b")} and got["a", "a"] > got["a", "b"] > 0


def test_file_stem(spark):
    names = ["a/b.tar.gz", ".md", "x", "d/.a.txt"]
    got = spark.createDataFrame([(n,) for n in names], "p string").select(T.file_stem(F.col("p"))).collect()
    assert [r[0] for r in got] == ["b.tar", ".md", "x", ".a"]


def test_sparse(spark):
    chunks = spark.createDataFrame([("a", "Tomato tomato BLIGHT"), ("b", "été"), ("c", "!!"), ("d", "토마토 잎-곰팡이 T_1")], "chunk_id string, text string")
    got = {r.chunk_id: r.sparse for r in sparse_vectors(chunks).collect()}
    assert got["a"].indices == [34697, 34928]
    assert got["a"]["values"] == pytest.approx([0.778282923, 0.627913762])
    assert got["b"].indices == [61348]
    assert got["c"].indices == [] and got["c"]["values"] == []
    assert got["d"].indices == [4097, 48353, 56062, 18737]
    for df in (sparse_terms(chunks), sparse_vectors(chunks), sparse_summary(chunks)):
        assert "Exchange" not in df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert [tuple(r)[1:4] for r in sparse_summary(chunks.where("chunk_id IN ('a', 'c')")).collect()] == [(2, 3, 2)]
    assert [(r.token, r.pos, r.tf) for r in sparse_terms(spark.createDataFrame([("x", "b a b c a b")], "chunk_id string, text string")).orderBy("pos").collect()] == [
        ("b", 0, 3),
        ("a", 1, 2),
        ("c", 3, 1),
    ]


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("k", "one", "x"), ("j", "two", "y")], "id string, name string, note string").withColumn("s", F.lit(1))
    new = spark.createDataFrame([("k", "three", ""), ("n", "four", None)], "id string, name string, note string").withColumn("s", F.lit(0))
    once = upsert(old, new, ["id"], ["s"], sticky=["note"])
    twice = upsert(once, new, ["id"], ["s"], sticky=["note"])
    expected = {("k", "three", "x"), ("j", "two", "y"), ("n", "four", None)}
    assert {tuple(r)[:3] for r in once.select("id", "name", "note").collect()} == expected
    assert {tuple(r)[:3] for r in twice.select("id", "name", "note").collect()} == expected


def test_last_wins_by_value_on_ties(spark):
    rows = spark.createDataFrame([("k", v, 1) for v in (3, 9, 4)], "id string, v int, s int")
    for n in (1, 3):
        assert last_wins(rows.repartition(n), ["id"], ["s"]).first().v == 9


def test_entities_keep_attributes_and_stubs_set_little(spark):
    entities = spark.createDataFrame(
        [("c1", 0, "Tomato", "Crop", "tomato", 0.9, "Solanum", 1), ("c2", 0, "tomato plant", "Crop", "tomato", 0.0, "", 2), ("c3", 0, "x", "Nope", "x1", 0.2, None, 3)],
        "chunk_id string, ord int, text string, type string, canonical_id string, confidence double, scientific_name string, seq int",
    )
    relations = spark.createDataFrame(
        [("c2", 0, "tomato", "rot", "causes", 0.4, "e", "Crop", None, None, None, 2)],
        "chunk_id string, ord int, source string, target string, type string, confidence double, evidence string, source_type string, source_text string, target_type string, target_text string, seq int",
    )
    scope, known = graph.Scope(created_at="t"), ontology.Ontology()
    got = {(r.label, r.canonical_id): r for r in graph.entity_nodes(entities, relations, scope, known).collect()}
    tomato = got["Crop", "tomato"]
    assert (tomato.name, tomato.scientific_name, tomato.confidence) == ("tomato plant", "Solanum", 0.5)
    assert ("Condition", "x1") in got
    assert got["Condition", "rot"].name is None and got["Condition", "rot"].confidence is None
    private = graph.entity_nodes(entities, relations, graph.Scope("private", "f1", "t"), known).select("tier", "farm_key").distinct().collect()
    assert [tuple(r) for r in private] == [("private", "f1")]


def test_typed_relations_stay_in_their_chunk(spark):
    from docweir.operators.extraction import typed_relations

    entities = spark.createDataFrame([("c", 0, "Tomato", "Crop", "tom"), ("c", 1, "Tom wilt", "Disease", "tom"), ("d", 0, "Rot", "Disease", "rot")], "chunk_id string, ord int, text string, type string, canonical_id string")
    relations = spark.createDataFrame([("c", 0, "tom", "rot", "CAUSES")], "chunk_id string, ord int, source string, target string, type string")
    r = typed_relations(relations, entities).collect()
    assert len(r) == 1 and (r[0].source_type, r[0].source_text, r[0].target_type) == ("Disease", "Tom wilt", None)


def test_replies():
    assert recovered_json('ok\n```JSON\n{"a":1}\n```') == {"a": 1}
    assert recovered_json('{"a":1,"a":2}') == {"a": 2}
    assert recovered_json("{'a':1}") is None
    assert parse_reply("[]")["status"] == "bad_shape"
    got = parse_reply('{"entities":[{"text":0,"confidence":true},{"confidence":"1_0"},{"confidence":"high"}]}')["entities"]
    assert [e["confidence"] for e in got] == ["1.0", "10.0", None] and got[0]["text"] == ""


def test_prompt_shortens_images(spark):
    chunks = spark.createDataFrame([("t", "image", "page:1#idx:0", "b" * 1030, "f.md")], "text string, modality string, asset_ref string, image_b64_ref string, source_doc string")
    got = chunks.select(prompt(chunks, ontology.Ontology())).first()[0]
    assert got.endswith("INPUT:\nt\n\nIMAGE_ASSET_REF: page:1#idx:0\n\nIMAGE_B64_REF:\n" + "b" * 1024 + "...(truncated)\n\nSOURCE_DOC: f.md")
    assert "Focus on image caption/meta evidence" in got


def test_ontology_file(tmp_path):
    path = tmp_path / "o.json"
    assert ontology.load_ontology(path).labels == ontology.DEFAULT_LABELS
    path.write_text('{"allowed_entity_labels": ["Pest"], "allowed_relation_types": []}')
    loaded = ontology.load_ontology(path)
    assert loaded.labels == ("Pest",) and loaded.relations == ontology.DEFAULT_RELATIONS
    merged = ontology.merge_ontology(ontology.read_json(path), {"entity": {"Crop"}}, {"ko": {"왜"}}, 3, {"ph": {"max": 7.0}})
    assert merged["allowed_entity_labels"] == ["Crop", "Pest"] and merged["_generation_meta"]["chunk_texts_analyzed"] == 3
    assert ontology.merge_ontology({}, {"entity": {"Crop"}}, {}, 0)["allowed_entity_labels"] == ["Crop"]


def test_sensor_overlay_replaces_whole_sensors(spark):
    row = spark.range(1).select(F.expr("map('a', map('x', 1.0D), 'b', map('y', 2.0D))").alias("base"), F.expr("map('a', map('z', 3.0D))").alias("new"))
    assert row.select(ontology.merged_sensors(F.col("base"), F.col("new")).alias("m")).first().m == {"a": {"z": 3.0}, "b": {"y": 2.0}}
