"""Statements of graph tables: escapes, what is set, and files."""

import re

import pytest
from pyspark.sql import functions as F

from docweir.operators import graph
from docweir.operators.ontology import Ontology
from docweir.sources import graph_statements as statements


def unescaped(text):
    """What a quoted literal stands for."""
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "r": "\r"}.get(m[1], m[1]), text)


@pytest.mark.parametrize("value", ["", "a", "it's", "\\", "\\'", "'\\", "a\\nb", "a\nb\r\n'c'", "딸기 {x:1}", "''", "\\\\"])
def test_literals_come_back(spark, value):
    row = spark.createDataFrame([(value,)], "v string").select(statements.escaped(F.col("v")), statements.literal(F.col("v"))).first()
    assert row[0] == value.replace("\\", "\\\\").replace("'", "\\'")
    quoted = re.fullmatch(r"'((?:[^'\\\n\r]|\\.)*)'", row[1])
    assert quoted and unescaped(quoted[1]) == value


def made(spark, scope):
    chunks = spark.createDataFrame([("d#t0", "it's\nold", "d.md", 1), ("e#t0", "x", "", 2)], "chunk_id string, text string, source_doc string, seq long")
    entities = spark.createDataFrame(
        [("d#t0", 0, "Tom's", "Crop", "tom", 0.9, 1, "Solanum", None), ("d#t0", 1, "rot", "Odd", "rot", 0.0, 1, "", None)],
        "chunk_id string, ord int, text string, type string, canonical_id string, confidence double, seq long, scientific_name string, unit string",
    )
    relations = spark.createDataFrame(
        [("d#t0", 0, "tom", "far", "CAUSES", 0.25, "so", "Crop", "Tom's", None, None, 1)],
        "chunk_id string, ord int, source string, target string, type string, confidence double, evidence string, source_type string, source_text string, target_type string, target_text string, seq long",
    )
    vocabulary = Ontology()
    g_chunk = graph.chunk_nodes(chunks, scope)
    return {
        "g_chunk": g_chunk,
        "g_document": graph.document_nodes(chunks, scope),
        "g_has_chunk": graph.has_chunk_edges(chunks, g_chunk, scope),
        "g_entity": graph.entity_nodes(entities, relations, scope, vocabulary),
        "g_mentions": graph.mention_edges(entities, g_chunk, scope, vocabulary),
        "g_relation": graph.relation_edges(relations, scope, vocabulary),
    }


def test_statements(spark):
    tables = made(spark, graph.Scope(created_at="t0"))
    nodes = {r[0] for r in statements.node_statements(tables).collect()}
    assert nodes == {
        r"MERGE (n:Chunk {chunk_id:'d#t0', tier:'public'}) SET n.text='it\'s\nold', n.source_type='document', n.created_at='t0'",
        "MERGE (n:Chunk {chunk_id:'e#t0', tier:'public'}) SET n.text='x', n.source_type='document', n.created_at='t0'",
        "MERGE (n:Document {doc_id:'d.md', tier:'public'}) SET n.source_doc='d.md', n.created_at='t0'",
        r"MERGE (n:Entity:Crop {canonical_id:'tom', tier:'public'}) SET n.name='Tom\'s', n.type='Crop', n.confidence=0.9000, n.created_at='t0', n.scientific_name='Solanum'",
        "MERGE (n:Entity:Condition {canonical_id:'rot', tier:'public'}) SET n.name='rot', n.type='Condition', n.confidence=0.5000, n.created_at='t0'",
        "MERGE (n:Entity:Condition {canonical_id:'far', tier:'public'}) SET n.type='Condition'",
    }
    edges = {r[0] for r in statements.edge_statements(tables).collect()}
    assert len(edges) == 4
    assert (
        "MATCH (a:Entity:Crop {canonical_id:'tom', tier:'public'}), (b:Entity:Condition {canonical_id:'far', tier:'public'}) "
        "MERGE (a)-[r:CAUSES {tier:'public'}]->(b) SET r.confidence=0.2500, r.evidence='so', r.created_at='t0'"
    ) in edges


def test_private_rows_say_whose_they_are_and_files_hold_a_statement_a_line(spark, tmp_path):
    tables = made(spark, graph.Scope("private", "f'1", "t0"))
    statements.export_graph(tables, str(tmp_path / "out"))
    for name, n in (("nodes", 6), ("edges", 4)):
        lines = [line for p in (tmp_path / "out" / name).glob("part-*") for line in p.read_text().splitlines()]
        assert len(lines) == n and all(r"tier:'private', farm_id:'f\'1'}" in line for line in lines)
        assert (tmp_path / "out" / name / "_SUCCESS").exists()
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        statements.export_graph(tables, str(tmp_path / "out"))


def test_parts_of_orders_have_a_bounded_number_of_rows(spark):
    from unittest import mock

    from docweir.plans import samples

    with mock.patch.object(samples, "ORDER_ROWS", 100):
        chunks = samples.order_chunks(spark, "/root/testdata/sf0.001")
        assert chunks.rdd.getNumPartitions() == -(-chunks.count() // 100)
