"""Values of rows are computed once, and by cheap ways that give the same as the plain ones."""

import hashlib
import random

from pyspark.sql import functions as F

from docweir import registry
from docweir.functions import text as T
from docweir.operators import extraction, graph, vectors
from docweir.operators.ontology import Ontology


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filters_copy_no_rules_of_identifiers(spark):
    raw = spark.createDataFrame([], "chunk_id string, ord int, source string, target string, type string, confidence string, evidence string").repartition("chunk_id")
    relations = extraction.valid_relations(raw, Ontology())
    assert plan(relations).count("regexp_extract(") == 2
    names = [F.lit(None).cast("string").alias(f"{end}_{c}") for end in ("source", "target") for c in ("type", "text")]
    rows = graph._relation_rows(relations.select("*", *names, F.lit(1).alias("seq")), graph.Scope(), Ontology())
    assert plan(rows).count("regexp_extract(") == 2
    raw = spark.createDataFrame([], "chunk_id string, ord int, text string, type string, canonical_id string, confidence string").repartition("chunk_id")
    assert plan(extraction.valid_entities(raw, Ontology())).count("regexp_extract(") == 1


def test_mentions_compute_an_identifier_once(spark):
    entities = spark.createDataFrame([], "chunk_id string, ord int, text string, type string, canonical_id string, confidence double, seq long").repartition("chunk_id")
    rows = graph._entity_rows(entities, graph.Scope(), Ontology())
    assert plan(rows).count("RLIKE") == 1


def test_identifiers_and_confidences_are_as_by_the_plain_rules(spark):
    rnd = random.Random(3)
    values = ["", " ", "Part 1", "a  b", "a b\n", "a\n", "a　b", "A_b-c:.d", "딸기 x", "a/b", " x ", "é e", "a b c"] + ["".join(rnd.choice("aB1_ -:./\t é") for _ in range(rnd.randint(0, 9))) for _ in range(500)]
    joined = F.regexp_replace(T.strip(F.lower(F.col("v"))), f"{T.SPACE}+", "_")
    rows = spark.createDataFrame([(v,) for v in values], "v string").select(T.squeezed_id(F.col("v")).alias("a"), F.regexp_replace(joined, r"[^a-z0-9_\-:.]+", "").alias("b")).collect()
    assert all(r.a == r.b for r in rows)
    numbers = [None, 0.0, -0.0, float("nan"), -1.0, 2.0] + [k / 20000 for k in range(0, 20001, 7)] + [rnd.random() for _ in range(500)]
    filled = F.coalesce(F.nullif(F.col("v"), F.lit(0.0)), F.lit(0.5))
    plain = F.format_number(T.clamped(filled), 4).cast("double")
    rows = spark.createDataFrame([(v,) for v in numbers], "v double").select(T.graph_confidence(F.col("v")).alias("a"), plain.alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_slot_collisions_stay_in_their_row(spark):
    words = [f"t{k}" for k in range(20000)]
    texts = [("a", " ".join(words + words[:50])), ("b", " ".join(words[::3])), ("c", "x X x"), ("d", ""), ("e", None)]
    chunks = spark.createDataFrame(texts, "chunk_id string, text string")
    expected = []
    for key, text in texts:
        slots = {}
        for w in sorted(set((text or "").lower().split())):
            slots.setdefault(int(hashlib.md5(w.encode()).hexdigest()[4:8], 16), []).append(w)
        expected += [(key, s, len(ws), " ".join(ws)) for s, ws in slots.items() if len(ws) > 1]
    assert sorted(map(tuple, vectors.slot_collisions(chunks).collect())) == sorted(expected) and max(n for _, _, n, _ in expected) > 2
    found = registry.QUERIES["sparse_slot_collisions"](spark, "/root/testdata/sf0.001")
    assert "Aggregate" not in plan(found)
