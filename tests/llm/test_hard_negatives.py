"""Hard negatives against DuckDB, and against scoring all rows in plain Python."""

import math
import random
from unittest import mock

import duckdb
import numpy as np
import pytest

from docweir.llm import entry, hard_negatives

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, dim string, cell int, `a b` int"


def brute(rows, every=50):
    """All (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    kept = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        moved = vec_id is not None and vec_id % 7 == 0
        kept.append((vec_id, [math.floor(256 * x) for x in v], math.fmod(label + 1, 10) if moved else label))
    out = []
    for a, (vec_id, v, label) in enumerate(kept):
        if vec_id is None or vec_id % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), math.inf if i is None else i, i, m) for b, (i, w, m) in enumerate(kept) if b != a and len(w) == len(v)]
        for p, _, positive, _ in sorted((s for s in scored if s[3] == label), key=lambda s: s[:2])[:5]:
            fitting = sorted((s for s in scored if s[3] != label and 50 * -p <= 100 * -s[0] <= 95 * -p), key=lambda s: s[:2])[:3]
            out += [(vec_id, positive, k + 1, s[2], -p, -s[0]) for k, s in enumerate(fitting)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.drop("place", "anchor_row").collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    ours = entry.QUERIES["op13_hard_negatives"](spark, SF)
    theirs = con.sql(entry.ORACLE_SQL["op13_hard_negatives"])
    assert ours.columns == theirs.columns
    assert sorted(map(tuple, ours.collect())) == sorted(theirs.fetchall())


def sample_rows(seed, n=400, dim=6):
    rnd = random.Random(seed)
    centers = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(8)]
    rows = []
    for k in range(n):
        c = rnd.choice(centers)
        rows.append((k * 5, [float(np.float32(x + rnd.gauss(0, 0.2))) for x in c], rnd.randint(0, 3)))
    nan, inf = float("nan"), float("inf")
    rows += [(None, rows[3][1], 1), (50, rows[0][1], None), (100, None, 1), (150, [1.0, None, 1.0, 0.0, 0.0, 0.0], 1), (200, [nan] * dim, 1), (250, [inf] * dim, 1)]
    rows += [(300, [0.0] * dim, 1), (301, [], 1), (350, [], 1), (302, [], 2), (400, [1.0, 2.0], 1), (401, [1.0, 2.1], 1), (402, [0.6, 1.1], 2), (403, [1.0, 1.2], 3)]
    return rows + rows[:30] + [rows[10]] * 40


@pytest.mark.parametrize("block", [8192, 37])
def test_odd_rows_against_all_scores(spark, block):
    rows = sample_rows(1)
    with mock.patch.object(hard_negatives, "BLOCK", block), mock.patch.object(hard_negatives, "ANCHOR_BLOCK", 20):
        assert found(hard_negatives.hard_negatives(frame(spark, rows))) == brute(rows)


def test_few_rows_ties_and_dimensions_without_pivots(spark):
    same = [(50 * k, [0.5, 0.5], k % 2) for k in range(8)] + [(k, [0.25, 0.5], k % 3) for k in range(1, 30)]
    for rows in (same, same[:1], [(50, [1.0], 1), (51, [0.5], 2), (52, [1.0], 1)]):
        assert found(hard_negatives.hard_negatives(frame(spark, rows))) == brute(rows)
    # Of two sampled rows one dimension at least has no pivots.
    mixed = sample_rows(2, 60)
    assert found(hard_negatives.hard_negatives(frame(spark, mixed), sample=2)) == brute(mixed)


def test_empty_table(spark):
    empty = hard_negatives.hard_negatives(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    none_left = hard_negatives.hard_negatives(frame(spark, [(50, None, 1), (51, [1.0], None)]))
    assert none_left.count() == 0


def test_brackets_hold_all_scores_and_rule_out_far_clusters():
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((6, 16)) * 300
    rows = np.floor(np.concatenate([c + rng.standard_normal((50, 16)) * 8 for c in centers]))
    bound2 = (rows * rows).sum(axis=1).max()
    lifted = hard_negatives.augmented(rows, bound2)
    assert np.allclose((lifted * lifted).sum(axis=1), bound2)
    pivots = hard_negatives.choose_pivots(lifted, 8)
    anchors = rows[::25]
    to_anchor = hard_negatives.distances(np.pad(anchors, ((0, 0), (0, 1))), pivots)
    low, high = hard_negatives.brackets((anchors * anchors).sum(axis=1), to_anchor, hard_negatives.distances(lifted, pivots), bound2)
    exact = hard_negatives.scores(anchors, rows)
    assert (low <= exact).all() and (exact <= high).all()
    fifth = np.sort(exact, axis=1)[:, -6]
    assert (high >= fifth[:, None]).mean() < 0.5


def test_scores_beyond_doubles_are_exact():
    big = np.array([[2.0**30, 1.0, 3.0]])
    assert hard_negatives.scores(big, big).tolist() == [[2**60 + 10]]
