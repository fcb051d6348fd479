"""Deduplication operators against brute force."""

import itertools
import math
import random
from unittest import mock

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docweir import storage
from docweir.llm import embedding_dedup, golay, simhash, similar_texts
from docweir.llm.components import connected_components
from docweir.llm.exact_dedup import content_hash, exact_dedup
from docweir.llm.simhash import first_of_each_group, fingerprint, shingles, simhash_groups


def texts(spark):
    data = [(4, "a b"), (2, "ab"), (3, "a  b"), (9, None), (8, " \n"), (7, ""), (1, "ab"), (1, "ab"), (None, "a\tb c"), (6, "abc"), (5, "x" * 200_000)]
    return spark.createDataFrame([(i, t, 0, "z", True) for i, t in data], "doc_id long, text string, h int, norm string, kept boolean")


@pytest.mark.parametrize("hashed", [content_hash, lambda norm: F.unhex(F.substring(F.md5(norm), 1, 1)), lambda norm: F.lit(b"x")])
def test_exact(spark, hashed):
    got = exact_dedup(texts(spark), hashed).collect()
    rows = sorted((r.doc_id is None, r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in got)
    assert rows == sorted(
        [
            (False, 4, 3, 5, False), (False, 2, 3, 5, False), (False, 3, 3, 5, True), (False, 1, 3, 5, False), (False, 1, 3, 5, False),
            (False, 9, 8, 3, False), (False, 8, 8, 3, True), (False, 7, 8, 3, False), (True, 0, None, 2, True), (False, 6, None, 2, False), (False, 5, 5, 1, True),
        ]
    )
    assert exact_dedup(texts(spark).limit(0), hashed).count() == 0


def test_exact_keeps_one_of_repeated_rows(spark):
    got = exact_dedup(spark.createDataFrame([(1, "same")] * 5, "doc_id long, text string")).collect()
    assert sum(r.kept for r in got) == 1 and {r.group_size for r in got} == {5}


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 400)
    for w in words:
        mine = set(golay.fuzzy_keys(np.array([w]))[0].tolist()) - {-1}
        assert len(mine) in (1, 6)
        for _ in range(6):
            other = int(w)
            for b in rng.choice(23, 2, replace=False):
                other ^= 1 << int(b)
            assert mine & (set(golay.fuzzy_keys(np.array([other]))[0].tolist()) - {-1})


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {n: find(n) for n in nodes}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize("spread", [2, 5])
def test_fingerprint_links(spark, spread):
    rnd = random.Random(spread)
    fps = set()
    for base in (rnd.getrandbits(64) for _ in range(4)):
        for _ in range(90):
            f = base
            for _ in range(rnd.randint(0, spread)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    expected = brute_components(sorted(fps, key=signed), lambda a, b: (a ^ b).bit_count() <= 2)
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = dict(connected_components(simhash.fingerprint_links(frame)).collect())
    groups = {}
    for f, r in expected.items():
        groups.setdefault(r, set()).add(signed(f))
    assert got == {f: min(g) for g in groups.values() if len(g) > 1 for f in g}


def test_fingerprints():
    import xxhash

    text = "One two\x0bTHREE four É"
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in ("one two three", "two three four", "three four É")]
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 3)
    assert fingerprint(text, 3) == signed(expected)
    assert fingerprint("A b", 3) == signed(xxhash.xxh64_intdigest(b"a b", 42))
    assert fingerprint(None, 3) == fingerprint(" \n", 3) == 0


def test_simhash_rows(spark):
    data = [(3, "a b c d"), (1, "A b C d"), (5, None), (4, ""), (None, "a b c d"), (1, "A b C d"), (7, "q " * 50_000), (None, "lonely words here")]
    got = simhash_groups(spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id long, text string, fp string"))
    rows = got.collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (0, 1), (1, 1), (1, 1), (3, 1), (4, 4), (5, 4), (7, 7)]
    assert {r.fingerprint for r in rows if r.doc_id in (4, 5)} == {"0" * 16}
    assert first_of_each_group(got).count() == 4
    assert simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 300)] + [(1000, k) for k in range(1001, 1400)] + [(5, 5), (7, 6)]
    random.Random(1).shuffle(edges)
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 0 for k in range(301)} | {k: 1000 for k in range(1000, 1400)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_embeddings(rows, least):
    ok = {}
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            ok[k] = np.array(v, dtype=np.float64)

    def linked(a, b):
        if a not in ok or b not in ok or rows[a][2] != rows[b][2] or len(ok[a]) != len(ok[b]):
            return False
        return float(ok[a] @ ok[b]) / math.sqrt(float(ok[a] @ ok[a]) * float(ok[b] @ ok[b])) >= least

    n = [sum(linked(a, b) for b in range(len(rows)) if b != a) for a in range(len(rows))]
    root = brute_components(list(range(len(rows))), linked)
    first = {}
    for k, r in root.items():
        first[r] = min(first.get(r, rows[k][0]), rows[k][0])
    return sorted((rows[k][0], n[k], first[root[k]], rows[k][0] == first[root[k]]) for k in range(len(rows)))


@pytest.mark.parametrize("dim, tile", [(64, 8192), (8, 16), (3, 16)])
def test_embeddings(spark, dim, tile, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    monkeypatch.setattr(embedding_dedup, "LOOKUP", 64)
    rng = np.random.default_rng(dim)
    rows = []
    for c in range(6):
        center = rng.standard_normal(dim)
        for _ in range(12):
            v = center / np.linalg.norm(center) + rng.standard_normal(dim) * rng.uniform(0, 0.35) / math.sqrt(dim)
            rows.append((len(rows), [float(np.float32(x)) for x in v], c % 2))
    rows += [(100, rows[3][1], 0), (101, [2 * x for x in rows[3][1]], 0), (102, rows[3][1], None), (103, None, 0), (104, [0.0] * dim, 0)]
    rows += [(105, [float("nan")] * dim, 0), (106, [None] + rows[3][1][1:], 0), (107, [float("inf")] * dim, 0), (108, rows[3][1] + [0.0], 0), (109, [], 1), (100, rows[3][1], 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, dim string")
    got = embedding_dedup.embedding_groups(frame, 0.93).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == brute_embeddings(rows, 0.93)


def unit_vectors(name):
    table = pq.read_table(f"/root/testdata/{name}/embeddings.parquet").to_pandas()
    return {label: np.stack(rows.embedding.to_list()).astype(np.float64) for label, rows in table.groupby("label")}


def test_the_range_join_compares_few_pairs_and_loses_none():
    pairs, compared, linked = 0, [], 0
    for x in unit_vectors("sf0.1").values():
        pairs += len(x) * (len(x) - 1) // 2
        found = [(i, j) for a, b in embedding_dedup.linked_pairs(x, x, True, 4, 0.93, compared) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        expected = {(i, j) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.93, 1)), strict=True)}
        assert set(found) == expected and len(found) == len(expected)
        linked += len(found)
    assert sum(compared) < 0.05 * pairs


def test_range_index_equals_a_scan():
    rng = np.random.default_rng(5)
    x = np.round(rng.standard_normal((300, 6)), 1)
    index = embedding_dedup.RangeIndex(x)
    inside = index.inside(x[:40], 0.7, 64)
    exact = (np.abs(x[:40, None] - x[None, 64:]) <= 0.7).all(axis=2)
    assert inside.shape == exact.shape and not (exact & ~inside).any() and inside.sum() < 1.5 * exact.sum() + 40
    assert embedding_dedup.RangeIndex(x[:1]).inside(x[:1], 0.1).tolist() == [[True]]


def test_links_between_tiles_equal_links_within_one():
    x = next(iter(unit_vectors("sf0.01").values()))
    x = np.concatenate([x, x[:20] + np.random.default_rng(1).standard_normal((20, x.shape[1])) * 0.02])
    whole = {(i, j) for a, b in embedding_dedup.linked_pairs(x, x, True, 4, 0.93) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    cut = len(x) // 3
    parts = {(i + s, j + t) for s, t, p, q in ((0, 0, x[:cut], x[:cut]), (cut, cut, x[cut:], x[cut:]), (0, cut, x[:cut], x[cut:])) for a, b in embedding_dedup.linked_pairs(p, q, s == t, 4, 0.93) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    assert whole == parts and len(whole) >= 20


def test_no_embeddings(spark):
    assert embedding_dedup.embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_bit_sums():
    rows = np.random.default_rng(1).integers(0, 256, (700, 16), dtype=np.uint8)
    assert (simhash.bit_sums(rows) == np.unpackbits(rows, axis=1).sum(axis=0)).all()


def test_similar_texts(spark):
    rnd = random.Random(11)
    data, family = [(-1, None), (-2, ""), (-3, "two words"), (-4, "Two  WORDS")], {-1: "none", -2: "none", -3: "two", -4: "two"}
    for f in range(12):
        base = [f"w{rnd.randrange(4000)}" for _ in range(400)]
        for _ in range(25 if f == 0 else 3):
            words = list(base)
            words[rnd.randrange(400)] = "changed"
            family[len(data)] = f
            data.append((len(data), " ".join(words)))
    for _ in range(60):
        family[len(data)] = f"alone{len(data)}"
        data.append((len(data), " ".join(f"w{rnd.randrange(4000)}" for _ in range(120))))
    data += data[10:12]
    frame = spark.createDataFrame([(i, t, 0) for i, t in data], "doc_id long, text string, wide int")
    groups = similar_texts.similar_groups(frame)
    found = {}
    for r in groups.collect():
        found.setdefault(r.component, set()).add(r.doc_id)
    expected = {}
    for i, f in family.items():
        expected.setdefault(f, set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))
    assert first_of_each_group(groups).count() == len(expected)
    assert similar_texts.similar_groups(frame.limit(0)).count() == 0


def test_components_on_documents_are_those_of_all_direct_links(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r.doc_id: frozenset(shingles(r.text, 5)) for r in docs.collect()}
    component = {r.doc_id: r.component for r in similar_texts.similar_groups(docs).collect()}
    holders = {}
    for i, s in sets.items():
        for h in s:
            holders.setdefault(h, []).append(i)
    pairs = {p for ids in holders.values() for p in itertools.combinations(sorted(ids), 2)}
    links = {(a, b) for a, b in pairs if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert links and all(component[a] == component[b] for a, b in links)
    empty = [i for i, s in sets.items() if not s]
    links |= {(empty[0], i) for i in empty[1:]}
    root = {i: i for i in sets}
    for a, b in sorted(links):
        low, high = sorted((root[a], root[b]))
        root = {i: low if r == high else r for i, r in root.items()}
    groups = {}
    for i, c in component.items():
        groups.setdefault(c, set()).add(root[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(root.values()))


def exact_links(texts_, least=(4, 5)):
    sets = {i: set(shingles(t, 5)) for i, t in texts_.items()}

    def linked(a, b):
        return least[1] * len(sets[a] & sets[b]) >= least[0] * len(sets[a] | sets[b])

    return linked


def edited(base, n, rnd):
    """The text with n words replaced that share no shingle."""
    words = list(base)
    for at in rnd.sample(range(4, len(base) - 4, 5), n):
        words[at] = f"new{rnd.randrange(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("n_edits, together", [(8, True), (9, False)])
def test_pairs_about_the_threshold(spark, n_edits, together):
    # Of 396 shingles 8 edits leave a similarity of 0.817, and 9 edits one of 0.796.
    rnd = random.Random(n_edits)
    data = {}
    for k in range(0, 120, 2):
        base = [f"w{rnd.randrange(4000)}" for _ in range(400)]
        data |= {k: " ".join(base), k + 1: edited(base, n_edits, rnd)}
    linked = exact_links(data)
    assert all(linked(k, k + 1) == together for k in range(0, 120, 2))
    component = {r.doc_id: r.component for r in similar_texts.similar_groups(spark.createDataFrame(list(data.items()), "doc_id long, text string")).collect()}
    assert all((component[k] == component[k + 1]) == together for k in range(0, 120, 2))


@pytest.mark.parametrize("bucket", [similar_texts.BUCKET, 16, 1])
def test_crowded_texts_against_brute_force(spark, bucket):
    # With small buckets those of the common shingles are crowded, and their rows are dealt to several tasks.
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(4000)}" for _ in range(400)]
    data = {k: edited(base, rnd.choice((2, 5, 9, 14)), rnd) for k in range(90)} | {90: "", 91: "one two"}
    data |= {100 + k: " ".join(f"w{rnd.randrange(4000)}" for _ in range(60)) + " " + " ".join(base[:90]) for k in range(20)}
    frame = spark.createDataFrame(list(data.items()), "doc_id long, text string")
    groups, expected = {}, {}
    for r in similar_texts.similar_groups(frame, bucket=bucket).collect():
        groups.setdefault(r.component, set()).add(r.doc_id)
    for i, root in brute_components(sorted(data), exact_links(data)).items():
        expected.setdefault(root, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values())) and 20 < len(expected) < len(data)


def test_a_common_shingle_is_counted_in_several_tasks(spark):
    texts_ = spark.createDataFrame([(k, f"a b c d e n{k}") for k in range(400)], "row_id long, text string").repartition(8)
    crowded = similar_texts._crowded(texts_, 5, 100, 8).collect()
    assert crowded and max(r.load for r in crowded) >= 400
    held = {r.node: r.held for r in similar_texts._held(texts_, 5, 800, 8).collect()}
    common = {h.hash for h in held[0]}.intersection(*({h.hash for h in held[k]} for k in range(400)))
    assert len(held) == 400 and len(common) == 1 and len({h.df for k in held for h in held[k] if h.hash in common}) == 1


def test_written_tables_leave_no_shuffle_files(spark):
    def shuffle_files():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    setting = spark.conf.get(storage._CLEANUP)
    before = shuffle_files()
    table = storage.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    texts_ = spark.createDataFrame([(k, f"a b c d e n{k}") for k in range(400)], "row_id long, text string").repartition(8)
    held = storage.materialize(similar_texts._held(texts_, 5, 800, 8), "held")
    assert not {f for f in shuffle_files() - before if f.endswith(".data")} and spark.conf.get(storage._CLEANUP) == setting
    assert table.count() == 7 and held.count() == 400


def test_parity_sketches(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) - 2**63 for _ in range(300)]
    sets = [(0, 0, []), (1, 3, base[:1])]
    for node in range(2, 40):
        n_changed = rng.randrange(0, 60)
        sets.append((node, rng.randrange(0, 20), rng.sample(base, 300 - n_changed) + [rng.getrandbits(63) for _ in range(n_changed)]))
    sketched = similar_texts._sketches(spark.createDataFrame(sets, "node long, alone long, hashes array<long>"))
    found = {r.node: [r[f"s{i}"] for i in range(similar_texts.SKETCH)] for r in sketched.collect()}
    for node, _, hashes in sets:
        expected = [0] * similar_texts.SKETCH
        for h in hashes:
            expected[h % similar_texts.SKETCH] ^= 1 << (h % 2**64 // similar_texts.SKETCH % 64)
        assert [s % 2**64 for s in found[node]] == expected
    sizes = spark.createDataFrame([(n, alone + len(h)) for n, alone, h in sets], "node long, size long")
    ends = [sketched.join(sizes, "node").select(*[F.col(c).alias(f"{c}_{e}") for c in (*sketched.columns, "size")]) for e in "ab"]
    passed = ends[0].join(ends[1], F.col("node_a") < F.col("node_b")).where(similar_texts._near_enough(similar_texts.SIMILARITY))
    passed = {(r.node_a, r.node_b) for r in passed.select("node_a", "node_b").collect()}
    near = set()
    for a, alone_a, ha in sets:
        for b, alone_b, hb in sets:
            common = len(set(ha) & set(hb))
            if a < b and common * 5 >= 4 * (alone_a + alone_b + len(ha) + len(hb) - common):
                near.add((a, b))
    assert near and near <= passed
    assert len(passed) < len(sets) * (len(sets) - 1) // 2


def test_holders_of_a_template_meet_by_classes_only(spark):
    """Texts that fill in one template too differently to link give no classes that meet, so no pairs are looked at."""
    words = [f"w{k}" for k in range(40)]
    found = []
    whole = similar_texts._meeting

    def meeting(classed, similarity):
        out = whole(classed, similarity)
        found.append((classed.count(), out.count()))
        return out

    for n in (200, 400):
        rows = [(k, " ".join(f"own{k}" if i == k % 40 else w for i, w in enumerate(words))) for k in range(n)]
        with mock.patch.object(similar_texts, "_meeting", meeting):
            got = similar_texts.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
            by_component = {}
            for r in got.collect():
                by_component.setdefault(r.component, set()).add(r.doc_id)
        # Brute force: words changed at either end of the text touch fewer shingles, so only such texts link.
        shingles = [{tuple(t.split()[i : i + 5]) for i in range(36)} for _, t in rows]
        root = list(range(n))
        for a in range(n):
            for b in range(a + 1, n):
                if len(shingles[a] & shingles[b]) * 5 >= len(shingles[a] | shingles[b]) * 4:
                    root = [root[a] if r == root[b] else r for r in root]
        expected = {}
        for k, r in enumerate(root):
            expected.setdefault(r, set()).add(k)
        assert sorted(map(sorted, by_component.values())) == sorted(map(sorted, expected.values()))
    assert all(holders > 20 * classes for holders, classes in found)


def near_copies(n, rnd):
    """Copies of one text with one to four words changed or put in, most of them too far from any one of the others to link with it."""
    base = [f"w{rnd.randrange(4000)}" for _ in range(150)]
    copies = []
    for _ in range(n):
        words = list(base)
        for at in rnd.sample(range(150), rnd.randint(1, 4)):
            words[at] = f"new{rnd.randrange(10**9)}" if rnd.random() < 0.7 else f"{words[at]} new{rnd.randrange(10**9)}"
        copies.append(" ".join(words))
    return copies


@pytest.mark.parametrize("rounds", [True, False])
def test_a_large_group_of_near_copies_is_gathered_not_paired(spark, rounds):
    rnd = random.Random(3)
    data = dict(enumerate(near_copies(500, rnd) + near_copies(60, rnd)))
    written, whole = {}, similar_texts.materialize

    def materialize(df, name):
        out = whole(df, name)
        written.setdefault(name, []).append(out.count())
        return out

    few = 2 if rounds else 10**9
    with mock.patch.object(similar_texts, "materialize", materialize), mock.patch.object(similar_texts, "WORTHWHILE", few):
        frame = spark.createDataFrame(list(data.items()), "doc_id long, text string").repartition(8)
        found = {}
        for r in similar_texts.similar_groups(frame).collect():
            found.setdefault(r.component, set()).add(r.doc_id)
    expected = {}
    for i, root in brute_components(sorted(data), exact_links(data)).items():
        expected.setdefault(root, set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values())) and 2 < len(expected) < 0.8 * len(data)
    # Without rounds the holders of common keys meet in pairs across the components that the first centers leave, and the result is the same.
    assert (written["similar-candidates"] < [2 * len(data)]) == rounds
    assert all(n <= len(data) for n in written.get("similar-more-stars", []))
