"""Near-duplicates by the similarity of their sets of shingles, verified on the shingles, none lost.

SimHash finds texts that are almost identical: two texts with a similarity of 0.8 differ
in nine of 64 bits on average, far beyond the two bits that fuzzy keys reach. So its
links come first, since they are cheap, and shared rare shingles give the rest.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweir.llm.batches import bounded
from docweir.llm.components import connected_components
from docweir.llm.simhash import digests, fingerprint_links, majority
from docweir.storage import materialize

#: Share of the shingles of two texts that both must have.
SIMILARITY = Fraction(4, 5)
#: Hashes of shingles that are counted together, about, and how many times as many make a bucket crowded.
BUCKET, CROWDED = 1 << 19, 4
#: Longs of a parity sketch.
SKETCH = 8
#: Another round looks for links while as many times the pairs that it looks at are left.
WORTHWHILE = 2


def distinct_hashes(rows: np.ndarray) -> np.ndarray:
    """The set of hashes, sorted; no rows give none."""
    return np.unique(np.ascontiguousarray(rows).view(">u8").ravel().astype(np.uint64))


def _sets(texts: DataFrame, n_words: int) -> DataFrame:
    """(row_id, doc_id, set_id, size, fp): a hash of 128 bits names a text's set of shingles."""

    def run(batches):
        for batch in bounded(batches):
            hashed = [digests(t, n_words) for t in batch.column("text").to_pylist()]
            found = [distinct_hashes(rows) for rows in hashed]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_id"),
                    batch.column("doc_id"),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found], pa.binary()),
                    pa.array([len(s) for s in found], pa.int64()),
                    pa.array(map(majority, hashed), pa.int64()),
                ],
                names=["row_id", "doc_id", "set_id", "size", "fp"],
            )

    doc_id = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"row_id bigint, doc_id {doc_id}, set_id binary, size bigint, fp bigint")


def _bucket(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)


def _crowded(texts: DataFrame, n_words: int, n_buckets: int, bucket: int) -> DataFrame:
    """(bucket, load): buckets that shingles of very many texts fall into, and the hashes they get."""

    def run(batches):
        for batch in bounded(batches):
            found = [distinct_hashes(digests(t, n_words)) for t in batch.column("text").to_pylist()]
            present, n = np.unique(_bucket(np.concatenate(found), n_buckets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(present), pa.array(n.astype(np.int64))], names=["bucket", "n"])

    loads = texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("load"))
    return materialize(loads.where(F.col("load") > CROWDED * bucket), "similar-crowded")


def _dealt(texts: DataFrame, n_words: int, n_buckets: int) -> DataFrame:
    """(bucket, high, hashes, lows): the hashes of some rows that fall into a bucket, and 32 bits each of the row_id of every hash."""

    def run(batches):
        for batch in bounded(batches):
            ids = batch.column("row_id").to_numpy()
            found = [distinct_hashes(digests(t, n_words)) for t in batch.column("text").to_pylist()]
            cuts = [0, *(np.flatnonzero(np.diff(ids >> 32)) + 1).tolist(), len(ids)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                hashes = np.concatenate(found[low:high])
                owners = np.repeat((ids[low:high] & 0xFFFFFFFF).astype(np.uint32), [len(s) for s in found[low:high]])
                if not len(hashes):
                    continue
                bucket = _bucket(hashes, n_buckets)
                order = np.argsort(bucket, kind="stable")
                hashes, owners = hashes[order], owners[order]
                present, starts = np.unique(bucket[order], return_index=True)
                ends = [*starts[1:].tolist(), len(hashes)]
                parts = [[x[a:b].tobytes() for a, b in zip(starts.tolist(), ends, strict=True)] for x in (hashes, owners)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(present), pa.array(np.full(len(present), ids[low] >> 32)), *(pa.array(p, pa.binary()) for p in parts)],
                    names=["bucket", "high", "hashes", "lows"],
                )

    return texts.select("row_id", "text").mapInArrow(run, "bucket bigint, high bigint, hashes binary, lows binary")


def _shared_hashes(table):
    """For one bucket: (node, hash, df) of the hashes that several rows hold; for a part of a crowded one, of all hashes, with the load as their df."""
    parts = [np.frombuffer(h, dtype=np.uint64) for h in table.column("hashes").to_pylist()]
    lows = np.frombuffer(b"".join(table.column("lows").to_pylist()), dtype=np.uint32)
    owners = (np.repeat(table.column("high").to_numpy(), [len(p) for p in parts]) << 32) + lows
    hashes = np.concatenate(parts)
    load = table.column("load")[0].as_py()
    if load is not None:
        return pa.table({"node": owners, "hash": hashes.view(np.int64), "df": np.full(len(hashes), load)})
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    df = counts[inverse]
    some = df > 1
    return pa.table({"node": owners[some], "hash": hashes[some].view(np.int64), "df": df[some]})


def _held(texts: DataFrame, n_words: int, total: int, bucket: int) -> DataFrame:
    """(node, held): each text's hashes, but those that no other row holds, in the order of (df, hash).

    The order must be one for all texts, and is the better the rarer its first hashes are,
    but nothing needs exact numbers. So a bucket with a shingle of very many texts isn't
    counted in one task: its rows are dealt to as many tasks as it takes, and all its
    hashes come last in the order, by the load of the bucket.
    """
    n_buckets = max(1, -(-total // bucket))
    part = F.when(F.col("load").isNotNull(), F.pmod(F.xxhash64("high", "lows"), F.ceil(F.col("load") / bucket))).otherwise(0)
    shared = (
        _dealt(texts, n_words, n_buckets)
        .join(_crowded(texts, n_words, n_buckets, bucket), "bucket", "left")
        .withColumn("part", part)
        .groupBy("bucket", "part")
        .applyInArrow(_shared_hashes, "node bigint, hash bigint, df bigint")
    )
    # Written, so that the shuffle of all hashes is gone before that of the shared ones begins.
    return (
        materialize(shared, "similar-hashes")
        .groupBy("node")
        # Two lists of longs, filled from the same rows in the same order, take two thirds of the shuffle that one of structs does.
        .agg(F.collect_list("df").alias("df"), F.collect_list("hash").alias("hash"))
        .select("node", F.sort_array(F.arrays_zip("df", "hash")).alias("held"))
    )


def _verified(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs (a, b, size_a, size_b, ...) whose sets have the similarity, counted on their shingles."""
    over, under = similarity.numerator, similarity.denominator
    left, right = (sets.select(F.col("node").alias(c), F.col("hashes").alias(f"hashes_{c}")) for c in ("a", "b"))
    common = F.size(F.array_intersect("hashes_a", "hashes_b"))
    enough = common * (over + under) >= (F.col("size_a") + F.col("size_b")) * over
    return pairs.join(left, "a").join(right, "b").where(enough).select(*pairs.columns)


def _may_link(similarity: Fraction) -> Column:
    """Whether two holders of a key may have the similarity, by their sizes and by what follows the key in both.

    It never denies a pair at the first key that both hold.
    """
    over, under = similarity.numerator, similarity.denominator
    sizes = F.least("size_a", "size_b") * under >= F.greatest("size_a", "size_b") * over
    left = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    return sizes & (left * (over + under) >= (F.col("size_a") + F.col("size_b")) * over)


def _classed(holders: DataFrame) -> DataFrame:
    """Holders of keys with the class of their size, in steps of 2 %, and of their place, in hundredths of the size."""
    size_class = F.floor(F.log(F.col("size").cast("double")) / float(np.log(1.02))).cast("int")
    return holders.withColumns({"size_class": size_class, "place_class": F.floor(F.col("place") * 100 / F.col("size")).cast("int")})


def _meeting(classed: DataFrame, similarity: Fraction) -> DataFrame:
    """(key, size_class_a, place_class_a, size_class_b, place_class_b): classes of a key's holders of which some may link, each two once.

    A key has some thousands of classes at most, however many hold it. What rules two of
    them out, rules out every pair of their members: sizes that are too far apart, too
    little left after the key in either, or one component that holds both.
    """
    over, under = similarity.numerator, similarity.denominator
    own = ["size_class", "place_class"]
    stats = {
        "least": F.min("size"), "most": F.max("size"), "left": F.max(F.col("size") - F.col("place")), "low": F.min("root"), "high": F.max("root"),
    }
    classes = materialize(classed.groupBy("key", *own).agg(*[f.alias(n) for n, f in stats.items()]), "similar-classes-of-keys")
    a, b = (classes.select("key", *[F.col(c).alias(f"{c}_{end}") for c in (*own, *stats)]) for end in ("a", "b"))
    in_order = F.struct(*[f"{c}_a" for c in own]) <= F.struct(*[f"{c}_b" for c in own])
    sizes = (F.col("most_a") * under >= F.col("least_b") * over) & (F.col("most_b") * under >= F.col("least_a") * over)
    rest = F.least("left_a", "left_b") * (over + under) >= (F.col("least_a") + F.col("least_b")) * over
    apart = F.least("low_a", "low_b") != F.greatest("high_a", "high_b")
    return a.join(b, "key").where(in_order & sizes & rest & apart).select("key", *[f"{c}_{end}" for end in ("a", "b") for c in own])


def _sketches(sets: DataFrame) -> DataFrame:
    """(node, alone, s0, s1, ...): a parity sketch of each set's held hashes, one bit for the parity of those that fall on it."""
    word = f"(hash & {SKETCH - 1})"
    bit = f"shiftleft(1L, cast(shiftrightunsigned(hash, {(SKETCH - 1).bit_length()}) & 63 AS int))"
    words = [F.expr(f"bit_xor(CASE WHEN {word} = {i} THEN {bit} ELSE 0L END)").alias(f"s{i}") for i in range(SKETCH)]
    return sets.select("node", "alone", F.explode_outer("hashes").alias("hash")).groupBy("node", "alone").agg(*words)


def _apart() -> Column:
    """A lower bound of how many hashes only one of two sets has.

    Two sketches differ in at most as many bits as the sets have held hashes that only one
    of them has, and hashes that no other row holds come on top.
    """
    return sum((F.bit_count(F.col(f"s{i}_a").bitwiseXOR(F.col(f"s{i}_b"))) for i in range(SKETCH)), F.col("alone_a") + F.col("alone_b"))


def _near_enough(similarity: Fraction) -> Column:
    """Whether two sets may have the similarity by what they don't share; no pair with the similarity is denied."""
    over, under = similarity.numerator, similarity.denominator
    return _apart() * (over + under) <= (F.col("size_a") + F.col("size_b")) * (under - over)


def _ended(end: str, prefix: str = "", more: tuple[str, ...] = ()) -> list[Column]:
    """The columns of a holder as one end of a pair."""
    named = {"node": end, "size": f"size_{end}", "place": f"place_{end}"} | {c: f"{c}_{end}" for c in more}
    return [F.col(prefix + c).alias(name) for c, name in named.items()]


def _mains(holders: DataFrame) -> DataFrame:
    """(key, main, members, others) of the open keys: the component that most holders of the key are in, all its holders, and those in other components."""
    counts = holders.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    mains = counts.groupBy("key").agg(
        F.max(F.struct("n", "root")).getField("root").alias("main"), F.sum("n").alias("members"), (F.sum("n") - F.max("n")).alias("others")
    )
    return mains.where("others > 0")


def _center_pairs(holders: DataFrame, similarity: Fraction, n_centers: int) -> DataFrame:
    """(a, b, size_a, size_b, root_a, root_b): for every component that holders of open keys (with the key's main) are in, the pair most likely to link it with a center of another.

    A key's centers are some holders in its main component and as many outside. A hash
    draws them, other ones for each number of centers, and favours early places of the key:
    these sets have the least that others don't.
    """
    more = ("root", "alone", *(f"s{i}" for i in range(SKETCH)))
    draw = F.pmod(F.xxhash64("node", "key", F.lit(n_centers)), F.lit(1 << 20)) + 1
    order = Window.partitionBy("key", F.col("root") == F.col("main")).orderBy(draw * F.pow(F.col("place") + 1.0, F.lit(3.0)), "node")
    centers = holders.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_centers).select("key", *_ended("a", more=more))
    pairs = centers.join(holders.select("key", *_ended("b", more=more)), "key")
    near = pairs.where((F.col("root_a") != F.col("root_b")) & _may_link(similarity) & _near_enough(similarity))
    best = F.min_by(F.struct("a", "b", "size_a", "size_b", "root_a"), F.struct(_apart() / (F.col("size_a") + F.col("size_b")), "a", "b"))
    return near.groupBy("root_b").agg(best.alias("best")).select("best.*", "root_b")


def _gathered(holders: DataFrame, sets: DataFrame, similarity: Fraction) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Holders of open keys under the roots of larger components, their keys' mains, and the links (a, b) that made them.

    The first center of a key is too far from many of a group of near copies, which are one
    component all the same. Rounds, each with twice the centers, compare every component
    with its nearest center. They end when one finds nothing or looks at about as many
    pairs as are left, so that all of them together look at no more than that.
    """
    links: list[DataFrame] = []
    n_centers = 1
    while True:
        mains = materialize(_mains(holders), "similar-mains")
        pairs, members = mains.agg(F.sum(F.col("members") * F.col("others")), F.sum("members")).first()
        if (pairs or 0) <= WORTHWHILE * 2 * n_centers * (members or 0):
            return holders, mains, links
        found = materialize(_verified(_center_pairs(holders.join(mains, "key"), similarity, n_centers), sets, similarity), "similar-more-stars")
        if found.isEmpty():
            return holders, mains, links
        links.append(found)
        joined = connected_components(found.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
        moved = joined.select(F.col("node").alias("root"), F.col("root").alias("to"))
        rest = holders.join(mains.select("key"), "key", "left_semi").join(moved, "root", "left")
        holders = materialize(rest.withColumn("root", F.coalesce("to", "root")).drop("to"), "similar-gathered")
        n_centers *= 2


def _across(holders: DataFrame, mains: DataFrame, meeting: DataFrame, similarity: Fraction) -> DataFrame:
    """(a, b, size_a, size_b): holders of a key in different components that may link, of classes that meet.

    One of the two is outside the key's main component, so holders in it never meet each
    other. What is looked at grows with those outside times all.
    """
    own = ("size_class", "place_class")
    more = ("root", "alone", "main", *own, *(f"s{i}" for i in range(SKETCH)))
    ends = [f"{c}_{end}" for end in ("a", "b") for c in own]
    turned = meeting.select("key", *[F.col(c).alias(to) for c, to in zip(ends, ends[2:] + ends[:2], strict=True)])
    both_ways = meeting.unionByName(turned).distinct()
    placed = holders.join(mains.select("key", "main"), "key")
    left, right = (placed.select("key", *_ended(end, more=more)) for end in ("a", "b"))
    once = (F.col("root_b") == F.col("main_b")) | (F.col("a") < F.col("b"))
    return (
        left.where("root_a != main_a")
        .join(both_ways, ["key", *ends[:2]])
        .join(right, ["key", *ends[2:]])
        .where(once & (F.col("root_a") != F.col("root_b")) & _may_link(similarity) & _near_enough(similarity))
        .select("a", "b", "size_a", "size_b")
        .distinct()
    )


def _simhash_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b, size_a, size_b): nodes whose fingerprints are equal or within two bits, each fingerprint standing for its first node."""
    first = materialize(nodes.groupBy("fp").agg(F.min(F.struct("node", "size")).alias("first")), "similar-fingerprints")
    ends = [first.select(F.col("fp").alias(f"fp_{c}"), F.col("first.node").alias(c), F.col("first.size").alias(f"size_{c}")) for c in ("a", "b")]
    links = fingerprint_links(first.select("fp")).select(F.col("a").alias("fp_a"), F.col("b").alias("fp_b"))
    near = links.join(ends[0], "fp_a").join(ends[1], "fp_b").select("a", "b", "size_a", "size_b")
    equal = nodes.join(first, "fp").select(F.col("first.node").alias("a"), F.col("node").alias("b"), F.col("first.size").alias("size_a"), F.col("size").alias("size_b"))
    return near.union(equal.where("a != b"))


def similar_groups(docs: DataFrame, n_words: int = 5, similarity: Fraction = SIMILARITY, row_id: str | None = None, bucket: int = BUCKET) -> DataFrame:
    """(row_id, doc_id, component) of every row; rows of one component are linked by near-duplicates.

    Two texts link if and only if the Jaccard similarity of their sets of shingles is
    ``similarity`` or more, and components are those of all links. Texts with equal sets
    are one node. Candidates come from two sources. SimHash fingerprints, through their
    Golay keys, give texts that are almost identical. A prefix filter loses no link: with
    all shingles in one order, rarest first, two sets of n and m shingles that link have a
    shingle (a key) in common among the first n - ceil(similarity * n) + 1 of one and as
    many by m of the other. All candidates are verified on the shingles, compared by hashes
    of 64 bits; what no other row holds is in no intersection and is only counted.

    All keys are worked alike, whatever their number of holders. First every holder is
    compared with one of them, the key's center: a group of near copies becomes one
    component by as many comparisons as it has members. Then a key whose holders are all
    in one component is done. The holders of the others fall into classes by size and place
    of the key; only classes meet whose sizes and places allow a link, so that a template
    that very many texts fill in, each too differently to link, gives no pairs at all. Of
    classes that meet, pairs across components are compared if parity sketches allow a link.

    Null and empty texts are one node. Texts may be of any length. Repeated rows are rows
    of their own. ``row_id`` names a stored column of longs that tells rows apart; without
    one, rows are written with a number first, since texts are read twice. Other columns
    are ignored; an empty table gives an empty result.
    """
    over, under = similarity.numerator, similarity.denominator
    number = F.monotonically_increasing_id() if row_id is None else F.col(row_id)
    texts = docs.select(number.alias("row_id"), "doc_id", "text")
    texts = materialize(texts, "similar-texts") if row_id is None else texts
    rows = materialize(_sets(texts, n_words), "similar-rows")
    firsts = rows.groupBy("set_id").agg(F.min(F.struct("row_id", "size", "fp")).alias("f"))
    nodes = materialize(firsts.select("set_id", F.col("f.row_id").alias("node"), "f.size", "f.fp"), "similar-nodes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    held = _held(texts, n_words, total, bucket)
    # Hashes that are not held here are those of one row; they come first in the order and take up their part of the prefix.
    alone = F.col("size") - F.size("held")
    prefix = F.expr(f"size - (size * {over} + {under - 1}) DIV {under} + 1") - alone
    sets = materialize(
        held.join(nodes, "node").select(
            "node",
            "size",
            alone.alias("alone"),
            F.col("held.hash").alias("hashes"),
            F.slice("held.hash", F.lit(1), F.greatest(prefix.cast("int"), F.lit(0))).alias("keys"),
        ),
        "similar-sets",
    )
    keyed = sets.select("node", "size", "alone", F.posexplode("keys").alias("at", "key")).select(
        "key", "node", "size", (F.col("alone") + F.col("at")).alias("place")
    )
    # A hash chooses the center, so that it is a member like any other.
    holder = F.struct(F.xxhash64("node").alias("draw"), "node", "size", "place")
    centers = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min(holder).alias("center")).where("members > 1")
    shared = materialize(keyed.join(centers, "key"), "similar-shared")

    spokes = shared.select(*_ended("a", "center."), *_ended("b")).where("a != b").where(_may_link(similarity))
    first_pairs = spokes.select("a", "b", "size_a", "size_b").union(_simhash_pairs(nodes)).distinct()
    stars = materialize(_verified(first_pairs, sets, similarity).select("a", "b"), "similar-stars")
    reached = materialize(connected_components(stars), "similar-reached")
    placed = materialize(
        shared.select("key", "node", "size", "place").join(reached, "node", "left").withColumn("root", F.coalesce("root", "node")), "similar-placed"
    )
    open_keys = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("key")
    undecided = materialize(_classed(placed.join(open_keys, "key", "left_semi")), "similar-open")
    meeting = materialize(_meeting(undecided, similarity), "similar-meeting")
    classes = ("size_class", "place_class")
    ends = [meeting.select("key", *[F.col(f"{c}_{end}").alias(c) for c in classes]) for end in ("a", "b")]
    asked = undecided.join(ends[0].union(ends[1]).distinct(), ["key", *classes], "left_semi")
    sketches = _sketches(sets.join(asked.select("node").distinct(), "node", "left_semi"))
    sketched = materialize(asked.join(sketches, "node"), "similar-sketched")
    gathered, mains, more_stars = _gathered(sketched, sets, similarity)
    across = _across(gathered, mains, meeting, similarity)
    links = _verified(materialize(across, "similar-candidates"), sets, similarity).select("a", "b").union(stars)
    for found in more_stars:
        links = links.union(found.select("a", "b"))
    roots = materialize(connected_components(links), "similar-roots")
    classes = materialize(
        nodes.join(roots, "node", "left").select("set_id", F.coalesce("root", "node").alias("component")), "similar-classes"
    )
    return rows.join(classes, "set_id").select("row_id", "doc_id", "component")
