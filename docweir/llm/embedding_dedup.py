"""Near-duplicate embeddings by a subspace pigeonhole join."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweir.llm.components import connected_components
from docweir.storage import materialize

#: Vectors of a tile; a task joins two tiles of one label, so it holds twice as many.
TILE = 8192
#: Edges by which each coordinate of a tile is indexed, and vectors that are looked up together.
EDGES, LOOKUP = 128, 256
#: Pairs whose distances are computed together.
RUN = 1 << 14


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix, so that a distance spreads over all blocks."""
    return np.linalg.qr(np.random.default_rng(20240229 + dim).standard_normal((dim, dim)))[0]


def block_edges(dim: int, blocks: int) -> np.ndarray:
    return np.linspace(0, dim, min(blocks, dim) + 1).astype(int)


def block_budgets(dim: int, blocks: int, min_cosine: float) -> np.ndarray:
    """What each block may contribute to the squared distance: its share by dimensions.

    The distance of linked unit vectors is 2 - 2 cos at most, so at least one block is
    within its share. The addend is room for rounding, far above any there is.
    """
    return (2 - 2 * min_cosine + 1e-5) * np.diff(block_edges(dim, blocks)) / dim


def _prepared(vectors: DataFrame) -> DataFrame:
    """(row_id, vec_id, label, dim, raw): doubles scaled to a largest component of 1; dim and raw are null if the vector can't link."""

    def run(batches):
        for batch in batches:
            lists, labels = batch.column("embedding"), batch.column("label")
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts, labelled = np.cumsum(lengths) - lengths, labels.is_valid().to_numpy(zero_copy_only=False)
            raws: list[bytes | None] = [None] * batch.num_rows
            for dim in np.unique(lengths[labelled & (lengths > 0)]):
                at = np.flatnonzero(labelled & (lengths == dim))
                x = values[starts[at][:, None] + np.arange(dim)]
                usable = np.isfinite(x).all(axis=1) & x.any(axis=1)
                at, x = at[usable], x[usable]
                # Adding zero gives both zeros one form.
                for k, scaled in zip(at.tolist(), x / np.abs(x).max(axis=1, keepdims=True) + 0.0, strict=True):
                    raws[k] = scaled.tobytes()
            dims = [n if raw is not None else None for n, raw in zip(lengths.tolist(), raws, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row_id", "vec_id", "label")), pa.array(dims, pa.int32()), pa.array(raws, pa.binary())],
                names=["row_id", "vec_id", "label", "dim", "raw"],
            )

    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return vectors.select(F.monotonically_increasing_id().alias("row_id"), "vec_id", "label", "embedding").mapInArrow(
        run, f"row_id bigint, vec_id {kinds['vec_id']}, label {kinds['label']}, dim int, raw binary"
    )


class RangeIndex:
    """Bitmaps over the vectors of a block, from which all those within a box around a point are read.

    Bitmap ``k`` of a coordinate marks the vectors below its edge ``k``, so an interval is
    one bitmap without another, and a box is the intersection of as many as the block has
    coordinates. The edges are quantiles: an interval is read too wide by one part in
    ``EDGES`` at either end, never too narrow.
    """

    def __init__(self, vectors: np.ndarray) -> None:
        self.n = len(vectors)
        at = np.unique(np.linspace(0, self.n - 1, min(EDGES, self.n)).astype(int))
        self.edges = np.sort(vectors, axis=0)[at].T.copy()
        words = -(-self.n // 64)
        self.below = np.zeros((vectors.shape[1], len(at) + 2, words), dtype=np.uint64)
        for c, edges in enumerate(self.edges):
            marks = np.zeros((len(at) + 2, words * 64), dtype=bool)
            marks[1:-1, : self.n] = vectors[:, c] < edges[:, None]
            marks[-1, : self.n] = True
            self.below[c] = np.packbits(marks, axis=1, bitorder="little").view(np.uint64)

    def inside(self, points: np.ndarray, radius: float, first: int = 0) -> np.ndarray:
        """For each point, which vectors from ``first`` (a multiple of 64) on are within ``radius`` in every coordinate, and maybe a few that are not."""
        found, skip = None, first // 64
        # Room for the rounding of both ends, and of the difference that a scan would take.
        reach = radius + 4 * np.finfo(np.float64).eps * (np.abs(points) + radius)
        for c, edges in enumerate(self.edges):
            low = np.searchsorted(edges, points[:, c] - reach[:, c], side="right")
            high = np.searchsorted(edges, points[:, c] + reach[:, c], side="right") + 1
            band = self.below[c, high, skip:] & ~self.below[c, low, skip:]
            found = band if found is None else found & band
        return np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")[:, : self.n - first].view(bool)


def _in_runs(i: np.ndarray, j: np.ndarray, test) -> np.ndarray:
    """``test`` of all pairs, some at a time."""
    parts = [test(i[k : k + RUN], j[k : k + RUN]) for k in range(0, len(i), RUN)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=bool)


def linked_pairs(a: np.ndarray, b: np.ndarray, same: bool, blocks: int, min_cosine: float, compared: list[int] | None = None):
    """(i, j) arrays of the linked pairs of two tiles, each pair once; of one tile, those with i < j.

    Each block of the rotated unit vectors is range-joined: its index gives the pairs
    within the block's budget in every coordinate, and those that keep the budget as a
    squared distance are candidates. The union over the blocks is verified by the cosine
    of the vectors as they are, computed alike for a pair in every task. ``compared``
    collects how many pairs the indexes gave.
    """
    dim = a.shape[1]
    edges, budgets = block_edges(dim, blocks), block_budgets(dim, blocks, min_cosine)
    spans = list(zip(edges.tolist(), edges[1:].tolist(), strict=False))
    norm_a, norm_b = (np.sqrt((x * x).sum(axis=1)) for x in (a, b))
    turned_a, turned_b = (x / norm[:, None] @ rotation(dim).T for x, norm in ((a, norm_a), (b, norm_b)))
    indexes = [RangeIndex(turned_b[:, low:high]) for low, high in spans]
    for start in range(0, len(a), LOOKUP):
        first = start if same else 0
        union = np.zeros((len(a[start : start + LOOKUP]), len(b) - first), dtype=bool)
        later = np.arange(len(union))[:, None] < np.arange(union.shape[1]) if same else True
        for (low, high), budget, index in zip(spans, budgets, indexes, strict=True):
            points, others = turned_a[start : start + LOOKUP, low:high], turned_b[first:, low:high]
            i, j = np.nonzero(index.inside(points, np.sqrt(budget), first) & ~union & later)
            if compared is not None:
                compared.append(len(i))
            kept = _in_runs(i, j, lambda p, q, x=points, y=others, limit=budget: ((x[p] - y[q]) ** 2).sum(axis=1) <= limit)
            union[i[kept], j[kept]] = True
        i, j = np.nonzero(union)
        i, j = i + start, j + first
        linked = _in_runs(i, j, lambda p, q: (a[p] * b[q]).sum(axis=1) / (norm_a[p] * norm_b[q]) >= min_cosine)
        if linked.any():
            yield i[linked], j[linked]


class Roots:
    """Components of the members of a task, joined link by link."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, node: int, others: np.ndarray) -> None:
        roots = np.unique(self.root[others])
        roots = np.union1d(roots, self.root[node])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots[1:])] = roots[0]


def _compare(blocks: int, min_cosine: float):
    """For one pair of tiles of a label: (node, n, root), vectors linked to each node and a star that spans them."""

    def run(key, table):
        dim, lower, upper = (k.as_py() for k in key[1:])
        table = table.sort_by("node")
        ids, tile, copies = (table.column(c).to_numpy() for c in ("node", "tile", "copies"))
        raw = np.frombuffer(b"".join(table.column("raw").to_pylist()), dtype=np.float64).reshape(-1, dim)
        a, b = np.flatnonzero(tile == lower), np.flatnonzero(tile == upper)
        counts, roots = np.zeros(len(ids), dtype=np.int64), Roots(len(ids))
        for i, j in linked_pairs(raw[a], raw[b], lower == upper, blocks, min_cosine):
            i, j = a[i], b[j]
            np.add.at(counts, i, copies[j])
            np.add.at(counts, j, copies[i])
            starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(i)], strict=True):
                roots.join(i[start], j[start:end])
        some = counts > 0
        return pa.table({"node": ids[some], "n": counts[some], "root": ids[roots.root[some]]})

    return run


def embedding_groups(vectors: DataFrame, min_cosine: float = 0.93, blocks: int = 4) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, row_id.

    Vectors of equal label and length are linked if their cosine in double precision is
    ``min_cosine`` or more. Vectors that are null, empty, zero, or hold null or non-finite
    components, and vectors without a label, have no links. n_links counts the other
    vectors linked directly; component_id is the smallest vec_id that links reach.

    Copies of a vector are one node with a count, so that a group of copies costs no pairs.
    Rotated unit vectors are split into blocks; two linked vectors keep the distance budget
    of at least one block, so each block is range-joined under its budget and the union of
    the candidates is verified. The nodes of a label are dealt to tiles by a hash; a task
    joins two tiles, finds candidates in bitmap indexes of the blocks, and returns one count
    and one link per node, never pairs. Its memory is that of two tiles, whatever share of
    all vectors a label holds. The work within a label still grows with the square of its
    distinct vectors, by one machine word for 64 pairs and coordinate; rows grow so only
    beyond a tile. Repeated rows are vectors of their own, told apart by ``row_id``. Ties
    (cosines that equal the limit) are links. Other columns are ignored; an empty table
    gives an empty result.
    """
    rows = materialize(_prepared(vectors), "vectors")
    same = ["label", "dim", "raw"]
    nodes = materialize(
        rows.where("dim IS NOT NULL")
        .groupBy(*same)
        .agg(F.min("row_id").alias("node"), F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies")),
        "vector-nodes",
    )
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("size"))
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    found = materialize(
        nodes.join(sizes, ["label", "dim"])
        .withColumn("tile", F.pmod(F.xxhash64("node"), tiles).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .select("node", "copies", *same, "tile", F.least("tile", "other").alias("lower"), F.greatest("tile", "other").alias("upper"))
        .groupBy("label", "dim", "lower", "upper")
        .applyInArrow(_compare(blocks, min_cosine), "node bigint, n bigint, root bigint"),
        "vector-links",
    )
    linked = nodes.select("node", "first_id").join(
        connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "node", "left"
    )
    linked = materialize(linked.withColumn("root", F.coalesce("root", "node")), "vector-classes")
    named = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Between copies of one vector the cosine is 1, whatever rounding makes of it.
    classes = materialize(
        nodes.join(found.groupBy("node").agg(F.sum("n").alias("n")), "node", "left")
        .join(linked.select("node", "root").join(named, "root"), "node")
        .select(*same, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"),
        "vector-named",
    )
    return rows.join(classes, same, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
        "row_id",
    )
