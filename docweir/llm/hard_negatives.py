"""Hard negatives of embeddings, found through a table of distances to pivots."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweir.storage import materialize

#: Pivots of each dimension, chosen among so many rows.
PIVOTS, SAMPLE = 16, 2048
#: Rows and anchors that meet in one task at most, about, and anchors that are compared together.
BLOCK, ANCHOR_BLOCK, CHUNK = 8192, 4096, 64
#: Room for the rounding of distances, as a part of the greatest there can be.
SLACK = 1e-6
PLACE = ["dim", "cell", "part"]
_LAST = np.iinfo(np.int64).max


def _prepared(vectors: DataFrame) -> DataFrame:
    """(row_id, vec_id, label, is_anchor, dim, raw, norm2) of the rows that take part; raw holds doubles that are whole numbers."""
    own = ["row_id", "vec_id", "label", "is_anchor"]

    def run(batches):
        for batch in batches:
            batch = batch.filter(pc.and_(batch.column("label").is_valid(), batch.column("embedding").is_valid()))
            lists = batch.column("embedding")
            dims = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            values = np.floor(256 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)) + 0.0
            ends = np.cumsum(dims)
            parts = [values[end - n : end] for n, end in zip(dims.tolist(), ends.tolist(), strict=True)]
            at = [k for k, part in enumerate(parts) if np.isfinite(part).all()]
            kept = batch.take(pa.array(at, pa.int64()))
            columns = {c: kept.column(c) for c in own} | {
                "dim": pa.array(dims[at], pa.int32()),
                "raw": pa.array([parts[k].tobytes() for k in at], pa.binary()),
                "norm2": pa.array([float(parts[k] @ parts[k]) for k in at], pa.float64()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    kinds = "row_id bigint, vec_id bigint, label bigint, is_anchor boolean, dim int, raw binary, norm2 double"
    return vectors.select(*own, "embedding").mapInArrow(run, kinds)


def _matrix(raws, dim: int) -> np.ndarray:
    raws = raws.to_pylist()
    return np.frombuffer(b"".join(raws), dtype=np.float64).reshape(len(raws), dim)


def augmented(vectors: np.ndarray, bound2: float) -> np.ndarray:
    """Rows with one more component, which brings all to the greatest norm; so the greatest product becomes the smallest distance."""
    extra = np.sqrt(np.maximum(bound2 - (vectors * vectors).sum(axis=1), 0.0))
    return np.column_stack([vectors, extra])


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((points * points).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * points @ pivots.T, 0.0))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Rows far from each other: the first, then always the one farthest from those chosen; equal rows are chosen once."""
    chosen = [0]
    nearest = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(sample, sample[chosen[-1:]])[:, 0])
        nearest[chosen] = 0
    return sample[chosen]


def _slack(bound2: float, norm2):
    return SLACK * (np.sqrt(bound2 + norm2) + 1)


def brackets(anchor_norm2: np.ndarray, to_anchor: np.ndarray, to_row: np.ndarray, bound2: float) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) score that each row can have with each anchor, by the triangles over the pivots.

    An anchor has 0 as its further component, so the squared distance is bound2 + its
    squared norm - twice the score.
    """
    near = np.zeros((len(to_anchor), len(to_row)))
    far = np.full(near.shape, np.inf)
    for a, b in zip(to_anchor.T, to_row.T, strict=True):
        np.maximum(near, np.abs(a[:, None] - b), out=near)
        np.minimum(far, a[:, None] + b, out=far)
    total, slack = (bound2 + anchor_norm2)[:, None], _slack(bound2, anchor_norm2)[:, None]
    return (total - (far + slack) ** 2) / 2, (total - np.maximum(near - slack, 0) ** 2) / 2


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as longs, exact: in doubles while they hold all sums, else in whole numbers of any length."""
    if anchors.size and rows.size and np.abs(anchors).max() * np.abs(rows).max() * anchors.shape[1] >= 2**53:
        a, b = ([[int(x) for x in v] for v in m.tolist()] for m in (anchors, rows))
        return np.array([[sum(x * y for x, y in zip(p, q, strict=True)) for q in b] for p in a], dtype=np.int64)
    return (anchors @ rows.T).astype(np.int64)


class _Block:
    """Rows of one block and the anchors that they meet."""

    def __init__(self, dim: int, rows: pa.Table, anchors: pa.Table, bound2: float) -> None:
        self.rows, self.anchors, self.bound2 = rows, anchors, bound2
        self.vectors, self.queries = _matrix(rows.column("raw"), dim), _matrix(anchors.column("raw"), dim)
        self.labels, self.own_labels = (t.column("label").to_numpy() for t in (rows, anchors))
        self.ids = pc.fill_null(rows.column("vec_id"), _LAST).to_numpy()
        self.row_ids, self.own_row_ids = (t.column("row_id").to_numpy() for t in (rows, anchors))
        self.norm2 = anchors.column("norm2").to_numpy()
        # Rows of a dimension without pivots have no distances, and no row is ruled out.
        self.to_row, self.to_anchor = (np.array(t.column("to_pivots").to_pylist(), dtype=np.float64).reshape(t.num_rows, -1) for t in (rows, anchors))

    def survivors(self, same_label: bool, least: np.ndarray, greatest: np.ndarray):
        """(anchor, rows, scores): of every anchor the rows whose brackets reach into [least, greatest], with their exact scores."""
        for start in range(0, len(self.queries), CHUNK):
            part = slice(start, start + CHUNK)
            low, high = brackets(self.norm2[part], self.to_anchor[part], self.to_row, self.bound2)
            alive = (high >= least[part, None]) & (low <= greatest[part, None]) & (self.own_row_ids[part, None] != self.row_ids)
            alive &= (self.own_labels[part, None] == self.labels) == same_label
            columns = np.flatnonzero(alive.any(axis=0))
            exact = scores(self.queries[part], self.vectors[columns])
            for k in range(len(alive)):
                of_columns = np.flatnonzero(alive[k, columns])
                yield start + k, columns[of_columns], exact[k, of_columns]

    def found(self, picked: list[tuple[int, np.ndarray, np.ndarray]], more: dict) -> pa.Table:
        anchor = np.repeat([p[0] for p in picked], [len(p[1]) for p in picked]).astype(np.int64)
        rows = np.concatenate([p[1] for p in picked]).astype(np.int64) if picked else anchor
        score = np.concatenate([p[2] for p in picked]).astype(np.int64) if picked else anchor
        return pa.table({"anchor": self.own_row_ids[anchor], "item": self.rows.column("vec_id").take(pa.array(rows)), "score": score} | more)


def _positives(n: int, bound2: float):
    """Of each anchor of a block, the best ``n`` rows of its label: (anchor, item, score)."""

    def run(key, rows, anchors):
        if not rows.num_rows or not anchors.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("anchor", "item", "score")})
        block = _Block(key[0].as_py(), rows, anchors, bound2)
        floor = pc.fill_null(anchors.column("floor").cast(pa.float64()), -np.inf).to_numpy()
        picked = []
        for k, at, score in block.survivors(True, floor, np.full(len(floor), np.inf)):
            best = np.lexsort((block.ids[at], -score))[:n]
            picked.append((k, at[best], score[best]))
        return block.found(picked, {})

    return run


def _negatives(n: int, bound2: float):
    """Of each anchor and positive of a block, the best ``n`` rows of other labels within the positive's limits: (anchor, item, score, place)."""

    def run(key, rows, anchors):
        if not rows.num_rows or not anchors.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("anchor", "item", "score", "place")})
        block = _Block(key[0].as_py(), rows, anchors, bound2)
        wanted = anchors.column("positives").to_pylist()
        least, greatest = anchors.column("least").to_numpy(), anchors.column("greatest").to_numpy()
        picked, places = [], []
        for k, at, score in block.survivors(False, least, greatest):
            inside = np.flatnonzero((score >= least[k]) & (score <= greatest[k]))
            order = inside[np.lexsort((block.ids[at[inside]], -score[inside]))]
            at, score = at[order], score[order]
            for positive in wanted[k]:
                first = np.searchsorted(-score, -positive["greatest"])
                best = slice(first, min(first + n, np.searchsorted(-score, -positive["least"], side="right")))
                picked.append((k, at[best], score[best]))
                places += [positive["place"]] * len(at[best])
        return block.found(picked, {"place": pa.array(places, pa.int64())})

    return run


def pivot_table(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> tuple[DataFrame, float]:
    """The rows that take part with to_pivots, of anchors also from_anchor, and cell; and the greatest squared norm.

    Pivots of each dimension are rows far from each other, of a sample of ``sample`` rows
    with the smallest hashes. Every row has its distances to them stored, as a row and, if
    it is one, as an anchor, and belongs to the cell of the nearest; a dimension that the
    sample lacks has one cell, -1, without distances.
    """
    rows = materialize(_prepared(vectors), "negatives-rows")
    bound2 = rows.agg(F.max("norm2")).first()[0] or 0.0
    by_dim: dict[int, list[bytes]] = {}
    for r in rows.select("dim", "raw", F.xxhash64("raw", "row_id").alias("draw")).orderBy("draw").limit(sample).collect():
        by_dim.setdefault(r.dim, []).append(r.raw)
    chosen = {d: choose_pivots(augmented(np.frombuffer(b"".join(raws)).reshape(len(raws), d), bound2), pivots) for d, raws in by_dim.items()}

    def run(batches):
        for batch in batches:
            dims, is_anchor = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "is_anchor"))
            as_row: list = [[]] * batch.num_rows
            as_anchor: list = [[] if a else None for a in is_anchor.tolist()]
            cells = np.full(batch.num_rows, -1)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                if dim not in chosen:
                    continue
                vectors = _matrix(batch.column("raw").take(pa.array(at)), dim)
                d = distances(augmented(vectors, bound2), chosen[dim])
                cells[at] = d.argmin(axis=1)
                for k, own in zip(at.tolist(), d.tolist(), strict=True):
                    as_row[k] = own
                of_anchors = np.flatnonzero(is_anchor[at])
                d = distances(np.pad(vectors[of_anchors], ((0, 0), (0, 1))), chosen[dim])
                for k, own in zip(at[of_anchors].tolist(), d.tolist(), strict=True):
                    as_anchor[k] = own
            listed = pa.list_(pa.float64())
            columns = {"to_pivots": pa.array(as_row, listed), "from_anchor": pa.array(as_anchor, listed), "cell": pa.array(cells, pa.int32())}
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in batch.schema.names} | columns)

    kinds = "row_id bigint, vec_id bigint, label bigint, is_anchor boolean, dim int, raw binary, norm2 double"
    return materialize(rows.mapInArrow(run, f"{kinds}, to_pivots array<double>, from_anchor array<double>, cell int"), "negatives-pivots"), bound2


def _cells(table: DataFrame, pivots: int) -> DataFrame:
    """(dim, cell, parts, lows, highs): in how many parts a cell lies, and its least and greatest distance to each pivot."""
    ends = [f(F.get("to_pivots", F.lit(i))).alias(f"{f.__name__}{i}") for i in range(pivots) for f in (F.min, F.max)]
    listed = [F.array(*[f"{f}{i}" for i in range(pivots)]).alias(n) for f, n in (("min", "lows"), ("max", "highs"))]
    sizes = table.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("size"), *ends)
    return materialize(sizes.select("dim", "cell", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts"), *listed), "negatives-cells")


def _cell_brackets(bound2: float) -> tuple[Column, Column]:
    """(least, greatest) score of an anchor with any row of a cell; without distances, all scores."""
    outside = F.greatest(
        F.array_max(F.zip_with("from_anchor", "highs", lambda a, high: a - high)), F.array_max(F.zip_with("from_anchor", "lows", lambda a, low: low - a)), F.lit(0.0)
    )
    far = F.coalesce(F.array_min(F.zip_with("from_anchor", "highs", lambda a, high: a + high)), F.lit(float("inf")))
    total, slack = F.lit(bound2) + F.col("norm2"), (F.sqrt(F.lit(bound2) + F.col("norm2")) + 1) * SLACK
    near = F.greatest(outside - slack, F.lit(0.0))
    return (total - (far + slack) * (far + slack)) / 2, (total - near * near) / 2


def hard_negatives(vectors: DataFrame, n_positives: int = 5, n_negatives: int = 3, every: int = 50, pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, place, anchor_row).

    Components are taken as floor(256 * x), scores are inner products of those, and rows
    of greater scores come first, ties by smaller vec_id (null last). An anchor is a row
    whose vec_id is a multiple of ``every``; its positives are the first ``n_positives``
    other rows of its label, numbered by ``place``. To each belong the first ``n_negatives``
    rows of other labels that score from 50 to 95 % of it, numbered by ``rank``; a positive
    without one has no row, and so has one with a score below zero. Where vec_id is a
    multiple of 7 the label counts as (label + 1) % 10.

    Rows with a null label, a null vector or a component that is null or not finite take
    no part; vectors of different lengths never meet, and empty ones score 0. Repeated
    rows are rows of their own: a copy of an anchor can be its positive, and is an anchor
    itself. Scores beyond a long raise. Other columns are ignored; an empty table gives an
    empty result.

    With one more component, which brings all rows to one norm, the greatest product is
    the smallest distance. Distances to pivots bracket it by the triangle inequality: first
    per cell of rows, so that an anchor is sent only to cells that can hold a row it needs,
    then per row; what survives is scored exactly. An anchor's own block gives its first
    positives, which bound what other cells must reach. Cells are cut into parts, and
    anchors into blocks, of bounded size, so no label or group of copies can crowd a task.
    """
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    is_anchor = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    own = vectors.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("vec_id").cast("bigint"), label.cast("bigint").alias("label"), is_anchor.alias("is_anchor"), "embedding"
    )
    table, bound2 = pivot_table(own, pivots, sample)
    cells = _cells(table, pivots)
    blocks = max(1, -(-table.where("is_anchor").count() // ANCHOR_BLOCK))
    part = F.pmod(F.xxhash64("row_id"), F.col("parts")).cast("int")
    placed = table.join(cells.select("dim", "cell", "parts"), ["dim", "cell"]).withColumn("part", part).drop("parts")
    rows = placed.select(*PLACE, "row_id", "vec_id", "label", "raw", "to_pivots", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    anchors = placed.where("is_anchor").select(
        *PLACE, "row_id", "vec_id", "label", "raw", "norm2", "from_anchor", F.pmod(F.xxhash64("row_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    )
    anchors = materialize(anchors, "negatives-anchors")

    def met(asked: DataFrame, what, kinds: str) -> DataFrame:
        both = [df.groupBy(*PLACE, "block") for df in (rows, asked.withColumnRenamed("from_anchor", "to_pivots"))]
        return both[0].cogroup(both[1]).applyInArrow(what, kinds)

    def elsewhere(asked: DataFrame, least: Column, greatest: Column) -> DataFrame:
        """Anchors in all parts of the cells that can hold a score between the limits; home is the place of their own."""
        low, high = _cell_brackets(bound2)
        home = [F.col(c).alias(f"home_{c}") for c in PLACE[1:]]
        return (
            asked.select(*[c for c in asked.columns if c not in PLACE[1:]], *home)
            .join(cells, "dim")
            .where((high >= least) & (low <= greatest))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .drop("parts", "lows", "highs")
        )

    kinds, endless = "anchor bigint, item bigint, score bigint", F.lit(float("inf"))
    best = _positives(n_positives, bound2)
    nearby = materialize(met(anchors.withColumn("floor", F.lit(None).cast("double")), best, kinds), "negatives-home")
    floors = nearby.groupBy(F.col("anchor").alias("row_id")).agg(F.when(F.count(F.lit(1)) >= n_positives, F.min("score")).cast("double").alias("floor"))
    asked = elsewhere(anchors.join(floors, "row_id", "left"), F.coalesce("floor", -endless), endless)
    afar = met(asked.where("cell != home_cell OR part != home_part").drop("home_cell", "home_part"), best, kinds)

    def first(df: DataFrame, by: str, n: int, name: str) -> DataFrame:
        return df.withColumn(name, F.expr(f"row_number() OVER (PARTITION BY {by} ORDER BY score DESC, item ASC NULLS LAST)")).where(F.col(name) <= n)

    positives = materialize(first(nearby.union(afar), "anchor", n_positives, "place"), "negatives-positives")
    # 50 * positive <= 100 * negative <= 95 * positive, of whole numbers.
    limits = F.struct(F.col("place").cast("bigint").alias("place"), F.expr("(score + 1) div 2").alias("least"), F.expr("95 * score div 100").alias("greatest"))
    wanted = positives.where("score >= 0").groupBy(F.col("anchor").alias("row_id")).agg(F.sort_array(F.collect_list(limits)).alias("positives"))
    ends = {"least": F.array_min("positives.least").cast("double"), "greatest": F.array_max("positives.greatest").cast("double")}
    asked = elsewhere(anchors.join(wanted, "row_id").withColumns(ends), F.col("least"), F.col("greatest")).drop("home_cell", "home_part")
    negatives = first(met(asked, _negatives(n_negatives, bound2), f"{kinds}, place bigint"), "anchor, place", n_negatives, "rank")
    named = positives.select("anchor", F.col("place").cast("bigint"), F.col("item").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        negatives.join(named, ["anchor", "place"])
        .join(anchors.select(F.col("row_id").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        .select(
            "anchor_id", "positive_id", "rank", F.col("item").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), F.col("place").cast("int").alias("place"), F.col("anchor").alias("anchor_row")
        )
    )
