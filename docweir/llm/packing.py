"""Best-fit packing of documents into sequences, under conflicts."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from functools import reduce
from operator import and_

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweir.llm.token_counts import count_batches
from docweir.storage import materialize

CAPACITY = 2048
_WHITE = b" \t\n\v\f\r"
#: Documents that are packed together on average; bins never reach over such a group.
GROUP_ROWS = 20_000


class _Run:
    """A stretch of the open bins, with the sources and the clusters that all its bins are known to hold."""

    def __init__(self, entries: list[tuple[int, int]], bins: ConflictBins) -> None:
        self.entries = entries
        self.learn(bins)

    def learn(self, bins: ConflictBins) -> None:
        self.sources = reduce(and_, (bins.sources[number] for _, number in self.entries))
        self.clusters = reduce(and_, (bins.clusters[number] for _, number in self.entries))


class ConflictBins:
    """Open bins in order of their residual; each carries a bitmap of the sources and one of the clusters it holds.

    The order is kept in runs of up to ``2 * RUN`` bins. A run knows bits that all its
    bins have, so that the search for the successor steps over runs of which no bin can
    take a document. What a run knows may be less than all, never more: bins that leave it
    take nothing away, and a run that was searched in vain is looked at anew.
    """

    RUN = 128

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.runs: list[_Run] = []
        self.lasts: list[tuple[int, int]] = []  # the last (residual, bin) of each run
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.source_places: dict[object, int] = {}
        self.cluster_places: dict[object, int] = {}

    @staticmethod
    def _bit(places: dict, key) -> int:
        """The bit of a source or cluster, dealt in the order of first use; null conflicts with nothing."""
        return 0 if key is None else 1 << places.setdefault(key, len(places))

    def _taken(self, length: int, source_bit: int, cluster_bit: int) -> tuple[int, int] | None:
        """Remove and return the first open bin with room for a document that holds neither bit."""
        first = bisect_left(self.lasts, (length, -1))
        for k in range(first, len(self.runs)):
            run = self.runs[k]
            if run.sources & source_bit or run.clusters & cluster_bit:
                continue
            entries = run.entries
            for at in range(bisect_left(entries, (length, -1)) if k == first else 0, len(entries)):
                number = entries[at][1]
                if not (self.sources[number] & source_bit or self.clusters[number] & cluster_bit):
                    found = entries.pop(at)
                    if not entries:
                        del self.runs[k], self.lasts[k]
                    elif at == len(entries):
                        self.lasts[k] = entries[-1]
                    return found
            run.learn(self)
        return None

    def _opened(self, entry: tuple[int, int]) -> None:
        k = min(bisect_left(self.lasts, entry), len(self.runs) - 1)
        if k < 0:
            self.runs, self.lasts = [_Run([entry], self)], [entry]
            return
        run, number = self.runs[k], entry[1]
        insort(run.entries, entry)
        run.sources &= self.sources[number]
        run.clusters &= self.clusters[number]
        self.lasts[k] = run.entries[-1]
        if len(run.entries) > 2 * self.RUN:
            parts = run.entries[: self.RUN], run.entries[self.RUN :]
            self.runs[k : k + 1] = [_Run(part, self) for part in parts]
            self.lasts[k : k + 1] = [part[-1] for part in parts]

    def place(self, length: int, source, cluster) -> tuple[int, int]:
        """(bin, offset): the tightest bin that has room and holds neither source nor cluster, or a new one."""
        source_bit, cluster_bit = self._bit(self.source_places, source), self._bit(self.cluster_places, cluster)
        found = self._taken(length, source_bit, cluster_bit)
        if found is None:
            found = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        residual, number = found
        self.sources[number] |= source_bit
        self.clusters[number] |= cluster_bit
        if residual > length:
            self._opened((residual - length, number))
        return number, self.capacity - residual


def pack(items, capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each (length, source, cluster), in the order given; give longer items first."""
    bins = ConflictBins(capacity)
    # What occurs once cannot conflict and needs no bit.
    sources, clusters = Counter(s for _, s, _ in items), Counter(c for _, _, c in items)
    return [bins.place(n, s if sources[s] > 1 else None, c if clusters[c] > 1 else None) for n, s, c in items]


def packed_documents(sized: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pieces of documents and their places: (row_id, doc_id, piece, piece_start, length, group, bin, bin_offset).

    ``sized`` has row_id, doc_id, n_tokens, source and cluster. A document longer than
    ``capacity`` is cut: its full pieces fill bins of their own, and the rest is packed
    like a short document. A document without tokens gives one piece of length 0 in bin
    and offset null. Rows are dealt to groups by a hash of row_id, so that neither a
    source nor a cluster nor a doc_id can fill a group; each group, of about
    ``group_rows`` rows, is packed alone, longest pieces first, and holds lengths and
    bitmaps only, no texts. Within a group the order is (length, row_id), which makes
    the result a function of the rows. Bins are numbered within their group.
    """
    n_groups = max(1, -(-sized.count() // group_rows))

    def run(key, table):
        rows = sorted(
            zip(*(table.column(c).to_pylist() for c in ("rest", "row_id", "source", "cluster")), range(table.num_rows), strict=True),
            key=lambda r: (-r[0], r[1]),
        )
        number, offset = [0] * len(rows), [0] * len(rows)
        for (_, _, _, _, at), place in zip(rows, pack([(r[0], r[2], r[3]) for r in rows], capacity), strict=True):
            number[at], offset[at] = place
        return pa.table(
            {
                "row_id": table.column("row_id"),
                "group": pa.array([key[0].as_py()] * len(rows), pa.int64()),
                "bin": pa.array(number, pa.int64()),
                "bin_offset": pa.array(offset, pa.int64()),
            }
        )

    length, full = F.col("n_tokens"), F.floor(F.col("n_tokens") / capacity)
    rest = length - full * capacity
    placed = (
        sized.withColumn("rest", rest)
        .where("rest > 0")
        .select("row_id", "rest", "source", "cluster", F.pmod(F.xxhash64("row_id", F.lit("pack")), F.lit(n_groups)).alias("group"))
        .groupBy("group")
        .applyInArrow(run, "row_id bigint, group bigint, bin bigint, bin_offset bigint")
    )
    pieces = sized.withColumn("full", full).join(placed, "row_id", "left")
    start = F.col("piece") * capacity
    own_bin = F.col("piece") < F.col("full")
    return pieces.withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(length / capacity) - 1, F.lit(0)).cast("bigint")))
    ).select(
        "row_id",
        "doc_id",
        "piece",
        start.alias("piece_start"),
        F.least(length - start, F.lit(capacity)).cast("bigint").alias("length"),
        # A full piece is a bin by itself: group null, and its row and piece as its number.
        F.when(~own_bin, F.col("group")).alias("group"),
        F.when(~own_bin, F.col("bin")).alias("bin"),
        F.when(own_bin, 0).otherwise(F.col("bin_offset")).cast("bigint").alias("bin_offset"),
    )


def sized_documents(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(row_id, doc_id, source, n_tokens, cluster) of whole texts; cluster hashes the text without ASCII white space."""

    def columns(batch, texts, counts):
        clusters = [xxhash.xxh64_intdigest(t.encode().translate(None, _WHITE)) if t else None for t in texts]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("row_id", "doc_id", "source")), pa.array(counts, pa.int64()), pa.array(clusters, pa.uint64()).view(pa.int64())],
            names=["row_id", "doc_id", "source", "n_tokens", "cluster"],
        )

    kinds = {c: docs.schema[c].dataType.simpleString() for c in ("doc_id", "source")}
    return docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "source", "text").mapInArrow(
        lambda batches: count_batches(batches, vocabulary_path, columns),
        f"row_id bigint, doc_id {kinds['doc_id']}, source {kinds['source']}, n_tokens bigint, cluster bigint",
    )


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pack whole documents into sequences of ``capacity`` tokens: a row per piece.

    Columns: doc_id, piece, piece_start, length, bin_id, bin_offset. No bin holds two
    pieces of one source, nor two documents with equal texts (white space aside). A null
    source, and a null or empty text, conflict with nothing; an empty text has one piece
    of length 0, without a bin. Repeated rows are documents of their own. Other columns
    are ignored; an empty table gives an empty result.
    """
    sized = materialize(sized_documents(docs, vocabulary_path), "packing-sizes")
    own = F.concat_ws("-", F.lit("f"), "row_id", "piece")
    shared = F.concat_ws("-", F.lit("g"), "group", "bin")
    return packed_documents(sized, capacity).select(
        "doc_id",
        "piece",
        "piece_start",
        "length",
        F.when(F.col("group").isNotNull(), shared).when(F.col("length") > 0, own).alias("bin_id"),
        F.when(F.col("length") > 0, F.col("bin_offset")).alias("bin_offset"),
    )
