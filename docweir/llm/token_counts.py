"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docweir.llm.batches import bounded
from docweir.llm.pieces import ChunkNumbers, Vocabulary


class RankSynchronousCounter:
    """Counts the tokens of many pieces at once.

    The symbols of all pieces lie in one array, beside the number of their piece. In each
    round every piece that can still merge applies its own lowest-ranked pair, at all its
    places that do not overlap (from the left); pieces that cannot merge leave the array
    with their count of symbols.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.width = vocabulary.size
        first, second = np.array(vocabulary.merge_pairs, dtype=np.int64).T
        codes = first * self.width + second
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks = codes[order], order
        self.merged = np.array(vocabulary.merge_ids, dtype=np.int64)
        self.none = len(codes)

    def _rank(self, pairs: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, pairs), self.none - 1)
        return np.where(self.codes[at] == pairs, self.ranks[at], self.none)

    def count(self, pieces: list[str]) -> np.ndarray:
        counts = np.zeros(len(pieces), dtype=np.int64)
        if not pieces:
            return counts
        data = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        symbols = self.vocabulary.byte_ids[np.frombuffer(b"".join(data), dtype=np.uint8)].astype(np.int64)
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.vocabulary.last_byte_ids[np.frombuffer(bytes(p[-1] for p in data), dtype=np.uint8)]
        piece = np.repeat(np.arange(len(data)), lengths)
        rank = np.full(len(symbols), self.none)  # of the pair that starts at each symbol
        inside = np.flatnonzero(piece[:-1] == piece[1:])
        rank[inside] = self._rank(symbols[inside] * self.width + symbols[inside + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            lengths = np.diff(np.r_[starts, len(piece)])
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == self.none
            if done.any():
                counts[piece[starts[done]]] = lengths[done]
                stay = np.repeat(~done, lengths)
                symbols, piece, rank = symbols[stay], piece[stay], rank[stay]
                lowest, lengths = lowest[~done], lengths[~done]
                if not len(symbols):
                    break
            hit = rank == np.repeat(lowest, lengths)
            # Of a run of neighbouring places, the first, third, ... can merge.
            at = np.arange(len(hit))
            run_start = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], at, -1))
            hit &= (at - run_start) % 2 == 0
            places = np.flatnonzero(hit)
            symbols[places] = self.merged[rank[places]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[places + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, piece, rank, places = symbols[keep], piece[keep], rank[keep], moved[places]
            # Only the pairs beside a merged symbol change.
            touched = np.concatenate([places, places[places > 0] - 1])
            rank[touched] = self.none
            touched = touched[touched < len(symbols) - 1]
            touched = touched[piece[touched] == piece[touched + 1]]
            rank[touched] = self._rank(symbols[touched] * self.width + symbols[touched + 1])
        return counts


class CountTable(ChunkNumbers):
    """Keeps the token counts of chunks."""

    def __init__(self, vocabulary: Vocabulary, limit: int = 400_000) -> None:
        self.counter = RankSynchronousCounter(vocabulary)
        super().__init__(vocabulary, limit)

    def reset(self) -> None:
        super().reset()
        self.sizes = np.zeros(0, dtype=np.int32)

    def learn(self, pieces: list[list[str]]) -> None:
        distinct, places, chunk_starts = self.piece_places(pieces)
        sizes = np.concatenate([self.counter.count(distinct), np.ones(len(self.vocabulary.special), dtype=np.int64)])
        self.sizes = np.concatenate([self.sizes, np.add.reduceat(sizes[places], chunk_starts).astype(np.int32)])

    def counts(self, texts: list[str | None]) -> list[int]:
        codes = self.codes(texts)
        return [int(self.sizes[c].sum(dtype=np.int64)) for c in codes]


@lru_cache(maxsize=2)
def count_table(vocabulary_path: str) -> CountTable:
    """The table of a worker process, kept from task to task."""
    return CountTable(Vocabulary(vocabulary_path))


def count_batches(batches, vocabulary_path: str, extra):
    """Add token counts to Arrow batches; ``extra`` gives the rest of the columns from (batch, texts, counts)."""
    table = count_table(vocabulary_path)
    for batch in bounded(batches, 1 << 20):
        texts = batch.column("text").to_pylist()
        yield extra(batch, texts, table.counts(texts))


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = 1024) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    Whole texts count. Null texts count as empty: no bytes and no tokens. A special
    token's string inside a text counts as one token. Each row stands alone, so repeated
    rows and repeated or null doc_ids give a row each; other columns are ignored. An empty
    table gives an empty result. Memory is bounded by a part of a batch and the longest text.
    """

    def columns(batch, texts, counts):
        n_tokens = np.array(counts, dtype=np.int64)
        n_bytes = pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), n_bytes, pa.array(n_tokens), pa.array(n_tokens > limit)],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: count_batches(batches, vocabulary_path, columns),
        f"doc_id {doc_id}, n_bytes bigint, n_tokens bigint, over_limit boolean",
    )
