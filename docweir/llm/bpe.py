"""BPE encoding by a pair occurrence index, and decoding."""

from __future__ import annotations

import hashlib
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from docweir.llm.batches import bounded
from docweir.llm.pieces import PieceTable, Vocabulary, flattened


class PairIndexEncoder:
    """Merges many pieces at once.

    The symbols of all pieces lie in one linked sequence. An index maps each rank to the
    positions of its pair. Active ranks are taken in ascending order from a heap; each
    merge at a position updates the lists of the pairs to its left and right. A pair with
    a merged symbol always ranks after the merge that made the symbol, so one ascending
    pass is complete, and within a rank positions are taken from left to right.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.width = vocabulary.size
        self.ranks = {a * self.width + b: r for r, (a, b) in reversed(list(enumerate(vocabulary.merge_pairs)))}
        self.merged = vocabulary.merge_ids
        self.pairs = vocabulary.merge_pairs

    def encode(self, pieces: list[str]) -> list[list[int]]:
        rank_of, width = self.ranks.get, self.width
        symbols: list[int] = [-1]
        starts: list[int] = []
        for piece in pieces:
            starts.append(len(symbols))
            symbols += self.vocabulary.symbols(piece)
            symbols.append(-1)
        # -1 stands between pieces; a merged-away symbol is -2 and is never looked at again
        left = list(range(-1, len(symbols) - 1))
        right = list(range(1, len(symbols) + 1))
        places: dict[int, list[int]] = {}
        active: list[int] = []
        a = -1
        for at, b in enumerate(symbols):
            if a >= 0 and b >= 0 and (r := rank_of(a * width + b)) is not None:
                if r in places:
                    places[r].append(at - 1)
                else:
                    places[r] = [at - 1]
            a = b
        active = sorted(places)
        while active:
            rank = heappop(active)
            first, second = self.pairs[rank]
            new = self.merged[rank]
            found = places.pop(rank)
            found.sort()
            for at in found:
                gone = right[at]
                if symbols[at] != first or symbols[gone] != second:
                    continue
                after = right[gone]
                before = left[at]
                symbols[at], symbols[gone] = new, -2
                right[at], left[after] = after, at
                if (s := symbols[before]) >= 0 and (r := rank_of(s * width + new)) is not None:
                    if r in places:
                        places[r].append(before)
                    else:
                        places[r] = [before]
                        heappush(active, r)
                if (s := symbols[after]) >= 0 and (r := rank_of(new * width + s)) is not None:
                    if r in places:
                        places[r].append(at)
                    else:
                        places[r] = [at]
                        heappush(active, r)
        out = []
        for at in starts:
            ids = []
            while (s := symbols[at]) >= 0:
                ids.append(s)
                at = right[at]
            out.append(ids)
        return out


@lru_cache(maxsize=2)
def piece_table(vocabulary_path: str) -> PieceTable:
    """The table of a worker process, kept from task to task."""
    vocabulary = Vocabulary(vocabulary_path)
    encoder = PairIndexEncoder(vocabulary)
    return PieceTable(vocabulary, lambda pieces: flattened(encoder.encode(pieces)))


def decode(tokens: list[str], ids: list[int]) -> str:
    """What a tokenizer without a decoder makes of ids: their tokens, joined by spaces."""
    return " ".join(map(tokens.__getitem__, ids))


def bpe_round_trip(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Encode and decode every whole text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null texts count as empty: no tokens, and the digests of the empty string. Special
    tokens' strings in a text become their ids. Each row stands alone, so repeated rows
    and repeated or null doc_ids give a row each; other columns are ignored. An empty
    table gives an empty result. Memory is bounded by a part of a batch and the longest text.
    """

    def run(batches):
        table = piece_table(vocabulary_path)
        tokens = table.vocabulary.tokens()
        numerals = [str(i) for i in range(len(tokens))]
        for batch in bounded(batches):
            counts, id_digests, text_digests = [], [], []
            for codes in table.codes(batch.column("text").to_pylist()):
                ids = table.ids(codes).tolist()
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(" ".join(map(numerals.__getitem__, ids)).encode()).hexdigest())
                text_digests.append(hashlib.sha256(decode(tokens, ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {doc_id}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
