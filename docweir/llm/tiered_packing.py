"""Hierarchical packing of documents into sequences of several lengths, without padding."""

from __future__ import annotations

import zlib
from heapq import heapify, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweir.llm.arrow_chunks import byte_table, token_ids
from docweir.llm.batches import bounded

CAPACITY = 2048
#: Lengths of sequences, besides the capacity, that documents are routed to.
TIERS = (256, 512, 1024)
#: Full sequences that a step holds, by their tokens and the work of attention.
STEP_SEQUENCES = 16

#: A piece is (document, start, length); a sequence is a list of pieces.
Piece = tuple[int, int, int]


class Waiting:
    """Pieces that have no place yet, by length; those of one length wait in line."""

    def __init__(self) -> None:
        self.lines: dict[int, list[Piece]] = {}
        self.lengths = 0  # a bit for each length that some piece has

    def add(self, piece: Piece) -> None:
        self.lines.setdefault(piece[2], []).append(piece)
        self.lengths |= 1 << piece[2]

    def longest(self, most: int | None = None) -> int:
        """The greatest length there is, up to ``most``; 0 if there is none."""
        found = self.lengths if most is None else self.lengths & ((2 << most) - 1)
        return max(found.bit_length() - 1, 0)

    def take(self, length: int) -> Piece:
        line = self.lines[length]
        piece = line.pop()
        if not line:
            del self.lines[length]
            self.lengths ^= 1 << length
        return piece


def tier_of(length: int, tiers: tuple[int, ...], capacity: int) -> int:
    """The shortest sequence that holds so many tokens."""
    return next((t for t in tiers if length <= t), capacity)


def pack_tiers(pieces: list[Piece], tiers: tuple[int, ...] = TIERS, capacity: int = CAPACITY) -> tuple[list[list[Piece]], list[Piece]]:
    """(full sequences, pieces left over, which are too few for one more).

    Pieces longer than ``capacity`` give up windows of their own; what is left of them is
    routed like any piece to the shortest tier that holds it. Tiers are packed from the
    longest down, longest pieces first. A sequence's gap takes the longest waiting piece
    that fits, again and again, so gaps of long sequences are filled from shorter tiers.
    When none fits, the longest waiting piece is cut to fill the gap, and its rest waits
    on in the tier of its new length. So every sequence is full, and at most one is cut
    short by the end of the pieces; it is handed back.
    """
    done: list[list[Piece]] = []
    waiting = Waiting()
    for document, start, length in sorted(pieces):
        while length >= capacity:
            done.append([(document, start, capacity)])
            start, length = start + capacity, length - capacity
        if length:
            waiting.add((document, start, length))
    while waiting.lengths:
        first = waiting.take(waiting.longest())
        sequence = [first]
        gap = tier_of(first[2], tiers, capacity) - first[2]
        while gap:
            fitting = waiting.longest(gap)
            if fitting:
                sequence.append(waiting.take(fitting))
            elif waiting.lengths:
                document, start, length = waiting.take(waiting.longest())
                sequence.append((document, start, gap))
                waiting.add((document, start + gap, length - gap))
            else:
                return done, sequence
            gap -= sequence[-1][2]
        done.append(sequence)
    return done, []


def in_powers(pieces: list[Piece]) -> list[list[Piece]]:
    """The last pieces of all as sequences whose lengths are powers of two, longest first, which need no padding."""
    done: list[list[Piece]] = []
    left = sum(p[2] for p in pieces)
    rest = list(reversed(pieces))
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        done.append([])
        while room:
            document, start, length = rest.pop()
            taken = min(room, length)
            done[-1].append((document, start, taken))
            room -= taken
            if length > taken:
                rest.append((document, start + taken, length - taken))
    return done


def step_groups(sequences: list[list[Piece]], capacity: int = CAPACITY, step_sequences: int = STEP_SEQUENCES) -> list[int]:
    """The step of each sequence, balanced by work: tokens, and tokens by the share of a window that each attends to.

    The number of steps follows from the tokens; the costliest sequences are dealt first,
    each to the step with the least work so far.
    """
    work = [sum(n + n * n / capacity for _, _, n in s) for s in sequences]
    tokens = sum(n for s in sequences for _, _, n in s)
    steps = [(0.0, k) for k in range(max(1, -(-tokens // (capacity * step_sequences))))]
    heapify(steps)
    out = [0] * len(sequences)
    for k in sorted(range(len(sequences)), key=lambda k: (-work[k], k)):
        load, step = steps[0]
        out[k] = step
        heapreplace(steps, (load + work[k], step))
    return out


def pack_documents_in_tiers(
    docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, tiers: tuple[int, ...] = TIERS, end_id: int = 1
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_id, row_id.

    Every whole text is encoded (a special token's string in it is that token) and
    ``end_id`` is put after it. Sequences hold ``capacity`` tokens or as many as a tier has;
    at most one at the end of each task's rows is cut up into lengths that are powers of
    two. So with tiers and a capacity that are powers of two nothing is padded; other
    values raise. ``start`` and ``offset`` count the ids of the document, and of the
    sequence, before a piece; ``tier`` is the length of the sequence and ``step_id`` the
    group of sequences, of about equal work, that it is to be trained with.

    A null or empty text is the end id alone. Repeated rows and equal or null doc_ids are
    documents of their own, told apart by ``row_id``. Texts may be of any length: a long one
    gives windows of its own. Other columns are ignored; an empty table gives an empty result.

    Rows stay where they are read: ids never leave the task that encodes them, nothing is
    shuffled, and no source or group of copies can crowd a task. Rows are packed some
    megabytes of text at a time, and what is left over joins those that follow; memory is
    bounded by that and the longest text. A task that is run again reads the same rows
    and numbers them alike, so nothing is lost or doubled with an executor.
    """
    if any(n < 1 or n & (n - 1) for n in (*tiers, capacity)) or list(tiers) != sorted(set(tiers)) or tiers and tiers[-1] >= capacity:
        raise ValueError("tiers and capacity must be ascending powers of two")

    def rows_of(sequences, steps, first_sequence, first_step, held, doc_type):
        flat = [(sequence, piece) for sequence, pieces in enumerate(sequences) for piece in pieces]
        lengths = np.array([p[2] for _, p in flat], dtype=np.int64)
        at = np.array([s for s, _ in flat], dtype=np.int64)
        totals = np.bincount(at, weights=lengths, minlength=len(sequences)).astype(np.int64)
        before = np.cumsum(lengths) - lengths
        offsets = before - (np.cumsum(totals) - totals)[at]
        crc = [zlib.crc32(held[d][1][start : start + n].tobytes()) for _, (d, start, n) in flat]
        columns = {
            "doc_id": pa.array([held[d][0] for _, (d, _, _) in flat], doc_type),
            "start": pa.array([p[1] for _, p in flat], pa.int64()),
            "length": pa.array(lengths),
            "ids_crc32": pa.array(crc, pa.int64()),
            "doc_tokens": pa.array([len(held[d][1]) for _, (d, _, _) in flat], pa.int64()),
            "sequence_id": pa.array(at + first_sequence),
            "offset": pa.array(offsets),
            "tier": pa.array(totals[at]),
            "step_id": pa.array(np.array(steps, dtype=np.int64)[at] + first_step),
            "row_id": pa.array([d for _, (d, _, _) in flat], pa.int64()),
        }
        return pa.RecordBatch.from_pydict(columns)

    def run(batches):
        table = byte_table(vocabulary_path)
        held: dict[int, tuple[object, np.ndarray]] = {}  # doc_id and ids of the documents that have no place yet
        waiting: list[Piece] = []
        n_rows = n_sequences = n_steps = 0
        doc_type = None

        def placed(sequences):
            nonlocal n_sequences, n_steps
            steps = step_groups(sequences, capacity)
            batch = rows_of(sequences, steps, n_sequences, n_steps, held, doc_type)
            n_sequences, n_steps = n_sequences + len(sequences), n_steps + max(steps) + 1
            return batch

        for batch in bounded(batches):
            doc_type = batch.schema.field("doc_id").type
            ids, counts = token_ids(table, batch.column("text"), end_id)
            ids = ids.astype("<u4")
            ends = np.cumsum(counts)
            for doc_id, start, end in zip(batch.column("doc_id").to_pylist(), (ends - counts).tolist(), ends.tolist(), strict=True):
                held[n_rows] = doc_id, ids[start:end]
                waiting.append((n_rows, 0, end - start))
                n_rows += 1
            sequences, waiting = pack_tiers(waiting, tiers, capacity)
            if sequences:
                yield placed(sequences)
            # Copies, so that a few waiting documents don't keep the ids of all.
            held = {d: (held[d][0], held[d][1].copy()) for d, _, _ in waiting}
        if waiting:
            yield placed(in_powers(waiting))

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = "sequence_id bigint, offset bigint, tier bigint, step_id bigint, row_id bigint"
    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, {numbers}")
    part = F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    return found.withColumns({c: F.col(c) + part for c in ("sequence_id", "step_id", "row_id")})
