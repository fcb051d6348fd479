"""Tiered packing against the tokenizer library: every id in one piece, nothing padded."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docweir.llm import entry
from docweir.llm.arrow_chunks import byte_table, token_ids
from docweir.llm.tiered_packing import in_powers, pack_documents_in_tiers, pack_tiers, step_groups

BYTE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "a", "a" * 300, "  \n\n x", " a", "a ", "a\n b", "a \nb", "a\n\nb", "x\x1cy", "\x01a \x02b", "a b", "́a b ́", "<|endoftext|>a<|endoftext|>",
    "ΣΑΣ Σ", "日本語 テスト", "é é Å", "՘xᲉy 12345", "İi̇", "don't we'll 'S it's,", "end., x. Y", "🙂🙂 ok", "A.\nB,\nC", "tab\tand\r\nline", "3×. 4÷, é. ÿ, ×, ok. a., b",
    "end.\n\nx", "x. ", "x.\n", "a, b. c,\nd.\ne", ". a", ", b", "ab. c", "x.y, z", "\u0085", "a.\u0085b", "ɐ. ɏ. Ĳ, x", "_. -, 9. 8,\n7",
]


def ids_of(texts):
    return [e.ids + [1] for e in Tokenizer.from_file(BYTE).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_arrow_chunks_give_the_ids_of_the_library():
    rnd = random.Random(5)
    texts = ODD + [None] + ["".join(rnd.choice("ab '.,!1é\n\tB日Σ́  ") for _ in range(rnd.randint(1, 60))) for _ in range(2000)]
    table = byte_table(BYTE, 60)
    for some in (texts[:40], [], texts[40:], texts):
        ids, counts = token_ids(table, pa.array(some, pa.string()), 1)
        ends = np.cumsum(counts)
        assert [ids[a:b].tolist() for a, b in zip(ends - counts, ends, strict=True)] == ids_of(some)


def checked(rows, docs):
    """Asserts that the rows hold each id of each document once, in full sequences without gaps; docs: (doc_id, text) of every row."""
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_row[r.row_id].append(r)
        by_sequence[r.sequence_id].append(r)
    expected = sorted((str(d), tuple(i)) for (d, _), i in zip(docs, ids_of([t for _, t in docs]), strict=True))
    left = defaultdict(list)
    for d, ids in expected:
        left[d, len(ids)].append(ids)
    for pieces in by_row.values():
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist() and all(r.length > 0 for r in pieces)
        size = pieces[0].doc_tokens
        assert all(r.doc_tokens == size for r in pieces) and sum(r.length for r in pieces) == size

        def is_of(ids, pieces=pieces):
            return all(zlib.crc32(np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes()) == r.ids_crc32 for r in pieces)

        same = left[str(pieces[0].doc_id), size]
        same.pop(next(k for k, ids in enumerate(same) if is_of(ids)))
    assert not any(left.values()) and len(by_row) == len(docs)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        total = sum(r.length for r in pieces)
        assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
        assert total <= 2048 and total & (total - 1) == 0 and all(r.tier == total for r in pieces)
        assert len({r.step_id for r in pieces}) == 1
    return by_sequence


def test_query_packs_every_id_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = entry.QUERIES["op12_tiered_packing"](spark, "/root/testdata/sf0.001").collect()
    checked(rows, [tuple(d) for d in docs])


def test_odd_rows(spark):
    texts = [*ODD, None, "same", "same", "word " * 200_000, "x" * 9000, ""]
    docs = [(None if k % 9 == 0 else k // 2, t) for k, t in enumerate(texts)]
    schema = "doc_id long, text string, start int, tier string, `sequence_id` string, `a b` int"
    frame = spark.createDataFrame([(*d, 1, "x", "y", 2) for d in docs], schema)
    by_sequence = checked(pack_documents_in_tiers(frame.repartition(3), BYTE).collect(), docs)
    assert {len(p) for p in by_sequence.values()} > {1}
    assert pack_documents_in_tiers(frame.limit(0), BYTE).count() == 0
    names = spark.createDataFrame([("b", "x y"), (None, "z")], "doc_id string, text string")
    assert {r.doc_id for r in pack_documents_in_tiers(names, BYTE).collect()} == {"b", None}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60))
def test_every_sequence_is_full(lengths):
    pieces = [(k, 0, n) for k, n in enumerate(lengths)]
    full, rest = pack_tiers(pieces, (4, 8), 16)
    assert all(sum(p[2] for p in s) in (4, 8, 16) for s in full) and sum(p[2] for p in rest) < 16
    last = in_powers(rest)
    sizes = [sum(p[2] for p in s) for s in last]
    assert all(n & (n - 1) == 0 for n in sizes) and sizes == sorted(set(sizes), reverse=True)
    covered = defaultdict(list)
    for document, start, n in (p for s in full + last for p in s):
        covered[document] += range(start, start + n)
    assert {d: sorted(c) for d, c in covered.items()} == {k: list(range(n)) for k, n in enumerate(lengths)}
    # A document is cut only where a gap is filled by it, besides its own windows: one cut a sequence at most.
    n_pieces = sum(map(len, full)) + sum(map(len, last))
    assert n_pieces <= len(lengths) + len(full) + len(last)


def test_documents_go_to_the_shortest_tier_and_fill_longer_ones():
    full, rest = pack_tiers([(0, 0, 14), (1, 0, 7), (2, 0, 2), (3, 0, 1), (4, 0, 4)], (4, 8), 16)
    assert full == [[(0, 0, 14), (2, 0, 2)], [(1, 0, 7), (3, 0, 1)], [(4, 0, 4)]] and rest == []
    full, rest = pack_tiers([(0, 0, 35), (1, 0, 10)], (4, 8), 16)
    assert full == [[(0, 0, 16)], [(0, 16, 16)], [(1, 0, 10), (0, 32, 3)]][:2] and rest == [(1, 0, 10), (0, 32, 3)]


def test_steps_share_work_evenly():
    rnd = random.Random(3)
    sequences = [[(0, 0, 1 << rnd.randint(6, 11))] for _ in range(400)]
    steps = step_groups(sequences)
    load = defaultdict(float)
    for s, k in zip(sequences, steps, strict=True):
        load[k] += s[0][2] + s[0][2] ** 2 / 2048
    assert len(load) == -(-sum(s[0][2] for s in sequences) // (16 * 2048)) and max(load.values()) - min(load.values()) <= 4096


@pytest.mark.parametrize("tiers, capacity", [((300,), 2048), ((512, 256), 2048), ((2048,), 2048), ((), 1000)])
def test_tiers_that_would_be_padded_raise(spark, tiers, capacity):
    with pytest.raises(ValueError):
        pack_documents_in_tiers(spark.createDataFrame([(1, "a")], "doc_id long, text string"), BYTE, capacity, tiers)
