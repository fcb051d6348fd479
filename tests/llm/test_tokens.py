"""Token operators against the tokenizer library, and their handling of odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docweir.llm.batches import bounded
from docweir.llm.bpe import PairIndexEncoder, bpe_round_trip, decode
from docweir.llm.pieces import PieceTable, Splitter, Vocabulary, flattened
from docweir.llm.token_counts import CountTable, RankSynchronousCounter, token_counts
from docweir.llm.token_files import library_table, read_token_files, token_file_digest, write_token_files

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = [
    "", " ", "a", "aaaaaaaaaaaaaaa", "  \n\n x", " a", "a ", "a\n b", "a \nb", "a\n\nb", "x\x1cy", "\x01a \x02b", "a b", "́a b ́",
    "<|endoftext|>a<|endoftext|><|startoftext|>", "ΣΑΣ Σ", "日本語 テスト", "é é Å", "՘xᲉy 12345", "a" * 5000, "İi̇", "don't we'll 'S it's,", "end., x. Y",
    "🙂🙂 ok", "٣٤ १२", "A.\nB,\nC", "tab\tand\r\nline", "3×. 4÷, é. ÿ, ×, ok. a., b", "end.\n\nx", "x. ", "x.\n",
]


def texts(n=1500):
    rnd = random.Random(7)
    return ODD + ["".join(rnd.choice("ab '.,!1é\n\tB日Σ́ ") for _ in range(rnd.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoders_equal_the_library(path):
    library, vocabulary = Tokenizer.from_file(path), Vocabulary(path)
    expected = [e.ids for e in library.encode_batch(texts(), add_special_tokens=False)]
    encoder = PairIndexEncoder(vocabulary)
    tables = [PieceTable(vocabulary, lambda pieces: flattened(encoder.encode(pieces)), limit=50)]
    if vocabulary.word_end:
        tables.append(PieceTable(vocabulary, library_table(path).encode, limit=50))
    for table in tables:
        got = [table.ids(c).tolist() for part in (texts()[:20], texts()[20:]) for c in table.codes(part)]
        assert got == expected
    counts = CountTable(vocabulary, limit=50)
    assert counts.counts(texts()[:40]) + counts.counts(texts()[40:]) == [len(e) for e in expected]


def test_every_character_is_split_as_the_library_does():
    for path in (WORD, BYTE):
        library, splitter = Tokenizer.from_file(path), Splitter(Vocabulary(path))
        for cp in [*range(0xD800), *range(0xE000, 0x20000, 3), *range(0x20000, 0x110000, 97)]:
            text = f"a{chr(cp)}b 1{chr(cp)} c"
            normal = library.normalizer.normalize_str(text) if splitter.lower else text
            expected = [normal[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(normal)]
            assert [p for c in splitter.chunks(text) for p in splitter.pieces_of(c)] == expected, hex(cp)


def test_counter_takes_overlapping_pairs_from_the_left():
    vocabulary = Vocabulary(BYTE)
    library = Tokenizer.from_file(BYTE)
    words = ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 20)] + ["-" * n for n in range(1, 70)]
    assert RankSynchronousCounter(vocabulary).count(words).tolist() == [len(library.encode(w, add_special_tokens=False).ids) for w in words]


def rows(spark):
    data = [(5, "Hello, world."), (2, None), (9, ""), (5, "Hello, world."), (None, "no id"), (1, "x" * 100_000), (3, "<|endoftext|> a")]
    return spark.createDataFrame([(i, t, 1, "other") for i, t in data], "doc_id long, text string, n_tokens int, ids string")


def test_round_trip_rows(spark):
    library = Tokenizer.from_file(WORD)
    got = sorted(bpe_round_trip(rows(spark), WORD).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.n_tokens))
    assert len(got) == 7
    for r, (_, t) in zip(got, [(1, "x" * 100_000), (2, ""), (3, "<|endoftext|> a"), (5, "Hello, world."), (5, "Hello, world."), (9, ""), (None, "no id")], strict=True):
        ids = library.encode(t, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert decode(Vocabulary(WORD).tokens(), []) == ""
    assert bpe_round_trip(rows(spark).limit(0), WORD).count() == 0


def test_count_rows(spark):
    library = Tokenizer.from_file(BYTE)
    got = token_counts(rows(spark), BYTE, limit=3).collect()
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 3)
        for t in ["Hello, world.", "", "", "Hello, world.", "no id", "x" * 100_000, "<|endoftext|> a"]
    )
    assert token_counts(rows(spark).limit(0), BYTE).count() == 0


def test_files(spark, tmp_path):
    library = Tokenizer.from_file(WORD)
    path = str(tmp_path / "ids")
    write_token_files(rows(spark), WORD, path, files=3)
    got = token_file_digest(spark, path).orderBy(F.asc_nulls_first("doc_id"), "start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 5, 5, 9]
    start = 0
    for r, t in zip(got, ["no id", "x" * 100_000, "", "<|endoftext|> a", "Hello, world.", "Hello, world.", ""], strict=True):
        ids = library.encode(t, add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    found = read_token_files(spark, path, F.col("doc_id") == 3)
    assert found.count() == 1
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,3)]" in found._jdf.queryExecution().toString()
    empty = str(tmp_path / "none")
    write_token_files(rows(spark).limit(0), WORD, empty, files=2)
    assert read_token_files(spark, empty).count() == 0 and token_file_digest(spark, empty).count() == 0


def test_files_have_bloom_filters(spark, tmp_path):
    from pyarrow import orc

    path = tmp_path / "ids"
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    write_token_files(docs, WORD, str(path), files=1)
    file = orc.ORCFile(next(p for p in path.glob("*.orc") if p.stat().st_size > 1000))
    assert file.nrows == 5000 and file.row_index_stride == 1000
    assert file.metadata is not None
    assert library_table(WORD) is library_table(WORD)


def test_parts_of_a_batch():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4, 5]), pa.array(["a" * 5, None, "é" * 9, "c", ""])], names=["doc_id", "text"])
    parts = [(p.column("doc_id").to_pylist(), p.column("text").to_pylist()) for p in bounded([batch, batch.slice(0, 0)], 6)]
    assert parts == [([1, 2], ["a" * 5, None]), ([3], ["é" * 9]), ([4, 5], ["c", ""])]
    assert [p.num_rows for p in bounded([batch.slice(1, 3)], 1000)] == [3]


def test_whole_table_against_the_library(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts_ = {r.doc_id: r.text or "" for r in docs.collect()}
    word, byte = (dict(zip(texts_, [e.ids for e in Tokenizer.from_file(p).encode_batch(list(texts_.values()), add_special_tokens=False)], strict=True)) for p in (WORD, BYTE))
    for r in token_counts(docs, BYTE).collect():
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts_[r.doc_id].encode()), len(byte[r.doc_id]), len(byte[r.doc_id]) > 1024)
    for r in bpe_round_trip(docs, WORD).collect():
        assert (r.n_tokens, r.ids_sha256) == (len(word[r.doc_id]), hashlib.sha256(" ".join(map(str, word[r.doc_id])).encode()).hexdigest())
    write_token_files(docs, WORD, str(tmp_path / "ids"))
    start, got = 0, {r.doc_id: r for r in token_file_digest(spark, str(tmp_path / "ids")).collect()}
    for i in sorted(word):
        ids = [*word[i], 2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(word)
