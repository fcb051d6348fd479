"""Chunks of many texts at once, cut and numbered as Arrow arrays, for the byte-level tokenizer file.

The chunks are those of ``pieces.Splitter``, and so are the pieces in them; only distinct
chunks of a batch become Python strings. Texts that have to be cut up in full go through
the splitter one by one.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from docweir.llm.pieces import BARE, PieceTable, Vocabulary, gathered

#: White space other than blanks and line ends, the marks of chunks, and blanks or line ends that don't stand alone inside a text.
_SPACES = r"\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: Letters and digits as ``pieces`` has them, in the notation of Arrow's expressions.
_LETTERS = r"A-Za-z0-9\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}"
_ODD = rf"[{_SPACES}\x00-\x03]|  | \n|\n[ \n]|\A[ \n]|[ \n]\z"


@lru_cache(maxsize=2)
def byte_table(vocabulary_path: str, limit: int = 700_000) -> PieceTable:
    """The table of a worker process, kept from task to task; the tokenizer library encodes new pieces, each as a word of one text."""
    vocabulary = Vocabulary(vocabulary_path)
    if vocabulary.lower:
        raise ValueError("texts are cut here as a byte-level tokenizer does")
    library = Tokenizer(Tokenizer.from_file(vocabulary_path).model)
    library.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not pieces:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        found = library.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, dtype=np.int32), np.bincount(np.array(found.word_ids), minlength=len(pieces))

    return PieceTable(vocabulary, encode, limit)


def chunk_codes(table: PieceTable, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the chunks of all texts, one text after the other, and how many each text has; null counts as empty."""
    if len(table.numbers) > table.limit:
        table.reset()
    texts = pc.fill_null(texts.cast(pa.string()), "")
    odd = pc.match_substring_regex(texts, _ODD)
    for special in table.vocabulary.special:
        odd = pc.or_(odd, pc.match_substring(texts, special))
    odd = odd.to_numpy(zero_copy_only=False)
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    counts = np.zeros(len(texts), dtype=np.int64)
    plain = np.flatnonzero(~odd & ~empty)
    words = pc.split_pattern(_stops_apart(texts.take(pa.array(plain))), " ")
    counts[plain] = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    encoded = words.flatten().dictionary_encode()
    numbers = np.fromiter(map(table.numbers.__getitem__, encoded.dictionary.to_pylist()), dtype=np.int32, count=len(encoded.dictionary))
    flat = [numbers[encoded.indices.to_numpy(zero_copy_only=False)] if len(numbers) else np.zeros(0, dtype=np.int32)]
    full = np.flatnonzero(odd)
    for k, text in zip(full.tolist(), texts.take(pa.array(full)).to_pylist(), strict=True):
        chunks = table.splitter.chunks(text)
        counts[k] = len(chunks)
        flat.append(np.fromiter(map(table.numbers.__getitem__, chunks), dtype=np.int32, count=len(chunks)))
    if table.new:
        # A chunk of ASCII letters alone is one piece, with the blank before it.
        table.learn([[" " + c] if c.isalpha() and c.isascii() else table.splitter.pieces_of(c) for c in table.new])
        table.new = []
    order = np.concatenate([plain, full])
    starts = np.zeros(len(texts), dtype=np.int64)
    starts[order] = np.cumsum(counts[order]) - counts[order]
    return gathered(np.concatenate(flat), starts, counts), counts


def _stops_apart(texts: pa.Array) -> pa.Array:
    """Texts as chunks with blanks between them: a comma or full stop between a letter or digit and white space is one, and so is a line end."""
    texts = pc.replace_substring_regex(texts, rf"([{_LETTERS}])([.,])([ \n])", rf"\1 {BARE}\2\3")
    texts = pc.replace_substring(texts, "\n", f" {BARE}\n {BARE}")
    return pc.binary_join_element_wise(BARE, texts, "")


def token_ids(table: PieceTable, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each with ``end_id`` after it, one text after the other, and how many each text has."""
    codes, counts = chunk_codes(table, texts)
    sizes = table.lengths[codes]
    ends = np.r_[0, np.cumsum(sizes, dtype=np.int64)][np.cumsum(counts)]
    return np.insert(table.ids(codes), ends, end_id), np.diff(ends, prepend=0) + 1
