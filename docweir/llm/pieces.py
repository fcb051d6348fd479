"""Splits texts into the pieces within which byte-pair merges happen.

Works for the two kinds of tokenizer file that the operators are run with: a byte-level
one and a lower-casing one with word ends. Texts of common scripts take a regular
expression; texts with characters that Unicode versions classify differently take the
tokenizer library's own normalizer and splitter.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import chain

import numpy as np
import regex

# The splitting patterns of the two kinds, and of each for ASCII texts.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
WORD_ASCII = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"
#: Anything outside scripts on whose classes all Unicode versions agree.
UNCOMMON = re.compile(
    "[^\\u0000-\\u052f\\u0590-\\u06ff\\u0900-\\u097f\\u0e00-\\u0e7f\\u2000-\\u206f\\u20a0-\\u20bf\\u2100-\\u214f"
    "\\u3000-\\u30ff\\u4e00-\\u9fff\\uac00-\\ud7a3\\uff00-\\uffef\\U0001f300-\\U0001f5ff]"
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable Latin-1, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """What a byte-pair tokenizer file holds, as arrays and dicts for the merge loops."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path = path
        self.ids: dict[str, int] = model["vocab"]
        self.word_end: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*self.ids.values(), *self.special.values()]) + 1
        self.byte_ids = np.array([self.ids[s] for s in byte_symbols()])
        self.last_byte_ids = np.array([self.ids[s + self.word_end] for s in byte_symbols()])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merge_pairs = [(self.ids[a], self.ids[b]) for a, b in pairs]
        self.merge_ids = [self.ids[a + b] for a, b in pairs]
        self.lower = spec["normalizer"] is not None

    def tokens(self) -> list[str]:
        """The string of each id."""
        out = [""] * self.size
        for text, i in [*self.ids.items(), *self.special.items()]:
            out[i] = text
        return out

    def symbols(self, piece: str) -> list[int]:
        """The ids of the piece's bytes, before any merge."""
        data = np.frombuffer(piece.encode(), dtype=np.uint8)
        out = self.byte_ids[data]
        out[-1] = self.last_byte_ids[data[-1]]
        return out.tolist()


#: Marks of chunks that don't follow a blank, and of pieces of a text that is cut up in full.
BARE, PIECE = "\x01", "\x02"
#: White space that a byte-level text must not have for its words to stand alone: other than single blanks and line ends inside.
_BYTE_ODD = re.compile(r"[^\S \n]|[\x00-\x03]|  | \n|\n[ \n]|\A\s|\s\Z")
#: Characters that Python, but not the library, counts as white space, and the marks.
_WORD_ODD = re.compile(r"[\x00-\x03\x1c-\x1f]")
#: A comma or full stop between a letter or digit and white space is always a piece.
_ALNUM = "A-Za-z0-9\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u024f"
_STOP = re.compile(rf"(?<=[{_ALNUM}])([.,])(?=[ \n])")
_OTHER_STOP = re.compile(rf"(?<![{_ALNUM}])[.,]")


def _plain(text: str) -> bool:
    """Whether a text has no control characters and no white space but blanks and line ends."""
    return text.replace("\n", "").isprintable()


def _stops_apart(text: str, mark: str) -> str:
    """With a blank and a mark before commas and full stops that are pieces of their own."""
    if _OTHER_STOP.search(text):
        return _STOP.sub(rf" {mark}\1", text)
    for stop in (", ", ". ", ",\n", ".\n"):
        text = text.replace(stop, f" {mark}{stop}")
    return text


class Splitter:
    """Text to pieces, by way of chunks.

    A chunk is a stretch of text whose pieces don't depend on what stands around it, as a
    rule a word between blanks, so that what is known of a chunk can be kept. A special
    token's string in a text is a piece of its own.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.lower = vocabulary.lower
        self.path = vocabulary.path
        self.special = vocabulary.special
        self.find = regex.compile(WORD_PATTERN if self.lower else BYTE_PATTERN).findall
        self.find_ascii = re.compile(WORD_ASCII if self.lower else BYTE_ASCII).findall
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split
        self.library = None

    def _odd(self, text: str) -> bool:
        """Whether a text has to be cut up in full."""
        if any(s in text for s in self.special):
            return True
        if self.lower:
            return (not _plain(text) and _WORD_ODD.search(text) is not None) or (not text.isascii() and UNCOMMON.search(text) is not None)
        if not _plain(text):
            return _BYTE_ODD.search(text) is not None
        return text[0].isspace() or text[-1].isspace() or any(s in text for s in ("  ", " \n", "\n ", "\n\n"))

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if self._odd(text):
            return [PIECE + p for p in self.split(text)]
        if self.lower:
            return _stops_apart(self._normal(text), "").split()
        return (BARE + _stops_apart(text, BARE).replace("\n", f" {BARE}\n {BARE}")).split(" ")

    def pieces_of(self, chunk: str) -> list[str]:
        if chunk[0] == PIECE:
            return [chunk[1:]]
        if self.lower:
            return self.find_ascii(chunk) if chunk.isascii() else self.find(chunk)
        return self._pieces(chunk[1:] if chunk[0] == BARE else " " + chunk)

    def split(self, text: str) -> list[str]:
        """The pieces of a whole text."""
        if not any(s in text for s in self.special):
            return self._pieces(text)
        out: list[str] = []
        for k, part in enumerate(self.cut(text)):
            out += [part] if k % 2 else self._pieces(part)
        return out

    @staticmethod
    def _normal(text: str) -> str:
        # The library lower-cases each character alone, so there is no final sigma.
        return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _pieces(self, text: str) -> list[str]:
        if not text.isascii() and UNCOMMON.search(text):
            return self._library_pieces(text)
        if self.lower:
            text = self._normal(text)
        return self.find_ascii(text) if text.isascii() else self.find(text)

    def _library_pieces(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        if self.lower:
            text = self.library.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]


class ChunkNumbers:
    """Numbers distinct chunks; what is known of each lies in arrays by number.

    ``learn`` (of a subclass) appends what it finds out about new chunks. Everything is
    forgotten when more than ``limit`` chunks are known at the start of a batch; results
    don't depend on it.
    """

    def __init__(self, vocabulary: Vocabulary, limit: int) -> None:
        self.vocabulary = vocabulary
        self.splitter = Splitter(vocabulary)
        self.limit = limit
        self.reset()

    def reset(self) -> None:
        table = self

        class Numbers(dict):
            def __missing__(self, chunk):
                self[chunk] = n = len(self)
                table.new.append(chunk)
                return n

        self.numbers, self.new = Numbers(), []

    def learn(self, pieces: list[list[str]]) -> None:
        raise NotImplementedError

    def codes(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of each text's chunks; null counts as empty."""
        if len(self.numbers) > self.limit:
            self.reset()
        out = []
        for text in texts:
            chunks = self.splitter.chunks(text or "")
            out.append(np.fromiter(map(self.numbers.__getitem__, chunks), dtype=np.int32, count=len(chunks)))
        if self.new:
            self.learn(list(map(self.splitter.pieces_of, self.new)))
            self.new = []
        return out

    def piece_places(self, pieces: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct pieces, special tokens last; the place of each piece of each chunk among them; where chunks start."""
        distinct = list(set().union(*pieces).difference(self.vocabulary.special))
        place = {p: k for k, p in enumerate(chain(distinct, self.vocabulary.special))}
        counts = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        places = np.fromiter(map(place.__getitem__, chain.from_iterable(pieces)), dtype=np.int64, count=int(counts.sum()))
        return distinct, places, np.cumsum(counts) - counts


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` with these starts and lengths, one after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def flattened(coded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids as one array and their lengths."""
    lengths = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
    return np.fromiter(chain.from_iterable(coded), dtype=np.int32, count=int(lengths.sum())), lengths


class PieceTable(ChunkNumbers):
    """Keeps the ids of chunks; ``encode`` maps pieces to the ids of all and the number of each."""

    def __init__(self, vocabulary: Vocabulary, encode, limit: int = 600_000) -> None:
        self.encode = encode
        super().__init__(vocabulary, limit)

    def reset(self) -> None:
        super().reset()
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.starts, self.lengths = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        self.used = 0

    def learn(self, pieces: list[list[str]]) -> None:
        distinct, places, chunk_starts = self.piece_places(pieces)
        flat, lengths = self.encode(distinct)
        special = np.array(list(self.vocabulary.special.values()), dtype=np.int32)
        flat, lengths = np.concatenate([flat, special]), np.concatenate([lengths, np.ones(len(special), dtype=np.int64)])
        starts = np.cumsum(lengths) - lengths
        ids = gathered(flat, starts[places], lengths[places])
        sizes = np.add.reduceat(lengths[places], chunk_starts)
        total = self.used + len(ids)
        if total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat) // 2, total - len(self.flat)), dtype=np.int32)])
        self.flat[self.used : total] = ids
        self.starts = np.concatenate([self.starts, (self.used + np.cumsum(sizes) - sizes).astype(np.int32)])
        self.lengths = np.concatenate([self.lengths, sizes.astype(np.int32)])
        self.used = total

    def ids(self, codes: np.ndarray) -> np.ndarray:
        """The token ids of a text from the numbers of its chunks."""
        return gathered(self.flat, self.starts[codes], self.lengths[codes])
