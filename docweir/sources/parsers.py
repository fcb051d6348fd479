"""Parsers: files to typed segments, behind one interface."""

from __future__ import annotations

import base64
import io
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from html.parser import HTMLParser
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweir.operators.chunking import CATEGORY_WORDS, CLASS_WORDS, asset_ref, modality, segment_text

ELEMENT = (
    "path string, seg_ord int, text string, category string, page_no string, table_html string, formula_latex string, image_b64 string, "
    "by_class boolean, failed_parser string, error string"
)


@dataclass
class Element:
    """What a parser finds, in order."""

    text: str = ""
    category: str = ""
    page_no: str = ""
    table_html: str | None = None
    formula_latex: str | None = None
    image: bytes | str | None = None


class Parser(Protocol):
    """Turns one file into elements; an empty list or an error passes the file on to the next parser."""

    #: Whether categories are class names, which have modality words of their own and no asset references.
    by_class: bool

    def elements(self, path: str, content: bytes) -> list[Element]: ...


class TextParser:
    """All of a file as one text."""

    by_class = False

    def elements(self, path: str, content: bytes) -> list[Element]:
        return [Element(content.decode("utf-8", "ignore"), "NarrativeText")]


class _HtmlReader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[Element] = []
        self.words: list[str] = []
        self.table: list[str] | None = None
        self.hidden = 0

    def _flush(self, category: str = "NarrativeText", **more) -> None:
        text = " ".join("".join(self.words).split())
        if text or more:
            self.found.append(Element(text, category, **more))
        self.words = []

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        if tag in ("script", "style"):
            self.hidden += 1
        elif tag == "table":
            self._flush()
            self.table = []
        elif tag == "img":
            self._flush()
            self.found.append(Element(given.get("alt") or "", "Image", image=given.get("src")))
        elif tag in ("p", "div", "li", "br", "section", "article", "math") or re.fullmatch("h[1-6]", tag):
            if self.table is None:
                self._flush()
        if self.table is not None:
            self.table.append(self.get_starttag_text() or "")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        if self.table is not None:
            self.table.append(f"</{tag}>")
            if tag == "table":
                html, self.table = "".join(self.table), None
                self._flush("Table", table_html=html)
        elif tag == "math":
            latex = "".join(self.words).strip()
            self._flush("Formula", formula_latex=latex)
        elif tag in ("p", "div", "li", "section", "article", "title") or re.fullmatch("h[1-6]", tag):
            self._flush("Title" if tag.startswith("h") or tag == "title" else "NarrativeText")

    def handle_data(self, data):
        if not self.hidden:
            self.words.append(data)
            if self.table is not None:
                self.table.append(data)


class HtmlParser:
    """Blocks, tables, images and formulas of HTML, with the standard library only."""

    by_class = False

    def elements(self, path: str, content: bytes) -> list[Element]:
        text = content.decode("utf-8", "ignore")
        if "<" not in text or ">" not in text:
            return []
        reader = _HtmlReader()
        reader.feed(text)
        reader.close()
        reader._flush()
        return reader.found


class MarkdownParser:
    """Paragraphs, pipe tables, images and display formulas of Markdown."""

    by_class = False

    def elements(self, path: str, content: bytes) -> list[Element]:
        if not path.endswith(".md"):
            return []
        out: list[Element] = []
        for block in re.split(r"\n\s*\n", content.decode("utf-8", "ignore")):
            block = block.strip()
            image = re.fullmatch(r"!\[([^\]]*)\]\(([^)\s]*)[^)]*\)", block)
            formula = re.fullmatch(r"\$\$(.+)\$\$", block, re.DOTALL)
            lines = block.split("\n")
            if image:
                out.append(Element(image[1], "Image", image=image[2]))
            elif formula:
                out.append(Element("", "Formula", formula_latex=formula[1].strip()))
            elif len(lines) > 1 and all("|" in line for line in lines) and re.fullmatch(r"[\s|:-]+", lines[1]):
                rows = [[c.strip() for c in line.strip().strip("|").split("|")] for k, line in enumerate(lines) if k != 1]
                html = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in row) + "</tr>" for row in rows)
                out.append(Element("", "Table", table_html=f"<table>{html}</table>"))
            elif block:
                out.append(Element(block.lstrip("# "), "Title" if block.startswith("#") else "NarrativeText"))
        return out


class PartitionParser:
    """A file partitioner from an optional package, called as ``partition(file=stream, metadata_filename=..., **options)``.

    It is given the content, since a task has no file of that path.
    """

    by_class = False

    def __init__(self, partition: Callable | None = None, **options) -> None:
        self.partition = partition
        self.options = {"strategy": "hi_res", "extract_images_in_pdf": True, "infer_table_structure": True, "languages": ["kor", "eng"]} | options

    def _callable(self) -> Callable | None:
        if self.partition is None:
            try:
                from unstructured.partition.auto import partition
            except ImportError:
                return None
            self.partition = partition
        return self.partition

    def elements(self, path: str, content: bytes) -> list[Element]:
        run = self._callable()
        if run is None:
            return []
        found = []
        for e in run(file=io.BytesIO(content), metadata_filename=path, **self.options) or ():
            meta = getattr(e, "metadata", None)
            found.append(
                Element(
                    str(getattr(e, "text", "") or ""),
                    str(getattr(e, "category", "") or ""),
                    str(getattr(meta, "page_number", "") or ""),
                    getattr(meta, "text_as_html", None),
                    getattr(meta, "text_as_latex", None),
                    getattr(meta, "image_base64", None),
                )
            )
        return found


@dataclass
class NamedStream:
    """A file's name and content, where the converter's package has no such class of its own."""

    name: str
    stream: io.BytesIO


class ConverterParser:
    """A document converter from an optional package, given named streams; items are told apart by the names of their classes."""

    by_class = True

    def __init__(self, converter=None) -> None:
        self.converter = converter

    def _object(self):
        if self.converter is None:
            try:
                from docling.document_converter import DocumentConverter
            except ImportError:
                return None
            self.converter = DocumentConverter()
        return self.converter

    @staticmethod
    def _stream(path: str, content: bytes):
        try:
            from docling.datamodel.base_models import DocumentStream
        except ImportError:
            return NamedStream(path, io.BytesIO(content))
        return DocumentStream(name=path, stream=io.BytesIO(content))

    def elements(self, path: str, content: bytes) -> list[Element]:
        converter = self._object()
        document = getattr(converter.convert(self._stream(path, content)), "document", None) if converter else None
        if document is None:
            return []
        try:
            items = list(document.iterate_items())
        except Exception:  # noqa: BLE001  a converter may fail in any way; its Markdown is the next best
            return [Element(str(document.export_to_markdown() or ""), "text")]
        out = []
        for item in items:
            # Items may come with their level, before or after it.
            part = next((p for p in reversed(item) if not isinstance(p, int)), None) if isinstance(item, tuple) else item
            html = getattr(part, "export_to_html", None)
            out.append(
                Element(
                    str(getattr(part, "text", "") or ""),
                    type(part).__name__,
                    table_html=str(html() or "") if html else None,
                    formula_latex=getattr(part, "latex", None),
                    image=getattr(part, "image", None),
                )
            )
        return out


#: By name, the parsers that are tried in turn.
CHAINS: dict[str, Callable[[], list[Parser]]] = {
    "auto": lambda: [ConverterParser(), PartitionParser(), MarkdownParser(), HtmlParser(), TextParser()],
    "packages": lambda: [ConverterParser(), PartitionParser(), TextParser()],
    "offline": lambda: [MarkdownParser(), HtmlParser(), TextParser()],
    "text": lambda: [TextParser()],
}


def first_elements(parsers: Iterable[Parser], path: str, content: bytes) -> tuple[list[Element], bool, list[tuple[str, str]]]:
    """The elements of the first parser that finds any text, whether their categories are class names, and (parser, error) of those that failed."""
    failures = []
    for parser in parsers:
        try:
            found = parser.elements(path, content)
        except Exception as e:  # noqa: BLE001  one parser's failure passes the file to the next
            failures.append((type(parser).__name__, f"{type(e).__name__}: {e}"))
            continue
        if any(e.text.strip() or (e.table_html or "").strip() or (e.formula_latex or "").strip() for e in found):
            return found, parser.by_class, failures
    return [], False, failures


def _base64(image: bytes | str | None) -> str | None:
    if isinstance(image, (bytes, bytearray)):
        return base64.b64encode(bytes(image)).decode()
    return image.strip() or None if isinstance(image, str) else None


def parsed_elements(files: DataFrame, chain: str | list[Parser] = "auto") -> DataFrame:
    """What parsers find in (path, content) rows, a row per element, and a row per failure of a parser.

    Parsing runs in Python, a file at a time; all rules on its output are columns.
    """
    import pandas as pd

    def run(batches):
        parsers = CHAINS[chain]() if isinstance(chain, str) else chain
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                found, by_class, failures = first_elements(parsers, path, bytes(content))
                rows = [(path, k, e.text, e.category, e.page_no, e.table_html, e.formula_latex, _base64(e.image), by_class, None, None) for k, e in enumerate(found)]
                rows += [(path, None, None, None, None, None, None, None, None, *failure) for failure in failures]
                frame = pd.DataFrame(rows, columns=[c.split()[0] for c in ELEMENT.split(", ")])
                yield frame.astype({"seg_ord": "Int32", "by_class": "boolean"})

    return files.select("path", "content").mapInPandas(run, ELEMENT)


def parse_failures(elements: DataFrame) -> DataFrame:
    """(path, parser, error) of parsers that failed on a file, which then went to the next parser."""
    return elements.where("error IS NOT NULL").select("path", F.col("failed_parser").alias("parser"), "error")


def element_segments(elements: DataFrame) -> DataFrame:
    """Segments of parsed elements: (path, seg_ord, text, modality, asset_ref, table_html, formula_latex, image_b64)."""
    kind = F.when(F.col("by_class"), modality(F.col("category"), CLASS_WORDS)).otherwise(modality(F.col("category"), CATEGORY_WORDS))
    return (
        elements.where("error IS NULL")
        .withColumn("modality", kind)
        .withColumn("asset_ref", F.when(~F.col("by_class"), asset_ref(F.col("modality"), F.col("page_no"), F.col("seg_ord"))))
        .withColumn("text", segment_text(F.col("text"), F.col("modality"), F.col("table_html"), F.col("formula_latex")))
        .where("text IS NOT NULL")
        .select("path", "seg_ord", "text", "modality", "asset_ref", "table_html", "formula_latex", "image_b64")
    )


def parsed_segments(files: DataFrame, chain: str | list[Parser] = "auto") -> DataFrame:
    """Segments of (path, content) rows."""
    return element_segments(parsed_elements(files, chain))
