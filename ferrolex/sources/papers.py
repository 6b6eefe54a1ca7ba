"""Text and figures of paper files: XML bodies and object lists, DOCX texts, PDF pages through an injected renderer."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Namespaces of the publisher's XML and of word processing files.
JA = "http://www.elsevier.com/xml/ja/dtd"
SVAPI = "http://www.elsevier.com/xml/svapi/article/dtd"
XOCS = "http://www.elsevier.com/xml/xocs/dtd"
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _root(xml: bytes | str):
    try:
        return ElementTree.fromstring(xml)
    except (ElementTree.ParseError, ValueError, TypeError):
        return None


def body_text_of(xml: bytes | str) -> str | None:
    """Text of the body, element by element: an element's text, then what follows it, before its children's; stripped
    pieces joined by blanks. Without a body all text as it stands; null for what is no XML."""
    root = _root(xml)
    if root is None:
        return None
    body = root.find(f".//{{{JA}}}body")
    if body is None:
        return " ".join(root.itertext())
    pieces = []
    for e in body.iter():
        pieces += [t.strip() for t in (e.text, e.tail) if t and t.strip()]
    return " ".join(pieces)


def objects_of(xml: bytes | str) -> list[tuple[int, str, str, str, str]]:
    """(pos, ref, category, type, url) of the listed objects."""
    root = _root(xml)
    if root is None:
        return []
    found = root.findall(f"{{{SVAPI}}}objects/{{{SVAPI}}}object")
    return [(k, o.get("ref") or "", o.get("category") or "", o.get("type") or "", (o.text or "").strip()) for k, o in enumerate(found)]


def attachments_of(xml: bytes | str) -> list[str]:
    """Identifiers of the supplementary attachments (.docx, .pdf), in order."""
    root = _root(xml)
    if root is None:
        return []
    found = [(e.text or "").strip() for a in root.iter(f"{{{XOCS}}}attachment") for e in a.findall(f"{{{XOCS}}}attachment-eid")]
    return [n for n in found if n.endswith((".docx", ".pdf"))]


def attachments(papers: DataFrame) -> DataFrame:
    """doi, pos, eid of papers (doi, xml)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(doi, k, eid) for doi, xml in zip(b["doi"], b["xml"]) if xml is not None for k, eid in enumerate(attachments_of(xml))]
            yield pd.DataFrame(rows, columns=["doi", "pos", "eid"])

    return papers.select("doi", "xml").mapInPandas(run, "doi string, pos int, eid string")


def docx_text_of(data: bytes) -> str:
    """Paragraphs, then the rows of tables with cells joined by bars; blank ones left out; "" for what is no DOCX."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            root = ElementTree.fromstring(z.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, TypeError):
        return ""
    text = lambda e: "".join(t.text or "" for t in e.iter(f"{WORD}t")).strip()
    body = root.find(f"{WORD}body")
    lines = [text(p) for p in body.findall(f"{WORD}p")] if body is not None else []
    for row in root.iter(f"{WORD}tr"):
        lines.append(" | ".join(c for c in map(text, row.findall(f"{WORD}tc")) if c))
    return "\n".join(x for x in lines if x)


def body_text(xml: Column) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda x: None if x is None else body_text_of(x))

    return run(xml)


def docx_text(data: Column) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda x: None if x is None else docx_text_of(x))

    return run(data)


def figure_objects(papers: DataFrame) -> DataFrame:
    """doi, pos, ref, category, type, url of papers (doi, xml)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(doi, *o) for doi, xml in zip(b["doi"], b["xml"]) if xml is not None for o in objects_of(xml)]
            yield pd.DataFrame(rows, columns=["doi", "pos", "ref", "category", "type", "url"])

    return papers.select("doi", "xml").mapInPandas(run, "doi string, pos int, ref string, category string, type string, url string")


def pdf_pages(papers: DataFrame, render: Callable[[bytes], list[bytes]]) -> DataFrame:
    """doi, label (page_1, page_2, ...), payload, mime of papers (doi, pdf); `render` gives PNG pages at 200 DPI."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(doi, f"page_{k}", page, "image/png") for doi, pdf in zip(b["doi"], b["pdf"]) if pdf is not None for k, page in enumerate(render(pdf), 1)]
            yield pd.DataFrame(rows, columns=["doi", "label", "payload", "mime"])

    return papers.select("doi", "pdf").mapInPandas(run, "doi string, label string, payload binary, mime string")


def supplement_text(parts: DataFrame) -> DataFrame:
    """doi, supp_text, supp_chars: texts (doi, filename, text) joined in order of name, each under a heading.

    supp_chars counts the headings as well.
    """
    # Fixed value: the form of a heading.
    headed = F.concat(F.lit("\n\n=== SUPPLEMENTARY: "), F.col("filename"), F.lit(" ===\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    one = parts.select("doi", F.struct("filename", headed.alias("t")).alias("p")).groupBy("doi").agg(F.array_sort(F.collect_list("p")).alias("ps"))
    text = F.array_join(F.transform("ps", lambda p: p["t"]), "")
    return one.select("doi", text.alias("supp_text"), F.length(text).alias("supp_chars"))
