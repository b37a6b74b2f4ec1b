"""Article XML as rows. Mixed content needs its order kept, so the walk is Python, fed in Arrow batches."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

ARTICLE = "pmid string, doi string, titulo string, abstract string, revista string, anio string, autores array<string>, mesh_terms array<string>, keywords array<string>, tipos array<string>"
TABLE = "titulo string, filas array<array<string>>, pie string"


def _text(node: ET.Element | None) -> str | None:
    if node is None:
        return None
    return re.sub(r"\s+", " ", "".join(node.itertext())).strip() or None


def parse_articles(xml: str) -> list[dict]:
    """Records of an article set: labelled abstract parts, year with fallbacks, DOI from either place, collective authors."""
    out = []
    for art in ET.fromstring(xml).iter("PubmedArticle"):
        parts = []
        for p in art.iterfind(".//Abstract/AbstractText"):
            body = _text(p)
            if body:
                parts.append(f"{p.get('Label')}: {body}" if p.get("Label") else body)
        year = _text(art.find(".//JournalIssue/PubDate/Year")) or _text(art.find(".//ArticleDate/Year"))
        if not year and (m := re.search(r"\d{4}", _text(art.find(".//JournalIssue/PubDate/MedlineDate")) or "")):
            year = m[0]
        doi = next((_text(x) for x in [*art.iterfind(".//ELocationID[@EIdType='doi']"), *art.iterfind(".//ArticleId[@IdType='doi']")] if _text(x)), None)
        names = []
        for a in art.iterfind(".//AuthorList/Author"):
            names.append(_text(a.find("CollectiveName")) or " ".join(x for x in (_text(a.find("LastName")), _text(a.find("Initials"))) if x))
        pick = lambda path: [t for t in (_text(x) for x in art.iterfind(path)) if t]
        out.append({
            "pmid": _text(art.find(".//PMID")), "doi": doi, "titulo": _text(art.find(".//ArticleTitle")), "abstract": "\n".join(parts) or None,
            "revista": _text(art.find(".//Journal/Title")), "anio": year, "autores": [n for n in names if n], "mesh_terms": pick(".//MeshHeading/DescriptorName"),
            "keywords": pick(".//Keyword"), "tipos": pick(".//PublicationType"),
        })
    return out


def parse_sections(xml: str) -> tuple[str, bool]:
    """Text of a full article with `##` headings by depth, captions last under their own heading, and whether it has a body."""
    root = ET.fromstring(xml)
    body = root.find(".//body")
    lines: list[str] = []

    def walk(node: ET.Element, depth: int) -> None:
        for child in node:
            if child.tag == "title":
                continue
            if child.tag == "sec":
                if title := _text(child.find("title")):
                    lines.append(f"{'#' * min(depth, 6)} {title}")
                walk(child, depth + 1)
            elif child.tag == "p":
                if text := _text(child):
                    lines.append(text)
            elif child.tag not in ("fig", "table-wrap"):
                walk(child, depth)

    if body is not None:
        walk(body, 2)
    captions = [t for t in (_text(x) for x in root.iterfind(".//caption")) if t]
    if captions:
        lines += ["## Captions", *captions]
    return "\n\n".join(lines), body is not None


def parse_tables(xml: str) -> list[dict]:
    """Tables of an article, cells repeated over their row and column spans."""
    out = []
    for wrap in ET.fromstring(xml).iter("table-wrap"):
        rows: list[list[str]] = []
        open_cells: dict[int, tuple[int, str]] = {}
        for tr in wrap.iter("tr"):
            row: list[str] = []
            cells = list(tr)
            while cells or len(row) in open_cells:
                at = len(row)
                if at in open_cells:
                    left, text = open_cells[at]
                    row.append(text)
                    if left > 1:
                        open_cells[at] = (left - 1, text)
                    else:
                        del open_cells[at]
                    continue
                cell = cells.pop(0)
                text = _text(cell) or ""
                for _ in range(int(cell.get("colspan") or 1)):
                    if (span := int(cell.get("rowspan") or 1)) > 1:
                        open_cells[len(row)] = (span - 1, text)
                    row.append(text)
            rows.append(row)
        out.append({"titulo": _text(wrap.find("caption")), "filas": rows, "pie": _text(wrap.find("table-wrap-foot"))})
    return out


def articles(df: DataFrame, xml: str = "xml") -> DataFrame:
    """One row per article of the XML column; null or broken XML gives none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for x in pdf[xml].dropna():
                try:
                    rows += parse_articles(x)
                except ET.ParseError:
                    continue
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ARTICLE.split(", ")])

    return df.select(xml).mapInPandas(run, ARTICLE)


def full_texts(df: DataFrame, key: str, xml: str = "xml") -> DataFrame:
    """(key, texto, con_cuerpo) of each document; broken XML gives a null text."""

    def one(x: str | None) -> tuple[str | None, bool]:
        try:
            return parse_sections(x) if x else (None, False)
        except ET.ParseError:
            return None, False

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [one(x) for x in pdf[xml]]
            yield pd.DataFrame({key: pdf[key], "texto": [a for a, _ in got], "con_cuerpo": [b for _, b in got]})

    return df.select(key, xml).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, texto string, con_cuerpo boolean")


def tables(df: DataFrame, key: str, xml: str = "xml") -> DataFrame:
    """One row per table: (key, titulo, filas, pie)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, x in zip(pdf[key], pdf[xml]):
                try:
                    rows += [{key: k, **t} for t in (parse_tables(x) if x else [])]
                except ET.ParseError:
                    continue
            yield pd.DataFrame(rows, columns=[key, "titulo", "filas", "pie"])

    return df.select(key, xml).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, {TABLE}")
