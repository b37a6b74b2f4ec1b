"""Strict file readers: schemas are given, headers checked, nothing is inferred."""

from __future__ import annotations

import re
import zipfile
import xml.etree.ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from correlia.operators.operons import group_rows


def _fields(schema: str | T.StructType) -> list[str]:
    return (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fieldNames()


def read_delimited(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = "\t", comment: str | None = None, header: bool = True) -> DataFrame:
    """A delimited file whose header must be the schema's names in order; a bad row or header stops the read."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", "FAILFAST").option("enforceSchema", False).option("quote", '"').option("escape", '"')
    if comment:
        reader = reader.option("comment", comment)
    if header:
        first = next((r.value for r in spark.read.text(path).limit(50).toLocalIterator() if not (comment and r.value.startswith(comment))), "")
        found = [x.strip('"﻿') for x in first.split(sep)]
        if found != _fields(schema):
            raise ValueError(f"header {found} is not {_fields(schema)}")
    return reader.csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType, required: list[str]) -> DataFrame:
    """JSON lines; a line that is no JSON stops the read, a row without a required key raises when it is used."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    for c in required:
        df = df.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"required key {c} is missing"))).otherwise(F.col(c)))
    return df


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """GFF features with their attributes as a decoded map."""
    raw = spark.read.option("sep", "\t").option("comment", "#").schema("seqid string, source string, tipo string, inicio int, fin int, score string, cadena string, fase string, attrs string").csv(path)
    pairs = F.filter(F.split("attrs", ";"), lambda x: F.contains(x, F.lit("=")))
    decoded = F.map_from_entries(F.transform(pairs, lambda x: F.struct(F.trim(F.split_part(x, F.lit("="), F.lit(1))), F.try_url_decode(F.regexp_replace(F.substring_index(x, "=", -1), r"\+", "%2B")))))
    return raw.withColumn("atributos", decoded).drop("attrs")


def genes_of_gff(features: DataFrame) -> DataFrame:
    """(locus, simbolo, inicio, fin, cadena) of the genes of read_gff."""
    a = F.col("atributos")
    return features.where("tipo = 'gene'").select(F.try_element_at(a, F.lit("locus_tag")).alias("locus"), F.coalesce(F.try_element_at(a, F.lit("gene")), F.try_element_at(a, F.lit("Name"))).alias("simbolo"), "inicio", "fin", "cadena")


def read_operon_dump(spark: SparkSession, path: str, organism: str) -> DataFrame:
    """Operon dump (koid, organism, name, comma list of members) of one organism, one row per operon with its members as an array."""
    df = read_delimited(spark, path, "koid string, organismo string, nombre string, miembros string")
    return df.where(F.col("organismo") == organism).withColumn("miembros", F.filter(F.transform(F.split("miembros", ","), lambda x: F.trim(x)), lambda x: x != ""))


def read_gene_rows(spark: SparkSession, path: str) -> DataFrame:
    """A table with one row per gene (operon, orden, locus) as one row per operon, genes in order."""
    return group_rows(read_delimited(spark, path, "operon string, orden int, locus string"), "operon", "orden", "locus")


def read_promoters(spark: SparkSession, path: str) -> DataFrame:
    """Promoters (locus, puntaje, secuencia), the best of each locus; ties to the longer, then the smaller sequence."""
    df = read_delimited(spark, path, "locus string, puntaje double, secuencia string")
    return df.groupBy("locus").agg(F.max_by(F.struct("puntaje", "secuencia"), F.struct("puntaje", F.length("secuencia"))).alias("m")).select("locus", "m.puntaje", "m.secuencia")


def units_with_genes(units: DataFrame, genes: DataFrame) -> DataFrame:
    """Transcription units (unidad, marco) joined with genes (marco, locus): members in order of locus, unknown frames counted."""
    j = units.join(genes, "marco", "left")
    return j.groupBy("unidad").agg(F.array_sort(F.collect_set("locus")).alias("miembros"), F.count_if(F.col("locus").isNull()).alias("sin_resolver"))


def sniff(head: bytes) -> str:
    """Kind of some unknown bytes, by what they begin with."""
    for kind, magic in (("pdf", b"%PDF"), ("zip", b"PK\x03\x04"), ("gzip", b"\x1f\x8b"), ("sqlite", b"SQLite format 3"), ("parquet", b"PAR1")):
        if head.startswith(magic):
            return kind
    text = head.lstrip(b"\xef\xbb\xbf \t\r\n")
    if text[:1] in (b"{", b"["):
        return "json"
    if text[:1] == b"<":
        return "html" if re.match(rb"<(?:!doctype\s+)?html", text, re.I) else "xml"
    lines = text.split(b"\n")[:5]
    for kind, sep in (("tsv", b"\t"), ("csv", b",")):
        counts = {x.count(sep) for x in lines if x.strip()}
        if len(counts) == 1 and counts.pop() > 0:
            return kind
    return "texto" if text and b"\x00" not in text else "binario"


def read_xlsx(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """Rows of one sheet as text (one curated sheet fits the driver); the first row names the columns, empty cells are null."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(path) as z:
        shared = ["".join(x.itertext()) for x in ET.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", ns)] if "xl/sharedStrings.xml" in z.namelist() else []
        book = ET.fromstring(z.read("xl/workbook.xml"))
        ids = {s.get("name"): s.get(rel) for s in book.iterfind(".//m:sheet", ns)}
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        root = ET.fromstring(z.read("xl/" + targets[ids[sheet]].removeprefix("/xl/")))
    rows = []
    for row in root.iterfind(".//m:row", ns):
        cells: dict[int, str | None] = {}
        for c in row.iterfind("m:c", ns):
            col = 0
            for ch in re.match(r"[A-Z]+", c.get("r"))[0]:
                col = col * 26 + ord(ch) - 64
            v = c.find("m:v", ns)
            inline = c.find("m:is", ns)
            cells[col - 1] = "".join(inline.itertext()) if inline is not None else None if v is None else shared[int(v.text)] if c.get("t") == "s" else v.text
        rows.append(cells)
    names = [rows[0].get(i) or f"col{i}" for i in range(max(rows[0]) + 1)]
    data = [tuple(r.get(i) for i in range(len(names))) for r in rows[1:]]
    return spark.createDataFrame(data, T.StructType([T.StructField(n, T.StringType()) for n in names]))
