"""Sinks: partitioned and staged writes, exports, graph and workbook files."""

from __future__ import annotations

import json
import os
import shutil
import uuid
import zipfile
from collections.abc import Callable
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from correlia.functions.text import tsv_cell, xml_safe

SEPARATOR = " | "


def write_runs(df: DataFrame, path: str, run: str = "corrida_id") -> None:
    """Write rows partitioned by run; the runs present replace those of the same id, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run).parquet(path)


def drop_run(spark, path: str, run: str, value) -> None:
    """Take one run out of a partitioned table (a no-op if it is not there)."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/{run}={value}")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def append_only(df: DataFrame, path: str, keys: list[str]) -> int:
    """Append the rows whose keys the table does not hold yet; returns how many. Repeats among them count once."""
    spark = df.sparkSession
    fresh = df.dropDuplicates(keys)
    try:
        fresh = fresh.join(spark.read.parquet(path).select(*keys), keys, "left_anti")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    stage = f"{path}.stage-{uuid.uuid4().hex}"
    fresh.write.parquet(stage)
    staged = spark.read.parquet(stage)
    n = staged.count()
    staged.write.mode("append").parquet(path)
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(stage)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return n


def publish(outputs: dict[str, Callable[[str], None]], folder: str) -> None:
    """Write several outputs beside the folder and put them there together; if one fails none is changed."""
    stage = f"{folder}.stage-{uuid.uuid4().hex}"
    os.makedirs(stage)
    try:
        for name, write in outputs.items():
            write(os.path.join(stage, name))
        os.makedirs(folder, exist_ok=True)
        for name in outputs:
            target = os.path.join(folder, name)
            if os.path.isdir(target):
                shutil.rmtree(target)
            os.replace(os.path.join(stage, name), target)
    finally:
        shutil.rmtree(stage, ignore_errors=True)


def flat(df: DataFrame) -> DataFrame:
    """Array columns joined by ` | `, texts without tabs and line breaks."""
    out = []
    for name, kind in df.dtypes:
        c = F.array_join(F.col(name).cast("array<string>"), SEPARATOR) if kind.startswith("array") else F.col(name)
        out.append(tsv_cell(c).alias(name) if kind == "string" or kind.startswith("array") else c.alias(name))
    return df.select(*out)


def write_delimited(df: DataFrame, path: str, sep: str = ",", parts: int | None = None) -> None:
    (flat(df) if parts is None else flat(df).coalesce(parts)).write.mode("overwrite").option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').csv(path)


def export_file(df: DataFrame, path: str, bom: bool = False, sep: str = ",") -> int:
    """One CSV file, streamed partition by partition to the driver; returns the rows written."""
    import csv

    rows = flat(df)
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as f:
        out = csv.writer(f, delimiter=sep, lineterminator="\n")
        out.writerow(rows.columns)
        n = 0
        for r in rows.toLocalIterator():
            out.writerow(["" if v is None else v for v in r])
            n += 1
    return n


def export_json_lines(df: DataFrame, path: str) -> int:
    with open(path, "w", encoding="utf-8") as f:
        n = 0
        for r in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator():
            f.write(r["j"] + "\n")
            n += 1
    return n


def export_package(tables: dict[str, DataFrame], path: str, about: str) -> dict[str, int]:
    """ZIP with one CSV per table and a README that names the rows of each."""
    stage = f"{path}.stage-{uuid.uuid4().hex}"
    os.makedirs(stage)
    try:
        counts = {n: export_file(t, os.path.join(stage, f"{n}.csv"), bom=True) for n, t in tables.items()}
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for n in tables:
                z.write(os.path.join(stage, f"{n}.csv"), f"{n}.csv")
            z.writestr("README.txt", about + "\n\n" + "\n".join(f"{n}.csv: {c} rows" for n, c in counts.items()) + "\n")
    finally:
        shutil.rmtree(stage, ignore_errors=True)
    return counts


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str, node: str = "nodo", source: str = "tf", target: str = "target") -> tuple[int, int]:
    """Directed GraphML, nodes and edges streamed in order; characters XML forbids are left out."""
    kinds = {"string": "string", "int": "int", "bigint": "long", "double": "double", "boolean": "boolean"}

    def typed(df: DataFrame) -> list[tuple[str, str]]:
        return [(c, kinds.get(k, "string")) for c, k in flat(df).dtypes]

    def clean(df: DataFrame, order: list[str]) -> DataFrame:
        f = flat(df)
        return f.select(*[xml_safe(F.col(c)).alias(c) if k == "string" else F.col(c) for c, k in f.dtypes]).orderBy(*order)

    n_nodes = n_edges = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write('<?xml version="1.0" encoding="UTF-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">\n')
        for what, df, skip in (("node", nodes, {node}), ("edge", edges, {source, target})):
            for c, k in typed(df):
                if c not in skip:
                    f.write(f'<key id="{what}_{c}" for="{what}" attr.name={quoteattr(c)} attr.type="{k}"/>\n')
        f.write('<graph edgedefault="directed">\n')

        def data(what: str, row, skip: set[str]) -> str:
            return "".join(f'<data key="{what}_{c}">{escape(str(v).lower() if isinstance(v, bool) else str(v))}</data>' for c, v in row.asDict().items() if c not in skip and v is not None)

        for r in clean(nodes, [node]).toLocalIterator():
            f.write(f"<node id={quoteattr(str(r[node]))}>{data('node', r, {node})}</node>\n")
            n_nodes += 1
        for r in clean(edges, [source, target]).toLocalIterator():
            f.write(f"<edge source={quoteattr(str(r[source]))} target={quoteattr(str(r[target]))}>{data('edge', r, {source, target})}</edge>\n")
            n_edges += 1
        f.write("</graph>\n</graphml>\n")
    return n_nodes, n_edges


def write_viewer(edges: DataFrame, path: str, title: str, most: int = 2000) -> None:
    """Self-contained HTML page with the `most` best supported edges, to look through and filter."""
    rows = [r.asDict() for r in flat(edges).orderBy(F.desc("n_evidencias"), "tf", "target").limit(most).toLocalIterator()]
    body = json.dumps(rows, ensure_ascii=False, default=str).replace("</", "<\\/")
    with open(path, "w", encoding="utf-8") as f:
        f.write(
            f"<!doctype html><meta charset=utf-8><title>{escape(title)}</title><h1>{escape(title)}</h1><input id=q placeholder=filter><table id=t></table><script>const E={body};"
            "const t=document.getElementById('t'),q=document.getElementById('q');function d(){const k=q.value.toLowerCase();t.replaceChildren();for(const e of E){const s=Object.values(e).join(' ');"
            "if(!s.toLowerCase().includes(k))continue;const r=t.insertRow();for(const v of Object.values(e))r.insertCell().textContent=v}}q.oninput=d;d()</script>\n"
        )


def write_xlsx(tables: dict[str, DataFrame], path: str, most: int = 1_000_000) -> None:
    """Workbook with one sheet per table, all cells as text; a sheet holds at most `most` rows (the format's own limit)."""
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        names = list(tables)
        z.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/s{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(len(names))) + "</Types>")
        z.writestr("_rels/.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r0" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{ns}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name={quoteattr(n[:31])} sheetId="{i + 1}" r:id="r{i}"/>' for i, n in enumerate(names)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="worksheets/s{i}.xml"/>' for i in range(len(names))) + "</Relationships>")

        def letters(i: int) -> str:
            out = ""
            while i >= 0:
                out = chr(65 + i % 26) + out
                i = i // 26 - 1
            return out

        def row(n: int, values: list) -> str:
            return f'<row r="{n}">' + "".join(f'<c r="{letters(i)}{n}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>' for i, v in enumerate(values) if v is not None) + "</row>"

        for i, n in enumerate(names):
            df = flat(tables[n])
            df = df.select(*[xml_safe(F.col(c).cast("string")).alias(c) for c in df.columns])
            with z.open(f"xl/worksheets/s{i}.xml", "w") as f:
                f.write(f'<worksheet xmlns="{ns}"><sheetData>{row(1, df.columns)}'.encode())
                for k, r in enumerate(df.limit(most).toLocalIterator(), 2):
                    f.write(row(k, list(r)).encode())
                f.write(b"</sheetData></worksheet>")
