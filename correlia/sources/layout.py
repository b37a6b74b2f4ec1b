"""Positioned page lines (doc, pagina, x0, y0, x1, y1, ancho, alto, texto) as text in reading order.

Lines come from any PDF reader; the layout is plain plans over their places. A document's lines are few, and every
window is one document or page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def without_margins(lines: DataFrame, band: float = 0.08, share: float = 0.5) -> DataFrame:
    """Without running heads and feet: lines in the outer band that recur, numbers aside, on at least `share` of the pages."""
    key = F.regexp_replace(F.lower(F.trim("texto")), r"\d+", "#")
    outer = (F.col("y1") <= band * F.col("alto")) | (F.col("y0") >= (1 - band) * F.col("alto"))
    keyed = lines.withColumns({"__key": key, "__outer": outer})
    pages = lines.groupBy("doc").agg(F.count_distinct("pagina").alias("__pages"))
    often = keyed.where("__outer").groupBy("doc", "__key").agg(F.count_distinct("pagina").alias("__n")).join(pages, "doc").where((F.col("__n") >= share * F.col("__pages")) & (F.col("__pages") > 1)).select("doc", "__key", F.lit(True).alias("__gone"))
    return keyed.join(often, ["doc", "__key"], "left").where(~(F.col("__outer") & F.coalesce("__gone", F.lit(False)))).drop("__key", "__outer", "__gone")


def reading_order(lines: DataFrame) -> DataFrame:
    """With `columna` (0 full width, 1 left, 2 right) and `orden` per document. A full-width line parts the columns above it from those below."""
    mid = F.col("ancho") / 2
    column = F.when((F.col("x0") < mid * 0.95) & (F.col("x1") > mid * 1.05), 0).when(F.col("x0") < mid * 0.95, 1).otherwise(2)
    with_column = lines.withColumn("columna", column)
    page = W.partitionBy("doc", "pagina").orderBy("y0", "x0")
    zone = F.sum((F.col("columna") == 0).cast("int") * 2).over(page.rowsBetween(W.unboundedPreceding, 0)) + (F.col("columna") != 0).cast("int")
    return with_column.withColumn("zona", zone).withColumn("orden", F.row_number().over(W.partitionBy("doc").orderBy("pagina", "zona", "columna", "y0", "x0")))


def joined_text(ordered: DataFrame) -> DataFrame:
    """(doc, texto): lines in order; a word broken by a hyphen at a line end is joined if the document has it whole elsewhere."""
    words = ordered.select("doc", F.explode(F.regexp_extract_all(F.lower("texto"), F.lit(r"(\p{L}+)"), 1)).alias("w")).groupBy("doc").agg(F.collect_set("w").alias("__words"))
    text = ordered.groupBy("doc").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("orden", "texto"))), lambda x: x["texto"]), "\n").alias("texto"))
    parts = F.split("texto", "-\n")
    tail = lambda s: F.lower(F.regexp_extract(s, r"(\p{L}+)$", 1))
    head = lambda s: F.lower(F.regexp_extract(s, r"^(\p{L}+)", 1))
    fold = lambda a, x: F.when(a.isNull(), x).when(F.array_contains("__words", F.concat(tail(a), head(x))), F.concat(a, x)).otherwise(F.concat(a, F.lit("-\n"), x))
    return text.join(words, "doc", "left").select("doc", F.aggregate(parts, F.lit(None).cast("string"), fold).alias("texto"))
