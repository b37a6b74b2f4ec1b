"""Snapshot visibility over append-only extractions (source, extraction, complete, rows).

Of each source the newest complete and non-empty extraction is visible. Null sources or extractions are never visible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def visible(extractions: DataFrame, rows: DataFrame) -> DataFrame:
    """(fuente, visible): the newest complete extraction of each source that has rows."""
    filled = extractions.where("completa").join(rows.select("extraccion").distinct(), "extraccion", "left_semi")
    return filled.groupBy("fuente").agg(F.max("extraccion").alias("visible"))


def current_rows(rows: DataFrame, shown: DataFrame) -> DataFrame:
    """Rows of the visible extractions; there are as many extractions as sources, far fewer than rows."""
    return rows.join(shown.withColumnRenamed("visible", "extraccion"), ["fuente", "extraccion"], "left_semi")


def retired(rows: DataFrame, shown: DataFrame, key: str) -> DataFrame:
    """(fuente, key) ever seen in a source with a snapshot and not in it."""
    seen = rows.join(shown.select("fuente"), "fuente", "left_semi").select("fuente", key).distinct()
    return seen.join(current_rows(rows, shown).select("fuente", key).distinct(), ["fuente", key], "left_anti")


def without_snapshot(extractions: DataFrame, shown: DataFrame) -> DataFrame:
    return extractions.select("fuente").distinct().join(shown, "fuente", "left_anti")


def failed_since(extractions: DataFrame, shown: DataFrame) -> DataFrame:
    """(fuente, n) extractions after the visible one."""
    later = extractions.join(shown, "fuente").groupBy("fuente").agg(F.count_if(F.col("extraccion") > F.col("visible")).alias("n"))
    return later


def repeated_content(df: DataFrame, group: list[str], content: str, name: str) -> DataFrame:
    """Contents that stand under more than one name within a group, with the sorted names."""
    digest = F.sha2(F.col(content), 256)
    names = df.where(F.col(content).isNotNull()).groupBy(*group, digest.alias("huella")).agg(F.countDistinct(name).alias("n"), F.min(name).alias("primero"), F.max(name).alias("ultimo"))
    return names.where("n > 1")
