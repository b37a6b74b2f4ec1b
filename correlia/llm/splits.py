"""Splits that keep related records together (problem 1).

`connected_groups`: iterative minimum-label propagation over the bipartite record-entity graph. In each
round an entity takes the smallest label among its records and a record the smallest label among its
entities; the pointers so found are doubled until they reach roots, and the graph is contracted to the
roots. Every round at least halves the labels of an unfinished component, so the number of rounds is
logarithmic. Entities and labels that hold a large share of the edges go through `lookup_join`.

`assign_splits`: stratified group assignment, in operators.group_splits.

Defined cases: a null or number-less article cell and a null or blank text tie nothing; a record without
any entity is its own group; repeated rows of a record give one row; null labels are a label of their own;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from correlia.operators.components import propagate
from correlia.operators.group_splits import PROPORTIONS, assign_splits, balance

__all__ = ["PROPORTIONS", "article_numbers", "assign_splits", "balance", "connected_groups", "record_entities", "text_key"]

#: Fixed value: the entity marks of the example sentences.
MARKS = r"(?i)[<\[]\s*/?\s*e[12]\s*[>\]]"


def article_numbers(cell) -> F.Column:
    """All article numbers of a cell, without prefix, leading zeros, decimal part or exponent, each once."""
    ascii_digits = F.translate(cell, "０１２３４５６７８９", "0123456789")
    found = F.regexp_extract_all(ascii_digits, F.lit(r"(\d+(?:\.\d+)?(?:[eE]\+?\d+)?)"), 1)

    def number(x):
        plain = F.regexp_replace(F.regexp_replace(x, r"\.\d*$", ""), "^0+", "")
        return F.when(x.rlike("[eE]"), x.cast("double").cast("decimal(38,0)").cast("string")).otherwise(plain)

    whole = F.filter(F.transform(found, number), lambda x: x.isNotNull() & ~x.isin("", "0"))
    return F.coalesce(F.array_distinct(whole), F.array().cast("array<string>"))


def text_key(text) -> F.Column:
    """Digest of the text without marks and white space; null if nothing is left."""
    bare = F.regexp_replace(F.regexp_replace(text, MARKS, ""), r"(?U)[\s​⁠﻿]+", "")
    return F.when(F.length(bare) > 0, F.md5(bare.cast("binary")))


def record_entities(df: DataFrame, id_col: str = "ejemplo_id", article: str = "pmid", text: str = "text") -> DataFrame:
    """Edges (node, ent) of the bipartite graph."""
    keys = F.array_union(
        F.transform(article_numbers(F.col(article)), lambda x: F.concat(F.lit("a"), x)),
        F.when(text_key(F.col(text)).isNotNull(), F.array(F.concat(F.lit("t"), text_key(F.col(text))))).otherwise(F.array().cast("array<string>")),
    )
    return df.select(F.col(id_col).alias("node"), F.explode(keys).alias("ent"))


def connected_groups(df: DataFrame, id_col: str = "ejemplo_id", article: str = "pmid", text: str = "text") -> DataFrame:
    """Every record with the smallest record id of its group: (id_col, grupo_id)."""
    labels = propagate(record_entities(df, id_col, article, text)).select(F.col("node").alias(id_col), F.col("label").alias("grupo_id"))
    ids = df.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    return ids.join(labels, id_col, "left").select(id_col, F.coalesce("grupo_id", id_col).alias("grupo_id"))
