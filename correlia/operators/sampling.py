"""Reproducible sampling and grouping: order by a seeded hash, which any engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def hash_order(seed: str, *cols: str) -> Column:
    """SHA-256 of seed and columns joined by |; nulls count as empty."""
    return F.sha2(F.concat_ws("|", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]), 256)


def ranked(df: DataFrame, block: Column, order: list, rank: str) -> DataFrame:
    """Rows with their place from 1 in order of block and `order`. Only a block is sorted in one task; equal rows of `order` fall in one block."""
    rows = df.withColumn("__b", block)
    sizes = rows.groupBy("__b").agg(F.count(F.lit(1)).alias("__m"))
    before = sizes.select("__b", (F.sum("__m").over(W.orderBy("__b").rowsBetween(W.unboundedPreceding, 0)) - F.col("__m")).alias("__before"))
    within = rows.withColumn("__r", F.row_number().over(W.partitionBy("__b").orderBy(*order)))
    return within.join(before, within["__b"].eqNullSafe(before["__b"])).withColumn(rank, F.col("__before") + F.col("__r")).drop("__b", "__before", "__r")


def lowest_by_hash(df: DataFrame, group: list[str], k: int, seed: str, *cols: str) -> DataFrame:
    """k rows of each group with the lowest hash; equal hashes go by the columns."""
    ranked = df.withColumn("__h", hash_order(seed, *cols))
    w = W.partitionBy(*group).orderBy("__h", *cols)
    return ranked.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= k).drop("__h", "__k")


def distinct_articles(df: DataFrame, edge: list[str], article: str, order: list[Column], k: int = 3) -> DataFrame:
    """Up to k evidences per edge, each from another article: the best of each article first."""
    one = df.withColumn("__r", F.row_number().over(W.partitionBy(*edge, article).orderBy(*order))).where("__r = 1").drop("__r")
    return one.withColumn("__k", F.row_number().over(W.partitionBy(*edge).orderBy(*order))).where(F.col("__k") <= k).drop("__k")


def keep_lowest(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Of rows with the same key only those of its lowest `order`; rows without key stay."""
    keyed = df.withColumn("__key", key)
    low = keyed.where("__key is not null").groupBy("__key").agg(F.min(order).alias("__low"))
    return keyed.join(low, "__key", "left").where(F.col("__low").isNull() | (F.col(order) == F.col("__low"))).drop("__key", "__low")


def eligible_negatives(candidates: DataFrame, positives: DataFrame, curated: DataFrame, article: str, pair: list[str]) -> DataFrame:
    """Pairs from articles with positives that are curated in neither direction."""
    a, b = pair
    both = curated.select(a, b).unionByName(curated.select(F.col(b).alias(a), F.col(a).alias(b))).distinct()
    return candidates.where(F.col(a) != F.col(b)).join(positives.select(article).distinct(), article, "left_semi").join(both, pair, "left_anti")


def balanced_negatives(candidates: DataFrame, positives: DataFrame, curated: DataFrame, article: str, pair: list[str], seed: str, id_col: str, share: float = 1.0) -> DataFrame:
    """`share` times as many negatives by hash as there are positives, or all if there are fewer."""
    pool = eligible_negatives(candidates, positives, curated, article, pair).withColumn("__h", hash_order(seed, article, id_col))
    k = positives.agg(F.rint(F.count(F.lit(1)) * share).cast("long").alias("__n"))
    return ranked(pool, F.substring("__h", 1, 3), ["__h", id_col], "__k").crossJoin(F.broadcast(k)).where("__k <= __n").drop("__h", "__k", "__n")


def negatives(candidates: DataFrame, positives: DataFrame, curated: DataFrame, article: str, pair: list[str], k: int, seed: str, id_col: str) -> DataFrame:
    """k negatives from articles with positives: pairs that are curated in neither direction, by hash."""
    pool = eligible_negatives(candidates, positives, curated, article, pair)
    return pool.withColumn("__h", hash_order(seed, article, id_col)).orderBy("__h", id_col).limit(k).drop("__h")


def consistent_labels(df: DataFrame, key: list[str], label: str) -> DataFrame:
    """One row per key that carries a single label; keys with two are dropped."""
    g = df.where(F.col(label).isNotNull()).groupBy(*key).agg(F.count_distinct(label).alias("__n"), F.min(label).alias(label), F.count(F.lit(1)).alias("copias"))
    return g.where("__n = 1").drop("__n")


def group_folds(df: DataFrame, group: str, label: str, k: int, seed: str = "0") -> DataFrame:
    """(group, pliegue, n): folds 0 to k - 1 of whole groups with like sizes; every group is in one fold.

    Groups of one label profile are dealt round the folds in order of hash, started at a place the profile's hash
    gives. The rank is taken within (profile, block) and offset by the blocks before.
    """
    blocks = 64
    per = df.where(F.col(group).isNotNull()).groupBy(group, label).agg(F.count(F.lit(1)).alias("c")).groupBy(group).agg(F.sum("c").alias("n"), F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(label, F.lit("(nulo)")), "c"))))).alias("perfil"))
    per = per.withColumn("bloque", F.pmod(F.xxhash64(F.lit(seed), group), F.lit(blocks)))
    offsets = per.groupBy("perfil", "bloque").agg(F.count(F.lit(1)).alias("m"))
    offsets = offsets.select("perfil", "bloque", (F.sum("m").over(W.partitionBy("perfil").orderBy("bloque")) - F.col("m")).alias("antes"))
    ranked = per.withColumn("r", F.row_number().over(W.partitionBy("perfil", "bloque").orderBy(F.xxhash64(F.lit(seed), F.lit(1), group), group)))
    fold = F.pmod(F.col("antes") + F.col("r") + F.pmod(F.xxhash64(F.lit(seed), "perfil"), F.lit(k)), F.lit(k))
    return ranked.join(offsets, ["perfil", "bloque"]).select(group, fold.cast("int").alias("pliegue"), "n")
