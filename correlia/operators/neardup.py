"""Near duplicates across two sets by contained n-grams, and leak checks of a split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from correlia.functions.text import canonical, word_groups
from correlia.runtime import lookup_join

#: Words of an n-gram and share of the shorter text's n-grams that must be shared.
WORDS, SHARE = 5, 0.8


def ngrams(df: DataFrame, id_col: str, text: str, n: int = WORDS) -> DataFrame:
    """(id, gram) distinct hashed n-grams; a text of fewer words is one gram, one without words has none."""
    words = df.select(F.col(id_col).alias("id"), F.split(canonical(F.col(text)), " ").alias("__w"))
    grams = F.when(F.col("__w")[0] != "", F.array_distinct(word_groups(F.col("__w"), n)))
    # For an inner explode Spark would put a filter before it that makes all n-grams a second time.
    return words.select("id", F.explode_outer(grams).alias("gram")).where("gram is not null")


def contained(left: DataFrame, right: DataFrame, share: float = SHARE) -> DataFrame:
    """(a, b, comunes, parte): classes of equal n-gram sets linked if `share` of the smaller set's n-grams are common; `left`, `right`: (id, gram).

    A link needs at least (1 - share) of the smaller set's rarest n-grams plus one to meet, so only that prefix of the
    smaller set is joined. Rare means rare on the other side: n-grams that are not there at all come first and need no join.
    Equal sets are one class, its smallest id. Spark takes exploded n-grams for a fraction of their size and would broadcast
    them through the driver, so all joins are merge joins.
    """
    def classes(side: DataFrame, of_a: bool) -> DataFrame:
        sets = side.groupBy("id").agg(F.sort_array(F.collect_set("gram")).alias("grams"))
        return sets.groupBy("grams").agg(F.min("id").alias("id")).select(F.lit(of_a).alias("of_a"), "id", F.size("grams").alias("n"), F.explode("grams").alias("gram"))

    every = classes(left, True).unionByName(classes(right, False))
    there = lambda of_a: F.count_if(F.col("of_a") == of_a).over(W.partitionBy("gram"))
    met = every.withColumn("f", F.when(F.col("of_a"), there(False)).otherwise(there(True))).where("f > 0")
    sets = met.groupBy("of_a", "id", "n").agg(F.sort_array(F.collect_list(F.struct("f", "gram"))).alias("g"))
    # The smaller set of a pair lies among the larger one's with at most n - ceil(share * n) grams missing, those not met among them.
    keep = (F.size("g") - F.ceil(F.col("n") * share) + 1).cast("int")
    prefix = sets.where(keep > 0).select("of_a", "id", "n", F.explode(F.slice("g", 1, keep)["gram"]).alias("gram"))
    s, l = prefix.alias("s"), met.hint("merge").alias("l")  # noqa: E741
    larger = (F.col("l.n") > F.col("s.n")) | ((F.col("l.n") == F.col("s.n")) & F.col("s.of_a"))
    pairs = s.join(l, (F.col("s.gram") == F.col("l.gram")) & (F.col("s.of_a") != F.col("l.of_a")) & larger)
    pairs = pairs.select("s.of_a", F.col("s.id").alias("small"), F.col("s.n").alias("n"), F.col("l.of_a").alias("of_a2"), F.col("l.id").alias("large"), F.col("l.n").alias("n2")).distinct()
    of = lambda key, id_col, n, name: sets.select(F.col("of_a").alias(key), F.col("id").alias(id_col), F.col("n").alias(n), F.col("g.gram").alias(name)).hint("merge")
    full = pairs.join(of("of_a", "small", "n", "x"), ["of_a", "small", "n"]).join(of("of_a2", "large", "n2", "y"), ["of_a2", "large", "n2"])
    common = F.size(F.array_intersect("x", "y"))
    a, b = F.when(F.col("of_a"), F.col("small")).otherwise(F.col("large")), F.when(F.col("of_a"), F.col("large")).otherwise(F.col("small"))
    return full.select(a.alias("a"), b.alias("b"), common.alias("comunes"), F.round(common / F.col("n"), 6).alias("parte")).where(common >= share * F.col("n"))


def membership(side: DataFrame) -> DataFrame:
    """(id, clase) of every id of `side` (id, gram): the smallest id with the same n-grams, by which `contained` names the class."""
    key = F.sha2(F.concat_ws(" ", F.transform(F.sort_array(F.collect_set("gram")), lambda x: x.cast("string"))), 256)
    sets = side.groupBy("id").agg(key.alias("__key"))
    return lookup_join(sets, sets.groupBy("__key").agg(F.min("id").alias("clase")), "__key").select("id", "clase")


def shared_keys(rows: DataFrame, key: F.Column, split: str) -> DataFrame:
    """Keys that stand in more than one split, with their rows per split: a leak-free split has none."""
    return rows.select(key.alias("clave"), F.col(split).alias("particion")).where("clave is not null").groupBy("clave").agg(F.count_distinct("particion").alias("n_particiones"), F.count(F.lit(1)).alias("n")).where("n_particiones > 1")
