"""Sentences, mentions and candidate pairs: dictionary joins, nearest occurrences, context and scores.

Null ids, units or offsets are dropped where they are the key. Ties go to the earlier offset, then the smaller
id, so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from correlia.operators.ingest import one_per_key

#: Shares of the ordering score.
SCORE = {"between": 0.40, "any": 0.20, "one_regulator": 0.20, "evidence": 0.15, "near": 0.15}


def tokens(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """(keep, pos, token): ASCII letter-and-digit words of a text with their order."""
    return df.select(*keep, F.posexplode(F.regexp_extract_all(text, F.lit(r"([A-Za-z][A-Za-z0-9]+)"), 1)).alias("pos", "token"))


def lexicon(surfaces: DataFrame) -> DataFrame:
    """(surface, folded, id, ambiguous, ambiguous_folded) of a dictionary (surface, id): a surface of two ids resolves to none."""
    base = surfaces.where("surface is not null and id is not null").distinct().withColumn("folded", F.lower("surface"))
    exact = base.groupBy("surface").agg(F.count_distinct("id").alias("n"), F.min("id").alias("id")).select("surface", F.when(F.col("n") == 1, F.col("id")).alias("id"), (F.col("n") > 1).alias("ambiguous"))
    return exact


def resolve(toks: DataFrame, surfaces: DataFrame) -> DataFrame:
    """Tokens with the id the dictionary gives: exact before folded; an ambiguous form stops without an id.

    Joined by plain equi-joins: Catalyst broadcasts the dictionary where it is below the session's size limit.
    """
    clean = surfaces.where("surface is not null and id is not null").distinct()
    exact = clean.groupBy(F.col("surface").alias("token")).agg(F.count_distinct("id").alias("n"), F.min("id").alias("exact"))
    folded = clean.groupBy(F.lower("surface").alias("low")).agg(F.count_distinct("id").alias("m"), F.min("id").alias("fold"))
    joined = toks.join(exact, "token", "left").withColumn("low", F.lower("token")).join(folded, "low", "left")
    found = F.when(F.col("n") == 1, F.col("exact")).when(F.col("n") > 1, None).when(F.col("m") == 1, F.col("fold"))
    return joined.withColumn("id", found).drop("low", "n", "exact", "m", "fold").where("id is not null")


def nearest_pairs(regulators: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per (unit, regulator, target): the occurrences with the least gap, ties by regulator's then target's place.

    Both tables: (unit, id, ini, fin). A pair of one id needs two occurrences. The join is on the unit only; a
    unit is one sentence, and only the best pair of each is kept by a partial aggregate.
    """
    r = regulators.select("unit", F.col("id").alias("tf"), F.col("ini").alias("r_ini"), F.col("fin").alias("r_fin"))
    t = targets.select("unit", F.col("id").alias("target"), F.col("ini").alias("t_ini"), F.col("fin").alias("t_fin"))
    pairs = r.join(t, "unit").where("not (r_ini = t_ini and r_fin = t_fin)")
    gap = F.greatest("r_ini", "t_ini") - F.least("r_fin", "t_fin")
    best = F.min(F.struct(gap.alias("gap"), "r_ini", "t_ini", "r_fin", "t_fin")).alias("b")
    return pairs.groupBy("unit", "tf", "target").agg(best).select("unit", "tf", "target", "b.gap", "b.r_ini", "b.r_fin", "b.t_ini", "b.t_fin")


def pair_summary(pairs: DataFrame) -> DataFrame:
    """Per directed pair (tf, target): sentences, documents, best score and the distinct signs in order."""
    return pairs.groupBy("tf", "target").agg(
        F.count(F.lit(1)).alias("n_oraciones"), F.count_distinct("pmid").alias("n_documentos"), F.max("score").alias("mejor"), F.array_join(F.array_sort(F.collect_set("sign")), ";").alias("signos")
    )


def context(units: DataFrame, group: list[str], order: str, text: str) -> DataFrame:
    """Text of the units before and after in the same document; null across a gap in the numbering."""
    w = W.partitionBy(*group).orderBy(order, "id")
    before = F.when(F.lag(order).over(w) == F.col(order) - 1, F.lag(text).over(w))
    after = F.when(F.lead(order).over(w) == F.col(order) + 1, F.lead(text).over(w))
    return units.select("*", before.alias("anterior"), after.alias("siguiente"))


def renumber(units: DataFrame, group: list[str], order: list[str], name: str = "numero") -> DataFrame:
    """0-based number of a unit within its document."""
    return units.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*order)) - 1)


def mention_lists(candidates: DataFrame, mentions: DataFrame, unit: str) -> DataFrame:
    """Mentions of candidate units only, as one sorted list per unit."""
    needed = mentions.join(candidates.select(unit).distinct(), unit, "left_semi")
    return needed.groupBy(unit).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset_ini", "id"))), lambda x: x["id"].cast("string")), ",").alias("ids"))


def nearest_sign(triggers: DataFrame, spans: DataFrame) -> DataFrame:
    """(unit, sign) of the signed trigger nearest to the span [ini, fin) of a unit; inside counts 0, ties to the first in the text."""
    j = spans.join(triggers.where("sign in ('+', '-')").select("unit", F.col("ini").alias("t_ini"), F.col("fin").alias("t_fin"), "sign"), "unit")
    dist = F.when((F.col("t_ini") >= F.col("ini")) & (F.col("t_fin") <= F.col("fin")), 0).otherwise(F.least(F.abs(F.col("t_ini") - F.col("fin")), F.abs(F.col("ini") - F.col("t_fin"))))
    return j.groupBy("unit").agg(F.min(F.struct(dist.alias("d"), "t_ini", "sign")).alias("b")).select("unit", F.col("b.d").alias("distancia"), F.col("b.sign").alias("sign"))


def ordering_score(between: str, triggers: str, regulators: str, evidence: str, inner: str) -> F.Column:
    """Score of a candidate from counts: triggers between the mentions, triggers, regulators, evidence words, genes between."""
    c = F.col
    s = (
        F.when(c(between) > 0, SCORE["between"]).when(c(triggers) > 0, SCORE["any"]).otherwise(0.0)
        + F.when(c(regulators) == 1, SCORE["one_regulator"]).otherwise(0.0)
        + F.when(c(evidence) >= 1, SCORE["evidence"]).otherwise(0.0)
        + SCORE["near"] * (1 - F.least(c(inner), F.lit(5)) / 5)
    )
    return F.round(F.least(s, F.lit(1.0)), 3)


def candidate_sentences(units: DataFrame, mentions: DataFrame, regulators: DataFrame, least: int = 40, most: int = 700, entities: tuple[int, int] = (2, 8)) -> DataFrame:
    """Units that qualify as candidates: length, section, number of distinct entities; with the regulator if it is the only one and the target if it is the only other."""
    genes = mentions.select(F.col("unidad_id").alias("id"), F.col("entidad")).where("entidad is not null").distinct()
    marked = genes.join(regulators.select(F.col("entidad")).distinct().withColumn("tf", F.lit(True)), "entidad", "left")
    sets = marked.groupBy("id").agg(F.count(F.lit(1)).alias("n_entidades"), F.count_if("tf").alias("n_tf"), F.min(F.when(F.col("tf"), F.col("entidad"))).alias("un_tf"), F.min(F.when(F.col("tf").isNull(), F.col("entidad"))).alias("otra"))
    kept = units.where(F.length("texto").between(least, most)).join(sets.where(F.col("n_entidades").between(*entities)), "id")
    one = F.col("n_tf") == 1
    return kept.select("id", "n_entidades", "n_tf", F.when(one, F.col("un_tf")).alias("regulador"), F.when(one & (F.col("n_entidades") == 2), F.col("otra")).alias("blanco"))


def capped_sentences(rows: DataFrame, group: list[str], sentence: str, order: str, k: int) -> DataFrame:
    """All rows of the first k distinct sentences of each group, in order of first appearance."""
    first = rows.groupBy(*group, sentence).agg(F.min(order).alias("__first"))
    ranked = first.withColumn("__rank", F.row_number().over(W.partitionBy(*group).orderBy("__first", sentence))).where(F.col("__rank") <= k)
    return rows.join(ranked.select(*group, sentence), [*group, sentence], "left_semi")


def first_mentions(mentions: DataFrame) -> DataFrame:
    """First mention of each entity of a unit."""
    return one_per_key(mentions, ["unidad_id", "id_normalizado"], [F.col("offset_ini"), F.col("id")], last=False)
