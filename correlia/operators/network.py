"""From scored evidence to a signed, directed network: thresholds, deduplication, caps, votes, expansion, nodes.

Evidence rows: id, tf, target, oracion, pmid, seccion, n, pred, and one probability column per class. A null key or
prediction takes a row out (counted as such). Every tie is ordered, so plans give the same result on any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CLASSES = ["activates", "no_relation", "regulates", "represses"]
THRESHOLDS = {"activates": 0.65, "represses": 0.70, "regulates": 0.60}
MAJORITY, CAP = 0.66, 200


def p_of(pred: str = "pred") -> Column:
    """Probability of the predicted class."""
    out = F.lit(None).cast("double")
    for c in CLASSES:
        out = F.when(F.col(pred) == c, F.col(f"p_{c}")).otherwise(out)
    return out


def invalid_distribution() -> Column:
    """First rule a row's probabilities break, else null."""
    ps = [F.col(f"p_{c}") for c in CLASSES]
    total = sum(ps[1:], ps[0])
    bad = F.lit(False)
    for p in ps:
        bad = bad | p.isNull() | F.isnan(p) | (p < 0) | (p > 1)
    return F.when(bad, "fuera_de_rango").when(F.abs(total - 1) > 1e-3, "suma").when(~F.col("pred").isin(*CLASSES) | F.col("pred").isNull(), "clase").when(F.greatest(*ps) - p_of() > 1e-6, "no_es_maximo")


def exclusion_reason(thresholds: dict[str, float] | None = None, captions: bool = True, introduction: bool = True, self_regulation: bool = False) -> Column:
    """Why a row is left out, the first reason that holds; null if it stays."""
    t = thresholds or THRESHOLDS
    limit = F.lit(None).cast("double")
    for c, x in t.items():
        limit = F.when(F.col("pred") == c, x).otherwise(limit)
    out = F.when(F.col("tf").isNull() | F.col("target").isNull() | F.col("pred").isNull(), "nulo")
    if captions:
        out = out.when(F.col("seccion") == "leyenda", "leyenda")
    if introduction:
        out = out.when(F.col("seccion") == "introduccion", "introduccion")
    if not self_regulation:
        out = out.when(F.col("tf") == F.col("target"), "autorregulacion")
    return out.when(F.col("pred") == "no_relation", "sin_relacion").when(F.coalesce(p_of() < limit, F.lit(True)), "umbral")


def deduplicate(rows: DataFrame) -> DataFrame:
    """One row per (tf, target, sentence): the likeliest copy, with the number of copies and their articles.

    The copies are reduced by partial aggregates; the set of articles of a sentence stays a set.
    """
    key = F.regexp_replace(F.regexp_replace("oracion", r"(?U)\s+", " "), "^ | $", "")
    best = F.min(F.struct((-p_of()).alias("p"), "pmid", "seccion", "n", "id", "pred", *[f"p_{c}" for c in CLASSES])).alias("b")
    out = rows.withColumn("clave", key).groupBy("tf", "target", "clave").agg(best, F.count(F.lit(1)).alias("copias"), F.array_sort(F.collect_set("pmid")).alias("pmids"))
    return out.select("tf", "target", F.col("clave").alias("oracion"), "b.id", "b.pmid", "b.seccion", "b.n", "b.pred", *[f"b.p_{c}" for c in CLASSES], "copias", "pmids")


def cap(rows: DataFrame, k: int = CAP) -> DataFrame:
    """At most k evidences per pair, in order of article, section, number and id."""
    w = W.partitionBy("tf", "target").orderBy("pmid", "seccion", "n", "id")
    return rows.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= k).drop("__k")


def vote(plus: Column, minus: Column, majority: float = MAJORITY) -> Column:
    """struct(sign, conflict) of the counts of signed votes."""
    total = plus + minus
    share = F.greatest(plus, minus) / F.nullif(total, F.lit(0))
    won = F.when(plus > minus, "activates").otherwise("represses")
    return F.when(total == 0, F.struct(F.lit("regulates").alias("sign"), F.lit(False).alias("conflict"))).when(plus == minus, F.struct(F.lit("regulates").alias("sign"), F.lit(True).alias("conflict"))).when(
        share >= majority, F.struct(won.alias("sign"), F.lit(False).alias("conflict"))
    ).otherwise(F.struct(F.lit("regulates").alias("sign"), F.lit(True).alias("conflict")))


def edges(evidence: DataFrame, majority: float = MAJORITY) -> DataFrame:
    """One row per pair in one aggregation: votes, sign, conflict, mean probability of the winning votes, articles."""
    n = lambda c: F.count_if(F.col("pred") == c)
    s = lambda c: F.sum(F.when(F.col("pred") == c, F.col(f"p_{c}")))
    out = evidence.groupBy("tf", "target").agg(
        F.count(F.lit(1)).alias("n_evidencias"), *[n(c).alias(f"n_{c}") for c in CLASSES if c != "no_relation"], *[s(c).alias(f"s_{c}") for c in CLASSES if c != "no_relation"],
        F.size(F.array_distinct(F.flatten(F.collect_set("pmids")))).alias("n_articulos"), F.count_distinct("seccion").alias("n_secciones"),
    )
    out = out.withColumn("v", vote(F.col("n_activates"), F.col("n_represses"), majority)).select("*", "v.sign", "v.conflict").drop("v")
    pick = lambda p: F.when(F.col("sign") == "activates", F.col(f"{p}_activates")).when(F.col("sign") == "represses", F.col(f"{p}_represses")).otherwise(F.col(f"{p}_regulates"))
    trust = F.when(pick("n") > 0, F.round(pick("s") / pick("n"), 4))
    return out.select("tf", "target", "sign", "conflict", "n_evidencias", "n_activates", "n_represses", "n_regulates", "n_articulos", "n_secciones", trust.alias("confianza"))


def sensitivity(rows: DataFrame, thresholds: list[float]) -> DataFrame:
    """Edges and evidences at each threshold. The thresholds are given values, so each row is repeated len(thresholds) times at most."""
    grid = rows.withColumn("umbral", F.explode(F.array(*map(F.lit, thresholds)))).where((F.col("pred") != "no_relation") & (p_of() >= F.col("umbral")))
    per_edge = grid.groupBy("umbral", "tf", "target").agg(F.count_distinct("oracion").alias("n"))
    return per_edge.groupBy("umbral").agg(F.count(F.lit(1)).alias("n_aristas"), F.sum("n").alias("n_evidencias"))


def article_votes(evidence: DataFrame, majority: float = MAJORITY) -> DataFrame:
    """Sign by article, for pairs with votes of both signs: every article votes once, empty or split ones abstain."""
    per = evidence.groupBy("tf", "target", "pmid").agg(F.count_if(F.col("pred") == "activates").alias("a"), F.count_if(F.col("pred") == "represses").alias("r"))
    per = per.withColumn("v", vote(F.col("a"), F.col("r"), majority))
    both = per.groupBy("tf", "target").agg(F.sum("a").alias("a"), F.sum("r").alias("r"), F.count_if(F.col("v.sign") == "activates").alias("va"), F.count_if(F.col("v.sign") == "represses").alias("vr")).where("a > 0 and r > 0")
    return both.withColumn("v", vote(F.col("va"), F.col("vr"), majority)).select("tf", "target", F.col("va").alias("articulos_mas"), F.col("vr").alias("articulos_menos"), F.col("v.sign").alias("signo"), (F.col("v.conflict") | (F.col("va") + F.col("vr") == 0)).alias("conflicto"))


def expand_groups(edge: DataFrame, members: DataFrame) -> DataFrame:
    """Edges plus, for each edge whose target is a group (grupo, miembro), one per member other than the regulator."""
    more = edge.join(members.withColumnRenamed("grupo", "target"), "target").where(F.lower("miembro") != F.lower("tf"))
    cols = [c for c in edge.columns if c != "target"]
    own = edge.select(*cols, "target", F.lit("").alias("expandida_de"))
    return own.unionByName(more.select(*cols, F.col("miembro").alias("target"), F.col("target").alias("expandida_de")))


def symmetric(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs in both directions, each once."""
    return pairs.select(a, b).unionByName(pairs.select(F.col(b).alias(a), F.col(a).alias(b))).distinct()


def new_pairs(candidates: DataFrame, known: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs that are known in neither direction."""
    return candidates.join(symmetric(known, a, b), [a, b], "left_anti")


def directions(gold: DataFrame, found: DataFrame, a: str, b: str) -> DataFrame:
    """Every gold pair as `directa`, `inversa` (only the reverse is found) or `ninguna`."""
    f = found.select(a, b).distinct()
    d = f.withColumn("__d", F.lit(True))
    i = f.select(F.col(b).alias(a), F.col(a).alias(b)).withColumn("__i", F.lit(True))
    return gold.join(d, [a, b], "left").join(i, [a, b], "left").withColumn("sentido", F.when(F.col("__d"), "directa").when(F.col("__i"), "inversa").otherwise("ninguna")).drop("__d", "__i")


def degrees(edge: DataFrame) -> DataFrame:
    """(nodo, sale, entra) of every node."""
    ends = edge.select(F.col("tf").alias("nodo"), F.lit(1).alias("s"), F.lit(0).alias("e")).unionByName(edge.select(F.col("target").alias("nodo"), F.lit(0).alias("s"), F.lit(1).alias("e")))
    return ends.groupBy("nodo").agg(F.sum("s").alias("sale"), F.sum("e").alias("entra"))


def unify(nodes: DataFrame) -> DataFrame:
    """(id, representante): ids that share a locus become one; a name before the locus itself, then the smaller."""
    best = nodes.where("locus is not null").groupBy("locus").agg(F.min(F.struct((F.col("id") == F.col("locus")).alias("own"), "id")).alias("b"))
    return nodes.join(best, "locus", "left").select("id", F.coalesce("b.id", "id").alias("representante")).distinct()


def collisions(nodes: DataFrame) -> DataFrame:
    """Ids that stand for more than one locus."""
    return nodes.where("id is not null and locus is not null").groupBy("id").agg(F.count_distinct("locus").alias("n")).where("n > 1")
