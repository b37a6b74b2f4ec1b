"""Agreement, classification, interval and voting statistics as plans.

Ties follow a fixed class order, ratios are rounded once at the end, and a ratio without denominator is null.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

Z95 = 1.959963984540054


def ratio(a: Column, b: Column, digits: int = 6) -> Column:
    return F.round(F.when(b != 0, a / b), digits)


def wilson(hits: Column, n: Column, low: bool, digits: int = 6) -> Column:
    """Bound of the 95 % Wilson interval; null for n = 0."""
    p, z2 = hits / n, Z95 * Z95
    half = Z95 * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    mid = p + z2 / (2 * n)
    return F.round(F.when(n > 0, (mid - half if low else mid + half) / (1 + z2 / n)), digits)


def confusion(df: DataFrame, truth: str, guess: str) -> DataFrame:
    return df.where(F.col(truth).isNotNull()).groupBy(truth, guess).agg(F.count(F.lit(1)).alias("n"))


def per_class(df: DataFrame, truth: str, guess: str, classes: list[str]) -> DataFrame:
    """(clase, aciertos, n_real, n_dicho, precision, recall, f1): a guess outside the classes is an error."""
    rows = df.where(F.col(truth).isin(*classes))
    # Each row counts for its true and for its guessed class; one aggregation for all classes.
    side = F.explode(F.array_distinct(F.array(F.col(truth), F.when(F.col(guess).isin(*classes), F.col(guess)).otherwise(F.col(truth)))))
    g = rows.withColumn("clase", side).groupBy("clase").agg(
        F.count_if((F.col("clase") == F.col(truth)) & (F.col(guess).eqNullSafe(F.col("clase")))).alias("aciertos"), F.count_if(F.col("clase") == F.col(truth)).alias("n_real"), F.count_if(F.col(guess).eqNullSafe(F.col("clase"))).alias("n_dicho")
    )
    return g.select("clase", "aciertos", "n_real", "n_dicho", ratio(F.col("aciertos"), F.col("n_dicho")).alias("precision"), ratio(F.col("aciertos"), F.col("n_real")).alias("recall"), ratio(2 * F.col("aciertos"), F.col("n_real") + F.col("n_dicho")).alias("f1"))


def macro_f1(df: DataFrame, truth: str, guess: str, classes: list[str]) -> DataFrame:
    by = per_class(df, truth, guess, classes)
    return by.agg(F.round(F.sum(F.coalesce(2 * F.col("aciertos") / (F.col("n_real") + F.col("n_dicho")), F.lit(0.0))) / len(classes), 6).alias("macro_f1"), F.round(F.sum("aciertos") / F.sum("n_real"), 6).alias("exactitud"))


def kappa(df: DataFrame, group: list[str], a: str, b: str) -> DataFrame:
    """Cohen's kappa of two labels per group: (group, n, observado, esperado, kappa); null where chance agreement is 1."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*group, a, b).agg(F.count(F.lit(1)).alias("c"))
    left = cells.groupBy(*group, F.col(a).alias("k")).agg(F.sum("c").alias("x"))
    right = cells.groupBy(*group, F.col(b).alias("k")).agg(F.sum("c").alias("y"))
    chance = left.join(right, [*group, "k"]).groupBy(*group).agg(F.sum(F.col("x").cast("double") * F.col("y")).alias("xy"))
    total = cells.groupBy(*group).agg(F.sum("c").alias("n"), F.sum(F.when(F.col(a) == F.col(b), F.col("c")).otherwise(0)).alias("same"))
    j = total.join(chance, group, "left") if group else total.crossJoin(chance)
    po, pe = F.col("same") / F.col("n"), F.coalesce("xy", F.lit(0.0)) / (F.col("n").cast("double") * F.col("n"))
    return j.select(*group, "n", F.round(po, 6).alias("observado"), F.round(pe, 6).alias("esperado"), F.round(F.when(pe < 1, (po - pe) / (1 - pe)), 4).alias("kappa"))


def modal_label(df: DataFrame, key: list[str], label: str, order: list[str]) -> DataFrame:
    """Commonest label of each key; ties go to the class named first in `order`."""
    rank = F.lit(len(order))
    for i, c in enumerate(order):
        rank = F.when(F.col(label) == c, i).otherwise(rank)
    counts = df.where(F.col(label).isNotNull()).groupBy(*key, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*key).agg(F.max_by(label, F.struct("n", (-rank).alias("o"))).alias("moda"), F.sum("n").alias("total"), F.max("n").alias("n"))


def best_threshold(df: DataFrame, positive: Column, score: str) -> DataFrame:
    """(umbral, precision, recall, f1) of the best F1 with score >= threshold; equal scores stand or fall together, ties to the lowest."""
    by = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("umbral")).agg(F.count(F.lit(1)).alias("n"), F.count_if(positive).alias("tp"))
    # One row per distinct score goes through the window.
    w = W.orderBy(F.desc("umbral")).rowsBetween(W.unboundedPreceding, 0)
    cum = by.select("umbral", F.sum("n").over(w).alias("n"), F.sum("tp").over(w).alias("tp"))
    total = by.agg(F.sum("tp").alias("p"))
    scored = cum.crossJoin(F.broadcast(total)).withColumn("f1", 2 * F.col("tp") / (F.col("n") + F.col("p")))
    best = scored.agg(F.max_by(F.struct("umbral", "n", "tp", "p", "f1"), F.struct(F.round("f1", 12), -F.col("umbral"))).alias("b")).select("b.*")
    return best.select("umbral", ratio(F.col("tp"), F.col("n")).alias("precision"), ratio(F.col("tp"), F.col("p")).alias("recall"), F.round("f1", 6).alias("f1"))


@F.pandas_udf(T.DoubleType())
def binomial_tail(hits: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    """P(X >= hits) for X binomial(n, p), summed in logarithms so that no n is too large; null for null input."""

    def tail(k: float, m: float, q: float) -> float | None:
        if pd.isna(k) or pd.isna(m) or pd.isna(q):
            return None
        k, m = max(0, int(k)), int(m)
        if k == 0 or q >= 1:
            return 1.0 if k <= m else 0.0
        if k > m or q <= 0:
            return 0.0
        first = math.lgamma(m + 1) - math.lgamma(k + 1) - math.lgamma(m - k + 1) + k * math.log(q) + (m - k) * math.log1p(-q)
        i = np.arange(k, m)
        steps = np.concatenate([[0.0], np.cumsum(np.log(m - i) - np.log(i + 1.0) + math.log(q) - math.log1p(-q))])
        top = float(steps.max())
        return min(1.0, math.exp(first + top) * float(np.exp(steps - top).sum()))

    return pd.Series([tail(*x) for x in zip(hits, n, p)], dtype="float64")


def stratified_precision(df: DataFrame, stratum: str, hit: Column, sizes: DataFrame) -> DataFrame:
    """Precision weighted by the strata's sizes (stratum, total), with the finite-population standard error; one row."""
    s = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"), F.avg(hit.cast("double")).alias("p")).join(sizes, stratum)
    weight = F.col("total") / F.sum("total").over(W.partitionBy())
    s = s.withColumn("w", weight)
    var = F.when(F.col("n") > 1, F.col("w") ** 2 * (1 - F.col("n") / F.col("total")) * F.col("p") * (1 - F.col("p")) / (F.col("n") - 1)).otherwise(0.0)
    return s.agg(F.sum("n").alias("n"), F.round(F.sum(F.col("w") * F.col("p")), 6).alias("precision"), F.round(F.sqrt(F.sum(var)), 6).alias("error"))


def jury(votes: DataFrame, item: str, answer: str, k: int) -> DataFrame:
    """Verdict per item: yes from at least k; else doubtful if doubts outnumber the noes; else no; `vacio` if nobody answered."""
    g = votes.groupBy(item).agg(F.count_if(F.col(answer) == "si").alias("si"), F.count_if(F.col(answer) == "no").alias("no"), F.count_if(F.col(answer) == "dudoso").alias("dudoso"))
    verdict = F.when(F.col("si") + F.col("no") + F.col("dudoso") == 0, "vacio").when(F.col("si") >= k, "si").when(F.col("dudoso") > F.col("no"), "dudoso").otherwise("no")
    return g.withColumn("veredicto", verdict)


def jury_sweep(votes: DataFrame, item: str, answer: str, gold: DataFrame, ks: list[int]) -> DataFrame:
    """Agreement with the settled label (item, gold) for each k."""
    g = jury(votes, item, answer, 1).drop("veredicto").join(gold, item).withColumn("k", F.explode(F.array(*map(F.lit, ks))))
    verdict = F.when(F.col("si") >= F.col("k"), "si").when(F.col("dudoso") > F.col("no"), "dudoso").otherwise("no")
    return g.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_if(verdict == F.col("gold")).alias("iguales"), F.count_if(verdict == "si").alias("retenidos"))


def verdict_rollup(judged: DataFrame, edge: list[str], verdict: str) -> DataFrame:
    """Verdict of an edge from those of its sentences, the strongest first: confirma, invierte, duda, rechaza."""
    any_of = lambda v: F.bool_or(F.col(verdict) == v)
    g = judged.groupBy(*edge).agg(*[any_of(v).alias(v) for v in ("confirma", "invierte", "duda", "rechaza")], F.count(F.lit(1)).alias("n"))
    out = F.lit("ninguno")
    for v in ("rechaza", "duda", "invierte", "confirma"):
        out = F.when(F.col(v), v).otherwise(out)
    return g.select(*edge, "n", out.alias("veredicto"))


def directed_jury(votes: DataFrame, item: str, juror: str, answer: str, direction: str, directions: tuple[str, str], k: int) -> DataFrame:
    """(item, relacion, direccion) of a jury whose yes votes carry a direction.

    At least k yes votes with a direction: yes, in the direction of most of them; even: `dudoso`, in the direction of the first
    of them by juror. Else `dudoso` if the doubtful votes with a direction outnumber the noes, in the direction of most of
    them (even: of the first); else `no`, `ninguna`. Nobody answered: null.
    """
    one, two = directions
    aimed = F.col(direction).isin(one, two)
    count = lambda c, d: F.count_if(c & (F.col(direction) == d))
    yes, doubt = (F.col(answer) == "si") & aimed, (F.col(answer) == "dudoso") & aimed
    first = lambda c: F.min_by(direction, F.when(c, F.col(juror)))
    g = votes.groupBy(item).agg(
        count(yes, one).alias("y1"), count(yes, two).alias("y2"), count(doubt, one).alias("d1"), count(doubt, two).alias("d2"), F.count_if(F.col(answer) == "no").alias("no"),
        F.count(answer).alias("n"), first(yes).alias("fy"), first(doubt).alias("fd"),
    )
    most = lambda a, b, tie: F.when(F.col(a) > F.col(b), one).when(F.col(b) > F.col(a), two).otherwise(F.col(tie))
    carried, doubted = F.col("y1") + F.col("y2") >= k, F.col("d1") + F.col("d2") > F.col("no")
    relation = F.when(F.col("n") == 0, None).when(carried & (F.col("y1") != F.col("y2")), "si").when(carried | doubted, "dudoso").otherwise("no")
    way = F.when(F.col("n") == 0, None).when(carried, most("y1", "y2", "fy")).when(doubted, most("d1", "d2", "fd")).otherwise("ninguna")
    return g.select(item, relation.alias("relacion"), way.alias("direccion"))


def edge_verdicts(judged: DataFrame, edge: list[str], juror: str, answer: str, direction: str, stated: str, directions: tuple[str, str]) -> DataFrame:
    """(edge, n, jueces, a_favor, veredicto, nivel): verdict of an edge from its judged sentences, and the confidence in it.

    A sentence abstains without an answer, rejects by no, confirms by yes in the edge's stated direction, inverts by yes in
    the other, and is doubtful otherwise. The edge takes the strongest of confirmed, inverted, doubtful, rejected; without any,
    `sin_juicio`. Level: inverted `al_reves`, else not confirmed `sin_respaldo`, confirmed by all of two or more jurors `alta`,
    else `media`; empty without a juror.
    """
    verdict = (
        F.when(F.col(answer).isNull(), "abstiene").when(F.col(answer) == "no", "rechaza")
        .when((F.col(answer) == "si") & (F.col(direction) == F.col(stated)), "confirma").when((F.col(answer) == "si") & F.col(direction).isin(*directions), "invierte").otherwise("dudosa")
    )
    rows = judged.withColumn("__v", verdict)
    answered = F.when(F.col("__v") != "abstiene", F.col(juror))
    g = rows.groupBy(*edge).agg(*[F.bool_or(F.col("__v") == v).alias(v) for v in ("confirma", "invierte", "dudosa", "rechaza")], F.count(F.lit(1)).alias("n"), F.count_distinct(answered).alias("jueces"), F.count_distinct(F.when(F.col("__v") == "confirma", F.col(juror))).alias("a_favor"))
    out = F.when(F.col("confirma"), "confirmada").when(F.col("invierte"), "invertida").when(F.col("dudosa"), "dudosa").when(F.col("rechaza"), "rechazada").otherwise("sin_juicio")
    level = F.when(F.col("jueces") == 0, "").when(out == "invertida", "al_reves").when(out != "confirmada", "sin_respaldo").when((F.col("jueces") >= 2) & (F.col("a_favor") == F.col("jueces")), "alta").otherwise("media")
    return g.select(*edge, "n", "jueces", "a_favor", out.alias("veredicto"), level.alias("nivel"))


def recall_by(gold: DataFrame, found: DataFrame, keys: list[str], stratum: str) -> DataFrame:
    """Recall per stratum and, as `todas`, over all; the strata overlap in `todas` only."""
    hit = gold.join(found.select(*keys).distinct().withColumn("__hit", F.lit(True)), keys, "left")
    wide = hit.withColumn("grupo", F.explode(F.array(F.coalesce(F.col(stratum).cast("string"), F.lit("(nulo)")), F.lit("todas"))))
    return wide.groupBy("grupo").agg(F.count(F.lit(1)).alias("n"), F.count("__hit").alias("cubiertas")).select("grupo", "n", "cubiertas", ratio(F.col("cubiertas"), F.col("n")).alias("recall"))


def sign_category(df: DataFrame, key: list[str], sign: str) -> DataFrame:
    """Of each key by its distinct signs: contradictorio (both), unico (one), mezcla (one and `?`), solo_interrogacion, sin_disparador (none)."""
    g = df.groupBy(*key).agg(*[F.coalesce(F.max(F.col(sign) == s), F.lit(False)).alias(n) for n, s in (("p", "+"), ("m", "-"), ("q", "?"))])
    kind = F.when(F.col("p") & F.col("m"), "contradictorio").when((F.col("p") | F.col("m")) & F.col("q"), "mezcla").when(F.col("p") | F.col("m"), "unico").when(F.col("q"), "solo_interrogacion")
    return g.select(*key, kind.otherwise("sin_disparador").alias("categoria"))


def cluster_bootstrap(df: DataFrame, cluster: str, hit: Column, replicates: int = 200, seed: int = 20261016) -> DataFrame:
    """95 % interval of a share when whole clusters are resampled: (valor, bajo, alto, replicas).

    Clusters are reduced to counts first. A replicate gives each cluster a Poisson(1) weight from a hash of
    (seed, replicate, cluster), so it needs no order and no collection; only one row per replicate is gathered.
    """
    per = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("h")).where(F.col(cluster).isNotNull())
    u = F.pmod(F.xxhash64(F.lit(seed), "replica", cluster), F.lit(1 << 40)) / float(1 << 40)
    # Inverse of the Poisson(1) distribution.
    weight, below = F.lit(12), 0.0
    cuts = []
    for k in range(12):
        below += math.exp(-1) / math.factorial(k)
        cuts.append((k, below))
    for k, cut in reversed(cuts):
        weight = F.when(u < cut, k).otherwise(weight)
    drawn = per.withColumn("replica", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("w", weight)
    each = drawn.groupBy("replica").agg(F.sum(F.col("w") * F.col("n")).alias("n"), F.sum(F.col("w") * F.col("h")).alias("h")).where("n > 0").select((F.col("h") / F.col("n")).alias("x"))
    spread = each.agg(F.count(F.lit(1)).alias("replicas"), F.percentile("x", F.lit(0.025)).alias("bajo"), F.percentile("x", F.lit(0.975)).alias("alto"))
    value = per.agg((F.sum("h") / F.sum("n")).alias("valor"))
    return value.crossJoin(spread).select(F.round("valor", 6).alias("valor"), F.round("bajo", 6).alias("bajo"), F.round("alto", 6).alias("alto"), "replicas")


def random_baseline(pool: DataFrame, key: str, is_gold: Column, size: int, draws: int = 200, seed: int = 7) -> DataFrame:
    """Hits of `draws` random subsets of about `size` rows of the pool: (media, maximo, sorteos). Membership is by hash, so no draw is collected."""
    total = pool.agg(F.count(F.lit(1)).alias("total"))
    rows = pool.select(key, is_gold.alias("gold")).crossJoin(F.broadcast(total)).withColumn("sorteo", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    u = F.pmod(F.xxhash64(F.lit(seed), "sorteo", key), F.lit(1 << 40)) / float(1 << 40)
    each = rows.where(u < size / F.col("total")).groupBy("sorteo").agg(F.count_if("gold").alias("h"))
    return each.agg(F.round(F.avg("h"), 6).alias("media"), F.max("h").alias("maximo"), F.count(F.lit(1)).alias("sorteos"))


def paired_bootstrap(df: DataFrame, item: str, a: Column, b: Column, replicates: int = 2000, seed: int = 20261024) -> DataFrame:
    """95 % interval of the difference of two hit rates on the same items: (diferencia, bajo, alto, replicas).

    An item's outcome is one of four; a replicate needs only how often each is drawn, so the items are reduced to
    counts of the four and hashed Poisson(1) weights are summed per outcome and replicate.
    """
    rows = df.where(F.col(item).isNotNull()).select(F.col(item).alias("i"), (F.coalesce(a, F.lit(False)).cast("int") - F.coalesce(b, F.lit(False)).cast("int")).alias("d"))
    u = F.pmod(F.xxhash64(F.lit(seed), "r", "i"), F.lit(1 << 40)) / float(1 << 40)
    weight, below, cuts = F.lit(12), 0.0, []
    for k in range(12):
        below += math.exp(-1) / math.factorial(k)
        cuts.append((k, below))
    for k, cut in reversed(cuts):
        weight = F.when(u < cut, k).otherwise(weight)
    each = rows.withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("w", weight).groupBy("r").agg(F.sum(F.col("w") * F.col("d")).alias("d"), F.sum("w").alias("n")).where("n > 0").select((F.col("d") / F.col("n")).alias("x"))
    spread = each.agg(F.sort_array(F.collect_list("x")).alias("s"))
    cut = lambda q: F.try_element_at("s", (F.floor(F.size("s") * q) + 1).cast("int"))
    value = rows.agg(F.avg("d").alias("v"))
    return value.crossJoin(spread).select(F.round("v", 6).alias("diferencia"), F.round(cut(0.025), 6).alias("bajo"), F.round(F.try_element_at("s", F.greatest(F.floor(F.size("s") * 0.975), F.lit(1)).cast("int")), 6).alias("alto"), F.size("s").alias("replicas"))
