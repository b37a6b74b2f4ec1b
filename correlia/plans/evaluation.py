"""Queries that measure labels, votes and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from correlia.functions import text as X
from correlia.operators import evaluate as E
from correlia.operators import ingest as I
from correlia.operators import neardup as D
from correlia.plans import network as P
from correlia.plans.base import plan
from correlia.runtime import read

_ANS = "CASE WHEN a IN ('si', 'sí', 's') THEN 'si' WHEN a IN ('no', 'n') THEN 'no' WHEN a IN ('dudoso', 'dudosa', 'duda', '?') THEN 'dudoso' END"
_VOTES = f"(SELECT item, anotador, arg_max(v, (t, v)) AS v FROM (SELECT id_item AS item, regexp_replace(lower(trim(anotador)), '[^a-z0-9]+', '_', 'g') AS anotador, {_ANS} AS v, epoch_us(juzgado_en) AS t FROM (SELECT *, lower(trim(juicio)) AS a FROM muestra_precision_50) m) x WHERE v IS NOT NULL GROUP BY 1, 2)"
_SETTLED = f"(SELECT id_item AS item, min({_ANS}) AS gold FROM (SELECT *, lower(trim(relacion)) AS a FROM juicio_consolidado) j GROUP BY 1 HAVING min({_ANS}) IS NOT NULL)"
CLASSES = ["si", "no", "dudoso"]


def answer(c: str) -> F.Column:
    a = F.lower(F.trim(c))
    return F.when(a.isin("si", "sí", "s"), "si").when(a.isin("no", "n"), "no").when(a.isin("dudoso", "dudosa", "duda", "?"), "dudoso")


def votes(spark: SparkSession, d: str) -> DataFrame:
    """Each person's latest usable answer per item."""
    m = read(spark, d, "muestra_precision_50").select(F.col("id_item").alias("item"), F.regexp_replace(F.lower(F.trim("anotador")), "[^a-z0-9]+", "_").alias("anotador"), answer("juicio").alias("v"), F.unix_micros("juzgado_en").alias("t"))
    return I.one_per_key(m.where("v is not null"), ["item", "anotador"], [F.col("t"), F.col("v")]).select("item", "anotador", "v")


def settled(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "juicio_consolidado").groupBy(F.col("id_item").alias("item")).agg(F.min(answer("relacion")).alias("gold")).where("gold is not null")


_GUESS = "(SELECT v.item, v.anotador, s.gold, v.v AS dicho FROM " + _VOTES + " v JOIN " + _SETTLED + " s ON s.item = v.item)"


def guesses(spark: SparkSession, d: str) -> DataFrame:
    return votes(spark, d).join(settled(spark, d), "item").select("item", "anotador", "gold", F.col("v").alias("dicho"))


@plan(f"SELECT gold, dicho, count(*) AS n FROM {_GUESS} g GROUP BY 1, 2")
def eval_confusion(spark, d):
    """Confusion matrix of answers against settled labels."""
    return E.confusion(guesses(spark, d), "gold", "dicho")


@plan(f"""SELECT c.clase, count(CASE WHEN gold = clase AND dicho = clase THEN 1 END) AS aciertos, count(CASE WHEN gold = clase THEN 1 END) AS n_real, count(CASE WHEN dicho = clase THEN 1 END) AS n_dicho, round(count(CASE WHEN gold = clase AND dicho = clase THEN 1 END) / nullif(count(CASE WHEN dicho = clase THEN 1 END), 0), 6) AS precision, round(count(CASE WHEN gold = clase AND dicho = clase THEN 1 END) / nullif(count(CASE WHEN gold = clase THEN 1 END), 0), 6) AS recall, round(2 * count(CASE WHEN gold = clase AND dicho = clase THEN 1 END) / nullif(count(CASE WHEN dicho = clase THEN 1 END) + count(CASE WHEN gold = clase THEN 1 END), 0), 6) AS f1 FROM {_GUESS} g, (VALUES ('si'), ('no'), ('dudoso')) c(clase) GROUP BY 1""")
def eval_per_class(spark, d):
    """Precision, recall and F1 of each class."""
    return E.per_class(guesses(spark, d), "gold", "dicho", CLASSES)


@plan(f"WITH c AS (SELECT c.clase, count(CASE WHEN gold = clase AND dicho = clase THEN 1 END) AS a, count(CASE WHEN gold = clase THEN 1 END) AS r, count(CASE WHEN dicho = clase THEN 1 END) AS s FROM {_GUESS} g, (VALUES ('si'), ('no'), ('dudoso')) c(clase) GROUP BY 1) SELECT round(sum(2 * a / (r + s)) / 3, 6) AS macro_f1, round(sum(a) / sum(r), 6) AS exactitud FROM c")
def eval_macro_f1(spark, d):
    """Macro F1 and accuracy."""
    return E.macro_f1(guesses(spark, d), "gold", "dicho", CLASSES)


@plan(f"""WITH c AS (SELECT anotador, gold, dicho, count(*) AS c FROM {_GUESS} g GROUP BY 1, 2, 3), l AS (SELECT anotador, gold AS k, sum(c) AS x FROM c GROUP BY 1, 2), r AS (SELECT anotador, dicho AS k, sum(c) AS y FROM c GROUP BY 1, 2), ch AS (SELECT l.anotador, sum(CAST(x AS DOUBLE) * y) AS xy FROM l JOIN r ON l.anotador = r.anotador AND l.k = r.k GROUP BY 1), t AS (SELECT anotador, sum(c) AS n, sum(CASE WHEN gold = dicho THEN c ELSE 0 END) AS same FROM c GROUP BY 1)
SELECT t.anotador, n, round(same / n, 6) AS observado, round(coalesce(xy, 0) / (CAST(n AS DOUBLE) * n), 6) AS esperado, round(CASE WHEN coalesce(xy, 0) / (CAST(n AS DOUBLE) * n) < 1 THEN (same / n - coalesce(xy, 0) / (CAST(n AS DOUBLE) * n)) / (1 - coalesce(xy, 0) / (CAST(n AS DOUBLE) * n)) END, 4) AS kappa FROM t LEFT JOIN ch ON ch.anotador = t.anotador""")
def eval_kappa(spark, d):
    """Kappa of each person with the settled labels."""
    return E.kappa(guesses(spark, d), ["anotador"], "gold", "dicho")


_W = "(((h / n) + 3.841458820694124 / (2 * n)) {op} sqrt((h / n) * (1 - h / n) * 3.841458820694124 / n + 3.841458820694124 * 3.841458820694124 / (4 * n * n))) / (1 + 3.841458820694124 / n)"


@plan(f"SELECT anotador, n, h AS aciertos, round({_W.format(op='-')}, 6) AS bajo, round({_W.format(op='+')}, 6) AS alto FROM (SELECT anotador, CAST(count(*) AS DOUBLE) AS n, CAST(count(CASE WHEN gold = dicho THEN 1 END) AS DOUBLE) AS h FROM {_GUESS} g GROUP BY 1) x")
def eval_wilson(spark, d):
    """Wilson interval of each person's precision."""
    g = guesses(spark, d).groupBy("anotador").agg(F.count(F.lit(1)).cast("double").alias("n"), F.count_if(F.col("gold") == F.col("dicho")).cast("double").alias("h"))
    return g.select("anotador", "n", F.col("h").alias("aciertos"), E.wilson(F.col("h"), F.col("n"), True).alias("bajo"), E.wilson(F.col("h"), F.col("n"), False).alias("alto"))


@plan(f"SELECT item, si, no, dudoso, CASE WHEN si + no + dudoso = 0 THEN 'vacio' WHEN si >= 3 THEN 'si' WHEN dudoso > no THEN 'dudoso' ELSE 'no' END AS veredicto FROM (SELECT item, count(CASE WHEN v = 'si' THEN 1 END) AS si, count(CASE WHEN v = 'no' THEN 1 END) AS no, count(CASE WHEN v = 'dudoso' THEN 1 END) AS dudoso FROM {_VOTES} v GROUP BY 1) x")
def eval_jury(spark, d):
    """Verdict of a jury in which three yes votes carry."""
    return E.jury(votes(spark, d), "item", "v", 3)


@plan(f"SELECT k, count(*) AS n, count(CASE WHEN ver = gold THEN 1 END) AS iguales, count(CASE WHEN ver = 'si' THEN 1 END) AS retenidos FROM (SELECT k, gold, CASE WHEN si >= k THEN 'si' WHEN dudoso > no THEN 'dudoso' ELSE 'no' END AS ver FROM (SELECT v.item, min(s.gold) AS gold, count(CASE WHEN v = 'si' THEN 1 END) AS si, count(CASE WHEN v = 'no' THEN 1 END) AS no, count(CASE WHEN v = 'dudoso' THEN 1 END) AS dudoso FROM {_VOTES} v JOIN {_SETTLED} s ON s.item = v.item GROUP BY 1) x, (VALUES (1), (2), (3), (4), (5)) t(k)) y GROUP BY 1")
def eval_jury_sweep(spark, d):
    """The jury at each number of votes."""
    return E.jury_sweep(votes(spark, d), "item", "v", settled(spark, d), [1, 2, 3, 4, 5])


_VERDICT = "CASE WHEN v = 'no' THEN 'rechaza' WHEN v = 'dudoso' THEN 'duda' WHEN item % 5 = 0 THEN 'invierte' ELSE 'confirma' END"


@plan(f"SELECT anotador, count(*) AS n, CASE WHEN bool_or(ver = 'confirma') THEN 'confirma' WHEN bool_or(ver = 'invierte') THEN 'invierte' WHEN bool_or(ver = 'duda') THEN 'duda' WHEN bool_or(ver = 'rechaza') THEN 'rechaza' ELSE 'ninguno' END AS veredicto, bloque FROM (SELECT anotador, item // 50 AS bloque, {_VERDICT} AS ver FROM {_VOTES} v) x GROUP BY anotador, bloque")
def eval_verdicts(spark, d):
    """Strongest verdict among the sentences of a group."""
    ver = F.when(F.col("v") == "no", "rechaza").when(F.col("v") == "dudoso", "duda").when(F.col("item") % 5 == 0, "invierte").otherwise("confirma")
    rows = votes(spark, d).select("anotador", F.floor(F.col("item") / 50).alias("bloque"), ver.alias("ver"))
    return E.verdict_rollup(rows, ["anotador", "bloque"], "ver")


@plan("SELECT tf, moda, total, n FROM (SELECT tf, arg_max(l, (n, -o)) AS moda, sum(n) AS total, max(n) AS n FROM (SELECT tf, lower(trim(label)) AS l, count(*) AS n, CASE lower(trim(label)) WHEN 'activates' THEN 0 WHEN 'represses' THEN 1 WHEN 'regulates' THEN 2 ELSE 3 END AS o FROM ejemplos WHERE label IS NOT NULL GROUP BY 1, 2, 4) x GROUP BY 1) y")
def eval_modal_label(spark, d):
    """Commonest label of each regulator, ties by a fixed order."""
    rows = read(spark, d, "ejemplos").select("tf", F.lower(F.trim("label")).alias("l"))
    return E.modal_label(rows, ["tf"], "l", ["activates", "represses", "regulates", "no_relation"])


@plan(f"""WITH e AS (SELECT p, pred = 'no_relation' AS pos FROM {P._EV} e WHERE pred IS NOT NULL), b AS (SELECT p AS umbral, count(*) AS n, count(CASE WHEN pos THEN 1 END) AS tp FROM e GROUP BY 1), c AS (SELECT umbral, sum(n) OVER (ORDER BY umbral DESC) AS n, sum(tp) OVER (ORDER BY umbral DESC) AS tp, (SELECT sum(tp) FROM b) AS t FROM b)
SELECT arg_max(umbral, (round(2 * tp / (n + t), 12), -umbral)) AS umbral, round(arg_max(tp / n, (round(2 * tp / (n + t), 12), -umbral)), 6) AS precision, round(arg_max(tp / t, (round(2 * tp / (n + t), 12), -umbral)), 6) AS recall, round(max(2 * tp / (n + t)), 6) AS f1 FROM c""")
def eval_best_threshold(spark, d):
    """Threshold of the best F1, equal scores together, ties to the lowest."""
    rows = P.evidence(spark, d).where("pred is not null").withColumn("p", F.greatest(*[f"p_{c}" for c in P.N.CLASSES]))
    return E.best_threshold(rows, F.col("pred") == "no_relation", "p")


@plan("""WITH s AS (SELECT coalesce(fuente, '(nulo)') AS f, count(*) AS n, avg(CASE WHEN lower(trim(label)) = 'activates' THEN 1.0 ELSE 0.0 END) AS p FROM ejemplos WHERE particion <> 'train' GROUP BY 1), z AS (SELECT coalesce(fuente, '(nulo)') AS f, count(*) AS total FROM ejemplos GROUP BY 1), j AS (SELECT s.*, total, total / sum(total) OVER () AS w FROM s JOIN z ON z.f = s.f)
SELECT sum(n) AS n, round(sum(w * p), 6) AS precision, round(sqrt(sum(CASE WHEN n > 1 THEN w * w * (1 - n / total) * p * (1 - p) / (n - 1) ELSE 0 END)), 6) AS error FROM j""")
def eval_stratified(spark, d):
    """Share weighted by strata with finite-population correction."""
    rows = read(spark, d, "ejemplos").withColumn("f", F.coalesce("fuente", F.lit("(nulo)")))
    sizes = rows.groupBy("f").agg(F.count(F.lit(1)).alias("total"))
    return E.stratified_precision(rows.where("particion <> 'train'"), "f", F.coalesce(F.lower(F.trim("label")) == "activates", F.lit(False)), sizes)


@plan("SELECT seccion, round(quantile_cont(length(texto), 0.5), 6) AS mediana, round(quantile_cont(length(texto), 0.975), 6) AS alto FROM texto_unidades GROUP BY 1")
def eval_percentiles(spark, d):
    """Exact percentiles with linear interpolation."""
    return read(spark, d, "texto_unidades").groupBy("seccion").agg(F.round(F.percentile(F.length("texto"), F.lit(0.5)), 6).alias("mediana"), F.round(F.percentile(F.length("texto"), F.lit(0.975)), 6).alias("alto"))


@plan("""SELECT regulador, CASE WHEN p AND m THEN 'contradictorio' WHEN (p OR m) AND q THEN 'mezcla' WHEN p OR m THEN 'unico' WHEN q THEN 'solo_interrogacion' ELSE 'sin_disparador' END AS categoria
FROM (SELECT regulador, coalesce(bool_or(signo_sugerido = '+'), FALSE) AS p, coalesce(bool_or(signo_sugerido = '-'), FALSE) AS m, coalesce(bool_or(signo_sugerido = '?'), FALSE) AS q FROM muestra_precision_50 GROUP BY 1) x""")
def eval_sign_category(spark, d):
    """Whether the signs of a regulator agree."""
    return E.sign_category(read(spark, d, "muestra_precision_50").select("regulador", F.col("signo_sugerido").alias("s")), ["regulador"], "s")


@plan("SELECT pmid, count(*) AS n FROM texto_unidades GROUP BY 1 ORDER BY n DESC, CAST(pmid AS BIGINT) LIMIT 10")
def eval_top_articles(spark, d):
    """The ten articles with most rows, ties by number."""
    return read(spark, d, "texto_unidades").groupBy("pmid").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.col("pmid").cast("long")).limit(10)


@plan("""WITH s AS (SELECT id_item, anotador, epoch_us(juzgado_en) AS t FROM muestra_precision_50 WHERE juzgado_en IS NOT NULL), g AS (SELECT *, t - lag(t) OVER (PARTITION BY id_item ORDER BY t, anotador) AS gap FROM s), n AS (SELECT *, sum(CASE WHEN gap IS NULL OR gap > 2592000000000 THEN 1 ELSE 0 END) OVER (PARTITION BY id_item ORDER BY t, anotador ROWS UNBOUNDED PRECEDING) AS sesion FROM g) SELECT id_item, sesion, count(*) AS n, max(t) - min(t) AS dura FROM n GROUP BY 1, 2""")
def eval_sessions(spark, d):
    """Sessions of answers to an item, cut at a pause of thirty days."""
    from pyspark.sql import Window as W

    s = read(spark, d, "muestra_precision_50").where("juzgado_en is not null").select("id_item", "anotador", F.unix_micros("juzgado_en").alias("t"))
    w = W.partitionBy("id_item").orderBy("t", "anotador")
    gap = F.col("t") - F.lag("t").over(w)
    cut = s.withColumn("c", F.when(gap.isNull() | (gap > 2592000000000), 1).otherwise(0)).withColumn("sesion", F.sum("c").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return cut.groupBy("id_item", "sesion").agg(F.count(F.lit(1)).alias("n"), (F.max("t") - F.min("t")).alias("dura"))


@plan(f"""WITH g AS (SELECT anotador, count(*) FILTER (gold = dicho) AS h, count(*) AS n FROM {_GUESS} g GROUP BY 1),
t AS (SELECT anotador, sum(exp(lgamma(n + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END - CASE WHEN i = n THEN 0 ELSE lgamma(n - i + 1) END + i * ln(1 / 3) + (n - i) * ln(2 / 3))) AS p FROM (SELECT anotador, n, unnest(range(h, n + 1)) AS i FROM g) x GROUP BY 1)
SELECT g.anotador, h, n, round(least(1, coalesce(p, 0)), 9) AS p FROM g LEFT JOIN t ON t.anotador = g.anotador""")
def eval_binomial_tail(spark, d):
    """Chance of at least so many agreements by guessing one in three."""
    g = guesses(spark, d).groupBy("anotador").agg(F.count_if(F.col("gold") == F.col("dicho")).alias("h"), F.count(F.lit(1)).alias("n"))
    return g.select("anotador", "h", "n", F.round(E.binomial_tail("h", "n", F.lit(1 / 3)), 9).alias("p"))


#: Votes with the sign each person gave, which serves as the direction of the vote.
_AIMED = f"(SELECT item, anotador, arg_max(v, (t, v, g)) AS v, nullif(arg_max(g, (t, v, g)), '') AS g FROM (SELECT id_item AS item, regexp_replace(lower(trim(anotador)), '[^a-z0-9]+', '_', 'g') AS anotador, {_ANS} AS v, coalesce(trim(signo_correcto), '') AS g, epoch_us(juzgado_en) AS t FROM (SELECT *, lower(trim(juicio)) AS a FROM muestra_precision_50) m) x WHERE v IS NOT NULL GROUP BY 1, 2)"


def aimed_votes(spark: SparkSession, d: str) -> DataFrame:
    """Each person's latest usable answer per item with its sign."""
    m = read(spark, d, "muestra_precision_50").select(
        F.col("id_item").alias("item"), F.regexp_replace(F.lower(F.trim("anotador")), "[^a-z0-9]+", "_").alias("anotador"), answer("juicio").alias("v"),
        F.coalesce(F.trim("signo_correcto"), F.lit("")).alias("g"), F.unix_micros("juzgado_en").alias("t"),
    )
    last = m.where("v is not null").groupBy("item", "anotador").agg(F.max(F.struct("t", "v", "g")).alias("m"))
    return last.select("item", "anotador", F.col("m.v").alias("v"), F.nullif(F.col("m.g"), F.lit("")).alias("g"))


@plan(f"""WITH c AS (SELECT item, count(*) FILTER (v = 'si' AND g = '+') AS y1, count(*) FILTER (v = 'si' AND g = '-') AS y2, count(*) FILTER (v = 'dudoso' AND g = '+') AS d1, count(*) FILTER (v = 'dudoso' AND g = '-') AS d2,
  count(*) FILTER (v = 'no') AS n, arg_min(g, anotador) FILTER (v = 'si' AND g IN ('+', '-')) AS fy, arg_min(g, anotador) FILTER (v = 'dudoso' AND g IN ('+', '-')) AS fd FROM {_AIMED} v GROUP BY 1)
SELECT item, CASE WHEN y1 + y2 >= 3 AND y1 <> y2 THEN 'si' WHEN y1 + y2 >= 3 OR d1 + d2 > n THEN 'dudoso' ELSE 'no' END AS relacion,
  CASE WHEN y1 + y2 >= 3 THEN CASE WHEN y1 > y2 THEN '+' WHEN y2 > y1 THEN '-' ELSE fy END WHEN d1 + d2 > n THEN CASE WHEN d1 > d2 THEN '+' WHEN d2 > d1 THEN '-' ELSE fd END ELSE 'ninguna' END AS direccion FROM c""")
def eval_directed_jury(spark, d):
    """A jury whose yes votes carry a direction (here the sign); even votes are doubtful."""
    return E.directed_jury(aimed_votes(spark, d), "item", "anotador", "v", "g", ("+", "-"), 3)


@plan(f"""WITH e AS (SELECT id_item, min(regulador) AS regulador, min(blanco) AS blanco, min(signo_sugerido) AS s FROM muestra_precision_50 GROUP BY 1),
j AS (SELECT regulador, blanco, anotador, CASE WHEN v = 'no' THEN 'rechaza' WHEN v = 'si' AND g = s THEN 'confirma' WHEN v = 'si' AND g IN ('+', '-') THEN 'invierte' ELSE 'dudosa' END AS ver FROM {_AIMED} v JOIN e ON e.id_item = v.item),
c AS (SELECT regulador, blanco, count(*) AS n, count(DISTINCT anotador) AS jueces, count(DISTINCT CASE WHEN ver = 'confirma' THEN anotador END) AS a_favor, bool_or(ver = 'confirma') AS c, bool_or(ver = 'invierte') AS i, bool_or(ver = 'dudosa') AS d, bool_or(ver = 'rechaza') AS r FROM j GROUP BY 1, 2)
SELECT regulador, blanco, n, jueces, a_favor, CASE WHEN c THEN 'confirmada' WHEN i THEN 'invertida' WHEN d THEN 'dudosa' WHEN r THEN 'rechazada' ELSE 'sin_juicio' END AS veredicto,
  CASE WHEN jueces = 0 THEN '' WHEN c AND jueces >= 2 AND a_favor = jueces THEN 'alta' WHEN c THEN 'media' WHEN i THEN 'al_reves' ELSE 'sin_respaldo' END AS nivel FROM c""")
def eval_edge_verdicts(spark, d):
    """Verdict and confidence of every regulator-target pair from the judged sentences; the sign is the direction."""
    e = read(spark, d, "muestra_precision_50").groupBy(F.col("id_item").alias("item")).agg(F.min("regulador").alias("regulador"), F.min("blanco").alias("blanco"), F.min("signo_sugerido").alias("s"))
    return E.edge_verdicts(aimed_votes(spark, d).join(e, "item"), ["regulador", "blanco"], "anotador", "v", "g", "s", ("+", "-"))


@plan()
def eval_cluster_bootstrap(spark, d):
    """Interval of the share of activations, whole articles resampled."""
    return E.cluster_bootstrap(read(spark, d, "ejemplos").withColumn("pm", F.coalesce(F.trim("pmid"), F.lit("?"))), "pm", F.lower(F.trim("label")) == "activates")


@plan()
def eval_random_baseline(spark, d):
    """Settled pairs a random choice of as many candidates would hit."""
    pool = P.candidates(spark, d).join(P.gold(spark, d).select("tf", "target").distinct().withColumn("g", F.lit(True)), ["tf", "target"], "left").withColumn("k", F.concat_ws("|", "tf", "target"))
    return E.random_baseline(pool, "k", F.coalesce("g", F.lit(False)), 100)


@plan("""SELECT o AS clave, count(DISTINCT particion) AS n_particiones, count(*) AS n FROM (SELECT particion, trim(regexp_replace(lower(regexp_replace(regexp_replace(text, '[<\\[]\\s*/?\\s*[eE][12]\\s*[>\\]]', ' ', 'g'), '[^\\p{L}\\p{N}\\s\\x{00A0}]+', ' ', 'g')), '[\\s\\x{00A0}]+', ' ', 'g')) AS o FROM ejemplos) x GROUP BY 1 HAVING count(DISTINCT particion) > 1""")
def leak_by_text(spark, d):
    """Canonical texts that stand in more than one split."""
    return D.shared_keys(read(spark, d, "ejemplos"), X.canonical(F.col("text")), "particion")


@plan()
def leak_near_duplicates(spark, d):
    """Evaluation texts that share 0.8 of their five-word groups with a training text, between class representatives."""
    e = read(spark, d, "ejemplos")
    return D.contained(D.ngrams(e.where("particion <> 'train'"), "ejemplo_id", "text"), D.ngrams(e.where("particion = 'train'"), "ejemplo_id", "text"))


_WORDS = "string_split(trim(regexp_replace(lower(regexp_replace(regexp_replace(text, '[<\\[]\\s*/?\\s*[eE][12]\\s*[>\\]]', ' ', 'g'), '[^\\p{L}\\p{N}\\s\\x{00A0}]+', ' ', 'g')), '[\\s\\x{00A0}]+', ' ', 'g')), ' ')"


@plan(f"""WITH w AS (SELECT ejemplo_id, CASE WHEN particion = 'train' THEN 'train' ELSE 'eval' END AS lado, {_WORDS} AS w FROM ejemplos WHERE particion IS NOT NULL), g AS (SELECT ejemplo_id, lado, CASE WHEN w <> [''] THEN list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS g FROM w)
SELECT ejemplo_id, lado, CASE WHEN g IS NOT NULL THEN min(ejemplo_id) OVER (PARTITION BY lado, g) END AS clase FROM g""")
def leak_near_duplicate_classes(spark, d):
    """Side and class of every row that has a split; the pairs of leak_near_duplicates are pairs of these classes. A text without words has none."""
    e = read(spark, d, "ejemplos").where("particion is not null")
    sides = {"eval": e.where("particion <> 'train'"), "train": e.where("particion = 'train'")}
    per = [x.select("ejemplo_id", F.lit(k).alias("lado")).join(D.membership(D.ngrams(x, "ejemplo_id", "text")).withColumnRenamed("id", "ejemplo_id"), "ejemplo_id", "left") for k, x in sides.items()]
    return per[0].unionByName(per[1])


@plan("""SELECT m.id_item, m.anotador, epoch_us(m.juzgado_en) AS t, j.rel FROM muestra_precision_50 m JOIN (SELECT o, regulador, blanco, arg_min(relacion, id_item) AS rel FROM (SELECT *, trim(regexp_replace(lower(oracion), '\\s+', ' ', 'g')) AS o FROM juicio_consolidado) z GROUP BY 1, 2, 3) j ON j.o = trim(regexp_replace(lower(m.oracion), '\\s+', ' ', 'g')) AND j.regulador = m.regulador AND j.blanco = m.blanco""")
def judgement_join(spark, d):
    """Judgements by sentence, regulator and target, the first of equal keys."""
    key = lambda c: F.regexp_replace(F.regexp_replace(F.lower(c), r"\s+", " "), "^ | $", "")
    j = read(spark, d, "juicio_consolidado").withColumn("o", key("oracion")).groupBy("o", "regulador", "blanco").agg(F.min_by("relacion", "id_item").alias("rel"))
    m = read(spark, d, "muestra_precision_50").withColumn("o", key("oracion"))
    return m.join(j, ["o", "regulador", "blanco"]).select("id_item", "anotador", F.unix_micros("juzgado_en").alias("t"), "rel")


@plan("SELECT DISTINCT d.doi FROM documentos d WHERE d.doi IS NOT NULL AND d.pmid IN (SELECT pmid FROM documents) AND lower(d.doi) LIKE '10.%'")
def contamination_ids(spark, d):
    """DOIs of articles that the corpus also holds."""
    doc = read(spark, d, "documentos").join(read(spark, d, "documents").where("pmid is not null").select("pmid").distinct(), "pmid", "left_semi")
    return doc.select(X.doi("doi").alias("doi")).where("doi is not null").distinct()


@plan()
def eval_paired_bootstrap(spark, d):
    """Difference of the precision of two people on the items both judged."""
    g = guesses(spark, d)
    a = g.where("anotador = 'anot_01'").select("item", "gold", F.col("dicho").alias("a"))
    b = g.where("anotador = 'anot_04'").select("item", F.col("dicho").alias("b"))
    return E.paired_bootstrap(a.join(b, "item"), "item", F.col("a") == F.col("gold"), F.col("b") == F.col("gold"))
