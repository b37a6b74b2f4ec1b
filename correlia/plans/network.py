"""Queries of the network layer: thresholds, deduplication, votes, expansion, nodes, contrast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from correlia.operators import evaluate as E
from correlia.operators import network as N
from correlia.plans.base import plan
from correlia.plans.operons import gene_values, loci
from correlia.runtime import read

#: Scores stand in for a classifier's: the label gets 0.50 to 0.99 by the row's id, the other classes share the rest.
_EV = """(SELECT id, tf, target, oracion, pmid, seccion, n, pred, p, CASE WHEN pred = 'activates' THEN p ELSE q END AS p_activates, CASE WHEN pred = 'no_relation' THEN p ELSE q END AS p_no_relation, CASE WHEN pred = 'regulates' THEN p ELSE q END AS p_regulates, CASE WHEN pred = 'represses' THEN p ELSE q END AS p_represses
FROM (SELECT ejemplo_id AS id, tf, target, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS oracion, coalesce(trim(pmid), '') AS pmid, CASE WHEN seccion = 'Fig. legend' THEN 'leyenda' WHEN seccion = 'INTRODUCTION' THEN 'introduccion' ELSE 'otra' END AS seccion, ejemplo_id % 7 AS n, lower(trim(label)) AS pred, (50 + ejemplo_id % 50) / 100 AS p, (1 - (50 + ejemplo_id % 50) / 100) / 3 AS q FROM ejemplos) z)"""
_LIMIT = "CASE pred WHEN 'activates' THEN 0.65 WHEN 'represses' THEN 0.70 WHEN 'regulates' THEN 0.60 END"
_REASON = f"CASE WHEN tf IS NULL OR target IS NULL OR pred IS NULL THEN 'nulo' WHEN seccion = 'leyenda' THEN 'leyenda' WHEN seccion = 'introduccion' THEN 'introduccion' WHEN tf = target THEN 'autorregulacion' WHEN pred = 'no_relation' THEN 'sin_relacion' WHEN coalesce(p < {_LIMIT}, TRUE) THEN 'umbral' END"
_KEPT = f"(SELECT * FROM {_EV} e WHERE {_REASON} IS NULL)"
_DEDUP = f"(SELECT tf, target, oracion, arg_min(id, (-p, pmid, seccion, n, id)) AS id, arg_min(pmid, (-p, pmid, seccion, n, id)) AS pmid, arg_min(seccion, (-p, pmid, seccion, n, id)) AS seccion, arg_min(n, (-p, pmid, seccion, n, id)) AS n, arg_min(pred, (-p, pmid, seccion, n, id)) AS pred, max(p) AS p, count(*) AS copias, list(DISTINCT pmid) AS pmids FROM {_KEPT} k GROUP BY 1, 2, 3)"
_CAP = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tf, target ORDER BY pmid, seccion, n, id) AS k FROM {_DEDUP} y) w WHERE k <= 5)"


def _sign(a: str, r: str) -> str:
    return f"CASE WHEN {a} + {r} = 0 THEN 'regulates' WHEN {a} = {r} THEN 'regulates' WHEN greatest({a}, {r}) / ({a} + {r}) >= 0.66 THEN CASE WHEN {a} > {r} THEN 'activates' ELSE 'represses' END ELSE 'regulates' END"


def _conflict(a: str, r: str) -> str:
    return f"CASE WHEN {a} + {r} = 0 THEN FALSE WHEN {a} = {r} THEN TRUE WHEN greatest({a}, {r}) / ({a} + {r}) >= 0.66 THEN FALSE ELSE TRUE END"


_COUNTS = f"(SELECT tf, target, count(*) AS n_evidencias, count(CASE WHEN pred = 'activates' THEN 1 END) AS a, count(CASE WHEN pred = 'represses' THEN 1 END) AS r, count(CASE WHEN pred = 'regulates' THEN 1 END) AS g, sum(CASE WHEN pred = 'activates' THEN p END) AS sa, sum(CASE WHEN pred = 'represses' THEN p END) AS sr, sum(CASE WHEN pred = 'regulates' THEN p END) AS sg, count(DISTINCT seccion) AS n_secciones, len(list_distinct(flatten(list(pmids)))) AS n_articulos FROM {_CAP} c GROUP BY 1, 2)"
_ALL_COUNTS = _COUNTS.replace(_CAP, _DEDUP)
_EDGES = f"(SELECT tf, target, {_sign('a', 'r')} AS sign, {_conflict('a', 'r')} AS conflict, n_evidencias, a AS n_activates, r AS n_represses, g AS n_regulates, n_articulos, n_secciones, sa, sr, sg FROM {_COUNTS} x)"
_ALL_EDGES = _EDGES.replace(_COUNTS, _ALL_COUNTS)


def evidence(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "ejemplos")
    p = (50 + F.col("ejemplo_id") % 50) / F.lit(100)
    pred = F.lower(F.trim("label"))
    sec = F.when(F.col("seccion") == "Fig. legend", "leyenda").when(F.col("seccion") == "INTRODUCTION", "introduccion").otherwise("otra")
    base = e.select(
        F.col("ejemplo_id").alias("id"), "tf", "target", F.regexp_replace(F.regexp_replace("text", r"\s+", " "), "^ +| +$", "").alias("oracion"),
        F.coalesce(F.trim("pmid"), F.lit("")).alias("pmid"), sec.alias("seccion"), (F.col("ejemplo_id") % 7).alias("n"), pred.alias("pred"), p.alias("p"),
    )
    return base.select("id", "tf", "target", "oracion", "pmid", "seccion", "n", "pred", *[F.when(F.col("pred") == c, F.col("p")).otherwise((1 - F.col("p")) / 3).alias(f"p_{c}") for c in N.CLASSES])


def kept(spark: SparkSession, d: str) -> DataFrame:
    return evidence(spark, d).where(N.exclusion_reason().isNull())


def capped(spark: SparkSession, d: str) -> DataFrame:
    return N.cap(N.deduplicate(kept(spark, d)), 5)


def edges(spark: SparkSession, d: str) -> DataFrame:
    return N.edges(capped(spark, d))


def all_edges(spark: SparkSession, d: str) -> DataFrame:
    return N.edges(N.deduplicate(kept(spark, d)))


@plan(f"SELECT coalesce({_REASON}, 'queda') AS motivo, count(*) AS n FROM {_EV} e GROUP BY 1")
def network_filter_counts(spark, d):
    """why rows are left out, each under its first reason."""
    return evidence(spark, d).select(F.coalesce(N.exclusion_reason(), F.lit("queda")).alias("motivo")).groupBy("motivo").agg(F.count(F.lit(1)).alias("n"))


@plan(f"SELECT CASE WHEN pred IS NULL THEN 'clase' ELSE 'valida' END AS estado, count(*) AS n FROM {_EV} e GROUP BY 1")
def network_distribution_check(spark, d):
    """rows whose probabilities are no distribution with the label on top."""
    return evidence(spark, d).select(F.coalesce(F.when(F.col("pred").isNull(), "clase").otherwise(N.invalid_distribution()), F.lit("valida")).alias("estado")).groupBy("estado").agg(F.count(F.lit(1)).alias("n"))


@plan(f"SELECT tf, target, oracion, id, pred, copias, len(pmids) AS n_pmids FROM {_DEDUP} x")
def network_dedup(spark, d):
    """One evidence per pair and sentence, the likeliest copy."""
    return N.deduplicate(kept(spark, d)).select("tf", "target", "oracion", "id", "pred", "copias", F.size("pmids").alias("n_pmids"))


@plan(f"SELECT id FROM {_CAP} x")
def network_cap(spark, d):
    """At most five evidences per pair."""
    return capped(spark, d).select("id")


@plan(f"SELECT tf, target, sign, conflict, n_evidencias, n_activates, n_represses, n_regulates, n_articulos, n_secciones, CASE sign WHEN 'activates' THEN round(sa / n_activates, 4) WHEN 'represses' THEN round(sr / n_represses, 4) ELSE CASE WHEN n_regulates > 0 THEN round(sg / n_regulates, 4) END END AS confianza FROM {_EDGES} x")
def network_edges(spark, d):
    """The network: filter, deduplicate, cap, vote."""
    return edges(spark, d)


@plan(f"SELECT tf, target, sign, conflict, n_evidencias, n_activates, n_represses, n_regulates, n_articulos, n_secciones, CASE sign WHEN 'activates' THEN round(sa / n_activates, 4) WHEN 'represses' THEN round(sr / n_represses, 4) ELSE CASE WHEN n_regulates > 0 THEN round(sg / n_regulates, 4) END END AS confianza FROM {_ALL_EDGES} x")
def network_edges_whole(spark, d):
    """The network with the vote of every deduplicated evidence, without a cap."""
    return all_edges(spark, d)


@plan(f"SELECT umbral, count(*) AS n_aristas, sum(n) AS n_evidencias FROM (SELECT umbral, tf, target, count(DISTINCT oracion) AS n FROM {_EV} e, (VALUES (0.5), (0.6), (0.7), (0.8), (0.9)) t(umbral) WHERE pred <> 'no_relation' AND p >= umbral GROUP BY 1, 2, 3) x GROUP BY 1")
def network_sensitivity(spark, d):
    """Size of the network at each of the given thresholds."""
    return N.sensitivity(evidence(spark, d), [0.5, 0.6, 0.7, 0.8, 0.9])


@plan(f"""WITH p AS (SELECT tf, target, pmid, count(CASE WHEN pred = 'activates' THEN 1 END) AS a, count(CASE WHEN pred = 'represses' THEN 1 END) AS r FROM {_KEPT} k GROUP BY 1, 2, 3), v AS (SELECT *, {_sign('a', 'r')} AS s FROM p), b AS (SELECT tf, target, sum(a) AS a, sum(r) AS r, count(CASE WHEN s = 'activates' THEN 1 END) AS va, count(CASE WHEN s = 'represses' THEN 1 END) AS vr FROM v GROUP BY 1, 2 HAVING sum(a) > 0 AND sum(r) > 0)
SELECT tf, target, va AS articulos_mas, vr AS articulos_menos, {_sign('va', 'vr')} AS signo, ({_conflict('va', 'vr')} OR va + vr = 0) AS conflicto FROM b""")
def network_article_votes(spark, d):
    """Pairs with votes of both signs, each article voting once."""
    return N.article_votes(kept(spark, d))


_MEMBERS = "(SELECT DISTINCT 'op:' || id_fuente AS grupo, unnest(string_split(locus_tags, '|')) AS miembro FROM operones_bronze WHERE locus_tags LIKE '%|%')"


@plan("""WITH e AS (SELECT id_fuente AS grupo, genes_raw AS tf FROM operones_bronze WHERE genes_raw NOT LIKE '%|%' AND length(genes_raw) > 1), m AS (SELECT DISTINCT id_fuente AS grupo, trim(unnest(string_split(locus_tags, '|'))) AS miembro FROM operones_bronze WHERE locus_tags LIKE '%|%')
SELECT tf, grupo AS target, '' AS expandida_de FROM e UNION ALL SELECT e.tf, m.miembro, e.grupo FROM e JOIN m ON m.grupo = e.grupo WHERE lower(m.miembro) <> lower(e.tf) AND m.miembro <> ''""")
def network_expansion(spark, d):
    """Edges to a group expanded to its members."""
    o = read(spark, d, "operones_bronze")
    edge = o.where("genes_raw not like '%|%' and length(genes_raw) > 1").select(F.col("genes_raw").alias("tf"), F.col("id_fuente").alias("target"))
    members = o.where("locus_tags like '%|%'").select(F.col("id_fuente").alias("grupo"), F.explode(F.split("locus_tags", r"\|")).alias("miembro")).select("grupo", F.trim("miembro").alias("miembro")).where("miembro <> ''").distinct()
    return N.expand_groups(edge, members)


@plan()
def network_expansion_whole(spark, d):
    """Edges to a group expanded to its members, whatever the notation of either list; cells of a single name are regulators."""
    one = gene_values(spark, d).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("valor").alias("tf")).where("n = 1 and length(tf) > 1")
    edge = read(spark, d, "operones_bronze").select("id", F.col("id_fuente").alias("target")).join(one, "id").select("tf", "target")
    members = loci(spark, d).select(F.col("id_fuente").alias("grupo"), F.explode("genes").alias("miembro")).distinct()
    return N.expand_groups(edge, members)


@plan(f"SELECT nodo, sum(s) AS sale, sum(e) AS entra FROM (SELECT tf AS nodo, 1 AS s, 0 AS e FROM {_EDGES} x UNION ALL SELECT target, 0, 1 FROM {_EDGES} x) y GROUP BY 1")
def network_degrees(spark, d):
    """How many edges leave and reach each node."""
    return N.degrees(edges(spark, d))


@plan(f"SELECT nodo, sum(s) AS sale, sum(e) AS entra FROM (SELECT tf AS nodo, 1 AS s, 0 AS e FROM {_ALL_EDGES} x UNION ALL SELECT target, 0, 1 FROM {_ALL_EDGES} x) y GROUP BY 1")
def network_degrees_whole(spark, d):
    """Edges that leave and reach each node of the uncapped network."""
    return N.degrees(all_edges(spark, d))


_NODES = "(SELECT DISTINCT texto AS id, upper(trim(id_normalizado)) AS locus FROM menciones WHERE tipo IN ('gen', 'proteina'))"


def nodes(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "menciones").where("tipo in ('gen', 'proteina')").select(F.col("texto").alias("id"), F.upper(F.trim("id_normalizado")).alias("locus")).distinct()


@plan(f"WITH b AS (SELECT locus, arg_min(id, (id = locus, id)) AS r FROM {_NODES} n WHERE locus IS NOT NULL GROUP BY 1) SELECT DISTINCT n.id, coalesce(b.r, n.id) AS representante FROM {_NODES} n LEFT JOIN b ON b.locus = n.locus")
def network_unify(spark, d):
    """Names that share a locus become one node."""
    return N.unify(nodes(spark, d))


@plan(f"SELECT id, count(DISTINCT locus) AS n FROM {_NODES} n WHERE id IS NOT NULL AND locus IS NOT NULL GROUP BY 1 HAVING count(DISTINCT locus) > 1")
def network_collisions(spark, d):
    """Names that stand for several loci."""
    return N.collisions(nodes(spark, d))


_GOLD = "(SELECT DISTINCT regulador AS tf, blanco AS target, disparador FROM juicio_consolidado WHERE regulador IS NOT NULL AND blanco IS NOT NULL)"
_CAND = "(SELECT DISTINCT tf, target FROM ejemplos)"


def gold(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "juicio_consolidado").where("regulador is not null and blanco is not null").select(F.col("regulador").alias("tf"), F.col("blanco").alias("target"), "disparador").distinct()


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "ejemplos").select("tf", "target").distinct()


@plan(f"SELECT g.tf, g.target, g.disparador, CASE WHEN EXISTS (SELECT 1 FROM {_CAND} c WHERE c.tf = g.tf AND c.target = g.target) THEN 'directa' WHEN EXISTS (SELECT 1 FROM {_CAND} c WHERE c.tf = g.target AND c.target = g.tf) THEN 'inversa' ELSE 'ninguna' END AS sentido FROM {_GOLD} g")
def contrast_directions(spark, d):
    """Settled pairs found in their direction, in the other one, or not."""
    return N.directions(gold(spark, d), candidates(spark, d), "tf", "target")


@plan(f"SELECT tf, target FROM {_CAND} c WHERE NOT EXISTS (SELECT 1 FROM {_GOLD} g WHERE (g.tf = c.tf AND g.target = c.target) OR (g.tf = c.target AND g.target = c.tf))")
def contrast_new_pairs(spark, d):
    """Candidate pairs that are settled in neither direction."""
    return N.new_pairs(candidates(spark, d), gold(spark, d), "tf", "target")


@plan(f"""SELECT grupo, count(*) AS n, count(CASE WHEN hit THEN 1 END) AS cubiertas, round(count(CASE WHEN hit THEN 1 END) / count(*), 6) AS recall FROM (SELECT unnest([coalesce(disparador, '(nulo)'), 'todas']) AS grupo, EXISTS (SELECT 1 FROM {_CAND} c WHERE c.tf = g.tf AND c.target = g.target) AS hit FROM {_GOLD} g) x GROUP BY 1""")
def contrast_recall(spark, d):
    """Recall per trigger word and over all."""
    return E.recall_by(gold(spark, d), candidates(spark, d), ["tf", "target"], "disparador")


@plan(f"SELECT tf, target FROM (SELECT DISTINCT CASE WHEN tf < target THEN tf ELSE target END AS tf, CASE WHEN tf < target THEN target ELSE tf END AS target FROM {_CAND} c) a INTERSECT SELECT DISTINCT CASE WHEN tf < target THEN tf ELSE target END, CASE WHEN tf < target THEN target ELSE tf END FROM {_GOLD} g")
def contrast_unordered(spark, d):
    """Pairs both sides know, whatever the direction."""
    unordered = lambda df: df.select(F.least("tf", "target").alias("tf"), F.greatest("tf", "target").alias("target"))
    return unordered(candidates(spark, d)).intersect(unordered(gold(spark, d)))
