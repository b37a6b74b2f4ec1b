"""Queries that sample, label and group rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from correlia.operators import sampling as S
from correlia.operators.components import propagate
from correlia.plans import network as P
from correlia.operators.group_splits import assign_splits, balance
from correlia.plans.base import plan
from correlia.runtime import read


@plan("SELECT ejemplo_id, fuente FROM (SELECT ejemplo_id, fuente, row_number() OVER (PARTITION BY fuente ORDER BY sha256(concat_ws('|', 'semilla', coalesce(pmid, ''), CAST(ejemplo_id AS VARCHAR))), pmid, ejemplo_id) AS k FROM ejemplos) x WHERE k <= 10")
def sample_by_hash(spark, d):
    """Ten rows of each source with the lowest seeded hash."""
    rows = read(spark, d, "ejemplos").select("ejemplo_id", "fuente", "pmid")
    return S.lowest_by_hash(rows, ["fuente"], 10, "semilla", "pmid", "ejemplo_id").select("ejemplo_id", "fuente")


@plan(f"WITH a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tf, target, pmid ORDER BY p DESC, id) AS r FROM {P._EV} e) x WHERE r = 1) SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY tf, target ORDER BY p DESC, id) AS k FROM a) y WHERE k <= 3")
def sample_distinct_articles(spark, d):
    """Up to three evidences per pair from different articles."""
    rows = P.evidence(spark, d).withColumn("p", F.when(F.col("pred").isNull(), (50 + F.col("id") % 50) / F.lit(100)).otherwise(P.N.p_of()))
    return S.distinct_articles(rows, ["tf", "target"], "pmid", [F.desc("p"), F.asc("id")], 3).select("id")


@plan("SELECT ejemplo_id FROM (SELECT ejemplo_id, k, coalesce(trim(pmid), '') AS p, min(coalesce(trim(pmid), '')) OVER (PARTITION BY k) AS low FROM (SELECT *, lower(regexp_replace(text, '[^A-Za-z0-9]+', '', 'g')) AS k FROM ejemplos) x) y WHERE p = low")
def sample_keep_lowest(spark, d):
    """A text that recurs in several articles stays in the lowest one only."""
    rows = read(spark, d, "ejemplos").withColumn("p", F.coalesce(F.trim("pmid"), F.lit("")))
    return S.keep_lowest(rows, F.lower(F.regexp_replace("text", "[^A-Za-z0-9]+", "")), "p").select("ejemplo_id")


@plan("SELECT tf, target, min(l) AS label, count(*) AS copias FROM (SELECT tf, target, lower(trim(label)) AS l FROM ejemplos) x WHERE l IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT l) = 1")
def training_labels(spark, d):
    """Pairs with a single label; those with two are dropped."""
    return S.consistent_labels(read(spark, d, "ejemplos").select("tf", "target", F.lower(F.trim("label")).alias("label")), ["tf", "target"], "label")


@plan("""WITH pos AS (SELECT DISTINCT coalesce(trim(pmid), '') AS pm FROM ejemplos WHERE lower(trim(label)) = 'activates'), cur AS (SELECT tf AS a, target AS b FROM ejemplos WHERE lower(trim(label)) = 'activates' UNION SELECT target, tf FROM ejemplos WHERE lower(trim(label)) = 'activates')
SELECT ejemplo_id FROM ejemplos e WHERE tf <> target AND coalesce(trim(pmid), '') IN (SELECT pm FROM pos) AND NOT EXISTS (SELECT 1 FROM cur WHERE cur.a = e.tf AND cur.b = e.target) ORDER BY sha256(concat_ws('|', 'n', coalesce(trim(pmid), ''), CAST(ejemplo_id AS VARCHAR))), ejemplo_id LIMIT 50""")
def training_negatives(spark, d):
    """Fifty negatives by hash, from articles with positives, curated in neither direction."""
    rows = read(spark, d, "ejemplos").select("ejemplo_id", "tf", "target", F.coalesce(F.trim("pmid"), F.lit("")).alias("pm"), F.lower(F.trim("label")).alias("l"))
    pos = rows.where("l = 'activates'")
    return S.negatives(rows, pos, pos, "pm", ["tf", "target"], 50, "n", "ejemplo_id").select("ejemplo_id")


@plan("""WITH pos AS (SELECT DISTINCT coalesce(trim(pmid), '') AS pm FROM ejemplos WHERE lower(trim(label)) = 'activates'), cur AS (SELECT tf AS a, target AS b FROM ejemplos WHERE lower(trim(label)) = 'activates' UNION SELECT target, tf FROM ejemplos WHERE lower(trim(label)) = 'activates')
SELECT ejemplo_id FROM (SELECT ejemplo_id, row_number() OVER (ORDER BY sha256(concat_ws('|', 'n', coalesce(trim(pmid), ''), CAST(ejemplo_id AS VARCHAR))), ejemplo_id) AS k FROM ejemplos e WHERE tf <> target AND coalesce(trim(pmid), '') IN (SELECT pm FROM pos) AND NOT EXISTS (SELECT 1 FROM cur WHERE cur.a = e.tf AND cur.b = e.target)) x WHERE k <= (SELECT round(1.0 * count(*)) FROM ejemplos WHERE lower(trim(label)) = 'activates')""")
def training_negatives_balanced(spark, d):
    """As many negatives by hash as there are positives, from articles with positives, curated in neither direction."""
    rows = read(spark, d, "ejemplos").select("ejemplo_id", "tf", "target", F.coalesce(F.trim("pmid"), F.lit("")).alias("pm"), F.lower(F.trim("label")).alias("l"))
    pos = rows.where("l = 'activates'")
    return S.balanced_negatives(rows, pos, pos, "pm", ["tf", "target"], "n", "ejemplo_id").select("ejemplo_id")


@plan()
def group_folds(spark, d):
    """Five folds of whole articles."""
    return S.group_folds(read(spark, d, "ejemplos").withColumn("pm", F.trim("pmid")), "pm", "label", 5)


@plan("""WITH RECURSIVE e AS (SELECT DISTINCT tf AS a, target AS b FROM ejemplos), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT DISTINCT a AS n, a AS m FROM u UNION SELECT u.b, r.m FROM r JOIN u ON u.a = r.n) SELECT n AS nodo, min(m) AS componente FROM r GROUP BY 1""")
def graph_components(spark, d):
    """G1: connected components of the pairs, the smallest name for each."""
    pairs = read(spark, d, "ejemplos").select("tf", "target").distinct().withColumn("ent", F.concat_ws("|", "tf", "target"))
    edges = pairs.select(F.col("tf").alias("node"), "ent").unionByName(pairs.select(F.col("target").alias("node"), "ent"))
    nodes = edges.select("node").distinct()
    return nodes.join(propagate(edges), "node", "left").select(F.col("node").alias("nodo"), F.coalesce("label", "node").alias("componente"))


@plan()
def group_splits(spark, d):
    """Articles go to train, validation and test as wholes, with like shares of each label."""
    e = read(spark, d, "ejemplos")
    groups = e.select("ejemplo_id", F.xxhash64(F.coalesce(F.trim("pmid"), F.concat(F.lit("?"), F.col("ejemplo_id").cast("string")))).alias("grupo_id")).dropDuplicates(["ejemplo_id"])
    return assign_splits(e, groups)


@plan()
def group_splits_balance(spark, d):
    """By how much each split's share of each label departs from the one asked for."""
    return balance(group_splits(spark, d), read(spark, d, "ejemplos"), "ejemplo_id", "label")
