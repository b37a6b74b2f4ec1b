"""Queries that check a run: summary, integrity, funnel, difference to another run, annotation rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from correlia.operators import scoring as R
from correlia.plans.base import plan
from correlia.runtime import read

_TABLES = ("texto_unidades", "menciones", "oraciones_candidatas", "documentos")


@plan("""SELECT 'menciones.unidad_id:nulo' AS regla, count(*) AS n FROM menciones WHERE unidad_id IS NULL UNION ALL SELECT 'menciones.unidad_id:huerfano', count(*) FROM menciones WHERE unidad_id IS NOT NULL AND unidad_id NOT IN (SELECT id FROM texto_unidades)
UNION ALL SELECT 'oraciones_candidatas.unidad_id:nulo', count(*) FROM oraciones_candidatas WHERE unidad_id IS NULL UNION ALL SELECT 'oraciones_candidatas.unidad_id:huerfano', count(*) FROM oraciones_candidatas WHERE unidad_id IS NOT NULL AND unidad_id NOT IN (SELECT id FROM texto_unidades)
UNION ALL SELECT 'texto_unidades.pmid:nulo', count(*) FROM texto_unidades WHERE pmid IS NULL UNION ALL SELECT 'texto_unidades.pmid:huerfano', count(*) FROM texto_unidades WHERE pmid IS NOT NULL AND pmid NOT IN (SELECT pmid FROM documentos WHERE pmid IS NOT NULL)""")
def verify_integrity(spark, d):
    """Rows without parent, and nulls, of every link."""
    tables = {t: read(spark, d, t) for t in _TABLES}
    return R.integrity(tables, [("menciones", "unidad_id", "texto_unidades", "id"), ("oraciones_candidatas", "unidad_id", "texto_unidades", "id"), ("texto_unidades", "pmid", "documentos", "pmid")])


@plan("""SELECT corrida_id, count(*) AS unidades, count(DISTINCT pmid) AS documentos, count(CASE WHEN seccion IS NULL THEN 1 END) AS sin_seccion, count(CASE WHEN NOT contiguo THEN 1 END) AS no_contiguas, count(CASE WHEN length(texto) NOT BETWEEN 40 AND 700 THEN 1 END) AS fuera_de_largo, count(CASE WHEN fuente_texto = 'pdf' THEN 1 END) AS de_pdf FROM texto_unidades GROUP BY 1""")
def verify_run_summary(spark, d):
    """A5: counts of each run in one pass."""
    u = read(spark, d, "texto_unidades")
    return u.groupBy("corrida_id").agg(
        F.count(F.lit(1)).alias("unidades"), F.count_distinct("pmid").alias("documentos"), F.count_if(F.col("seccion").isNull()).alias("sin_seccion"), F.count_if(~F.col("contiguo")).alias("no_contiguas"),
        F.count_if(~F.length("texto").between(40, 700)).alias("fuera_de_largo"), F.count_if(F.col("fuente_texto") == "pdf").alias("de_pdf"),
    )


@plan("""SELECT 'documentos' AS paso, count(DISTINCT pmid) AS n FROM documentos UNION ALL SELECT 'unidades', count(DISTINCT id) FROM texto_unidades UNION ALL SELECT 'con_mencion', count(DISTINCT unidad_id) FROM menciones UNION ALL SELECT 'candidatas', count(DISTINCT unidad_id) FROM oraciones_candidatas UNION ALL SELECT 'con_par', count(DISTINCT unidad_id) FROM oraciones_candidatas WHERE regulador_candidato <> '' AND blanco_candidato <> ''""")
def verify_funnel(spark, d):
    """Q26: how much is left after each step."""
    o = read(spark, d, "oraciones_candidatas")
    steps = [("documentos", read(spark, d, "documentos"), "pmid"), ("unidades", read(spark, d, "texto_unidades"), "id"), ("con_mencion", read(spark, d, "menciones"), "unidad_id"), ("candidatas", o, "unidad_id"), ("con_par", o.where("regulador_candidato <> '' and blanco_candidato <> ''"), "unidad_id")]
    rows = [t.agg(F.count_distinct(k).alias("n")).select(F.lit(n).alias("paso"), "n") for n, t, k in steps]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@plan("""WITH a AS (SELECT unidad_id, max(score) AS s FROM oraciones_candidatas WHERE corrida_id = 1 GROUP BY 1), b AS (SELECT unidad_id, max(score) AS s FROM oraciones_candidatas WHERE corrida_id > 1 GROUP BY 1) SELECT CASE WHEN b.unidad_id IS NULL THEN 'solo_antes' WHEN a.unidad_id IS NULL THEN 'solo_ahora' WHEN a.s = b.s THEN 'igual' ELSE 'cambia' END AS estado, count(*) AS n FROM a FULL JOIN b ON a.unidad_id = b.unidad_id GROUP BY 1""")
def verify_run_diff(spark, d):
    """Q26/Q29: what changed between one run and the later ones."""
    o = read(spark, d, "oraciones_candidatas")
    a = o.where("corrida_id = 1").groupBy("unidad_id").agg(F.max("score").alias("a"), F.lit(True).alias("in_a"))
    b = o.where("corrida_id > 1").groupBy("unidad_id").agg(F.max("score").alias("b"), F.lit(True).alias("in_b"))
    state = F.when(F.col("in_b").isNull(), "solo_antes").when(F.col("in_a").isNull(), "solo_ahora").when(F.col("a") == F.col("b"), "igual").otherwise("cambia")
    return a.join(b, "unidad_id", "full_outer").select(state.alias("estado")).groupBy("estado").agg(F.count(F.lit(1)).alias("n"))


@plan("""SELECT id_item, regla FROM (SELECT id_item, unnest([CASE WHEN rel IS NULL OR rel NOT IN ('si', 'no', 'dudoso') THEN 'relacion_desconocida' END, CASE WHEN rel = 'no' AND coalesce(signo, '') <> '' THEN 'no_con_signo' END, CASE WHEN rel IN ('si', 'dudoso') AND (signo IS NULL OR signo NOT IN ('+', '-', '?')) THEN 'signo_desconocido' END]) AS regla FROM (SELECT id_item, trim(relacion) AS rel, trim(signo_correcto) AS signo FROM juicio_consolidado) x) y WHERE regla IS NOT NULL""")
def verify_annotation_rules(spark, d):
    """M5: annotation rules that settled rows break, as they are spelled."""
    j = read(spark, d, "juicio_consolidado").select("id_item", F.trim("relacion").alias("relacion"), F.trim("signo_correcto").alias("signo"), F.when(F.trim("relacion") == "no", "ninguna").otherwise("1>2").alias("direccion"), F.lit("no").alias("negada"), F.lit("no").alias("especulativa"), F.lit("-").alias("comentario"))
    return j.select("id_item", F.explode(R.broken_rules()).alias("regla"))
