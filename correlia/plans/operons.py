"""Queries over the gene groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from correlia.functions import text as X
from correlia.operators import operons as O
from correlia.operators import packed_values as V
from correlia.operators.sampling import ranked
from correlia.plans.base import plan
from correlia.runtime import read

_LOCI = "(SELECT id, id_fuente, split_part(id_fuente, '-', 1) AS fuente, cadena, tipo_evidencia, pmid, regexp_extract_all(coalesce(locus_tags, ''), 'PA\\d+(?:\\.\\d+)?') AS genes FROM operones_bronze)"


def loci(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "operones_bronze")
    genes = F.regexp_extract_all(F.coalesce("locus_tags", F.lit("")), F.lit(r"(PA\d+(?:\.\d+)?)"), 1)
    return o.select("id", "id_fuente", F.split_part("id_fuente", F.lit("-"), F.lit(1)).alias("fuente"), "cadena", "tipo_evidencia", "pmid", genes.alias("genes"))


def gene_values(spark: SparkSession, d: str) -> DataFrame:
    """(id, posicion, valor): the names of genes_raw, whatever their notation."""
    o = read(spark, d, "operones_bronze")
    v = V.split_values(o.select(F.lit("genes_raw").alias("campo"), F.col("id").cast("string").alias("clave"), F.col("genes_raw").alias("cell")))
    return v.select(F.col("clave").cast("long").alias("id"), "posicion", "valor")


_KEY = "array_to_string(list_sort(list_distinct(genes)), '|')"


@plan(f"""WITH r AS (SELECT {_KEY} AS clave, fuente, cadena, CASE WHEN tipo_evidencia = 'curada' THEN 1 WHEN tipo_evidencia IS NULL THEN 3 ELSE 2 END AS nivel, list_filter(regexp_extract_all(coalesce(pmid, ''), '\\d+'), lambda x: length(x) BETWEEN 7 AND 8) AS pmids FROM {_LOCI} l WHERE len(genes) > 0)
SELECT clave, count(*) AS n, min(nivel) AS nivel, string_agg(DISTINCT fuente, ';' ORDER BY fuente) AS fuentes, len(list_distinct(flatten(list(pmids)))) AS n_articulos, CASE count(DISTINCT cadena) WHEN 0 THEN 'no_verificada' WHEN 1 THEN 'unica' ELSE 'distintas' END AS hebra, bool_or(len(pmids) > 0) AS con_cita, len(string_split(clave, '|')) AS n_genes FROM r GROUP BY clave""")
def operon_silver(spark, d):
    """One row per gene set with the best level, its sources, articles and strands."""
    level = F.when(F.col("tipo_evidencia") == "curada", 1).when(F.col("tipo_evidencia").isNull(), 3).otherwise(2)
    pmids = F.coalesce(X.article_ids("pmid"), F.array().cast("array<string>"))
    rows = loci(spark, d).where("size(genes) > 0").select("fuente", "genes", level.alias("nivel"), pmids.alias("pmids"), "cadena")
    return O.curate(rows).select("clave", "n", "nivel", "fuentes", "n_articulos", "hebra", "con_cita", "n_genes")


_POS = f"(SELECT DISTINCT id_fuente, CAST(regexp_extract(g, 'PA(\\d+)', 1) AS INTEGER) AS pos FROM (SELECT id_fuente, unnest(genes) AS g FROM {_LOCI} l) x)"
_ISL = f"(SELECT id_fuente, isla, min(pos) AS desde, max(pos) AS hasta, count(*) AS n FROM (SELECT id_fuente, pos, sum(c) OVER (PARTITION BY id_fuente ORDER BY pos) AS isla FROM (SELECT id_fuente, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY id_fuente ORDER BY pos) > 1 THEN 1 WHEN lag(pos) OVER (PARTITION BY id_fuente ORDER BY pos) IS NULL THEN 1 ELSE 0 END AS c FROM {_POS} p) y) z GROUP BY 1, 2)"


def positions(spark: SparkSession, d: str) -> DataFrame:
    return loci(spark, d).select("id_fuente", F.explode("genes").alias("g")).select("id_fuente", F.regexp_extract("g", r"PA(\d+)", 1).cast("int").alias("pos"))


@plan(f"SELECT id_fuente, isla, desde, hasta, n FROM {_ISL} i")
def operon_islands(spark, d):
    """Runs of neighbouring genes of each group."""
    return O.islands(positions(spark, d), ["id_fuente"], "pos")


@plan(f"SELECT i.id_fuente, a.x AS ini, b.x AS fin FROM {_ISL} i JOIN range(0, 9999) a(x) ON a.x >= i.desde AND a.x < i.hasta JOIN range(0, 9999) b(x) ON b.x > a.x AND b.x <= least(i.hasta, a.x + 4) WHERE i.n > 1")
def operon_runs(spark, d):
    """Every run of two to five neighbours within an island."""
    return O.runs_within(O.islands(positions(spark, d), ["id_fuente"], "pos"), ["id_fuente"], 5).select("id_fuente", "ini", "fin")


@plan(f"SELECT id_fuente, a AS ini, unnest(range(a + 1, hasta + 1)) AS fin FROM (SELECT id_fuente, hasta, unnest(range(desde, hasta)) AS a FROM {_ISL} i WHERE n > 1) x")
def operon_runs_whole(spark, d):
    """Every run of two or more neighbours within an island."""
    return O.runs_within(O.islands(positions(spark, d), ["id_fuente"], "pos"), ["id_fuente"]).select("id_fuente", "ini", "fin")


@plan(f"WITH g AS (SELECT DISTINCT {_KEY} AS clave, list_distinct(genes) AS genes FROM {_LOCI} l WHERE len(genes) > 0), k AS (SELECT clave, any_value(genes) AS genes FROM g GROUP BY 1) SELECT a.clave, min(b.clave) AS contenida_en, count(*) AS n_mayores FROM k a JOIN k b ON a.clave <> b.clave AND len(a.genes) < len(b.genes) AND list_has_all(b.genes, a.genes) GROUP BY 1")
def operon_subsets(spark, d):
    """Gene sets that lie within a larger one."""
    rows = loci(spark, d).where("size(genes) > 0").select(O.set_key(F.col("genes")).alias("clave"), "genes")
    return O.strict_subsets(rows)


@plan(f"SELECT g AS gen, count(DISTINCT id_fuente) AS n_grupos, string_agg(DISTINCT id_fuente, ';' ORDER BY id_fuente) AS grupos FROM (SELECT id_fuente, unnest(genes) AS g FROM {_LOCI} l) x GROUP BY 1")
def operon_membership(spark, d):
    """Groups of each gene."""
    m = loci(spark, d).select("id_fuente", F.explode("genes").alias("gen"))
    return m.groupBy("gen").agg(F.count_distinct("id_fuente").alias("n_grupos"), F.array_join(F.array_sort(F.collect_set("id_fuente")), ";").alias("grupos"))


@plan(f"SELECT id_fuente, string_agg(g, '|' ORDER BY id, g) AS miembros FROM (SELECT id, id_fuente, unnest(genes) AS g FROM {_LOCI} l) x GROUP BY 1")
def operon_from_rows(spark, d):
    """One row per group from one row per gene, in order."""
    rows = loci(spark, d).select("id", "id_fuente", F.explode("genes").alias("g"))
    return O.group_rows(rows, "id_fuente", "id", "g").select("id_fuente", F.array_join("miembros", "|").alias("miembros"))


@plan(f"SELECT id, fuente, coalesce(len(list_intersect(genes, lag(genes) OVER w)), 0) AS comunes, len(list_distinct(genes)) AS n FROM {_LOCI} l WINDOW w AS (PARTITION BY fuente, cadena ORDER BY id)")
def operon_set_overlap(spark, d):
    """Genes an entry shares with the one fetched before it from the same source and strand."""
    from pyspark.sql import Window as W

    before = F.lag("genes").over(W.partitionBy("fuente", "cadena").orderBy("id"))
    return loci(spark, d).select("id", "fuente", F.when(before.isNotNull(), F.size(F.array_intersect("genes", before))).otherwise(0).alias("comunes"), F.size(F.array_distinct("genes")).alias("n"))


@plan("SELECT id_fuente, CAST(split_part(id_fuente, '-', 2) AS INTEGER) AS num FROM operones_bronze WHERE id_fuente LIKE 'ODB-%' GROUP BY ALL ORDER BY num LIMIT 25")
def operon_natural_order(spark, d):
    """T5: the first entries of a source in natural order."""
    o = read(spark, d, "operones_bronze").where("id_fuente like 'ODB-%'").select("id_fuente", F.split_part("id_fuente", F.lit("-"), F.lit(2)).cast("int").alias("num")).distinct()
    return o.orderBy("num").limit(25)


@plan("""SELECT fuente, id_fuente, row_number() OVER (ORDER BY fuente, num = '', length(ltrim(num, '0')), ltrim(num, '0'), id_fuente) AS puesto FROM (SELECT DISTINCT split_part(id_fuente, '-', 1) AS fuente, id_fuente, regexp_extract(id_fuente, '([0-9]+)$', 1) AS num FROM operones_bronze WHERE id_fuente IS NOT NULL) x""")
def operon_natural_rank(spark, d):
    """T5: place of every entry of every source in natural order; ids that end in no number come last."""
    o = read(spark, d, "operones_bronze").where("id_fuente is not null").select("id_fuente").distinct()
    num = F.regexp_extract("id_fuente", "([0-9]+)$", 1)
    # Numbers of any length compare as text by length, then digits.
    o = o.select(F.split_part("id_fuente", F.lit("-"), F.lit(1)).alias("fuente"), "id_fuente", (num == "").alias("sin"), F.regexp_replace(num, "^0+", "").alias("num"))
    block = F.struct("fuente", "sin", F.length("num").alias("n"), F.expr("left(num, length(num) - 3)").alias("miles"))
    return ranked(o, block, ["num", "id_fuente"], "puesto").select("fuente", "id_fuente", "puesto")


@plan()
def operon_names(spark, d):
    """Short names of groups from their genes."""
    v = gene_values(spark, d).where(F.col("valor").rlike("^[a-z]{3}[A-Z]$"))
    genes = v.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("posicion", "valor"))), lambda x: x["valor"]).alias("genes"))
    o = read(spark, d, "operones_bronze").where("genes_raw is not null").select("id")
    return o.join(genes, "id", "left").select("id", F.coalesce(O.operon_name(F.col("genes")), F.lit("")).alias("nombre"))


@plan("SELECT json_extract_string(registro_raw, '$.fuente') AS fuente, json_extract_string(registro_raw, '$.definition') AS definicion, count(*) AS n FROM operones_bronze WHERE registro_raw IS NOT NULL GROUP BY 1, 2")
def operon_raw_fields(spark, d):
    """Raw records: fields read from JSON."""
    o = read(spark, d, "operones_bronze").where("registro_raw is not null")
    return o.groupBy(F.get_json_object("registro_raw", "$.fuente").alias("fuente"), F.get_json_object("registro_raw", "$.definition").alias("definicion")).agg(F.count(F.lit(1)).alias("n"))
