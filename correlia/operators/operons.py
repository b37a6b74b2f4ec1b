"""Gene groups: curation by gene set, adjacency along a chromosome, strict subsets, names and loci."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def set_key(genes: Column) -> Column:
    """Sorted distinct genes joined by |; null for none."""
    clean = F.array_sort(F.array_distinct(F.filter(genes, lambda x: x.isNotNull() & (x != ""))))
    return F.nullif(F.array_join(clean, "|"), F.lit(""))


def curate(rows: DataFrame) -> DataFrame:
    """One row per gene set of (fuente, genes, nivel, pmids, cadena): best level (least), sources, articles, strands, marks."""
    out = rows.withColumn("clave", set_key(F.col("genes"))).where("clave is not null").groupBy("clave").agg(
        F.count(F.lit(1)).alias("n"), F.min("nivel").alias("nivel"), F.array_join(F.array_sort(F.collect_set("fuente")), ";").alias("fuentes"),
        F.size(F.array_distinct(F.flatten(F.collect_set("pmids")))).alias("n_articulos"), F.count_distinct("cadena").alias("n_hebras"), F.max(F.size("pmids") > 0).alias("con_cita"),
    )
    return out.withColumn("hebra", F.when(F.col("n_hebras") == 0, "no_verificada").when(F.col("n_hebras") == 1, "unica").otherwise("distintas")).withColumn("n_genes", F.size(F.split("clave", r"\|")))


def islands(genes: DataFrame, group: list[str], position: str) -> DataFrame:
    """Runs of consecutive positions: (group, isla, desde, hasta, n). Gaps and islands over a window of each group."""
    one = genes.select(*group, position).where(F.col(position).isNotNull()).distinct()
    w = W.partitionBy(*group).orderBy(position)
    cut = F.coalesce((F.col(position) - F.lag(position).over(w) > 1).cast("int"), F.lit(1))
    numbered = one.withColumn("__cut", cut).withColumn("isla", F.sum("__cut").over(w))
    return numbered.groupBy(*group, "isla").agg(F.min(position).alias("desde"), F.max(position).alias("hasta"), F.count(F.lit(1)).alias("n"))


def runs_within(found: DataFrame, group: list[str], longest: int | None = None) -> DataFrame:
    """Every consecutive run of 2 or more positions inside an island, up to `longest` if given."""
    start = F.explode(F.sequence(F.col("desde"), F.col("hasta") - 1))
    some = found.where("n > 1").select(*group, "isla", "hasta", start.alias("ini"))
    last = F.col("hasta") if longest is None else F.least(F.col("hasta"), F.col("ini") + longest - 1)
    return some.select(*group, "isla", "ini", F.explode(F.sequence(F.col("ini") + 1, last)).alias("fin"))


def strict_subsets(groups: DataFrame) -> DataFrame:
    """Keys (clave, genes) whose set lies strictly within another's: (clave, contenida_en = smallest such key).

    Candidates come from the rarest gene of the smaller set only: a set within another must share that gene too.
    """
    g = groups.select("clave", F.array_distinct("genes").alias("genes")).dropDuplicates(["clave"])
    members = g.select("clave", F.explode("genes").alias("gen"))
    often = members.groupBy("gen").agg(F.count(F.lit(1)).alias("n"))
    rare = members.join(often, "gen").groupBy("clave").agg(F.min(F.struct("n", "gen")).alias("m")).select("clave", F.col("m.gen").alias("gen"))
    small = rare.join(g, "clave").select(F.col("clave").alias("menor"), "gen", F.col("genes").alias("a"))
    pairs = small.join(members.withColumnRenamed("clave", "mayor"), "gen").where("menor <> mayor").join(g.select(F.col("clave").alias("mayor"), F.col("genes").alias("b")), "mayor")
    inside = pairs.where((F.size("a") < F.size("b")) & (F.size(F.array_except("a", "b")) == 0))
    return inside.groupBy(F.col("menor").alias("clave")).agg(F.min("mayor").alias("contenida_en"), F.count(F.lit(1)).alias("n_mayores"))


def group_rows(rows: DataFrame, group: str, order: str, member: str) -> DataFrame:
    """One row per group from one row per member, the members in order."""
    return rows.groupBy(group).agg(F.transform(F.sort_array(F.collect_list(F.struct(order, member))), lambda x: x[member]).alias("miembros"))


def operon_name(genes: Column) -> Column:
    """`mexA, mexB, oprM` as `mexAB-oprM`: genes that share their first three letters run together."""
    fold = lambda a, x: F.when(F.substring(a, -1, 1).isNull() | (a == ""), x).when(
        F.substring(F.element_at(F.split(a, "-"), -1), 1, 3) == F.substring(x, 1, 3), F.concat(a, F.substring(x, 4, 100))
    ).otherwise(F.concat(a, F.lit("-"), x))
    return F.aggregate(genes, F.lit(""), fold)


def decompose_name(name: Column) -> Column:
    """`mexAB-oprM` as `mexA, mexB, oprM`; parts that are no gene names stay as they are."""
    def part(x: Column) -> Column:
        stem, letters = F.substring(x, 1, 3), F.regexp_extract(x, r"^[a-z]{3}([A-Z]+)$", 1)
        return F.when(x.rlike(r"^[a-z]{3}[A-Z]{2,}$"), F.transform(F.sequence(F.lit(1), F.greatest(F.length(letters), F.lit(1))), lambda i: F.concat(stem, F.substr(letters, i, F.lit(1))))).otherwise(F.array(x))

    return F.filter(F.flatten(F.transform(F.split(name, "-"), part)), lambda x: x != "")
