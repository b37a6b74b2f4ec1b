"""Queries over the problem tables that belong to this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from correlia.llm import consensus, cooccur, leakage, overlap, packing, quality, sentences, splits
from correlia.runtime import durable, read


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.connected_groups(read(spark, d, "ejemplos"))


def p1_splits(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "ejemplos")
    return splits.assign_splits(rows, durable(splits.connected_groups(rows)))


def p1_balance(spark: SparkSession, d: str) -> DataFrame:
    """Rows and groups of each split and label."""
    rows = read(spark, d, "ejemplos")
    label = F.coalesce(F.nullif(F.lower(F.trim("label")), F.lit("")), F.lit("(none)")).alias("label")
    return p1_splits(spark, d).join(rows.select("ejemplo_id", label), "ejemplo_id").groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("grupo_id").alias("n_grupos"))


def p1_deviation(spark: SparkSession, d: str) -> DataFrame:
    """Per split and label: rows, share of the label's rows, share asked for, difference."""
    return splits.balance(p1_splits(spark, d), read(spark, d, "ejemplos"), "ejemplo_id", "label")


def p2_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Every sentence with its order, offsets and text."""
    return sentences.cut_sentences(sentences.project_texts(read(spark, d, "documentos"), read(spark, d, "texto_unidades")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_sentences(spark, d).select("origen", "clave", "offset_ini", "offset_fin")


def p4_pairs(spark: SparkSession, d: str) -> DataFrame:
    ents = cooccur.sentence_entities(read(spark, d, "oraciones_candidatas"), read(spark, d, "menciones"))
    return cooccur.pair_counts(ents, "unidad_id", "entidad").select(F.col("a").alias("entidad_a"), F.col("b").alias("entidad_b"), "n_ab", "n_a", "n_b", F.col("n_records").alias("n_oraciones"), F.round("lift", 6).alias("lift"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    ents = cooccur.sentence_entities(read(spark, d, "oraciones_candidatas"), read(spark, d, "menciones"))
    counted = cooccur.pair_counts(ents, "unidad_id", "entidad", min_count=4)
    often = F.col("n_ab") * F.col("n_records") >= 4 * F.col("n_a") * F.col("n_b")
    return counted.where(often).select(F.col("a").alias("entidad_a"), F.col("b").alias("entidad_b"))


def _overlap(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = overlap.sided_rows(read(spark, d, "ejemplos"))
    classes = overlap.classes_of(rows)
    return rows, classes, overlap.links(rows, classes)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.row_pairs(*_overlap(spark, d))


def p5_links(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of classes of equal texts that match (clase_held, clase_train): every link between different texts once."""
    return _overlap(spark, d)[2].select(F.col("held").alias("clase_held"), F.col("train").alias("clase_train"))


def p5_members(spark: SparkSession, d: str) -> DataFrame:
    """Side and class of every row: with p5_links it says what p5_found writes out pair by pair."""
    rows, classes, _ = _overlap(spark, d)
    return overlap.members(rows, classes).select(F.col("id").alias("ejemplo_id"), F.col("side").alias("lado"), "clase")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Evaluation rows with a match in training, by split and source."""
    rows, classes, linked = _overlap(spark, d)
    held = overlap.members(rows, classes).where("side = 'held'")
    hit = held.join(linked.select(F.col("held").alias("clase")).distinct(), "clase", "left_semi").select(F.col("id").alias("ejemplo_id"), F.lit(1).alias("hit"))
    all_held = read(spark, d, "ejemplos").where("particion in ('dev', 'test')").select("ejemplo_id", "particion", F.coalesce("fuente", F.lit("(none)")).alias("fuente")).dropDuplicates(["ejemplo_id"])
    return all_held.join(hit, "ejemplo_id", "left").groupBy("particion", "fuente").agg(F.count(F.lit(1)).alias("n_filas"), F.count("hit").alias("n_repetidas"))


def _labels(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return consensus.label_items(read(spark, d, "muestra_precision_50"), read(spark, d, "juicio_consolidado"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d)[0].select("id_item", "campo", "valor")


def p6_annotators(spark: SparkSession, d: str) -> DataFrame:
    return _labels(spark, d)[1]


def p6_agreement(spark: SparkSession, d: str) -> DataFrame:
    return consensus.agreement(read(spark, d, "muestra_precision_50"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Container, place and first token of every piece of every text."""
    return packing.pack(read(spark, d, "documents"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(p7_containers(spark, d))


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Leaked items per document, with the share of the item that is covered."""
    return leakage.find_leaks(read(spark, d, "documents"), read(spark, d, "items_evaluacion"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).select("doc_id", "item_id")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """Leaks by source and task."""
    where = read(spark, d, "documents").select("doc_id", "source").dropDuplicates(["doc_id"])
    task = read(spark, d, "items_evaluacion").select("item_id", "tarea").dropDuplicates(["item_id"])
    hits = p8_leaks(spark, d).join(where, "doc_id").join(task, "item_id")
    return hits.groupBy("source", "tarea").agg(F.countDistinct("doc_id").alias("n_documentos"), F.countDistinct("item_id").alias("n_items"))


def p9_stats(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_statistics(read(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_stats(spark, d).where("no_prosa > 0.5").select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_splits, p1_balance, p1_deviation, p2_found, p2_sentences, p4_found, p4_pairs, p5_found, p5_links, p5_members, p5_report, p6_found, p6_annotators, p6_agreement, p7_containers, p7_fill, p8_found, p8_leaks, p8_report, p9_found, p9_stats)
}
