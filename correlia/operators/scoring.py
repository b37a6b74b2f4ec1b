"""Scoring through injected models: only what has no score yet, in Arrow batches, with the answers checked."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from correlia.operators.network import CLASSES

SCORES = ", ".join(f"p_{c} double" for c in CLASSES)


def to_score(rows: DataFrame, cache: DataFrame, text: str, signature: str) -> DataFrame:
    """Distinct texts (clave, text) that the model of this signature has not scored."""
    keyed = rows.where(F.col(text).isNotNull()).select(F.sha2(F.col(text), 256).alias("clave"), F.col(text)).dropDuplicates(["clave"])
    return keyed.join(cache.where(F.col("firma") == signature).select("clave"), "clave", "left_anti")


def score(texts: DataFrame, text: str, model: Callable[[list[str]], list[list[float]]], signature: str, batch: int = 64) -> DataFrame:
    """(clave, firma, one probability per class, pred). The model gets lists of at most `batch` texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found: list[list[float]] = []
            asked = pdf[text].tolist()
            for i in range(0, len(asked), batch):
                got = model(asked[i : i + batch])
                if len(got) != len(asked[i : i + batch]) or any(len(p) != len(CLASSES) for p in got):
                    raise ValueError("the model must give one probability per class and text")
                found += got
            out = pd.DataFrame(found, columns=[f"p_{c}" for c in CLASSES], index=pdf.index, dtype="float64")
            out.insert(0, "clave", pdf["clave"])
            yield out

    raw = texts.select("clave", text).mapInPandas(run, f"clave string, {SCORES}")
    top = F.greatest(*[F.col(f"p_{c}") for c in CLASSES])
    pred = F.lit(CLASSES[-1])
    for c in reversed(CLASSES[:-1]):
        pred = F.when(F.col(f"p_{c}") == top, c).otherwise(pred)
    return raw.select("clave", F.lit(signature).alias("firma"), *[f"p_{c}" for c in CLASSES], pred.alias("pred"))


def with_scores(rows: DataFrame, scores: DataFrame, text: str, signature: str) -> DataFrame:
    """Rows with the scores of their text; those without a score keep nulls."""
    return rows.withColumn("clave", F.sha2(F.col(text), 256)).join(scores.where(F.col("firma") == signature).drop("firma"), "clave", "left")


def broken_rules() -> Column:
    """Names of the annotation rules a row (relacion, direccion, signo, negada, especulativa, comentario) breaks, in order."""
    c = F.col
    rules = [
        ("relacion_desconocida", ~F.coalesce(c("relacion").isin("si", "no", "dudoso"), F.lit(False))),
        ("no_sin_ninguna", (c("relacion") == "no") & (F.coalesce(c("direccion"), F.lit("")) != "ninguna")),
        ("no_con_signo", (c("relacion") == "no") & (F.coalesce(c("signo"), F.lit("")) != "")),
        ("sin_direccion", c("relacion").isin("si", "dudoso") & ~F.coalesce(c("direccion").isin("1>2", "2>1"), F.lit(False))),
        ("signo_desconocido", c("relacion").isin("si", "dudoso") & ~F.coalesce(c("signo").isin("+", "-", "?"), F.lit(False))),
        ("falta_negada", ~F.coalesce(c("negada").isin("si", "no"), F.lit(False))),
        ("falta_especulativa", ~F.coalesce(c("especulativa").isin("si", "no"), F.lit(False))),
        ("si_negada", (c("relacion") == "si") & (c("negada") == "si")),
        ("aviso_dudoso_sin_comentario", (c("relacion") == "dudoso") & (F.coalesce(F.trim(c("comentario")), F.lit("")) == "")),
        ("aviso_si_especulativa", (c("relacion") == "si") & (c("especulativa") == "si")),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), name) for name, test in rules]))


def integrity(tables: dict[str, DataFrame], links: list[tuple[str, str, str, str]]) -> DataFrame:
    """(regla, n): for each link (child, column, parent, key) the child rows that are null there and that have no parent."""
    out = None
    for child, column, parent, key in links:
        c = tables[child].select(F.col(column).alias("k"))
        orphans = c.where("k is not null").join(tables[parent].select(F.col(key).alias("k")).distinct(), "k", "left_anti")
        for name, df in ((f"{child}.{column}:nulo", c.where("k is null")), (f"{child}.{column}:huerfano", orphans)):
            row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("regla"), "n")
            out = row if out is None else out.unionByName(row)
    return out


def check_labels(declared: dict[int, str]) -> None:
    """A model's labels must be the classes, in the order its scores are read in."""
    said = [declared.get(i) for i in range(len(CLASSES))]
    if len(declared) != len(CLASSES) or said != CLASSES:
        raise ValueError(f"the model's labels {declared} are not {dict(enumerate(CLASSES))}")


def valid_annotation(said: str, text: str) -> Column:
    """Why an annotator's answer is no use: none, unreadable, or quoting words the text does not have; null if it is of use."""
    quoted = F.get_json_object(said, "$.fragmento")
    return F.when(F.col(said).isNull(), "abstencion").when(F.get_json_object(said, "$.relacion").isNull(), "ilegible").when(quoted.isNotNull() & ~F.contains(F.col(text), quoted), "fragmento_ajeno")
