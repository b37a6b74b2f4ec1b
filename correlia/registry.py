"""Queries of the core and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from correlia.operators import packed_values
from correlia.plans import evaluation, extraction, ingest, linguistic, network, operons, sampling, verification  # noqa: F401  (they register their queries)
from correlia.plans.base import ORACLE, QUERIES, plan
from correlia.runtime import read


@plan()
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Every value of the packed list cells, one per row with its position."""
    return packed_values.split_values(packed_values.project_cells(read(spark, d, "documentos"), read(spark, d, "operones_bronze")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.directed_pairs(spark, sf_dir)


__all__ = ["ORACLE", "QUERIES", "flagship"]
