"""Relational core of an incremental ingest: keyed inserts, upserts, links, deletes, coverage and listings.

Every function takes and returns DataFrames and is a pure plan. Null keys never match and are dropped from
inserts; repeated rows of a key resolve by the order given, with all columns as the last tie-break, so results
do not depend on partitioning; further columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZES = (1, 500, 50)  # least, most and default page size


def _key(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def one_per_key(df: DataFrame, keys: str | list[str], order: list[Column], last: bool = True) -> DataFrame:
    """Of each key the last (or first) row by `order`. A partial aggregate over structs: no key is gathered or sorted."""
    keys = _key(keys)
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"__o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    pick = (F.max if last else F.min)(ranked).alias("__m")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"__m.{c}").alias(c) for c in rest]).select(*df.columns)


def new_keys(requested: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys asked for and not yet known: what is left to fetch."""
    return requested.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")


def insert_absent(table: DataFrame, rows: DataFrame, keys: str | list[str], order: list[Column]) -> DataFrame:
    """The rows to append: new keys only, of each the first row by `order`."""
    keys = _key(keys)
    some = rows.where(F.expr(" and ".join(f"`{k}` is not null" for k in keys)))
    return one_per_key(some, keys, order, last=False).join(table.select(*keys).distinct(), keys, "left_anti")


def insert_links(links: DataFrame, wanted: DataFrame, documents: DataFrame, keys: list[str], document: str) -> DataFrame:
    """Links to append: whose document exists and that are not there yet."""
    return wanted.distinct().join(documents.select(document), document, "left_semi").join(links.select(*keys), keys, "left_anti")


def upsert_counting(state: DataFrame, changes: DataFrame, keys: str | list[str], counter: str) -> DataFrame:
    """State after changes (one row per key each): changed columns win where not null, `counter` grows by one per change."""
    keys = _key(keys)
    rest = [c for c in state.columns if c not in (*keys, counter)]
    s, c = state.alias("s"), changes.alias("c")
    on = [F.col(f"s.{k}") == F.col(f"c.{k}") for k in keys]
    joined = s.join(c, on, "full_outer")
    grown = F.coalesce(F.col(f"s.{counter}"), F.lit(0)) + F.when(F.col(f"c.{keys[0]}").isNotNull(), 1).otherwise(0)
    value = [F.coalesce(*([F.col(f"c.{x}")] if x in changes.columns else []), F.col(f"s.{x}")).alias(x) for x in rest]
    return joined.select(*[F.coalesce(f"s.{k}", f"c.{k}").alias(k) for k in keys], *value, grown.alias(counter)).select(*state.columns)


def fill_empty(df: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """`column` filled from `values` (key, column) only where it is null or blank."""
    given = values.groupBy(key).agg(F.min(column).alias("__given"))
    empty = F.col(column).isNull() | (F.trim(column) == "")
    return df.join(given, key, "left").withColumn(column, F.when(empty, F.coalesce("__given", column)).otherwise(F.col(column))).drop("__given")


def update_given(df: DataFrame, changes: dict[str, object], editable: set[str], where: Column) -> DataFrame:
    """Set the given columns of the rows `where` holds; None leaves a column, others than `editable` are refused."""
    if wrong := set(changes) - editable:
        raise ValueError(f"not editable: {sorted(wrong)}")
    return df.withColumns({c: F.when(where, F.lit(v).cast(dict(df.dtypes)[c])).otherwise(F.col(c)) for c, v in changes.items() if v is not None})


def delete_cascade(tables: dict[str, DataFrame], keys: DataFrame, key: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every table without the rows of `keys`, and how many each loses: (tabla, n)."""
    gone = keys.select(key).distinct()
    kept = {n: t.join(gone, key, "left_anti") for n, t in tables.items()}
    lost = [t.join(gone, key, "left_semi").groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("tabla"), "n") for n, t in tables.items()]
    out = lost[0]
    for x in lost[1:]:
        out = out.unionByName(x)
    return kept, out


def coverage(documents: DataFrame, texts: DataFrame, key: str, has_abstract: Column) -> DataFrame:
    """(cobertura, n): every document once, as complete (full text), abstract only, or none."""
    full = texts.select(key).distinct().withColumn("__full", F.lit(True))
    kind = F.when(F.col("__full"), "completo").when(has_abstract, "resumen").otherwise("ninguno")
    return documents.join(full, key, "left").select(kind.alias("cobertura")).groupBy("cobertura").agg(F.count(F.lit(1)).alias("n"))


def pending(documents: DataFrame, downloads: DataFrame, key: str, kind: str, retry: bool = False) -> DataFrame:
    """Documents without a download of `kind` (with `retry`, also those in error), with a flag if another kind is there."""
    mine = downloads.where(F.col("tipo") == kind).select(key, F.col("estado").alias("__mine"))
    other = downloads.where((F.col("tipo") != kind) & (F.col("estado") == "ok")).select(key).distinct().withColumn("__other", F.lit(True))
    left = documents.join(mine, key, "left").where(F.col("__mine").isNull() | (F.lit(retry) & (F.col("__mine") == "error")))
    return left.join(other, key, "left").withColumn("otro_listo", F.coalesce("__other", F.lit(False))).drop("__mine", "__other")


def contains_text(df: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """Rows where any column contains the text, whatever its case; wildcards in it are ordinary characters."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(text.lower())), F.lit(False))
    return df.where(hit)


def page(df: DataFrame, order: list[Column], number: int | None = 1, size: int | None = None) -> DataFrame:
    """One page in order; the page number is at least 1, the size between 1 and 500 (50 if not given)."""
    least, most, usual = SIZES
    n = min(max(size if size is not None else usual, least), most)
    return df.orderBy(*order).offset((max(number or 1, 1) - 1) * n).limit(n)


def content_hash(df: DataFrame, group: list[str], key: str, digits: int = 16) -> DataFrame:
    """Fingerprint of the set of keys of each group (sha-256 of the sorted keys, one per line)."""
    sets = df.where(F.col(key).isNotNull()).groupBy(*group).agg(F.sort_array(F.collect_set(key)).alias("__k"))
    return sets.select(*group, F.size("__k").alias("n"), F.substring(F.sha2(F.array_join("__k", "\n"), 256), 1, digits).alias("huella"))
