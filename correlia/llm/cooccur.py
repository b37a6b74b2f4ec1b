"""Items that appear together (problem 4): pair counts by heavy-light decomposition, with lift.

An item is heavy if it makes at least HEAVY_SHARE of all occurrences, so at most 1 / HEAVY_SHARE items are.
Blocks of records are counted in three ways and united: heavy-heavy pairs by popcounts over a dense bit
matrix, heavy-light pairs by probing the bit matrix with each light item's list of records, light-light pairs
in a hash table. Every block adds up its own counts before the shuffle. Items rarer than the least pair count
cannot be in a result and are dropped first, which loses no pair.

A record of more than PIECE items is cut into pieces and every two of its pieces are counted together in a
task of their own, so no task holds an unbounded record.

Defined cases: null records and null or blank items count for nothing; an item counts once in a record; pairs
have the smaller string first; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from correlia.runtime import durable, lookup_join

HEAVY_SHARE, PIECE, FLUSH = 1 / 1024, 256, 200_000


def _block_counts(items: list[list[str]], sides: list, heavy: dict[str, int], dense: np.ndarray, rest: Counter) -> None:
    """Add the pairs of a block of records. sides: per record None, or the number of leading items that are to meet only the others."""
    whole = [r for r, s in enumerate(sides) if s is None]
    bits = np.zeros((len(heavy), len(whole)), dtype=bool)
    light_items: list[str] = []
    light_rows: list[int] = []
    for row, r in enumerate(whole):
        light = []
        for x in items[r]:
            if (h := heavy.get(x)) is None:
                light.append(x)
            else:
                bits[h, row] = True
        light_items += light
        light_rows += [row] * len(light)
        rest.update((a, b) if a < b else (b, a) for i, a in enumerate(light) for b in light[i + 1 :])
    present = np.flatnonzero(bits.any(axis=1))
    if len(present):
        packed = np.packbits(bits[present], axis=1)
        packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)
        for i, h in enumerate(present[:-1]):
            dense[h, present[i + 1 :]] += np.bitwise_count(packed[i] & packed[i + 1 :]).sum(axis=1, dtype=np.int64)
        if light_items:
            names = list(heavy)
            at, found = np.nonzero(bits.T[light_rows][:, present])
            for i, h in zip(at.tolist(), present[found].tolist()):
                a, b = light_items[i], names[h]
                rest[(a, b) if a < b else (b, a)] += 1
    for r, s in enumerate(sides):
        if s is not None:
            rest.update((a, b) if a < b else (b, a) for a in items[r][:s] for b in items[r][s:])


def pair_counts(pairs: DataFrame, record: str, item: str, min_count: int = 1) -> DataFrame:
    """(a, b, n_ab, n_a, n_b, n_records, lift) of the pairs that occur in at least min_count records; n_records counts all records given."""
    spark = pairs.sparkSession
    rows = durable(pairs.select(F.col(record).alias("r"), F.col(item).alias("x")).where("r is not null").distinct())
    total = rows.select("r").distinct().count()
    kept = rows.where("x is not null and x <> ''")
    freq = durable(kept.groupBy("x").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))
    occurrences = freq.agg(F.sum("n")).first()[0] or 0
    heavy_items = sorted(r["x"] for r in freq.where(F.col("n") >= max(2, occurrences * HEAVY_SHARE)).select("x").collect())
    heavy = spark.sparkContext.broadcast({x: i for i, x in enumerate(heavy_items)})
    used = lookup_join(kept, freq.select("x"), "x", "inner") if min_count > 1 else kept
    sizes = used.groupBy("r").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    pieces = used.join(sizes, "r").withColumn("of", F.ceil(F.col("size") / PIECE))
    pieces = pieces.withColumn("p", F.when(F.col("of") > 1, F.pmod(F.xxhash64("x"), F.col("of"))).otherwise(0))
    # Every item of a long record goes to the tasks of all pairs of pieces that its own is in.
    other = F.when(F.col("of") > 1, F.sequence(F.lit(0).cast("long"), F.col("of") - 1)).otherwise(F.array(F.lit(0).cast("long")))
    pieces = pieces.withColumn("q", F.explode(other)).select("r", "x", "p", F.least("p", "q").alias("lo"), F.greatest("p", "q").alias("hi"))
    blocks = pieces.groupBy("r", "lo", "hi").agg(
        F.collect_list(F.when(F.col("p") == F.col("lo"), F.col("x"))).alias("left"), F.collect_list(F.when((F.col("p") == F.col("hi")) & (F.col("lo") < F.col("hi")), F.col("x"))).alias("right")
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = heavy.value
        names = list(index)
        dense = np.zeros((len(index), len(index)), dtype=np.int64)
        rest: Counter = Counter()

        def out(cells) -> pd.DataFrame:
            return pd.DataFrame(cells, columns=["a", "b", "n"]).astype({"n": "int64"})

        for pdf in batches:
            left, right = [list(x) for x in pdf["left"]], [list(x) for x in pdf["right"]]
            sides = [None if lo == hi else len(a) for lo, hi, a in zip(pdf["lo"], pdf["hi"], left)]
            _block_counts([a + b for a, b in zip(left, right)], sides, index, dense, rest)
            if len(rest) > FLUSH:
                yield out([(*k, n) for k, n in rest.items()])
                rest.clear()
        yield out([(*k, n) for k, n in rest.items()] + [(names[i], names[j], int(dense[i, j])) for i, j in zip(*np.nonzero(dense))])

    together = blocks.mapInPandas(count, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n_ab")).where(F.col("n_ab") >= min_count)
    together = durable(together)
    one = lookup_join(together, freq.select(F.col("x").alias("a"), F.col("n").alias("n_a")), "a", "inner")
    two = lookup_join(one, freq.select(F.col("x").alias("b"), F.col("n").alias("n_b")), "b", "inner")
    lift = F.col("n_ab") * F.lit(float(total)) / (F.col("n_a").cast("double") * F.col("n_b"))
    return two.select("a", "b", "n_ab", "n_a", "n_b", F.lit(total).cast("long").alias("n_records"), lift.alias("lift"))


def sentence_entities(candidates: DataFrame, mentions: DataFrame) -> DataFrame:
    """(unidad_id, entidad): the genic ids of each candidate sentence over all its rows; entidad is null where a sentence has none.

    Lists that are no valid JSON add nothing; ids are trimmed (tabs too) and in capitals.
    """
    clean = lambda c: F.nullif(F.upper(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), F.lit(""))
    ids = F.from_json("entidades", "array<string>", {"mode": "PERMISSIVE"})
    listed = candidates.where(F.col("entidades").rlike(r"(?s)^\s*\[.*\]\s*$")).select("unidad_id", F.explode(ids).alias("id")).select("unidad_id", F.expr("try_cast(id as bigint)").alias("id")).where("id is not null").distinct()
    named = mentions.select("id", clean(F.col("id_normalizado")).alias("entidad")).where("entidad is not null and id is not null").distinct()
    by_mention = lookup_join(listed, named, "id", "inner").select("unidad_id", "entidad")
    direct = candidates.select("unidad_id", F.explode(F.array(clean(F.col("regulador_candidato")), clean(F.col("blanco_candidato")))).alias("entidad"))
    return by_mention.unionByName(direct)
