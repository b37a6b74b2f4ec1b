"""Split of groups of rows with like shares of each label: stratified group assignment.

Groups that hold at least HOT_SHARE of the rows (at most 1 / HOT_SHARE of them) are placed one by one where they raise the
squared relative label deviation least; all others are dealt out within strata of equal label profile, by exact
distributed ranks, in the proportions that the placed groups leave over. The ranks of a stratum are counted in as many
blocks as it needs for BLOCK_ROWS groups each.

Defined cases: null and blank labels are a label of their own; labels of less than HOT_SHARE of the rows are balanced as one;
repeated rows of an id count once; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from correlia.runtime import HOT_SHARE, durable, lookup_join

#: Shares of the splits.
PROPORTIONS = {"train": 0.8, "validation": 0.1, "test": 0.1}
#: Groups that one task ranks; the label that stands for all rare ones.
BLOCK_ROWS, RARE = 100_000, "(rare)"


def _place_heavy(heavy: list[tuple], totals: dict[str, int], shares: dict[str, float]) -> tuple[dict, dict]:
    """Largest group first, each to the split whose squared relative label deviation it lowers most."""
    have = {s: dict.fromkeys(totals, 0) for s in shares}
    where = {}
    for gid, profile in sorted(heavy, key=lambda x: (-sum(x[1].values()), x[0])):
        def gain(s: str) -> float:
            want = {k: max(shares[s] * totals[k], 1e-9) for k in profile}
            return sum(((have[s][k] + n - want[k]) / want[k]) ** 2 - ((have[s][k] - want[k]) / want[k]) ** 2 for k, n in profile.items())

        best = min(shares, key=lambda s: (gain(s), -shares[s], s))
        where[gid] = best
        for k, n in profile.items():
            have[best][k] += n
    return where, have


def assign_splits(df: DataFrame, groups: DataFrame, id_col: str = "ejemplo_id", label: str = "label", proportions: dict[str, float] | None = None, seed: str = "0") -> DataFrame:
    """(id_col, grupo_id, split) with the given shares of rows and like shares of each label."""
    shares = proportions or PROPORTIONS
    spark = df.sparkSession
    clean = F.coalesce(F.nullif(F.lower(F.trim(label)), F.lit("")), F.lit("(none)"))
    rows = df.select(id_col, clean.alias("label")).dropDuplicates([id_col])
    tagged = durable(rows.join(groups, id_col))
    total = tagged.count()
    if not total:
        return tagged.select(id_col, "grupo_id", F.lit("").alias("split"))
    # Labels of less than HOT_SHARE of the rows count as one label, so at most 1 / HOT_SHARE + 1 are told apart.
    often = [r["label"] for r in tagged.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= total * HOT_SHARE).collect()]
    tagged = tagged.withColumn("label", F.when(F.col("label").isin(often), F.col("label")).otherwise(RARE))
    totals = {r["label"]: r["n"] for r in tagged.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    per_label = tagged.groupBy("grupo_id", "label").agg(F.count(F.lit(1)).alias("n"))
    profiles = durable(per_label.groupBy("grupo_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("profile"), F.sum("n").alias("size")))
    heavy = [(r["grupo_id"], {k: v for k, v in r["profile"].items() if k in totals}) for r in profiles.where(F.col("size") > max(1, total * HOT_SHARE)).collect()]
    placed, have = _place_heavy(heavy, totals, shares)
    taken = {k: sum(have[s][k] for s in shares) for k in totals}
    rest = {s: {k: max(shares[s] * totals[k] - have[s][k], 0.0) for k in totals} for s in shares}
    quota = []
    for k in totals:
        norm = sum(rest[s][k] for s in shares)
        cut = 0.0
        for s in shares:
            part = rest[s][k] / norm if totals[k] > taken[k] and norm else shares[s]
            quota.append((k, s, cut, cut + part))
            cut += part
    names = list(shares)
    cuts = {k: [c for q, s, _, c in quota if q == k] for k in totals}
    light = profiles.where(F.col("size") <= max(1, total * HOT_SHARE))
    n_blocks = max(1, -(-total // BLOCK_ROWS))
    light = light.select("grupo_id", "size", "profile", F.to_json("profile").alias("stratum"), F.pmod(F.xxhash64(F.lit(seed), "grupo_id"), F.lit(n_blocks)).alias("block"))
    blocks = light.groupBy("stratum", "block").agg(F.count(F.lit(1)).alias("n"))
    # Of each stratum as many rows as there are blocks meet in these windows.
    by = W.partitionBy("stratum")
    blocks = blocks.select("stratum", "block", (F.sum("n").over(by.orderBy("block")) - F.col("n")).alias("before"), F.sum("n").over(by).alias("all"))
    ranked = light.withColumn("rank", F.row_number().over(W.partitionBy("stratum", "block").orderBy(F.xxhash64(F.lit(seed), F.lit("r"), "grupo_id"), "grupo_id")))
    placed_light = ranked.join(blocks, ["stratum", "block"])
    phase = F.pmod(F.xxhash64(F.lit(seed), "stratum"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    spot = F.pmod((F.col("before") + F.col("rank") - 0.5) / F.col("all") + F.when(F.col("all") < 50, phase).otherwise(0.0), F.lit(1.0))
    # The cut points of a stratum: those of its labels, weighted by the rows the stratum has of each.
    cut_map = F.create_map(*[x for k in totals for x in (F.lit(k), F.array(*map(F.lit, cuts[k])))]) if totals else F.create_map()
    plain, run = [], 0.0
    for s in names:
        run += shares[s]
        plain.append(run)
    default = F.array(*map(F.lit, plain))
    entries = F.map_entries("profile")

    def cut_of(i: int) -> F.Column:
        return F.aggregate(entries, F.lit(0.0), lambda a, e: a + e["value"] * F.element_at(F.coalesce(F.try_element_at(cut_map, e["key"]), default), i + 1)) / F.col("size")

    at = [cut_of(i) for i in range(len(names))]
    chosen = F.lit(names[-1])
    for i in reversed(range(len(names) - 1)):
        chosen = F.when(spot < at[i], names[i]).otherwise(chosen)
    light_split = placed_light.select("grupo_id", chosen.alias("split"))
    heavy_split = spark.createDataFrame([(g, s) for g, s in placed.items()] or [], f"grupo_id {dict(profiles.dtypes)['grupo_id']}, split string")
    return lookup_join(tagged, light_split.unionByName(heavy_split), "grupo_id", hot=[g for g, _ in heavy]).select(id_col, "grupo_id", "split")


def balance(assigned: DataFrame, labels: DataFrame, id_col: str, label: str, proportions: dict[str, float] | None = None) -> DataFrame:
    """(split, label, n, parte, pedida, desviacion): per split and label the rows, their share of the label's rows, the share asked for, and the difference."""
    shares = proportions or PROPORTIONS
    clean = F.coalesce(F.nullif(F.lower(F.trim(label)), F.lit("")), F.lit("(none)")).alias("label")
    rows = assigned.join(labels.select(id_col, clean).dropDuplicates([id_col]), id_col)
    all_of = rows.groupBy("label").agg(F.count(F.lit(1)).alias("total"))
    asked = F.create_map(*[x for s, p in shares.items() for x in (F.lit(s), F.lit(p))])
    part = F.col("n") / F.col("total")
    got = rows.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n")).join(all_of, "label")
    return got.select("split", "label", "n", F.round(part, 6).alias("parte"), asked[F.col("split")].alias("pedida"), F.round(part - asked[F.col("split")], 6).alias("desviacion"))
