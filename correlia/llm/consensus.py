"""Consensus from several annotators' labels (problem 6): bipartite message passing, one class against the rest.

For every class c an answer counts A = [answer = c] - (that person's share of c), so a person who always
says the same sends nothing. On each answer edge an item tells its annotator x = sum of A * y over its other
annotators, and the annotator tells the item y = correlation of A and x over their other items. Messages are
updated until no annotator's reliability moves by more than TOLERANCE; if that does not come about within ROUNDS
rounds (messages that swing between two states), what the last round moved is told beside the reliabilities. A settled label takes part as the
answers of one more annotator, `GOLD`, which carries no vote of its own in the result.

Reliability = the correlations averaged over the classes by variance, in [-1, 1]. A vote weighs
log((1 + r) / (1 - r)); persons with r below DEPENDABLE carry none. If an item has no dependable annotator, the
signed messages decide.

Both sums are partial aggregates; annotators and items come back to the edges through `lookup_join`, so
neither a person nor an item that holds a large share of all answers is gathered.

Defined cases: unusable and null answers, persons or items are dropped; of one person's usable answers for an
item the latest counts (equal times: the larger answer in text order); repeats count once; ties in weight go
to the settled label, then to the class named first; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from correlia.runtime import durable, hot_keys, lookup_join

TOLERANCE, ROUNDS, DEPENDABLE, GOLD = 1e-3, 100, 0.15, "(gold)"
#: The spellings of the answers.
ANSWERS = {"si": ["si", "sí", "s", "yes", "y"], "no": ["no", "n"], "dudoso": ["dudoso", "dudosa", "duda", "?", "？"]}
SIGNS = {"+": ["+", "＋", "pos", "positivo", "positive", "activa"], "-": ["-", "–", "−", "—", "－", "neg", "negativo", "negative", "reprime"], "?": ["?", "？"]}


def spelled(col: str, spellings: dict[str, list[str]]) -> Column:
    """The class whose spelling the cell has, apart from case, blanks and brackets; else null."""
    bare = F.regexp_replace(F.lower(F.col(col)), r"(?U)^[\s(\[]+|[\s)\].]+$", "")
    out = F.lit(None).cast("string")
    for name, ways in spellings.items():
        out = F.when(bare.isin(*ways), name).otherwise(out)
    return out


def person(col: str) -> Column:
    return F.nullif(F.regexp_replace(F.lower(F.trim(F.col(col))), r"(?U)[^\p{L}\p{N}]+", "_"), F.lit(""))


def latest(df: DataFrame, item: str, who: str, value: Column, when: str, extra: Column | None = None) -> DataFrame:
    """(item, who, label, more): each person's latest usable answer for each item."""
    rows = df.select(F.col(item).alias("item"), person(who).alias("who"), value.alias("label"), (extra if extra is not None else F.lit(None).cast("string")).alias("more"), F.col(when).alias("at"))
    rows = rows.where("item is not null and who is not null and label is not null")
    last = rows.groupBy("item", "who").agg(F.max(F.struct("at", "label", "more")).alias("m"))
    return last.select("item", "who", F.col("m.label").alias("label"), F.col("m.more").alias("more"))


def _back(edges: DataFrame, table: DataFrame, key: str, hot: list) -> DataFrame:
    return lookup_join(edges, table, key, "left", hot)


def reliabilities(answers: DataFrame, settled: DataFrame | None, classes: list[str]) -> DataFrame:
    """(who, n, rel array by class, reliability, moved) from (item, who, label) and optional (item, label); moved: by how much the last round moved any reliability."""
    edges = answers.select("item", "who", "label")
    if settled is not None:
        known = settled.where("item is not null and label is not null").groupBy("item").agg(F.min("label").alias("label"))
        known = known.join(edges.select("item").distinct(), "item", "left_semi")
        edges = edges.unionByName(known.select("item", F.lit(GOLD).alias("who"), "label"))
    edges = durable(edges)
    hot_who, hot_item = hot_keys(edges, "who"), hot_keys(edges, "item")
    k = range(len(classes))
    rates = edges.groupBy("who").agg(*[F.avg((F.col("label") == c).cast("double")).alias(f"p{i}") for i, c in enumerate(classes)])
    a = [((F.col("label") == c).cast("double") - F.col(f"p{i}")).alias(f"a{i}") for i, c in enumerate(classes)]
    state = _back(edges, rates, "who", hot_who).select("item", "who", *a, *[F.lit(1.0).alias(f"y{i}") for i in k])
    state = durable(state)
    old: DataFrame | None = None
    moved = None
    for _ in range(ROUNDS):
        sums = state.groupBy("item").agg(*[F.sum(F.col(f"a{i}") * F.col(f"y{i}")).alias(f"s{i}") for i in k])
        told = _back(state, sums, "item", hot_item)
        told = told.select("item", "who", *[f"a{i}" for i in k], *[(F.col(f"s{i}") - F.col(f"a{i}") * F.col(f"y{i}")).alias(f"x{i}") for i in k])
        told = durable(told)
        each = [f(i) for i in k for f in (
            lambda i: F.sum(F.col(f"a{i}") * F.col(f"x{i}")).alias(f"ax{i}"),
            lambda i: F.sum(F.col(f"a{i}") * F.col(f"a{i}")).alias(f"aa{i}"),
            lambda i: F.sum(F.col(f"x{i}") * F.col(f"x{i}")).alias(f"xx{i}"),
        )]
        totals = durable(told.groupBy("who").agg(F.count(F.lit(1)).alias("n"), *each))
        norm = [F.sqrt(F.col(f"aa{i}") * F.col(f"xx{i}")) + 1e-12 for i in k]
        state = _back(told, totals, "who", hot_who)
        state = durable(state.select("item", "who", *[f"a{i}" for i in k], *[((F.col(f"ax{i}") - F.col(f"a{i}") * F.col(f"x{i}")) / norm[i]).alias(f"y{i}") for i in k]))
        spread = sum((F.col(f"aa{i}") for i in k), F.lit(1e-12))
        rel = totals.select("who", "n", F.array(*[F.col(f"ax{i}") / norm[i] for i in k]).alias("rel"), (sum((F.col(f"aa{i}") * F.col(f"ax{i}") / norm[i] for i in k), F.lit(0.0)) / spread).alias("reliability"))
        rel = durable(rel)
        if old is not None:
            moved = rel.join(old.select("who", F.col("reliability").alias("before")), "who").agg(F.max(F.abs(F.col("reliability") - F.col("before")))).first()[0]
            if moved is None or moved <= TOLERANCE:
                break
        old = rel
    return rel.withColumn("moved", F.lit(moved).cast("double"))


def consensus(answers: DataFrame, rel: DataFrame, settled: DataFrame | None, classes: list[str]) -> DataFrame:
    """(item, label, agreement, n): agreement = the label's share of the dependable weight (of the answers, if nobody is dependable)."""
    weight = F.when(F.col("reliability") >= DEPENDABLE, F.log((1 + F.least("reliability", F.lit(0.999))) / (1 - F.least("reliability", F.lit(0.999))))).otherwise(0.0)
    votes = lookup_join(answers.select("item", "who", "label"), rel.select("who", "reliability", weight.alias("w")), "who")
    votes = votes.withColumn("w", F.coalesce("w", F.lit(0.0))).withColumn("r", F.coalesce("reliability", F.lit(0.0)))
    sums = [f(i, c) for i, c in enumerate(classes) for f in (
        lambda i, c: F.sum(F.when(F.col("label") == c, F.col("w")).otherwise(0.0)).alias(f"w{i}"),
        lambda i, c: F.sum(F.when(F.col("label") == c, F.col("r")).otherwise(-F.col("r") / max(1, len(classes) - 1))).alias(f"r{i}"),
    )]
    got = votes.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("all"), *sums)
    if settled is not None:
        got = got.join(settled.where("label is not null").groupBy("item").agg(F.min("label").alias("known")), "item", "left")
    else:
        got = got.withColumn("known", F.lit(None).cast("string"))
    rank = [F.struct(F.round(F.when(F.col("all") > 0, F.col(f"w{i}")).otherwise(F.col(f"r{i}")), 9).alias("s"), F.coalesce((F.col("known") == c).cast("int"), F.lit(0)).alias("k"), F.lit(-i).alias("o"), F.lit(c).alias("c"), F.col(f"w{i}").alias("w")) for i, c in enumerate(classes)]
    best = F.greatest(*rank)
    return got.select("item", "n", best.alias("b"), "all").select("item", F.col("b.c").alias("label"), F.when(F.col("all") > 0, F.col("b.w") / F.col("all")).alias("agreement"), "n")


def label_items(sample: DataFrame, settled: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Labels (id_item, campo, valor, acuerdo, n) and reliabilities (anotador, campo, n, fiabilidad, movimiento) of both fields."""
    answers = durable(latest(sample, "id_item", "anotador", spelled("juicio", ANSWERS), "juzgado_en", spelled("signo_correcto", SIGNS)))
    known = None if settled is None else settled.select(F.col("id_item").alias("item"), spelled("relacion", ANSWERS).alias("label"))
    rel = reliabilities(answers, known, list(ANSWERS))
    labels = durable(consensus(answers, rel, known, list(ANSWERS)))
    yes = labels.where("label = 'si'").select("item")
    signs = durable(answers.where("label = 'si' and more is not null").join(yes, "item", "left_semi").select("item", "who", F.col("more").alias("label")))
    known_sign = None if settled is None else settled.select(F.col("id_item").alias("item"), spelled("signo_correcto", SIGNS).alias("label"))
    rel_sign = reliabilities(signs, known_sign, list(SIGNS))
    sign = consensus(signs, rel_sign, known_sign, list(SIGNS))
    out = [x.select(F.col("item").alias("id_item"), F.lit(f).alias("campo"), F.col("label").alias("valor"), F.round("agreement", 6).alias("acuerdo"), "n") for f, x in (("juicio", labels), ("signo_correcto", sign))]
    who = [x.where(F.col("who") != GOLD).select(F.col("who").alias("anotador"), F.lit(f).alias("campo"), "n", F.round("reliability", 6).alias("fiabilidad"), F.round("moved", 9).alias("movimiento")) for f, x in (("juicio", rel), ("signo_correcto", rel_sign))]
    return out[0].unionByName(out[1]), who[0].unionByName(who[1])


def agreement(sample: DataFrame) -> DataFrame:
    """Krippendorff's nominal alpha of each field over all usable latest answers: (campo, n_items, n_respuestas, observado, esperado, alfa)."""
    answers = latest(sample, "id_item", "anotador", spelled("juicio", ANSWERS), "juzgado_en", spelled("signo_correcto", SIGNS))
    both = answers.select("item", F.lit("juicio").alias("campo"), "label").unionByName(answers.where("label = 'si' and more is not null").select("item", F.lit("signo_correcto").alias("campo"), F.col("more").alias("label")))
    cells = both.groupBy("campo", "item", "label").agg(F.count(F.lit(1)).alias("c"))
    items = cells.groupBy("campo", "item").agg(F.sum("c").alias("m"), F.sum(F.col("c") * (F.col("c") - 1)).alias("same")).where("m > 1")
    paired = cells.join(items.select("campo", "item"), ["campo", "item"], "left_semi").groupBy("campo", "label").agg(F.sum("c").alias("c"))
    observed = items.groupBy("campo").agg(F.count(F.lit(1)).alias("n_items"), F.sum("m").alias("n_respuestas"), F.sum(F.col("same") / (F.col("m") - 1)).alias("agree"))
    chance = paired.groupBy("campo").agg(F.sum(F.col("c") * (F.col("c") - 1)).alias("pairs"), F.sum("c").alias("t"))
    out = observed.join(chance, "campo").withColumn("o", F.col("agree") / F.col("n_respuestas")).withColumn("e", F.col("pairs") / (F.col("t") * (F.col("t") - 1)))
    return out.select("campo", "n_items", "n_respuestas", F.round("o", 6).alias("observado"), F.round("e", 6).alias("esperado"), F.round(F.when(F.col("e") < 1, (F.col("o") - F.col("e")) / (1 - F.col("e"))), 6).alias("alfa"))
