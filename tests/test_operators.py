"""Hand-made cases: nulls, ties, repeats, empty tables, skew."""

import random

from correlia import runtime
from correlia.functions import text as X
from correlia.operators import components, evaluate, group_splits, ingest, mentions, neardup, network, operons, sampling, scoring
from correlia.runtime import hot_keys, lookup_join
from pyspark.sql import functions as F


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr).first()[0]


def test_text_functions(spark):
    assert one(spark, X.squeeze("c"), "  a \n b ") == "a b"
    assert one(spark, X.heading("c"), " 3.1 Results: ") == "results"
    assert one(spark, X.section_class("c"), "RESULTS AND DISCUSSION") == "resultados"
    assert one(spark, X.section_class("c"), None) == "otra"
    assert one(spark, X.protein_form("c"), "abcD") == "AbcD" and one(spark, X.protein_form("c"), "PA1234") == "PA1234"
    assert one(spark, X.without_loss_prefix("c"), "ΔmexR") == "mexR"
    assert one(spark, X.locus_range("c"), "PA0425-PA0427") == ["PA0425", "PA0426", "PA0427"]
    assert one(spark, X.locus_range("c"), "x") == []
    assert one(spark, X.article_ids("c"), "10.1000/1234567; PMID 08101234 8101234") == ["8101234"]
    assert one(spark, X.doi("c"), "https://doi.org/10.1000/ABC") == "10.1000/abc" and one(spark, X.doi("c"), "n/a") is None
    assert [one(spark, X.sign("c"), s) for s in ("＋", " neg", "x", None)] == ["+", "-", "?", None]
    assert one(spark, X.sentences("c"), "In P. aeruginosa, x rose (Fig. 3A). Y fell.") == ["In P. aeruginosa, x rose (Fig. 3A).", "Y fell."]
    assert one(spark, X.sentences("c"), "") == []
    assert str(one(spark, X.partial_date("c", end=True), "2020/2")) == "2020-02-29" and one(spark, X.partial_date("c"), "spring") is None
    assert one(spark, X.redact("c"), "see /home/a/b.txt and 12345678") == "see [path] and [id]"
    assert one(spark, X.xml_safe("c"), "a\u0001b") == "ab"


def test_one_per_key_and_inserts(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (None, 1, "z")], "k int, t int, v string")
    assert sorted((r.k or 0, r.v) for r in ingest.one_per_key(df, "k", [F.col("t")]).collect()) == [(0, "z"), (1, "c")]
    assert ingest.insert_absent(df.where("k = 9"), df, "k", [F.col("t")]).collect()[0].v == "a"


def test_upsert_counts(spark):
    state = spark.createDataFrame([(1, "a", 2), (2, "b", 1)], "k int, v string, n int")
    changes = spark.createDataFrame([(1, None), (3, "c")], "k int, v string")
    assert sorted(map(tuple, ingest.upsert_counting(state, changes, "k", "n").collect())) == [(1, "a", 3), (2, "b", 1), (3, "c", 1)]


def test_update_refuses_other_columns(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    try:
        ingest.update_given(df, {"k": 2}, {"v"}, F.lit(True))
    except ValueError as e:
        assert "k" in str(e)
    else:
        raise AssertionError


def test_lookup_join_with_a_hot_key(spark):
    rows = spark.range(3000).select((F.when(F.col("id") < 1500, 0).otherwise(F.col("id"))).alias("k"), F.col("id").alias("x"))
    table = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y")).where("k % 2 = 0")
    assert hot_keys(rows, "k") == [0]
    got = lookup_join(rows, table, "k")
    assert got.count() == 3000 and got.where("y is not null").count() == rows.where("k % 2 = 0").count()
    assert lookup_join(rows, table, "k", "inner").count() == rows.where("k % 2 = 0").count()


def test_components_chain_star_and_null(spark):
    edges = [(i, f"c{i}") for i in range(1, 60)] + [(i + 1, f"c{i}") for i in range(1, 60)] + [(i, "star") for i in range(100, 140)] + [(None, "star"), (200, None), (300, "own")]
    df = spark.createDataFrame(edges, "node long, ent string")
    got = {r.node: r.label for r in components.propagate(df).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, **{i: 100 for i in range(101, 140)}}
    assert components.propagate(df.limit(0)).count() == 0


def test_nearest_pairs_ties(spark):
    r = spark.createDataFrame([(1, "A", 0, 4), (1, "A", 20, 24)], "unit int, id string, ini int, fin int")
    t = spark.createDataFrame([(1, "B", 10, 14), (1, "A", 0, 4), (1, "A", 20, 24)], "unit int, id string, ini int, fin int")
    got = {(x.tf, x.target): (x.gap, x.r_ini, x.t_ini) for x in mentions.nearest_pairs(r, t).collect()}
    assert got == {("A", "B"): (6, 0, 10), ("A", "A"): (16, 0, 20)}


def test_vote(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (1, 3), (3, 2)], "a int, r int")
    got = [tuple(r.v) for r in df.select(network.vote(F.col("a"), F.col("r")).alias("v")).collect()]
    assert got == [("regulates", False), ("regulates", True), ("activates", False), ("represses", False), ("regulates", True)]


def test_threshold_is_inclusive_and_reasons_are_ordered(spark):
    cols = "tf string, target string, pred string, seccion string, p_activates double, p_no_relation double, p_regulates double, p_represses double"
    df = spark.createDataFrame([("a", "b", "activates", "x", 0.65, 0.2, 0.1, 0.05), ("a", "a", "activates", "leyenda", 0.9, 0.05, 0.03, 0.02), ("a", "b", "activates", "x", 0.64, 0.2, 0.1, 0.06), (None, "b", "activates", "x", 0.9, 0.1, 0.0, 0.0)], cols)
    assert [r[0] for r in df.select(network.exclusion_reason()).collect()] == [None, "leyenda", "umbral", "nulo"]


def test_strict_subsets(spark):
    df = spark.createDataFrame([("a|b", ["a", "b"]), ("a|b|c", ["c", "b", "a"]), ("b|c", ["b", "c"]), ("x", ["x"])], "clave string, genes array<string>")
    assert sorted((r.clave, r.contenida_en) for r in operons.strict_subsets(df).collect()) == [("a|b", "a|b|c"), ("b|c", "a|b|c")]


def test_operon_name(spark):
    assert one(spark, operons.operon_name(F.col("c")), ["mexA", "mexB", "oprM"], "array<string>") == "mexAB-oprM"


def test_binomial_and_kappa(spark):
    df = spark.createDataFrame([(3, 3, 0.5), (0, 3, 0.5)], "h int, n int, p double")
    assert [round(r[0], 6) for r in df.select(evaluate.binomial_tail("h", "n", "p")).collect()] == [0.125, 1.0]
    same = spark.createDataFrame([("a", "a")] * 3, "x string, y string")
    assert evaluate.kappa(same, [], "x", "y").first()["kappa"] is None


def test_near_duplicates_against_brute_force(spark):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(1, base), (2, base + " extra"), (3, " ".join(reversed(base.split()))), (4, base), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "id int, t string")
    got = neardup.contained(neardup.ngrams(df.where("id in (1, 5, 6)"), "id", "t"), neardup.ngrams(df.where("id in (2, 3, 4)"), "id", "t")).collect()
    assert sorted((r.a, r.b) for r in got) == [(1, 2), (1, 4)]


def test_near_duplicates_broadcast_nothing_by_estimate(spark, tmp_path):
    """Any sizes on either side, against all pairs; the n-grams, whose size Spark can't estimate, must not go through the driver."""
    rnd = random.Random(5)
    bases = [[f"w{rnd.randrange(300)}" for _ in range(rnd.choice([1, 4, 6, 9, 20, 60, 400]))] for _ in range(40)]

    def changed(w):
        w = list(w)
        for _ in range(rnd.choice([0, 0, 1, 2])):
            w[rnd.randrange(len(w))] = "other"
        cut = rnd.choice([0, 0, 1, len(w) // 3])
        return " ".join(w[cut:] + rnd.choice([[], ["more"] * 3, rnd.choice(bases)]))

    rows = [(i, changed(rnd.choice(bases)), rnd.random() < 0.4) for i in range(400)] + [(400, None, True), (401, "...", False)]
    rows += [(i, changed(rnd.choice(bases)), held) for i, _, held in rows[:10]]  # a repeated id has the n-grams of all its rows
    spark.createDataFrame(rows, "id long, t string, held boolean").write.parquet(f"{tmp_path}/rows")
    df = spark.read.parquet(f"{tmp_path}/rows")
    got = neardup.contained(*[neardup.ngrams(df.where(x), "id", "t") for x in ("held", "not held")])
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()

    def classes(held):
        sets = {}
        for i, t, h in rows:
            if h == held and t and t != "...":
                w = t.split()
                sets.setdefault(i, set()).update(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1)))
        first = {}
        for i, g in sets.items():
            first[frozenset(g)] = min(i, first.get(frozenset(g), i))
        return first

    want = {(a, b, len(x & y), round(len(x & y) / min(len(x), len(y)), 6)) for x, a in classes(True).items() for y, b in classes(False).items() if len(x & y) >= 0.8 * min(len(x), len(y))}
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want and len(want) > 300


def test_folds_keep_groups_and_balance(spark):
    df = spark.range(2000).select((F.col("id") % 500).alias("g"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("l"))
    folds = sampling.group_folds(df, "g", "l", 5)
    sizes = [r["n"] for r in folds.groupBy("pliegue").agg(F.sum("n").alias("n")).collect()]
    assert folds.count() == 500 and len(sizes) == 5 and max(sizes) - min(sizes) <= 40


def test_scoring_skips_what_is_cached(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "t string")
    empty = spark.createDataFrame([], "clave string, firma string, p_activates double, p_no_relation double, p_regulates double, p_represses double, pred string")
    model = lambda xs: [[0.7, 0.1, 0.1, 0.1] for _ in xs]
    first = scoring.score(scoring.to_score(rows, empty, "t", "m1"), "t", model, "m1").persist()
    assert first.count() == 2 and {r.pred for r in first.collect()} == {"activates"}
    assert scoring.to_score(rows, first, "t", "m1").count() == 0 and scoring.to_score(rows, first, "t", "m2").count() == 2
    assert scoring.with_scores(rows, first, "t", "m1").where("pred is not null").count() == 3


def test_annotation_rules(spark):
    df = spark.createDataFrame([("no", "1>2", "+", "no", "no", ""), ("si", "1>2", "+", "no", "no", ""), ("dudoso", "2>1", "?", "no", "no", " ")], "relacion string, direccion string, signo string, negada string, especulativa string, comentario string")
    assert [r[0] for r in df.select(scoring.broken_rules()).collect()] == [["no_sin_ninguna", "no_con_signo"], [], ["aviso_dudoso_sin_comentario"]]


def test_wording_takes_the_first_class_that_fits(spark):
    cases = {"In the mutant its level is elevated and it activates": "fenotipo_mutante", "It activates the old gene": "directa", "It upregulates the gene": "contraria_aparente", "It upregulates a mutant": "fenotipo_mutante", "It was there": "otra"}
    for text, want in cases.items():
        assert one(spark, X.wording("c"), text) == want


def test_article_numbers_in_scientific_notation(spark):
    assert one(spark, X.article_ids("c"), "1.2345678E7; 123456789 7654321.0 99") == ["12345678", "7654321"]


def test_binomial_tail_of_many(spark):
    df = spark.createDataFrame([(1100, 2000, 0.5), (0, 5, 0.3), (6, 5, 0.3), (50_000, 100_000, 0.5)], "h int, n int, p double")
    got = [r[0] for r in df.select(evaluate.binomial_tail("h", "n", "p")).collect()]
    assert abs(got[0] - 4.18e-6) < 2e-7 and got[1:3] == [1.0, 0.0] and abs(got[3] - 0.50126) < 1e-4


def test_directed_jury(spark):
    rows = [(1, "a", "si", "+"), (1, "b", "si", "+"), (1, "c", "si", "-"), (2, "b", "si", "-"), (2, "c", "si", "+"), (3, "a", "no", None), (3, "b", "dudoso", "-"), (3, "c", "dudoso", "-"), (4, "a", "si", None), (5, "a", None, None), (6, "a", "no", "+")]
    df = spark.createDataFrame(rows, "i int, who string, v string, g string")
    got = {r.i: (r.relacion, r.direccion) for r in evaluate.directed_jury(df, "i", "who", "v", "g", ("+", "-"), 2).collect()}
    assert got == {1: ("si", "+"), 2: ("dudoso", "-"), 3: ("dudoso", "-"), 4: ("no", "ninguna"), 5: (None, None), 6: ("no", "ninguna")}


def test_edge_verdicts(spark):
    rows = [("x", "a", "si", "+", "+"), ("x", "b", "si", "+", "+"), ("y", "a", "si", "-", "+"), ("z", "a", "si", "?", "+"), ("z", "b", "no", None, "+"), ("w", "a", "no", None, "+"), ("v", "a", None, None, "+"), ("u", "a", "si", "+", "+")]
    df = spark.createDataFrame(rows, "e string, who string, v string, g string, s string")
    got = {r.e: (r.veredicto, r.nivel) for r in evaluate.edge_verdicts(df, ["e"], "who", "v", "g", "s", ("+", "-")).collect()}
    assert got == {"x": ("confirmada", "alta"), "y": ("invertida", "al_reves"), "z": ("dudosa", "sin_respaldo"), "w": ("rechazada", "sin_respaldo"), "v": ("sin_juicio", ""), "u": ("confirmada", "media")}


def test_lookup_join_keeps_many_null_keys_out_of_the_shuffle(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("k"), "id")
    table = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner"):
        want = df.join(table, "k", how)
        got = runtime.lookup_join(df, table, "k", how)
        assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_group_splits_balance_every_label(spark):
    rows = spark.range(20_000).select(F.col("id").alias("i"), F.when(F.col("id") % 2000 == 0, F.concat(F.lit("rare"), (F.col("id") % 7).cast("string"))).when(F.col("id") % 5 == 0, "b").when(F.col("id") % 11 == 0, None).otherwise("a").alias("label"))
    groups = rows.select("i", F.when(F.col("i") < 5000, -1).otherwise(F.floor(F.col("i") / 4)).alias("grupo_id"))
    got = group_splits.assign_splits(rows, groups, "i").cache()
    assert got.count() == 20_000 and got.groupBy("grupo_id").agg(F.count_distinct("split").alias("n")).where("n > 1").isEmpty()
    off = {(r.split, r.label): abs(r.desviacion) for r in group_splits.balance(got, rows, "i", "label").collect()}
    assert max(v for (_, k), v in off.items() if k in ("a", "b", "(none)")) < 0.01
    assert group_splits.assign_splits(rows.limit(0), groups.limit(0), "i").isEmpty()
