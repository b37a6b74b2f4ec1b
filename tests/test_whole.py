"""Queries that do the whole job: nothing is lost beyond a fixed number of rows."""

import __spark_entry__ as entry
import pytest
from correlia.operators import mentions, network
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def query(spark, tmp_path_factory):
    """Runs a query over hand-made tables."""

    def run(name, **tables):
        d = tmp_path_factory.mktemp(name)
        for table, df in tables.items():
            df.write.parquet(f"{d}/{table}.parquet")
        return entry.queries()[name](spark, str(d))

    return run


def test_every_evidence_of_a_pair_votes(spark, query):
    rows = spark.range(300).select(
        F.col("id").alias("ejemplo_id"), F.lit("A").alias("tf"), F.lit("b").alias("target"), F.concat(F.lit("sentence "), "id").alias("text"), F.lpad(F.col("id").cast("string"), 4, "0").alias("pmid"),
        F.lit("RESULTS").alias("seccion"), F.when(F.col("id") < 60, "represses").otherwise("activates").alias("label"),
    )
    live = rows.where("(50 + ejemplo_id % 50) / 100 >= 0.70")
    e = query("network_edges_whole", ejemplos=live).first()
    n = live.count()
    assert (e.sign, e.conflict, e.n_evidencias, e.n_articulos) == ("activates", False, n, n) and e.n_represses == live.where("label = 'represses'").count() > 5
    assert sorted(map(tuple, query("network_degrees_whole", ejemplos=live).collect())) == [("A", 1, 0), ("b", 0, 1)]


def test_caps_are_the_k_they_are_given(spark):
    rows = spark.range(300).select(F.lit("A").alias("tf"), F.lit("b").alias("target"), F.col("id").cast("string").alias("pmid"), F.lit("x").alias("seccion"), F.lit(0).alias("n"), "id", F.concat(F.lit("s"), "id").alias("s"))
    assert [network.cap(rows, k).count() for k in (2, 250)] == [2, 250] and network.cap(rows).count() == network.CAP == 200
    assert [mentions.capped_sentences(rows, ["tf", "target"], "s", "id", k).count() for k in (2, 200)] == [2, 200]


def test_every_row_of_a_leak_class_is_named(spark, query):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(i, base, "train" if i % 2 else "test") for i in range(1, 21)] + [(30, base + " extra", "dev"), (31, "alone", "dev"), (32, None, "dev"), (33, "...", "train")]
    df = spark.createDataFrame(rows, "ejemplo_id int, text string, particion string")
    of = {r.ejemplo_id: (r.lado, r.clase) for r in query("leak_near_duplicate_classes", ejemplos=df).collect()}
    assert of == {**{i: ("train", 1) if i % 2 else ("eval", 2) for i in range(1, 21)}, 30: ("eval", 30), 31: ("eval", 31), 32: ("eval", None), 33: ("train", None)}
    pairs = {(r.a, r.b) for r in query("leak_near_duplicates", ejemplos=df).collect()}
    assert {i for i, (side, c) in of.items() if side == "eval" and c in {a for a, _ in pairs}} == {*range(2, 21, 2), 30}


def test_as_many_negatives_as_positives(spark, query):
    """120 positives, and 200 pairs of the same article that are no positives."""
    df = spark.range(320).select(F.col("id").alias("ejemplo_id"), F.concat(F.lit("t"), "id").alias("tf"), F.lit("g").alias("target"), F.lit("1").alias("pmid"), F.when(F.col("id") < 120, "activates").otherwise("no_relation").alias("label"))
    got = [r[0] for r in query("training_negatives_balanced", ejemplos=df).collect()]
    assert len(got) == len(set(got)) == 120 and min(got) >= 120
    few = [r[0] for r in query("training_negatives_balanced", ejemplos=df.where("ejemplo_id < 150")).collect()]
    assert sorted(few) == list(range(120, 150))
    assert {r[0] for r in query("training_negatives", ejemplos=df).collect()} <= set(got)


def test_gene_lists_of_any_notation(spark, query):
    """Each group is written in seven ways, and has one regulator in a row of its own."""
    rows = []
    for k in range(20):
        x, y = chr(97 + k), chr(65 + k)
        names, tags = [f"{x}ab{c}" for c in "CDE"], [f"PA{1000 + 10 * k + j}" for j in range(3)]
        for j, put in enumerate(["|".join, ";".join, ", ".join, "/".join, "\t".join, lambda v: str(v).replace("'", '"'), lambda v: ",".join(f'"{z}"' for z in v)]):
            rows.append((len(rows), f"S{j}-{k}", put(names), put(tags)))
        rows.append((len(rows), f"R-{k}", f"{x}eg{y}", "{" + ", ".join(tags) + "}"))
    df = spark.createDataFrame(rows, "id long, id_fuente string, genes_raw string, locus_tags string").withColumns({c: F.lit(None).cast("string") for c in ("cadena", "tipo_evidencia", "pmid")})
    named = {r.id: r.nombre for r in query("operon_names", operones_bronze=df).collect()}
    assert named == {i: g if f[0] == "R" else f"{chr(97 + int(f.split('-')[1]))}abCDE" for i, f, g, _ in rows}
    got = {tuple(r) for r in query("network_expansion_whole", operones_bronze=df).collect()}
    assert got == {(g, f, "") for _, f, g, _ in rows if f[0] == "R"} | {(g, f"PA{1000 + 10 * int(f.split('-')[1]) + j}", f) for _, f, g, _ in rows if f[0] == "R" for j in range(3)}


def test_every_entry_of_every_source_has_its_place(spark, query):
    ids = [f"{f}-{n}" for f in ("PGD", "ODB", "BIOCYC") for n in range(1, 1501)] + ["ODB-x", "ODB-007", "ODB-123456789012345678901234567890", "ODB-0"]
    df = spark.createDataFrame([(i,) for i in [*ids, *ids[:9], None]], "id_fuente string")
    got = [r.id_fuente for r in sorted(query("operon_natural_rank", operones_bronze=df).collect(), key=lambda r: r.puesto)]

    def key(i):
        f, n = i.split("-")
        return f, not n.isdigit(), int(n) if n.isdigit() else 0, i

    assert got == sorted(ids, key=key)
