"""Sections, vocabularies, spans, paths and joins by priority on hand-made rows."""

import difflib

from correlia.operators import linguistic as L
from pyspark.sql import functions as F


def test_markdown_sections(spark):
    df = spark.createDataFrame([(1, "intro\n# A\nx\n\n## B\n"), (2, ""), (3, None), (4, "no heading # here")], "k int, t string")
    got = [(r.k, r.titulo, r.cuerpo) for r in L.markdown_sections(df, "k", "t").orderBy("k", "pos").collect()]
    assert got == [(1, None, "intro"), (1, "A", "x"), (1, "B", ""), (4, None, "no heading # here")]


def test_member_names(spark):
    df = spark.createDataFrame([("pqsABC",), ("pqsA",), (None,), ("PA1",)], "t string")
    assert [list(r[0] or []) for r in df.select(L.member_names(F.col("t"))).collect()] == [["pqsA", "pqsB", "pqsC"], [], [], []]


def test_vocabulary_longest_first_without_overlap(spark):
    df = spark.createDataFrame([(1, "Heat-shock and heat shocks; HEAT  shock response"), (2, None)], "k int, t string")
    got = [(r.tipo, r.texto, r.ini) for r in L.tag_vocabulary(df, "k", "t", {"heat": "a", "heat shock": "b", "heat shock response": "c"}).collect()]
    assert got == [("b", "Heat-shock", 0), ("a", "heat", 15), ("c", "HEAT  shock response", 28)]
    try:
        L.tag_vocabulary(df, "k", "t", {str(i): "x" for i in range(L.MOST_WORDS + 1)})
    except ValueError:
        pass
    else:
        raise AssertionError


def test_squeeze_keeps_places(spark):
    df = spark.createDataFrame([("  a\n b ",), (None,), ("",)], "t string")
    got = [r.m for r in df.select(L.squeeze_with_map("t").alias("m")).collect()]
    assert got[0].texto == "a b" and list(got[0].mapa) == [2, 3, 5] and got[2].texto == ""


def test_first_json(spark):
    df = spark.createDataFrame([('<think>{"x":0}</think> so: {"b": 1, "a": [2]} done {"c":3}',), ("{broken",), (None,)], "t string")
    assert [r[0] for r in df.select(L.first_json("t")).collect()] == ['{"a": [2], "b": 1}', None, None]


def test_dependency_path(spark):
    active = [(0, "A", "nsubj", 1), (1, "activate", "ROOT", 1), (2, "B", "dobj", 1)]
    passive = [(0, "A", "nsubjpass", 1), (1, "activate", "ROOT", 1), (2, "by", "agent", 1), (3, "B", "pobj", 2)]
    listed = [(0, "A", "conj", 1), (1, "B", "nsubj", 2), (2, "bind", "ROOT", 2)]
    rows = [(1, active, 0, 2), (2, passive, 0, 3), (3, listed, 0, 1), (4, None, 0, 1), (5, active, 0, 9)]
    df = spark.createDataFrame(rows, "k int, tree array<struct<i:int,lemma:string,dep:string,head:int>>, a int, b int")
    got = {r.k: r.sintaxis for r in L.dependency_paths(df, "tree", "a", "b").collect()}
    assert got[1].sentido == "1>2" and got[1].ancestro == 1 and got[1].camino == "<nsubj[activate]>dobj"
    assert got[2].sentido == "2>1" and got[3].sentido is None and got[4].ancestro is None and got[5].camino is None


def test_contained_texts_against_all_pairs(spark):
    texts = {1: "one two three four five six seven eight", 2: "zz one two three four five six seven eight nine", 3: "two three four five six seven eight", 4: "short", 5: "ne two three four five six seven eigh", 6: "other words that are not there at all now", 7: "", 8: None}
    reserved = ["one two three four five six seven eight", "short", None, ""]
    df = spark.createDataFrame([(k, t) for k, t in texts.items()], "k int, t string")
    got = {r.k for r in L.contained_texts(df, spark.createDataFrame([(r,) for r in reserved], "reservada string"), "k", "t").collect()}
    assert got == {1, 2, 3, 4, 5}


def test_first_match_by_priority(spark):
    left = spark.createDataFrame([(1, "a", "b"), (2, "b", "a"), (3, "x", "y"), (4, None, None)], "id int, p string, q string")
    right = spark.createDataFrame([(10, "a", "b"), (9, "a", "b"), (11, "x", "z")], "f int, r string, s string")
    got = {r.id: (r.f, r.regla) for r in L.first_match(left, right, [[("p", "r"), ("q", "s")], [("p", "s"), ("q", "r")], [("p", "r")]], "id", "f").collect()}
    assert got == {1: (9, 1), 2: (9, 2), 3: (11, 3), 4: (None, None)}


def test_fuzzy_sentences(spark):
    left = spark.createDataFrame([("d", 1, "the gene activated transcription strongly"), ("d", 2, "nothing alike here whatever")], "g string, lid int, texto string")
    right = spark.createDataFrame([("d", 7, "the gene actived transcription strongly"), ("e", 8, "the gene activated transcription strongly")], "g string, rid int, texto string")
    got = L.fuzzy_sentences(left, right, "g").collect()
    want = round(difflib.SequenceMatcher(None, "the gene activated transcription strongly", "the gene actived transcription strongly", autojunk=False).ratio(), 6)
    assert [(r.lid, r.rid, r.parecido) for r in got] == [(1, 7, want)]


def test_cap_and_scores(spark):
    df = spark.createDataFrame([("u", 1, 3.0), ("u", 2, 3.0), ("u", 3, 1.0), ("v", 1, 9.0)], "g string, n int, c double")
    assert sorted((r.g, r.n) for r in L.within_cap(df, ["g"], ["n"], "c", 6.0).collect()) == [("u", 1), ("u", 2)]
    s = spark.createDataFrame([("a", "a"), ("a", None), (None, "b")], "x string, y string")
    assert tuple(L.field_scores(s, [("x", "y")]).first()) == ("x", 2, 1, 1)


def test_the_rest_needs_nothing_of_the_subpackage():
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parent.parent / "correlia"
    users = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts and re.search(r"correlia\.llm|from correlia import llm", p.read_text())]
    assert not users


def test_short_texts_in_reserved_ones(spark):
    d = spark.createDataFrame([(1, "a red"), (2, "它上升"), (3, "x"), (4, "the old red gene of the cell rose in the end"), (5, "none"), (6, ""), (7, None), (8, "gene z9 q")], "i int, t string")
    r = spark.createDataFrame([("It is a red gene.",), ("然后它上升了",), ("gene of the cell",), (None,), ("z9",)], "reservada string")
    assert {x.i for x in L.contained_texts(d, r, "i", "t").collect()} == {1, 2, 4, 8}
