import json
import zipfile
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from correlia.plans import runner
from correlia.sources import files, layout, ranges, sinks, xmltext
from correlia.streaming import ingest as stream

ARTICLES = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>1</PMID><Article><Journal><JournalIssue><PubDate><MedlineDate>1999 Mar-Apr</MedlineDate></PubDate></JournalIssue><Title>J</Title></Journal><ArticleTitle>A <i>b</i> c</ArticleTitle>
<Abstract><AbstractText Label="AIM">x <b>y</b></AbstractText><AbstractText>z</AbstractText></Abstract><AuthorList><Author><LastName>Lee</LastName><Initials>A</Initials></Author><Author><CollectiveName>Group</CollectiveName></Author></AuthorList></Article></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/x</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"""
FULL = """<article><body><sec><title>Results</title><p>One <i>two</i>.</p><sec><title>Sub</title><p>Three.</p></sec></sec><fig><caption>Cap.</caption></fig></body></article>"""
TABLE = """<article><body><table-wrap><caption>T</caption><table><tr><th rowspan="2">a</th><th colspan="2">b</th></tr><tr><td>1</td><td>2</td></tr></table></table-wrap></body></article>"""


def test_xml(spark):
    df = spark.createDataFrame([("k", ARTICLES), ("broken", "<a"), ("none", None)], "k string, xml string")
    r = xmltext.articles(df).collect()
    assert len(r) == 1 and (r[0].pmid, r[0].titulo, r[0].abstract, r[0].anio, r[0].doi, r[0].autores) == ("1", "A b c", "AIM: x y\nz", "1999", "10.1/x", ["Lee A", "Group"])
    t = {r.k: (r.texto, r.con_cuerpo) for r in xmltext.full_texts(df.withColumn("xml", F.when(F.col("k") == "k", F.lit(FULL)).otherwise(F.col("xml"))), "k").collect()}
    assert t["k"] == ("## Results\n\nOne two.\n\n### Sub\n\nThree.\n\n## Captions\n\nCap.", True) and t["broken"] == (None, False)
    tab = xmltext.tables(spark.createDataFrame([("k", TABLE)], "k string, xml string"), "k").first()
    assert tab.titulo == "T" and [list(x) for x in tab.filas] == [["a", "b", "b"], ["a", "1", "2"]]


class Fake:
    """A service with three records a day."""

    def count(self, query, a, b):
        return 3 * ((b - a).days + 1)

    def ids(self, query, a, b):
        return [f"{a + timedelta(days=i)}-{k}" for i in range((b - a).days + 1) for k in range(3)]


def test_slices_cover_the_range_and_respect_the_cap():
    got = ranges.slices(Fake(), "q", date(2019, 11, 20), date(2021, 2, 3), cap=50)
    assert all(n <= 50 for *_, n in got) and got[0][0] == date(2019, 11, 20) and got[-1][1] == date(2021, 2, 3)
    assert all(x[1] + timedelta(days=1) == y[0] for x, y in zip(got, got[1:]))
    with pytest.raises(ValueError):
        ranges.slices(Fake(), "q", date(2020, 1, 1), date(2020, 1, 5), cap=2)


def test_search_source(spark):
    class Local:
        def count(self, query, a, b):
            return (b - a).days + 1

        def ids(self, query, a, b):
            from datetime import timedelta

            return [str(a + timedelta(days=i)) for i in range((b - a).days + 1)]

    ranges.register(spark, ranges.search_source("fake_search", Local, cap=10))
    df = spark.read.format("fake_search").options(query="q", first="2020-01-01", last="2020-02-09").load()
    ids, report = ranges.union_slices(df)
    assert ids.count() == 40 and {r.estado for r in report.collect()} == {"igual"}
    got = ranges.fetch_records(ids, lambda keys: [{"pmid": k, "n": len(keys)} for k in keys], "pmid string, n int", batch=7)
    assert got.count() == 40 and got.agg(F.max("n")).first()[0] <= 7


def test_files(spark, tmp_path):
    p = tmp_path / "a.tsv"
    p.write_text("koid\torganismo\tnombre\tmiembros\n1\tpae\tx\tb, a,\n2\teco\ty\tc\n")
    assert [list(r.miembros) for r in files.read_operon_dump(spark, str(p), "pae").collect()] == [["b", "a"]]
    with pytest.raises(ValueError):
        files.read_delimited(spark, str(p), "koid string, nombre string")
    g = tmp_path / "g.gff"
    g.write_text("##gff\nchr\tR\tgene\t1\t9\t.\t+\t.\tlocus_tag=PA1;gene=abc%41\nchr\tR\tCDS\t1\t9\t.\t+\t.\tx=y\n")
    assert [tuple(r) for r in files.genes_of_gff(files.read_gff(spark, str(g))).collect()] == [("PA1", "abcA", 1, 9, "+")]
    rows = tmp_path / "r.tsv"
    rows.write_text("operon\torden\tlocus\no1\t2\tPA2\no1\t1\tPA9\n")
    assert list(files.read_gene_rows(spark, str(rows)).first().miembros) == ["PA9", "PA2"]
    assert [files.sniff(x) for x in (b"%PDF-1", b"PK\x03\x04", b'{"a":1}', b"<!DOCTYPE html>", b"<a/>", b"a\tb\n1\t2\n", b"\x00\x01", b"word")] == ["pdf", "zip", "json", "html", "xml", "tsv", "binario", "texto"]


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a\u0001<", None), ("b", "2")], "x string, y string")
    sinks.write_xlsx({"one": df}, str(tmp_path / "w.xlsx"))
    got = files.read_xlsx(spark, str(tmp_path / "w.xlsx"), "one")
    assert got.columns == ["x", "y"] and {r.x for r in got.collect()} == {"a<", "b"}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], "x\ty"), (2, None, None)], "id int, l array<string>, t string")
    assert sinks.export_file(df, str(tmp_path / "a.csv")) == 2
    assert (tmp_path / "a.csv").read_text().splitlines()[0] == "id,l,t" and "a | b" in (tmp_path / "a.csv").read_text()
    assert sinks.export_json_lines(df, str(tmp_path / "a.jsonl")) == 2 and json.loads((tmp_path / "a.jsonl").read_text().splitlines()[0])["id"] in (1, 2)
    assert sinks.export_package({"t": df}, str(tmp_path / "p.zip"), "about") == {"t": 2} and set(zipfile.ZipFile(tmp_path / "p.zip").namelist()) == {"t.csv", "README.txt"}
    path = str(tmp_path / "t")
    assert sinks.append_only(df.select("id"), path, ["id"]) == 2 and sinks.append_only(df.select("id"), path, ["id"]) == 0 and spark.read.parquet(path).count() == 2
    runs = str(tmp_path / "r")
    two = spark.createDataFrame([(1, "a"), (2, "b")], "corrida_id int, v string")
    sinks.write_runs(two, runs)
    sinks.write_runs(two.where("corrida_id = 2").withColumn("v", F.lit("c")), runs)
    assert sorted((r.corrida_id, r.v) for r in spark.read.parquet(runs).collect()) == [(1, "a"), (2, "c")]
    sinks.drop_run(spark, runs, "corrida_id", 1)
    assert spark.read.parquet(runs).count() == 1


def test_graph(spark, tmp_path):
    import xml.etree.ElementTree as ET

    nodes = spark.createDataFrame([("a&", 1), ("b", 2)], "nodo string, n int")
    edges = spark.createDataFrame([("a&", "b", True, 3)], "tf string, target string, conflict boolean, n_evidencias int")
    assert sinks.write_graphml(nodes, edges, str(tmp_path / "g.graphml")) == (2, 1)
    assert len(ET.parse(tmp_path / "g.graphml").getroot().findall(".//{*}node")) == 2
    sinks.write_viewer(edges, str(tmp_path / "v.html"), "net")
    assert "a&" in (tmp_path / "v.html").read_text()


def test_publish_is_all_or_nothing(tmp_path):
    good = lambda text: lambda p: open(p, "w").write(text)
    sinks.publish({"a": good("1"), "b": good("1")}, str(tmp_path / "out"))

    def bad(_):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        sinks.publish({"a": good("2"), "b": bad}, str(tmp_path / "out"))
    assert (tmp_path / "out/a").read_text() == "1"


def test_layout(spark):
    schema = "doc string, pagina int, x0 double, y0 double, x1 double, y1 double, ancho double, alto double, texto string"
    rows = []
    for p in (1, 2):
        rows += [("d", p, 10, 5, 90, 8, 100, 100, f"Head {p}"), ("d", p, 5, 20, 95, 24, 100, 100, f"Title{p}"), ("d", p, 55, 30, 95, 34, 100, 100, f"right{p}"), ("d", p, 5, 30, 45, 34, 100, 100, f"left{p} repli-"), ("d", p, 5, 36, 45, 40, 100, 100, "cate replicate")]
    df = spark.createDataFrame([tuple(float(x) if i in range(2, 8) else x for i, x in enumerate(r)) for r in rows], schema)
    text = layout.joined_text(layout.reading_order(layout.without_margins(df))).first().texto
    assert text.startswith("Title1\nleft1 replicate replicate\nright1\nTitle2") and "Head" not in text


def test_steps_run_once(tmp_path):
    log = []

    def write(text):
        def run(inputs, output):
            log.append(text)
            open(output, "w").write(text + "".join(open(p).read() for p in inputs.values()))

        return run

    steps = [runner.Step("b", write("b"), ["a"]), runner.Step("a", write("a"))]
    assert runner.run_steps(steps, str(tmp_path)) == {"a": "hecho", "b": "hecho"}
    assert runner.run_steps(steps, str(tmp_path)) == {"a": "igual", "b": "igual"}
    steps[1].params = {"x": 1}
    assert runner.run_steps(steps, str(tmp_path)) == {"a": "hecho", "b": "igual"}
    assert log == ["a", "b", "a"]
    with pytest.raises(ValueError):
        runner.ordered([runner.Step("x", write("x"), ["x"])])
    assert len(runner.grid({"a": [1, 2], "b": [3, 4, 5]})) == 6


def test_streams(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (2, "b"), (1, "a")], "id int, v string").write.parquet(src)
    for _ in range(2):
        stream.ingest_new(stream.follow(spark, src, "id int, v string"), out, ["id"], str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([(2, "b"), (3, "c")], "id int, v string").write.mode("append").parquet(src)
    stream.ingest_new(stream.follow(spark, src, "id int, v string"), out, ["id"], str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    ev = str(tmp_path / "ev")
    spark.sql("select 'u' as k, timestamp'2024-01-01 00:00:00' as t, 'x' as v union all select 'u', timestamp'2024-01-01 00:05:00', 'y' union all select 'w', timestamp'2024-01-01 02:00:00', 'x'").write.parquet(ev)

    def run(df, name, mode):
        df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
        return spark.table(name).collect()

    s = lambda: stream.follow(spark, ev, "k string, t timestamp, v string")
    assert {(r.k, r.v, r.cambios) for r in run(stream.latest_state(s(), "k", "t", "v"), "latest", "update")} == {("u", "y", 1), ("w", "x", 0)}
    assert sum(r.n for r in run(stream.windowed_counts(s(), "t", "1 hour", ["k"]), "wins", "complete")) == 3
    assert {(r.k, r.n) for r in run(stream.sessions(s(), "t", ["k"]), "sess", "complete")} == {("u", 2), ("w", 1)}
    assert len(run(stream.first_of_key(s(), ["k"], "t"), "firsts", "append")) == 2


def test_client_tells_no_from_could_not_ask():
    answers = iter([OSError(), (503, b""), (200, b"x")])

    def opener(url):
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a

    assert ranges.Client(opener, sleep=lambda s: None).get("u") == b"x"
    assert ranges.Client(lambda u: (404, b""), sleep=lambda s: None).get("u") is None
    with pytest.raises(ConnectionError):
        ranges.Client(lambda u: (500, b""), sleep=lambda s: None).get("u")


def test_names_and_answers(spark):
    from correlia.functions import text as X
    from correlia.operators import operons, scoring

    df = spark.createDataFrame([("mexAB-oprM", "a = b (= c); d", "ﬁve −1", '{"relacion": "si", "fragmento": "zz"}', "text"), (None, None, None, None, None)], "n string, c string, t string, s string, x string")
    r = df.select(operons.decompose_name(F.col("n")).alias("n"), X.alias_chains("c").alias("c"), X.without_ligatures("t").alias("t"), scoring.valid_annotation("s", "x").alias("v")).collect()
    assert list(r[0].n) == ["mexA", "mexB", "oprM"] and [list(x) for x in r[0].c] == [["a", "b", "c"]] and r[0].t == "five -1" and r[0].v == "fragmento_ajeno"
    assert r[1].n is None and r[1].v == "abstencion"
    scoring.check_labels({0: "activates", 1: "no_relation", 2: "regulates", 3: "represses"})
    with pytest.raises(ValueError):
        scoring.check_labels({0: "represses", 1: "no_relation", 2: "regulates", 3: "activates"})
