"""Queries over text structure and joins by priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from correlia.functions.text import LIGATURES, like_pattern, without_ligatures
from correlia.operators import linguistic as L
from correlia.plans.base import plan
from correlia.runtime import read

VOCABULARY = {"upregulates": "+", "downregulates": "-", "represses": "-", "activates": "+", "heat shock": "contexto", "two-hybrid assay": "evidencia", "surface plasmon resonance": "evidencia", "DNase I footprinting": "evidencia"}


@plan(r"SELECT doc_id, len(string_split_regex(text, '(?m)^#{1,6} ')) - 1 AS n_titulos FROM documents")
def markdown_headings(spark, d):
    """C4: how many headings a text has."""
    docs = read(spark, d, "documents")
    heads = L.markdown_sections(docs, "doc_id", "text").where("titulo is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return docs.select("doc_id").join(heads, "doc_id", "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("n_titulos"))


@plan()
def markdown_parts(spark, d):
    """C4/Q27: the parts of each text between its headings."""
    return L.markdown_sections(read(spark, d, "documents"), "doc_id", "text")


@plan("""SELECT DISTINCT t AS operon, array_to_string(list_transform(range(1, length(t) - 2), lambda i: left(t, 3) || substr(t, 3 + i, 1)), ',') AS genes FROM (SELECT substr(id_normalizado, 4) AS t FROM menciones WHERE id_normalizado LIKE 'op:%') x WHERE regexp_matches(t, '^[a-z]{3}[A-Z]{2,}$')""")
def operon_members(spark, d):
    """C11: concatenated operon names as their genes."""
    m = read(spark, d, "menciones").where("id_normalizado like 'op:%'").select(F.substring("id_normalizado", 4, 1000).alias("operon")).distinct()
    return m.where(F.col("operon").rlike("^[a-z]{3}[A-Z]{2,}$")).select("operon", F.array_join(L.member_names(F.col("operon")), ",").alias("genes"))


@plan("""SELECT organismo, count(*) AS n FROM (SELECT unnest(list_distinct(regexp_extract_all(texto, '(?:[A-Z]\\.|Pseudomonas|Escherichia|Bacillus|Salmonella) [a-z]{4,}'))) AS organismo FROM texto_unidades) x GROUP BY 1""")
def organism_counts(spark, d):
    """Sentences that name each species."""
    return read(spark, d, "texto_unidades").select(F.explode(L.organisms(F.col("texto"))).alias("organismo")).groupBy("organismo").agg(F.count(F.lit(1)).alias("n"))


@plan()
def vocabulary_tags(spark, d):
    """Words and phrases of a vocabulary with their offsets."""
    return L.tag_vocabulary(read(spark, d, "texto_unidades").select("id", "texto").distinct(), "id", "texto", VOCABULARY)


@plan("SELECT DISTINCT d.doc_id FROM documents d JOIN items_evaluacion i ON length(i.text) > 0 AND length(d.text) > 0 AND (contains(d.text, i.text) OR contains(i.text, d.text))")
def reserved_texts(spark, d):
    """F8: texts that equal, hold, or lie within a reserved one."""
    return L.contained_texts(read(spark, d, "documents").select("doc_id", "text"), read(spark, d, "items_evaluacion").select(F.col("text").alias("reservada")), "doc_id", "text")


@plan("""WITH e AS (SELECT tf, target, min(ejemplo_id) AS ejemplo_id FROM ejemplos GROUP BY 1, 2), e1 AS (SELECT tf, min(ejemplo_id) AS ejemplo_id FROM ejemplos GROUP BY 1), e2 AS (SELECT target, tf, min(ejemplo_id) AS ejemplo_id FROM ejemplos GROUP BY 1, 2)
SELECT j.id_item, coalesce(e.ejemplo_id, e2.ejemplo_id, e1.ejemplo_id) AS ejemplo_id, CASE WHEN e.ejemplo_id IS NOT NULL THEN 1 WHEN e2.ejemplo_id IS NOT NULL THEN 2 WHEN e1.ejemplo_id IS NOT NULL THEN 3 END AS regla FROM juicio_consolidado j LEFT JOIN e ON e.tf = j.regulador AND e.target = j.blanco LEFT JOIN e2 ON e2.target = j.regulador AND e2.tf = j.blanco LEFT JOIN e1 ON e1.tf = j.regulador""")
def prioritised_join(spark, d):
    """Settled items joined with examples by the pair, else the reversed pair, else the regulator."""
    j = read(spark, d, "juicio_consolidado").select("id_item", "regulador", "blanco")
    keys = [[("regulador", "tf"), ("blanco", "target")], [("regulador", "target"), ("blanco", "tf")], [("regulador", "tf")]]
    return L.first_match(j, read(spark, d, "ejemplos").select("ejemplo_id", "tf", "target"), keys, "id_item", "ejemplo_id").select("id_item", "ejemplo_id", "regla")


@plan("""SELECT user_id, event_id, gastado FROM (SELECT user_id, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 6) AS gastado FROM events) x WHERE gastado <= 200""")
def spend_cap(spark, d):
    """Events of a user up to a spend cap."""
    return L.within_cap(read(spark, d, "events").select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "value", 200.0).select("user_id", "event_id", "gastado")


@plan("""WITH m AS (SELECT upper(trim(id_normalizado)) AS gen, count(*) AS n_menciones FROM menciones WHERE id_normalizado IS NOT NULL GROUP BY 1), o AS (SELECT gen, count(*) AS n_operones FROM (SELECT DISTINCT id_fuente, unnest(regexp_extract_all(coalesce(locus_tags, ''), 'PA\\d+(?:\\.\\d+)?')) AS gen FROM operones_bronze) x GROUP BY 1), a AS (SELECT upper(trim(m.id_normalizado)) AS gen, count(DISTINCT u.pmid) AS n_articulos FROM menciones m JOIN texto_unidades u ON u.id = m.unidad_id WHERE m.id_normalizado IS NOT NULL GROUP BY 1)
SELECT o.gen, o.n_operones, coalesce(m.n_menciones, 0) AS n_menciones, coalesce(a.n_articulos, 0) AS n_articulos FROM o LEFT JOIN m ON m.gen = o.gen LEFT JOIN a ON a.gen = o.gen""")
def gene_corpus_counts(spark, d):
    """A4: groups, mentions and articles of each gene, each counted by itself before they are joined."""
    men = read(spark, d, "menciones").where("id_normalizado is not null").select(F.upper(F.trim("id_normalizado")).alias("gen"), "unidad_id")
    n = men.groupBy("gen").agg(F.count(F.lit(1)).alias("n_menciones"))
    art = men.join(read(spark, d, "texto_unidades").select(F.col("id").alias("unidad_id"), "pmid"), "unidad_id").groupBy("gen").agg(F.count_distinct("pmid").alias("n_articulos"))
    ops = read(spark, d, "operones_bronze").select("id_fuente", F.explode(F.regexp_extract_all(F.coalesce("locus_tags", F.lit("")), F.lit(r"(PA\d+(?:\.\d+)?)"), 1)).alias("gen")).distinct().groupBy("gen").agg(F.count(F.lit(1)).alias("n_operones"))
    return ops.join(n, "gen", "left").join(art, "gen", "left").select("gen", "n_operones", F.coalesce("n_menciones", F.lit(0)).alias("n_menciones"), F.coalesce("n_articulos", F.lit(0)).alias("n_articulos"))


@plan("""SELECT 'signo_sugerido' AS campo, count(signo_correcto) AS n, count(CASE WHEN signo_sugerido = signo_correcto THEN 1 END) AS iguales, count(CASE WHEN signo_correcto IS NULL THEN 1 END) AS no_aplica FROM muestra_precision_50 UNION ALL SELECT 'disparador', count(juicio), count(CASE WHEN disparador = juicio THEN 1 END), count(CASE WHEN juicio IS NULL THEN 1 END) FROM muestra_precision_50""")
def field_agreement(spark, d):
    """M7: how often a suggested field is the settled one."""
    return L.field_scores(read(spark, d, "muestra_precision_50"), [("signo_sugerido", "signo_correcto"), ("disparador", "juicio")])


@plan()
def fuzzy_match(spark, d):
    """Evaluation sentences matched with the likest training sentence of the same article."""
    e = read(spark, d, "ejemplos").select(F.trim("pmid").alias("pmid"), "ejemplo_id", "particion", F.col("text").alias("texto")).where("pmid <> ''")
    left = e.where("particion <> 'train'").select("pmid", F.col("ejemplo_id").alias("lid"), "texto")
    right = e.where("particion = 'train'").select("pmid", F.col("ejemplo_id").alias("rid"), "texto")
    return L.fuzzy_sentences(left, right, "pmid", 0.7)


@plan("""WITH m AS (SELECT upper(trim(id_normalizado)) AS locus, min(CASE WHEN tipo = 'gen' THEN texto END) AS nombre, bool_or(tipo = 'proteina') AS es_tf FROM menciones WHERE id_normalizado IS NOT NULL GROUP BY 1), o AS (SELECT gen, string_agg(DISTINCT id_fuente, ';' ORDER BY id_fuente) AS operones FROM (SELECT id_fuente, unnest(regexp_extract_all(coalesce(locus_tags, ''), 'PA\\d+(?:\\.\\d+)?')) AS gen FROM operones_bronze) x GROUP BY 1)
SELECT m.locus, m.nombre, m.es_tf, coalesce(o.operones, '') AS operones FROM m LEFT JOIN o ON o.gen = m.locus""")
def gene_cards(spark, d):
    """M6: what the lookup tools answer for each locus: name, whether it stands as a regulator, its groups."""
    m = read(spark, d, "menciones").where("id_normalizado is not null").groupBy(F.upper(F.trim("id_normalizado")).alias("locus")).agg(F.min(F.when(F.col("tipo") == "gen", F.col("texto"))).alias("nombre"), F.bool_or(F.col("tipo") == "proteina").alias("es_tf"))
    o = read(spark, d, "operones_bronze").select("id_fuente", F.explode(F.regexp_extract_all(F.coalesce("locus_tags", F.lit("")), F.lit(r"(PA\d+(?:\.\d+)?)"), 1)).alias("locus"))
    groups = o.groupBy("locus").agg(F.array_join(F.array_sort(F.collect_set("id_fuente")), ";").alias("operones"))
    return m.join(groups, "locus", "left").select("locus", "nombre", "es_tf", F.coalesce("operones", F.lit("")).alias("operones"))


_PLAIN = "text"
for _a, _b in LIGATURES.items():
    _PLAIN = f"replace({_PLAIN}, '{_a}', '{_b}')"


@plan(f"SELECT doc_id, {_PLAIN} AS limpio FROM documents")
def plain_characters(spark, d):
    """Typeset characters as plain ones."""
    return read(spark, d, "documents").select("doc_id", without_ligatures("text").alias("limpio"))


@plan("""SELECT pmid FROM (SELECT DISTINCT pmid, titulo FROM documentos) x WHERE titulo LIKE '%\\_%' ESCAPE '\\' OR titulo LIKE '%5\\%%' ESCAPE '\\' OR titulo LIKE '%5 \\%%' ESCAPE '\\'""")
def literal_wildcards(spark, d):
    """Titles that hold characters LIKE would take for wildcards."""
    t = read(spark, d, "documentos").select("pmid", "titulo").distinct()
    hit = F.lit(False)
    for x in ("_", "5%", "5 %"):
        hit = hit | F.col("titulo").like(like_pattern(x))
    return t.where(hit).select("pmid")
