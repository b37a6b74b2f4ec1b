"""Queries of the extraction layer: sections, sentences, mentions, candidates and pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from correlia.functions import text as X
from correlia.operators import mentions as M
from correlia.operators import network as N
from correlia.plans.base import plan
from correlia.runtime import read

GENIC = ["gen", "proteina", "operon"]
_MEN = "(SELECT DISTINCT id, unidad_id, tipo, texto, upper(trim(id_normalizado)) AS entidad, offset_ini, offset_fin FROM menciones)"
_UNI = "(SELECT DISTINCT id, pmid, fuente_texto, seccion, num_oracion, texto, corrida_id FROM texto_unidades)"
_TF = f"(SELECT DISTINCT entidad FROM {_MEN} m WHERE tipo = 'proteina' AND entidad IS NOT NULL)"


def mentions(spark: SparkSession, d: str) -> DataFrame:
    """Mentions without exact repeats, ids trimmed and in capitals."""
    return read(spark, d, "menciones").select("id", "unidad_id", "tipo", "texto", F.upper(F.trim("id_normalizado")).alias("entidad"), "offset_ini", "offset_fin").distinct()


def units(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "texto_unidades").select("id", "pmid", "fuente_texto", "seccion", "num_oracion", "texto", "corrida_id").distinct()


def spans(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Regulators (protein forms) and all genic entities as (unit, id, ini, fin)."""
    m = mentions(spark, d).where(F.col("tipo").isin(*GENIC) & F.col("entidad").isNotNull())
    s = m.select(F.col("unidad_id").alias("unit"), F.col("entidad").alias("id"), F.col("offset_ini").alias("ini"), F.col("offset_fin").alias("fin"), "tipo")
    return s.where("tipo = 'proteina'").drop("tipo"), s.drop("tipo")


_BEST = f"""(SELECT unit, tf, target, b[1] AS gap, b[2] AS r_ini, b[3] AS t_ini FROM (SELECT r.unidad_id AS unit, r.entidad AS tf, t.entidad AS target, min([greatest(r.offset_ini, t.offset_ini) - least(r.offset_fin, t.offset_fin), r.offset_ini, t.offset_ini]) AS b
FROM {_MEN} r JOIN {_MEN} t ON r.unidad_id = t.unidad_id WHERE r.tipo = 'proteina' AND r.entidad IS NOT NULL AND t.tipo IN ('gen', 'proteina', 'operon') AND t.entidad IS NOT NULL AND NOT (r.offset_ini = t.offset_ini AND r.offset_fin = t.offset_fin) GROUP BY 1, 2, 3) x)"""
_TRI = "(SELECT DISTINCT m.unidad_id AS unit, m.offset_ini AS ini, m.offset_fin AS fin, CASE WHEN lower(m.texto) IN ('activates', 'induces', 'stimulates', 'upregulates', 'derepresses') THEN '+' WHEN lower(m.texto) IN ('represses', 'inhibits', 'silences', 'blocks', 'downregulates') THEN '-' ELSE '?' END AS sign FROM menciones m WHERE tipo = 'disparador')"
#: Trigger words by sign.
POSITIVE, NEGATIVE = ["activates", "induces", "stimulates", "upregulates", "derepresses"], ["represses", "inhibits", "silences", "blocks", "downregulates"]


def triggers(spark: SparkSession, d: str) -> DataFrame:
    word = F.lower("texto")
    sign = F.when(word.isin(*POSITIVE), "+").when(word.isin(*NEGATIVE), "-").otherwise("?")
    return mentions(spark, d).where("tipo = 'disparador'").select(F.col("unidad_id").alias("unit"), F.col("offset_ini").alias("ini"), F.col("offset_fin").alias("fin"), sign.alias("sign")).distinct()


@plan(f"""SELECT b.tf, b.target, count(*) AS n_oraciones, count(DISTINCT u.pmid) AS n_documentos, max(1.0 / (1 + greatest(b.gap, 0))) AS mejor, coalesce(string_agg(DISTINCT s.sign, ';' ORDER BY s.sign), '') AS signos, count(CASE WHEN s.sign = '+' THEN 1 END) AS n_mas, count(CASE WHEN s.sign = '-' THEN 1 END) AS n_menos,
CASE WHEN count(CASE WHEN s.sign = '+' THEN 1 END) = count(CASE WHEN s.sign = '-' THEN 1 END) THEN 'regulates' WHEN greatest(count(CASE WHEN s.sign = '+' THEN 1 END), count(CASE WHEN s.sign = '-' THEN 1 END)) / (count(CASE WHEN s.sign = '+' THEN 1 END) + count(CASE WHEN s.sign = '-' THEN 1 END)) >= 0.66 THEN CASE WHEN count(CASE WHEN s.sign = '+' THEN 1 END) > count(CASE WHEN s.sign = '-' THEN 1 END) THEN 'activates' ELSE 'represses' END ELSE 'regulates' END AS signo
FROM {_BEST} b JOIN {_UNI} u ON u.id = b.unit LEFT JOIN (SELECT unit, min(sign) AS sign FROM {_TRI} t WHERE sign <> '?' GROUP BY unit HAVING count(DISTINCT sign) = 1) s ON s.unit = b.unit GROUP BY 1, 2""")
def directed_pairs(spark, d):
    """Directed pairs with sentences, documents, best score, and the sign their triggers vote for."""
    best = M.nearest_pairs(*spans(spark, d)).withColumn("score", 1.0 / (1 + F.greatest("gap", F.lit(0))))
    one = triggers(spark, d).where("sign <> '?'").groupBy("unit").agg(F.min("sign").alias("sign"), F.max("sign").alias("__x")).where("sign = __x").drop("__x")
    rows = best.join(units(spark, d).select(F.col("id").alias("unit"), "pmid"), "unit").join(one, "unit", "left")
    summary = M.pair_summary(rows)
    votes = rows.groupBy("tf", "target").agg(F.count_if(F.col("sign") == "+").alias("n_mas"), F.count_if(F.col("sign") == "-").alias("n_menos"))
    return summary.join(votes, ["tf", "target"]).withColumn("signo", N.vote(F.col("n_mas"), F.col("n_menos"))["sign"])


@plan(f"SELECT unit, tf, target, gap, r_ini, t_ini FROM {_BEST} b")
def nearest_occurrence(spark, d):
    """Of each pair in a sentence the nearest occurrences."""
    return M.nearest_pairs(*spans(spark, d)).select("unit", "tf", "target", "gap", "r_ini", "t_ini")


@plan(f"""WITH s AS (SELECT unit, min(r_ini) AS ini, max(t_ini) AS fin FROM {_BEST} b GROUP BY unit), j AS (SELECT s.unit, CASE WHEN t.ini >= s.ini AND t.fin <= s.fin THEN 0 ELSE least(abs(t.ini - s.fin), abs(s.ini - t.fin)) END AS d, t.ini AS ti, t.sign FROM s JOIN {_TRI} t ON t.unit = s.unit WHERE t.sign <> '?')
SELECT unit, arg_min(d, (d, ti, sign)) AS distancia, arg_min(sign, (d, ti, sign)) AS sign FROM j GROUP BY unit""")
def lexical_sign(spark, d):
    """Sign of the trigger nearest to the span between the mentions."""
    span = M.nearest_pairs(*spans(spark, d)).groupBy("unit").agg(F.min("r_ini").alias("ini"), F.max("t_ini").alias("fin"))
    return M.nearest_sign(triggers(spark, d), span)


@plan(f"""WITH g AS (SELECT DISTINCT unidad_id AS id, entidad FROM {_MEN} m WHERE tipo IN ('gen', 'proteina', 'operon') AND entidad IS NOT NULL), s AS (SELECT g.id, count(*) AS n_entidades, count(t.entidad) AS n_tf, min(t.entidad) AS un_tf, min(CASE WHEN t.entidad IS NULL THEN g.entidad END) AS otra FROM g LEFT JOIN {_TF} t ON t.entidad = g.entidad GROUP BY 1)
SELECT u.id, s.n_entidades, s.n_tf, CASE WHEN n_tf = 1 THEN un_tf END AS regulador, CASE WHEN n_tf = 1 AND n_entidades = 2 THEN otra END AS blanco FROM {_UNI} u JOIN s ON s.id = u.id WHERE length(u.texto) BETWEEN 40 AND 700 AND n_entidades BETWEEN 2 AND 8""")
def candidate_sentences(spark, d):
    """Sentences that qualify as candidates."""
    m = mentions(spark, d).where(F.col("tipo").isin(*GENIC))
    return M.candidate_sentences(units(spark, d), m, m.where("tipo = 'proteina' and entidad is not null").select("entidad"))


@plan(f"""WITH e AS (SELECT unidad_id AS unit, count(CASE WHEN tipo = 'evidencia' THEN 1 END) AS evid, count(CASE WHEN tipo = 'disparador' THEN 1 END) AS trig, count(DISTINCT CASE WHEN tipo = 'proteina' THEN entidad END) AS regs, count(DISTINCT CASE WHEN tipo IN ('gen', 'proteina', 'operon') THEN entidad END) AS genes FROM {_MEN} m GROUP BY 1)
SELECT unit, round(least(CASE WHEN trig > 1 THEN 0.40 WHEN trig > 0 THEN 0.20 ELSE 0.0 END + CASE WHEN regs = 1 THEN 0.20 ELSE 0.0 END + CASE WHEN evid >= 1 THEN 0.15 ELSE 0.0 END + CAST(0.15 AS DOUBLE) * (1 - CAST(least(genes, 5) AS DOUBLE) / 5), 1.0), 3) AS score FROM e""")
def ordering_scores(spark, d):
    """Ordering score of sentences (two triggers standing for one between the mentions)."""
    m = mentions(spark, d)
    is_ = lambda t: F.col("tipo") == t
    e = m.groupBy(F.col("unidad_id").alias("unit")).agg(
        F.count_if(is_("evidencia")).alias("evid"), F.count_if(is_("disparador")).alias("trig"), F.count_distinct(F.when(is_("proteina"), F.col("entidad"))).alias("regs"),
        F.count_distinct(F.when(F.col("tipo").isin(*GENIC), F.col("entidad"))).alias("genes"),
    )
    e = e.withColumn("between", F.greatest(F.col("trig") - 1, F.lit(0)))
    return e.select("unit", M.ordering_score("between", "trig", "regs", "evid", "genes").alias("score"))


@plan(f"SELECT id, num_oracion, CASE WHEN lag(num_oracion) OVER w = num_oracion - 1 THEN lag(texto) OVER w END AS anterior, CASE WHEN lead(num_oracion) OVER w = num_oracion + 1 THEN lead(texto) OVER w END AS siguiente FROM {_UNI} u WINDOW w AS (PARTITION BY corrida_id, pmid, fuente_texto ORDER BY num_oracion, id)")
def sentence_context(spark, d):
    """Text of the neighbouring sentences, null across a gap."""
    return M.context(units(spark, d), ["corrida_id", "pmid", "fuente_texto"], "num_oracion", "texto").select("id", "num_oracion", "anterior", "siguiente")


@plan(f"SELECT id, row_number() OVER (PARTITION BY corrida_id, pmid ORDER BY fuente_texto, num_oracion, id) - 1 AS numero FROM {_UNI} u WHERE length(texto) >= 40")
def sentence_numbers(spark, d):
    """Number of a kept sentence within its document."""
    return M.renumber(units(spark, d).where(F.length("texto") >= 40), ["corrida_id", "pmid"], ["fuente_texto", "num_oracion", "id"]).select("id", "numero")


@plan(f"SELECT m.unidad_id, count(*) AS n, string_agg(CAST(m.id AS VARCHAR), ',' ORDER BY m.offset_ini, m.id) AS ids FROM {_MEN} m WHERE m.unidad_id IN (SELECT unidad_id FROM oraciones_candidatas) GROUP BY 1")
def candidate_mentions(spark, d):
    """Mentions of candidate sentences, as a list per sentence."""
    return M.mention_lists(read(spark, d, "oraciones_candidatas"), mentions(spark, d), "unidad_id")


@plan(f"""SELECT o.id, u.pmid, u.seccion, o.score, doc.anio FROM oraciones_candidatas o JOIN {_UNI} u ON u.id = o.unidad_id JOIN (SELECT pmid, max(anio) AS anio FROM documentos GROUP BY 1) doc ON doc.pmid = u.pmid""")
def candidate_export(spark, d):
    """Candidates with their sentence and document."""
    doc = read(spark, d, "documentos").groupBy("pmid").agg(F.max("anio").alias("anio"))
    o = read(spark, d, "oraciones_candidatas").select("id", F.col("unidad_id"), "score")
    return o.join(units(spark, d).select(F.col("id").alias("unidad_id"), "pmid", "seccion"), "unidad_id").join(doc, "pmid").select("id", "pmid", "seccion", "score", "anio")


@plan("""WITH s AS (SELECT DISTINCT texto AS surface, upper(trim(id_normalizado)) AS id FROM menciones WHERE id_normalizado IS NOT NULL AND regexp_matches(texto, '^[A-Za-z][A-Za-z0-9]+$')), e AS (SELECT surface, count(DISTINCT id) AS n, min(id) AS id FROM s GROUP BY 1), f AS (SELECT lower(surface) AS low, count(DISTINCT id) AS m, min(id) AS id FROM s GROUP BY 1),
t AS (SELECT pmid, unnest(regexp_extract_all(titulo, '[A-Za-z][A-Za-z0-9]+')) AS token FROM (SELECT pmid, max(titulo) AS titulo FROM documentos GROUP BY 1) x)
SELECT coalesce(CASE WHEN e.n = 1 THEN e.id END, CASE WHEN e.n IS NULL AND f.m = 1 THEN f.id END) AS id, count(*) AS n, count(DISTINCT pmid) AS n_documentos FROM t LEFT JOIN e ON e.surface = t.token LEFT JOIN f ON f.low = lower(t.token) WHERE coalesce(CASE WHEN e.n = 1 THEN e.id END, CASE WHEN e.n IS NULL AND f.m = 1 THEN f.id END) IS NOT NULL GROUP BY 1""")
def dictionary_mentions(spark, d):
    """Titles tagged with a dictionary, exact before folded, ambiguous forms left out."""
    surfaces = read(spark, d, "menciones").where(F.col("id_normalizado").isNotNull() & F.col("texto").rlike("^[A-Za-z][A-Za-z0-9]+$")).select(F.col("texto").alias("surface"), F.upper(F.trim("id_normalizado")).alias("id"))
    titles = read(spark, d, "documentos").groupBy("pmid").agg(F.max("titulo").alias("titulo"))
    got = M.resolve(M.tokens(titles, "titulo", ["pmid"]), surfaces)
    return got.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("pmid").alias("n_documentos"))


@plan("""WITH s AS (SELECT DISTINCT texto AS surface, upper(trim(id_normalizado)) AS id FROM menciones WHERE id_normalizado IS NOT NULL) SELECT surface, count(DISTINCT id) AS n FROM s GROUP BY 1 HAVING count(DISTINCT id) > 1""")
def dictionary_ambiguity(spark, d):
    """Q13: surfaces that more than one id claims."""
    s = read(spark, d, "menciones").where("id_normalizado is not null").select(F.col("texto").alias("surface"), F.upper(F.trim("id_normalizado")).alias("id"))
    return s.groupBy("surface").agg(F.count_distinct("id").alias("n")).where("n > 1")


_CLS = "CASE WHEN h IN ('abstract', 'summary', 'resumen') THEN 'resumen' WHEN h IN ('introduction', 'background', 'introduccion', 'introducción') THEN 'introduccion' WHEN h IN ('methods', 'materials and methods', 'experimental procedures', 'métodos', 'metodos') THEN 'metodos' WHEN h IN ('results', 'results and discussion', 'resultados') THEN 'resultados' WHEN h IN ('discussion', 'discusion', 'discusión') THEN 'discusion' WHEN h IN ('conclusion', 'conclusions', 'conclusiones') THEN 'conclusiones' WHEN h IN ('fig. legend', 'figure legend', 'legend', 'leyenda') THEN 'leyenda' WHEN h IN ('references', 'acknowledgements', 'funding', 'bibliography') THEN 'excluir' ELSE 'otra' END"
_HEAD = "lower(regexp_replace(regexp_replace(trim(regexp_replace(seccion, '\\s+', ' ', 'g')), '^(?:\\d+(?:\\.\\d+)*\\.?|[IVX]+\\.) ', ''), '[.: ]+$', ''))"


@plan(f"SELECT {_CLS} AS clase, count(*) AS n, count(DISTINCT pmid) AS n_documentos FROM (SELECT pmid, {_HEAD} AS h FROM texto_unidades) x GROUP BY 1")
def section_classes(spark, d):
    """Headings normalised and put into classes."""
    return read(spark, d, "texto_unidades").select("pmid", X.section_class("seccion").alias("clase")).groupBy("clase").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("pmid").alias("n_documentos"))


@plan("SELECT ejemplo_id, trim(regexp_replace(lower(regexp_replace(regexp_replace(text, '[<\\[]\\s*/?\\s*[eE][12]\\s*[>\\]]', ' ', 'g'), '[^\\p{L}\\p{N}\\s\\x{00A0}]+', ' ', 'g')), '[\\s\\x{00A0}]+', ' ', 'g')) AS canon FROM ejemplos")
def canonical_text(spark, d):
    """C17: sentences without marks, punctuation and case."""
    return read(spark, d, "ejemplos").select("ejemplo_id", X.canonical(F.col("text")).alias("canon"))


@plan("SELECT id, CASE WHEN regexp_matches(texto, '^[a-z]{3}[A-Z0-9]') THEN upper(left(texto, 1)) || substr(texto, 2) ELSE texto END AS proteina, CASE WHEN regexp_matches(texto, '^[A-Z][a-z]{2}[A-Z0-9]') THEN lower(left(texto, 1)) || substr(texto, 2) ELSE texto END AS gen FROM (SELECT DISTINCT id, texto FROM menciones WHERE tipo IN ('gen', 'proteina')) m")
def name_forms(spark, d):
    """Gene and protein forms of a name."""
    return read(spark, d, "menciones").where("tipo in ('gen', 'proteina')").select("id", "texto").distinct().select("id", X.protein_form("texto").alias("proteina"), X.gene_form("texto").alias("gen"))


@plan(f"""SELECT id_item, CASE WHEN regexp_matches(o, '{X.LOSS}') AND regexp_matches(o, '{X.RAISED}') THEN 'fenotipo_mutante' WHEN regexp_matches(o, '{X.DIRECT}') THEN 'directa'
WHEN regexp_matches(o, '{X.CONTRARY}') THEN 'contraria_aparente' ELSE 'otra' END AS redaccion FROM (SELECT DISTINCT id_item, oracion AS o FROM juicio_consolidado) x""")
def evidence_wording(spark, d):
    """C14: how a sentence words its evidence."""
    return read(spark, d, "juicio_consolidado").select("id_item", "oracion").distinct().select("id_item", X.wording("oracion").alias("redaccion"))


@plan(r"""SELECT ejemplo_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(regexp_replace(pmid, '10\.\d{4,}/\S+', ' ', 'g'), '\d+(?:\.\d+)?[eE]\+?\d{1,2}\b|\d+'),
  lambda x: ltrim(CASE WHEN regexp_matches(x, '[eE]') THEN CAST(TRY_CAST(TRY_CAST(x AS DOUBLE) AS DECIMAL(38, 0)) AS VARCHAR) ELSE x END, '0')), lambda x: length(x) BETWEEN 7 AND 8))), ',') AS articulos FROM ejemplos""")
def article_cells(spark, d):
    """Article numbers of a cell that may name several."""
    return read(spark, d, "ejemplos").select("ejemplo_id", F.array_join(F.array_sort(X.article_ids("pmid")), ",").alias("articulos"))


@plan("SELECT id, locate AS lugar FROM (SELECT m.id, nullif(strpos(u.texto, m.texto) - 1, -1) AS locate FROM (SELECT DISTINCT id, unidad_id, texto FROM menciones) m JOIN (SELECT DISTINCT id AS uid, texto FROM texto_unidades) u ON u.uid = m.unidad_id) x")
def fragment_places(spark, d):
    """Place of a fragment in its sentence."""
    m = read(spark, d, "menciones").select("id", "unidad_id", F.col("texto").alias("frag")).distinct()
    u = read(spark, d, "texto_unidades").select(F.col("id").alias("unidad_id"), "texto").distinct()
    return m.join(u, "unidad_id").select("id", X.locate("texto", "frag").alias("lugar"))


@plan(f"SELECT m.id, substr(u.texto, 1, m.offset_ini) || '<e1> ' || substr(u.texto, m.offset_ini + 1, m.offset_fin - m.offset_ini) || ' </e1>' || substr(u.texto, m.offset_fin + 1) AS marcado FROM {_MEN} m JOIN {_UNI} u ON u.id = m.unidad_id WHERE m.tipo = 'proteina'")
def marked_sentences(spark, d):
    """A mention marked in its sentence."""
    m = mentions(spark, d).where("tipo = 'proteina'").select(F.col("id").alias("mid"), "unidad_id", "offset_ini", "offset_fin")
    return m.join(units(spark, d).select(F.col("id").alias("unidad_id"), "texto"), "unidad_id").select(F.col("mid").alias("id"), X.mark_span("texto", "offset_ini", "offset_fin", "e1").alias("marcado"))


@plan("SELECT ejemplo_id, left(sha1(concat_ws('|', coalesce(pmid, ''), coalesce(tf, ''), coalesce(target, ''))), 16) AS id_par FROM ejemplos")
def pair_ids(spark, d):
    """Short content ids of pairs."""
    return read(spark, d, "ejemplos").select("ejemplo_id", X.short_hash("pmid", "tf", "target").alias("id_par"))


@plan("""SELECT item_id, len(list_filter(string_split(regexp_replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)), lambda x: length(x) > 0)) AS trozos FROM items_evaluacion""")
def sentence_split(spark, d):
    """Cut at sentence marks (before the pieces that end in an abbreviation are rejoined)."""
    return read(spark, d, "items_evaluacion").select("item_id", F.size(F.split(X.squeeze("text"), r"(?<=[.!?]) ")).alias("trozos"))


@plan()
def sentence_fold(spark, d):
    """Sentences of the abstracts, abbreviations and initials kept together."""
    doc = read(spark, d, "documentos").groupBy("pmid").agg(F.max("abstract").alias("abstract"))
    return doc.select("pmid", F.posexplode(X.sentences(F.col("abstract"))).alias("num", "oracion"))


@plan("""WITH p AS (SELECT tf, target, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS s, min(ejemplo_id) AS f FROM ejemplos GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY tf, target ORDER BY f, s) AS k FROM p) SELECT e.ejemplo_id FROM ejemplos e JOIN r ON r.tf = e.tf AND r.target = e.target AND r.s = trim(regexp_replace(e.text, '\\s+', ' ', 'g')) WHERE k <= 2""")
def capped_pairs(spark, d):
    """Rows of the first two distinct sentences of each pair."""
    rows = read(spark, d, "ejemplos").select("ejemplo_id", "tf", "target", F.regexp_replace(F.regexp_replace("text", r"\s+", " "), "^ | $", "").alias("s"))
    return M.capped_sentences(rows, ["tf", "target"], "s", "ejemplo_id", 2).select("ejemplo_id")


@plan("SELECT unidad_id, upper(trim(id_normalizado)) AS entidad, arg_min(id, (offset_ini, id)) AS id FROM menciones WHERE id_normalizado IS NOT NULL GROUP BY 1, 2")
def first_mention(spark, d):
    """First mention of each entity of a sentence."""
    m = read(spark, d, "menciones").where("id_normalizado is not null").select("unidad_id", F.upper(F.trim("id_normalizado")).alias("id_normalizado"), "offset_ini", "id")
    return M.first_mentions(m).select("unidad_id", F.col("id_normalizado").alias("entidad"), "id")
