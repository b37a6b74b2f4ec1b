"""Queries of the ingest layer over the project tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from correlia.functions import text as X
from correlia.operators import ingest as I
from correlia.operators import snapshots as S
from correlia.plans.base import plan
from correlia.runtime import read

#: Saved queries of the examples: name and the word a title holds.
SAVED = [("quorum", "quorum"), ("operon", "operon"), ("strain", "strain"), ("never", "zzzz")]
_SAVED = "(VALUES ('quorum','quorum'),('operon','operon'),('strain','strain'),('never','zzzz')) s(consulta, palabra)"
_DOC = "(SELECT pmid, max(doi) AS doi, max(titulo) AS titulo, max(abstract) AS abstract, max(anio) AS anio FROM documentos GROUP BY pmid)"


def documents(spark: SparkSession, d: str) -> DataFrame:
    """One row per article."""
    return read(spark, d, "documentos").groupBy("pmid").agg(*[F.max(c).alias(c) for c in ("doi", "titulo", "abstract", "anio")])


def links(spark: SparkSession, d: str) -> DataFrame:
    # Few saved queries, each tested on every title: a stated query set against all rows.
    saved = spark.createDataFrame(SAVED, "consulta string, palabra string")
    return documents(spark, d).join(F.broadcast(saved), F.contains(F.lower("titulo"), F.col("palabra"))).select("consulta", "pmid")


_LINKS = f"(SELECT consulta, pmid FROM {_DOC} doc JOIN {_SAVED} ON contains(lower(titulo), palabra))"


def downloads(spark: SparkSession, d: str) -> DataFrame:
    """Download state per (pmid, tipo), read off the text units: xml is there, pdf is there unless a gap broke it."""
    u = read(spark, d, "texto_unidades").where("pmid is not null")
    return u.groupBy("pmid", F.col("fuente_texto").alias("tipo")).agg(F.when(F.bool_and("contiguo"), "ok").otherwise("error").alias("estado"), F.count(F.lit(1)).alias("unidades"))


_DOWN = "(SELECT pmid, fuente_texto AS tipo, CASE WHEN bool_and(contiguo) THEN 'ok' ELSE 'error' END AS estado, count(*) AS unidades FROM texto_unidades WHERE pmid IS NOT NULL GROUP BY 1, 2)"


@plan("SELECT DISTINCT pmid FROM documentos WHERE pmid IS NOT NULL AND pmid NOT IN (SELECT pmid FROM documents WHERE pmid IS NOT NULL)")
def ingest_new_ids(spark, d):
    """Ids asked for and not yet known."""
    return I.new_keys(read(spark, d, "documentos"), read(spark, d, "documents"), "pmid")


@plan("""WITH u AS (SELECT pmid, min(t) AS tramo FROM (SELECT pmid, 1 AS t FROM texto_unidades UNION ALL SELECT pmid, 2 FROM documents UNION ALL SELECT pmid, 3 FROM documentos) x WHERE pmid IS NOT NULL GROUP BY pmid) SELECT tramo, count(*) AS n FROM u GROUP BY tramo""")
def ingest_slice_union(spark, d):
    """Union of slices, each id under the first slice that has it."""
    parts = [read(spark, d, t).select("pmid", F.lit(i).alias("t")) for i, t in enumerate(("texto_unidades", "documents", "documentos"), 1)]
    first = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("pmid is not null").groupBy("pmid").agg(F.min("t").alias("tramo"))
    return first.groupBy("tramo").agg(F.count(F.lit(1)).alias("n"))


@plan("""SELECT pmid, epoch_us(min(extraido_en)) AS extraido_us FROM documentos WHERE pmid IS NOT NULL AND pmid NOT IN (SELECT pmid FROM documents WHERE pmid IS NOT NULL) GROUP BY pmid""")
def ingest_insert_absent(spark, d):
    """Articles not there yet, the first row of each."""
    rows = read(spark, d, "documentos").select("pmid", "extraido_en")
    new = I.insert_absent(read(spark, d, "documents").select("pmid"), rows, "pmid", [F.col("extraido_en")])
    return new.select("pmid", F.unix_micros("extraido_en").alias("extraido_us"))


@plan(f"SELECT l.consulta, l.pmid FROM {_LINKS} l WHERE l.pmid IN (SELECT pmid FROM texto_unidades) AND NOT EXISTS (SELECT 1 FROM documents x WHERE x.pmid = l.pmid AND l.consulta = 'operon')")
def ingest_insert_links(spark, d):
    """Links whose document exists and that are new."""
    there = read(spark, d, "documents").where("pmid is not null").select(F.lit("operon").alias("consulta"), "pmid").distinct()
    return I.insert_links(there, links(spark, d), read(spark, d, "texto_unidades"), ["consulta", "pmid"], "pmid")


@plan("""WITH b AS (SELECT id_fuente, max(descarga_id) AS descarga_id, count(*) AS intentos FROM operones_bronze WHERE descarga_id <= 6 GROUP BY 1), c AS (SELECT id_fuente, max(descarga_id) AS descarga_id FROM operones_bronze WHERE descarga_id > 6 GROUP BY 1)
SELECT coalesce(b.id_fuente, c.id_fuente) AS id_fuente, coalesce(c.descarga_id, b.descarga_id) AS descarga_id, coalesce(b.intentos, 0) + CASE WHEN c.id_fuente IS NULL THEN 0 ELSE 1 END AS intentos FROM b FULL JOIN c ON b.id_fuente = c.id_fuente""")
def ingest_upsert_attempts(spark, d):
    """State after a round of downloads, with the attempts counted."""
    o = read(spark, d, "operones_bronze")
    state = o.where("descarga_id <= 6").groupBy("id_fuente").agg(F.max("descarga_id").alias("descarga_id"), F.count(F.lit(1)).alias("intentos"))
    changes = o.where("descarga_id > 6").groupBy("id_fuente").agg(F.max("descarga_id").alias("descarga_id"))
    return I.upsert_counting(state, changes, "id_fuente", "intentos")


@plan("SELECT d.pmid, epoch_us(d.extraido_en) AS extraido_us, CASE WHEN d.doi IS NULL OR trim(d.doi) = '' THEN coalesce(g.doi, d.doi) ELSE d.doi END AS doi FROM documentos d LEFT JOIN (SELECT pmid, min(doi) AS doi FROM documentos WHERE doi IS NOT NULL GROUP BY pmid) g ON d.pmid = g.pmid")
def ingest_fill_doi(spark, d):
    """Missing DOIs filled from other rows of the article."""
    rows = read(spark, d, "documentos").select("pmid", F.unix_micros("extraido_en").alias("extraido_us"), "doi")
    return I.fill_empty(rows, rows.where("doi is not null").select("pmid", "doi"), "pmid", "doi")


@plan("SELECT anio, revista, count(*) AS n FROM (SELECT anio, CASE WHEN anio < '2000' THEN 'archivo' ELSE revista END AS revista FROM documentos) x GROUP BY 1, 2")
def ingest_partial_update(spark, d):
    """A partial update of editable columns."""
    out = I.update_given(read(spark, d, "documentos"), {"revista": "archivo", "doi": None}, {"revista", "doi"}, F.col("anio") < "2000")
    return out.groupBy("anio", "revista").agg(F.count(F.lit(1)).alias("n"))


@plan("""WITH k AS (SELECT DISTINCT pmid FROM documentos WHERE anio < '1996') SELECT 'documentos' AS tabla, count(*) AS n FROM documentos WHERE pmid IN (SELECT pmid FROM k) UNION ALL SELECT 'texto_unidades', count(*) FROM texto_unidades WHERE pmid IN (SELECT pmid FROM k) UNION ALL SELECT 'documents', count(*) FROM documents WHERE pmid IN (SELECT pmid FROM k)""")
def ingest_delete_cascade(spark, d):
    """Rows each table loses when articles go."""
    tables = {t: read(spark, d, t) for t in ("documentos", "texto_unidades", "documents")}
    return I.delete_cascade(tables, tables["documentos"].where("anio < '1996'"), "pmid")[1]


@plan("SELECT fuente_texto, seccion, corrida_id, count(*) AS n FROM texto_unidades WHERE corrida_id <> 2 GROUP BY ALL")
def ingest_superseded_run(spark, d):
    """What is left when a run is superseded."""
    return read(spark, d, "texto_unidades").where("corrida_id <> 2").groupBy("fuente_texto", "seccion", "corrida_id").agg(F.count(F.lit(1)).alias("n"))


@plan(f"SELECT l.consulta, doc.pmid, doc.titulo, doc.anio FROM {_LINKS} l JOIN {_DOC} doc ON l.pmid = doc.pmid WHERE l.consulta = 'operon'")
def ingest_query_documents(spark, d):
    """Documents of a saved query."""
    return links(spark, d).where("consulta = 'operon'").join(documents(spark, d), "pmid").select("consulta", "pmid", "titulo", "anio")


@plan(f"""SELECT doc.pmid, doc.anio, (o.pmid IS NOT NULL) AS otro_listo FROM {_DOC} doc LEFT JOIN {_DOWN} m ON m.pmid = doc.pmid AND m.tipo = 'pdf' LEFT JOIN (SELECT DISTINCT pmid FROM {_DOWN} q WHERE tipo <> 'pdf' AND estado = 'ok') o ON o.pmid = doc.pmid WHERE m.pmid IS NULL OR m.estado = 'error'""")
def ingest_pending(spark, d):
    """Documents whose pdf is still to come."""
    return I.pending(documents(spark, d), downloads(spark, d), "pmid", "pdf", retry=True).select("pmid", "anio", "otro_listo")


@plan(f"SELECT pmid, anio FROM {_DOC} doc WHERE NOT EXISTS (SELECT 1 FROM {_DOWN} x WHERE x.pmid = doc.pmid AND x.estado = 'ok')")
def ingest_library_missing(spark, d):
    """Documents without any good download."""
    return documents(spark, d).join(downloads(spark, d).where("estado = 'ok'").select("pmid"), "pmid", "left_anti").select("pmid", "anio")


@plan(f"SELECT s.consulta, count(l.pmid) AS n_documentos, max(doc.anio) AS ultimo FROM {_SAVED} LEFT JOIN {_LINKS} l ON l.consulta = s.consulta LEFT JOIN {_DOC} doc ON doc.pmid = l.pmid GROUP BY s.consulta")
def ingest_query_list(spark, d):
    """Every saved query with its documents and newest year."""
    got = links(spark, d).join(documents(spark, d), "pmid").groupBy("consulta").agg(F.count(F.lit(1)).alias("n"), F.max("anio").alias("ultimo"))
    return spark.createDataFrame(SAVED, "consulta string, palabra string").join(got, "consulta", "left").select("consulta", F.coalesce("n", F.lit(0)).alias("n_documentos"), "ultimo")


@plan("SELECT count(*) AS filas, count(DISTINCT pmid) AS articulos, count(DISTINCT doi) AS dois, count(DISTINCT revista) AS revistas, count(CASE WHEN tiene_abstract THEN 1 END) AS con_resumen FROM documentos")
def ingest_base_summary(spark, d):
    """A1: counts of the base."""
    return read(spark, d, "documentos").agg(F.count(F.lit(1)).alias("filas"), F.count_distinct("pmid").alias("articulos"), F.count_distinct("doi").alias("dois"), F.count_distinct("revista").alias("revistas"), F.count_if("tiene_abstract").alias("con_resumen"))


@plan(f"SELECT tipo, estado, count(*) AS n FROM {_DOWN} x GROUP BY 1, 2")
def ingest_download_states(spark, d):
    """A1: downloads by kind and state."""
    return downloads(spark, d).groupBy("tipo", "estado").agg(F.count(F.lit(1)).alias("n"))


@plan(f"""SELECT CASE WHEN t.pmid IS NOT NULL THEN 'completo' WHEN trim(doc.abstract) <> '' THEN 'resumen' ELSE 'ninguno' END AS cobertura, count(*) AS n FROM {_DOC} doc LEFT JOIN (SELECT DISTINCT pmid FROM texto_unidades) t ON t.pmid = doc.pmid GROUP BY 1""")
def ingest_coverage(spark, d):
    """A2: every document once, by what is there of it."""
    return I.coverage(documents(spark, d), read(spark, d, "texto_unidades"), "pmid", F.trim("abstract") != "")


@plan(f"SELECT pmid, anio FROM {_DOC} doc WHERE contains(lower(titulo), 'operon') OR contains(lower(abstract), 'operon') ORDER BY anio DESC, pmid LIMIT 20 OFFSET 20")
def ingest_document_page(spark, d):
    """Second page of the documents that hold a text, newest first."""
    hits = I.contains_text(documents(spark, d), "Operon", ["titulo", "abstract"])
    return I.page(hits, [F.desc("anio"), F.asc("pmid")], 2, 20).select("pmid", "anio")


@plan("SELECT count(*) AS n, count(CASE WHEN id_normalizado LIKE 'PA%' THEN 1 END) AS con_prefijo, round(count(CASE WHEN id_normalizado LIKE 'PA%' THEN 1 END) / count(*), 6) AS parte FROM menciones WHERE tipo IN ('gen', 'proteina', 'operon')")
def ingest_prefix_rate(spark, d):
    """Share of genic mentions with a normalised id of the locus form (case-sensitive prefix)."""
    m = read(spark, d, "menciones").where(F.col("tipo").isin("gen", "proteina", "operon"))
    hit = F.count_if(F.coalesce(F.col("id_normalizado").startswith("PA"), F.lit(False)))
    return m.agg(F.count(F.lit(1)).alias("n"), hit.alias("con_prefijo"), F.round(hit / F.count(F.lit(1)), 6).alias("parte"))


@plan("SELECT id, regulador_candidato, blanco_candidato FROM oraciones_candidatas WHERE regulador_candidato IS DISTINCT FROM blanco_candidato")
def ingest_null_safe(spark, d):
    """null-safe inequality."""
    return read(spark, d, "oraciones_candidatas").where(~F.col("regulador_candidato").eqNullSafe(F.col("blanco_candidato"))).select("id", "regulador_candidato", "blanco_candidato")


@plan("""SELECT fuente_texto, left(sha256(string_agg(pmid, chr(10) ORDER BY pmid)), 16) AS huella, count(*) AS n FROM (SELECT DISTINCT fuente_texto, pmid FROM texto_unidades WHERE pmid IS NOT NULL) x GROUP BY 1""")
def ingest_corpus_hash(spark, d):
    """Frozen corpus: fingerprint of its set of ids."""
    return I.content_hash(read(spark, d, "texto_unidades"), ["fuente_texto"], "pmid")


def _extractions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = read(spark, d, "operones_bronze")
    rows = o.select(F.split_part("id_fuente", F.lit("-"), F.lit(1)).alias("fuente"), F.col("descarga_id").alias("extraccion"), "id_fuente", "registro_raw", "id")
    ext = rows.groupBy("fuente", "extraccion").agg((F.count(F.lit(1)) % 5 != 0).alias("completa"))
    return ext, rows


_ROWS = "(SELECT split_part(id_fuente, '-', 1) AS fuente, descarga_id AS extraccion, id_fuente, registro_raw, id FROM operones_bronze)"
_EXT = f"(SELECT fuente, extraccion, count(*) % 5 <> 0 AS completa FROM {_ROWS} r GROUP BY 1, 2)"
_VIS = f"(SELECT fuente, max(extraccion) AS visible FROM {_EXT} e WHERE completa GROUP BY 1)"


@plan(f"SELECT r.fuente, r.extraccion, r.id FROM {_ROWS} r JOIN {_VIS} v ON v.fuente = r.fuente AND v.visible = r.extraccion")
def snapshot_current(spark, d):
    """Rows of the newest complete extraction of each source."""
    ext, rows = _extractions(spark, d)
    return S.current_rows(rows, S.visible(ext.select("fuente", "extraccion", "completa"), rows.select("extraccion"))).select("fuente", "extraccion", "id")


@plan(f"SELECT DISTINCT r.fuente, r.id_fuente FROM {_ROWS} r JOIN {_VIS} v ON v.fuente = r.fuente WHERE r.id_fuente NOT IN (SELECT r2.id_fuente FROM {_ROWS} r2 WHERE r2.fuente = v.fuente AND r2.extraccion = v.visible)")
def snapshot_retired(spark, d):
    """Ids that are gone from the current extraction."""
    ext, rows = _extractions(spark, d)
    return S.retired(rows, S.visible(ext, rows.select("extraccion")), "id_fuente")


@plan(f"SELECT e.fuente, count(CASE WHEN e.extraccion > v.visible THEN 1 END) AS n FROM {_EXT} e JOIN {_VIS} v ON v.fuente = e.fuente GROUP BY 1")
def snapshot_failed_since(spark, d):
    """Extractions after the visible one."""
    ext, rows = _extractions(spark, d)
    return S.failed_since(ext, S.visible(ext, rows.select("extraccion")))


@plan(f"SELECT extraccion, sha256(registro_raw) AS huella, count(DISTINCT id_fuente) AS n, min(id_fuente) AS primero, max(id_fuente) AS ultimo FROM {_ROWS} r WHERE registro_raw IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT id_fuente) > 1")
def snapshot_repeated_content(spark, d):
    """The same content under several names of one extraction."""
    return S.repeated_content(_extractions(spark, d)[1], ["extraccion"], "registro_raw", "id_fuente")


@plan("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2")
def log_latest(spark, d):
    """The last event of each key of an append-only log."""
    return I.one_per_key(read(spark, d, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id")


@plan("SELECT pmid, anio, CAST(regexp_extract(anio, '^(\\d{4})', 1) AS INTEGER) AS anio_num FROM documentos WHERE anio IS NOT NULL")
def ingest_year(spark, d):
    """Years that may be ranges, as text and as the first year."""
    return read(spark, d, "documentos").where("anio is not null").select("pmid", "anio", F.regexp_extract("anio", r"^(\d{4})", 1).cast("int").alias("anio_num"))
