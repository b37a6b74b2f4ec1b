"""DuckDB statements for the queries of this subpackage that SQL can express."""

_ENTITIES = r"""
ids AS (
  SELECT DISTINCT o.unidad_id, TRY_CAST(x AS BIGINT) AS id
  FROM (SELECT unidad_id, unnest(CASE WHEN json_valid(entidades) AND json_type(entidades) = 'ARRAY' THEN json_extract_string(entidades, '$[*]') END) AS x FROM oraciones_candidatas) o
),
names AS (SELECT DISTINCT id, upper(regexp_replace(id_normalizado, '^\s+|\s+$', '', 'g')) AS e FROM menciones),
ents AS (
  SELECT unidad_id, e FROM ids JOIN names USING (id) WHERE e <> ''
  UNION SELECT unidad_id, upper(regexp_replace(regulador_candidato, '^\s+|\s+$', '', 'g')) AS e FROM oraciones_candidatas WHERE e <> ''
  UNION SELECT unidad_id, upper(regexp_replace(blanco_candidato, '^\s+|\s+$', '', 'g')) AS e FROM oraciones_candidatas WHERE e <> ''
),
n AS (SELECT e, count(*) AS n FROM ents GROUP BY e),
t AS (SELECT count(DISTINCT unidad_id) AS n FROM oraciones_candidatas),
pairs AS (SELECT a.e AS a, b.e AS b, count(*) AS n_ab FROM ents a JOIN ents b ON a.unidad_id = b.unidad_id AND a.e < b.e GROUP BY 1, 2)
"""

_BARE = r"regexp_replace(lower({c}), '^[\s(\[]+|[\s)\].]+$', '', 'g')"
_ANSWERS = rf"""
said AS (SELECT id_item AS item, nullif(regexp_replace(lower(trim(anotador)), '[^\p{{L}}\p{{N}}]+', '_', 'g'), '') AS who, epoch_us(juzgado_en) AS t, {_BARE.format(c='juicio')} AS j, {_BARE.format(c='signo_correcto')} AS g FROM muestra_precision_50),
read AS (SELECT item, who, t, CASE WHEN j IN ('si', 'sí', 's', 'yes', 'y') THEN 'si' WHEN j IN ('no', 'n') THEN 'no' WHEN j IN ('dudoso', 'dudosa', 'duda', '?', '？') THEN 'dudoso' END AS v, CASE WHEN g IN ('+', '＋', 'pos', 'positivo', 'positive', 'activa') THEN '+' WHEN g IN ('-', '–', '−', '—', '－', 'neg', 'negativo', 'negative', 'reprime') THEN '-' WHEN g IN ('?', '？') THEN '?' END AS s FROM said),
latest AS (SELECT item, who, arg_max(v, (coalesce(t, -1), v, coalesce(s, ''))) AS v, nullif(max_by(coalesce(s, ''), (coalesce(t, -1), v, coalesce(s, ''))), '') AS s FROM read WHERE v IS NOT NULL AND item IS NOT NULL AND who IS NOT NULL GROUP BY 1, 2)
"""

ORACLE = {
    "p4_found": f"WITH {_ENTITIES} SELECT a AS entidad_a, b AS entidad_b FROM pairs JOIN n x ON x.e = a JOIN n y ON y.e = b, t WHERE n_ab >= 4 AND n_ab * t.n >= 4 * x.n * y.n",
    "p4_pairs": f"WITH {_ENTITIES} SELECT a AS entidad_a, b AS entidad_b, n_ab, x.n AS n_a, y.n AS n_b, t.n AS n_oraciones, round(n_ab * CAST(t.n AS DOUBLE) / (CAST(x.n AS DOUBLE) * y.n), 6) AS lift FROM pairs JOIN n x ON x.e = a JOIN n y ON y.e = b, t",
    "p6_agreement": f"""WITH {_ANSWERS}, pairs AS (SELECT item, 'juicio' AS campo, v AS label FROM latest UNION ALL SELECT item, 'signo_correcto', s FROM latest WHERE v = 'si' AND s IS NOT NULL), cells AS (SELECT campo, item, label, count(*) AS c FROM pairs GROUP BY 1, 2, 3), items AS (SELECT campo, item, sum(c) AS m, sum(c * (c - 1)) AS same FROM cells GROUP BY 1, 2 HAVING sum(c) > 1),
paired AS (SELECT cells.campo, label, sum(c) AS c FROM cells JOIN items ON items.campo = cells.campo AND items.item = cells.item GROUP BY 1, 2), ch AS (SELECT campo, sum(c * (c - 1)) AS p, sum(c) AS t FROM paired GROUP BY 1), ob AS (SELECT campo, count(*) AS n_items, sum(m) AS n, sum(same / (m - 1)) AS agree FROM items GROUP BY 1), j AS (SELECT ob.campo, n_items, n, agree / n AS o, p / (t * (t - 1)) AS e FROM ob JOIN ch ON ch.campo = ob.campo)
SELECT campo, n_items, n AS n_respuestas, round(o, 6) AS observado, round(e, 6) AS esperado, round(CASE WHEN e < 1 THEN (o - e) / (1 - e) END, 6) AS alfa FROM j""",
}
