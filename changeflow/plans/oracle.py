"""SQL twins of the registered queries, runnable by DuckDB on the test
tables (views ``events``, ``conversations``, ``lineitem`` ...).

Every query starts from the same change-event view of ``events`` that
``changeflow.sources.replay`` builds on the Spark side.
"""

from __future__ import annotations

# The change-event view: mirrors replay.change_events + refine + batch dedup
# (event_id is unique, so dedup keeps every row).
CHANGES = """
ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
chg AS (
  SELECT event_id,
         date_trunc('millisecond', ts) AS ts_evento,
         CAST(event_id AS VARCHAR) AS meta_id,
         event_type AS tipo,
         'w' || CAST(k % 5 AS VARCHAR) AS wiki,
         's' || CAST(k % 5 AS VARCHAR) AS servidor,
         k % 4 AS espacio,
         'P' || CAST(k AS VARCHAR) AS titulo,
         CAST(user_id AS VARCHAR) AS usuario,
         user_id % 5 = 0 AS es_bot,
         make_timestamp(((epoch_us(ts) // 1000) // 1000) * 1000000) AS ts_mediawiki,
         make_timestamp(((epoch_us(ts) // 1000) + (event_id * 7919) % 90000) * 1000) AS ts_cola,
         make_timestamp(((epoch_us(ts) // 1000) + (event_id * 7919) % 90000
                         + 2000 + (event_id * 104729) % 10000) * 1000) AS ingerido_en
  FROM ev
),
silver AS (
  SELECT meta_id, ts_evento, tipo, wiki, servidor, espacio, titulo, usuario, es_bot,
         ts_mediawiki, ts_cola,
         epoch_us(ts_cola) / 1000000.0 - epoch_us(ts_evento) / 1000000.0 AS retraso_s,
         ingerido_en
  FROM chg
),
wm AS (SELECT max(ts_evento) - INTERVAL 30 SECOND AS bound FROM silver)
"""

P1 = """
p1 AS (
  SELECT date_trunc('minute', ts_evento) AS ventana_inicio,
         date_trunc('minute', ts_evento) + INTERVAL 1 MINUTE AS ventana_fin,
         servidor, espacio, count(*) AS eventos
  FROM silver GROUP BY ALL
),
p1c AS (SELECT p1.* FROM p1, wm WHERE ventana_fin <= wm.bound)
"""

P2 = """
p2 AS (
  SELECT date_trunc('minute', ts_evento) AS ventana_inicio,
         date_trunc('minute', ts_evento) + INTERVAL 1 MINUTE AS ventana_fin,
         es_bot, count(*) AS eventos
  FROM silver GROUP BY ALL
),
p2c AS (SELECT p2.* FROM p2, wm WHERE ventana_fin <= wm.bound)
"""

P3 = """
p3 AS (
  SELECT date_trunc('minute', ts_evento) - r.i * INTERVAL 1 MINUTE AS ventana_inicio,
         date_trunc('minute', ts_evento) - r.i * INTERVAL 1 MINUTE + INTERVAL 5 MINUTE AS ventana_fin,
         wiki, titulo,
         count(DISTINCT usuario) AS editores, count(*) AS ediciones
  FROM silver, range(5) r(i)
  WHERE NOT es_bot AND tipo IN ('click', 'view', 'purchase')
  GROUP BY ALL
  HAVING count(DISTINCT usuario) >= 2
),
p3c AS (SELECT p3.* FROM p3, wm WHERE ventana_fin <= wm.bound)
"""

BRONZE = """
bronze AS (
  SELECT wiki || '|' || titulo AS clave,
         json_object(
           '$schema', '/mediawiki/recentchange/1.0.0',
           'meta', json_object('id', meta_id,
                               'dt', strftime(ts_evento, '%Y-%m-%dT%H:%M:%S.%g') || 'Z',
                               'domain', servidor),
           'id', event_id, 'type', tipo, 'namespace', espacio, 'title', titulo,
           'timestamp', epoch_us(ts_evento) // 1000000, 'user', usuario, 'bot', es_bot,
           'server_name', servidor, 'wiki', wiki)::VARCHAR AS valor,
         'events' AS origen,
         CAST(event_id % 3 AS VARCHAR) AS particion,
         CAST(event_id // 3 AS VARCHAR) AS desplazamiento,
         ts_cola, ingerido_en
  FROM chg
)
"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts) + "\n"


def q(body: str, *parts: str) -> str:
    return with_ctes(CHANGES, *parts) + body.strip()


ORACLE = {
    "bronze_replay": q("SELECT * FROM bronze", BRONZE),
    "silver_refine": q("SELECT * FROM silver"),
    "gold_activity": q("SELECT * FROM p1c", P1),
    "gold_bot_counts": q("SELECT * FROM p2c", P2),
    "gold_concurrent_exact": q("SELECT * FROM p3c", P3),
    "serve_layer_volumes": q("""
        SELECT 'bronze' AS tabla, count(*) AS filas, true AS existe FROM bronze
        UNION ALL SELECT 'silver', count(*), true FROM silver
        UNION ALL SELECT 'gold_activity', count(*), true FROM p1c
        UNION ALL SELECT 'gold_bots', count(*), true FROM p2c
        UNION ALL SELECT 'gold_concurrent', count(*), true FROM p3c
    """, BRONZE, P1, P2, P3),
    "serve_latency": q("""
        , recent AS (
          SELECT epoch_us(ingerido_en) / 1000000.0 - epoch_us(ts_evento) / 1000000.0 AS lat
          FROM silver
          WHERE ts_evento > (SELECT max(ts_evento) - INTERVAL 15 MINUTE FROM silver)
            AND ingerido_en > ts_evento)
        SELECT count(*) AS filas, round(min(lat), 2) AS minimo,
               round(quantile_cont(lat, 0.50), 2) AS p50,
               round(quantile_cont(lat, 0.95), 2) AS p95,
               round(quantile_cont(lat, 0.99), 2) AS p99,
               round(max(lat), 2) AS maximo
        FROM recent
    """),
    "serve_activity_latest": q("""
        SELECT servidor, espacio, eventos FROM p1c
        WHERE ventana_inicio = (SELECT max(ventana_inicio) FROM p1c)
        ORDER BY eventos DESC, servidor, espacio LIMIT 12
    """, P1),
    "serve_bot_share": q("""
        SELECT strftime(ventana_inicio, '%Y-%m-%d %H:%M') AS ventana, ventana_inicio,
               CAST(sum(CASE WHEN es_bot THEN eventos ELSE 0 END) AS BIGINT) AS bots,
               CAST(sum(CASE WHEN es_bot THEN 0 ELSE eventos END) AS BIGINT) AS humanos,
               round(100.0 * CAST(sum(CASE WHEN es_bot THEN eventos ELSE 0 END) AS DOUBLE)
                     / CAST(sum(eventos) AS DOUBLE), 1) AS pct_bot
        FROM p2c GROUP BY ventana_inicio
        ORDER BY ventana_inicio DESC LIMIT 12
    """, P2),
    "serve_bot_share_swing": q("""
        , per_window AS (
          SELECT 100.0 * CAST(sum(CASE WHEN es_bot THEN eventos ELSE 0 END) AS DOUBLE)
                 / CAST(sum(eventos) AS DOUBLE) AS pct_bot
          FROM p2c GROUP BY ventana_inicio)
        SELECT count(*) AS ventanas, round(min(pct_bot), 1) AS min_pct_bot,
               round(avg(pct_bot), 1) AS media_pct_bot, round(max(pct_bot), 1) AS max_pct_bot,
               round(stddev_samp(pct_bot), 1) AS desviacion
        FROM per_window
    """, P2),
    "serve_concurrent_top": q("""
        SELECT ventana_inicio, wiki, titulo, editores, ediciones FROM p3c
        ORDER BY editores DESC, ediciones DESC, ventana_inicio, wiki, titulo LIMIT 15
    """, P3),
}

# --- integrity (G1-G3) -------------------------------------------------------

def _queue(table: str, p: str, o: str) -> str:
    return ("q AS (SELECT CAST(%s AS VARCHAR) AS particion, CAST(%s AS VARCHAR) AS desplazamiento FROM %s)"
            % (p, o, table))


DUPS = """
SELECT count(*) AS filas, count(DISTINCT struct_pack(p := particion, o := desplazamiento)) AS distintos,
       count(*) - count(DISTINCT struct_pack(p := particion, o := desplazamiento)) AS duplicados
FROM q
"""

CONT = """
cont AS (
  SELECT particion, count(*) AS filas,
         count(DISTINCT TRY_CAST(desplazamiento AS BIGINT)) AS distintos,
         min(TRY_CAST(desplazamiento AS BIGINT)) AS primero,
         max(TRY_CAST(desplazamiento AS BIGINT)) AS ultimo,
         max(TRY_CAST(desplazamiento AS BIGINT)) - min(TRY_CAST(desplazamiento AS BIGINT)) + 1
           - count(DISTINCT TRY_CAST(desplazamiento AS BIGINT)) AS huecos,
         count(*) FILTER (WHERE TRY_CAST(desplazamiento AS BIGINT) IS NULL) AS ilegibles
  FROM q GROUP BY particion
)
"""


def _verdict(contiguous: bool) -> str:
    def summed(col):
        return "(SELECT CAST(coalesce(sum(%s), 0) AS BIGINT) FROM cont)" % col if contiguous else "CAST(NULL AS BIGINT)"
    return """
SELECT filas, distintos, duplicados, huecos, ilegibles, %s AS contiguo,
       duplicados = 0 AND coalesce(huecos, 0) = 0 AND coalesce(ilegibles, 0) = 0 AS ok
FROM (SELECT count(*) AS filas,
             count(DISTINCT struct_pack(p := particion, o := desplazamiento)) AS distintos,
             count(*) - count(DISTINCT struct_pack(p := particion, o := desplazamiento)) AS duplicados,
             %s AS huecos, %s AS ilegibles
      FROM q)
""" % ("true" if contiguous else "false", summed("huecos"), summed("ilegibles"))


BRONZE_Q = "q AS (SELECT particion, desplazamiento FROM bronze)"

ORACLE.update({
    "integrity_duplicates_bronze": q(DUPS, BRONZE, BRONZE_Q),
    "integrity_duplicates_lineitem": with_ctes(_queue("lineitem", "l_orderkey", "l_linenumber")) + DUPS,
    "integrity_continuity_conversations": with_ctes(_queue("conversations", "conv_id", "turn"), CONT)
        + "SELECT * FROM cont",
    "integrity_continuity_lineitem": with_ctes(_queue("lineitem", "l_orderkey", "l_linenumber"), CONT)
        + "SELECT * FROM cont",
    "integrity_verdict_bronze": q(_verdict(True), BRONZE, BRONZE_Q, CONT),
    "integrity_verdict_lineitem": with_ctes(_queue("lineitem", "l_orderkey", "l_linenumber"), CONT) + _verdict(True),
    "integrity_verdict_unreadable": with_ctes(_queue("documents", "lang", "source"), CONT) + _verdict(True),
    "integrity_verdict_offsets_only": with_ctes(_queue("lineitem", "l_orderkey", "l_linenumber")) + _verdict(False),
})

# --- fault injection and late data (H1-H5, J1-J3) -----------------------------

from changeflow.functions.columns import seeded_unit_sql  # noqa: E402
from changeflow.plans import scenario  # noqa: E402


def _injected() -> str:
    s = scenario.LATE
    u1 = seeded_unit_sql("event_id", s["seed"], 1)
    u2 = seeded_unit_sql("event_id", s["seed"], 2)
    u3 = seeded_unit_sql("event_id", s["seed"], 3)
    late = "(%s * 100.0 < %r)" % (u1, float(s["late_pct"]))
    shift = "CAST(floor(%r + %r * %s) AS BIGINT)" % (s["lo_s"] * 1000.0, (s["hi_s"] - s["lo_s"]) * 1000.0, u2)
    return """
inj0 AS (
  SELECT chg.*, %s AS tardio,
         CASE WHEN %s THEN %s ELSE CAST(0 AS BIGINT) END AS retraso_inyectado_ms,
         %s * 100.0 < %r AS dup
  FROM chg
),
inj AS (
  SELECT inj0.* EXCLUDE (dup, ts_evento, ts_mediawiki),
         make_timestamp(epoch_us(ts_evento) - retraso_inyectado_ms * 1000) AS ts_evento,
         make_timestamp(((epoch_us(ts_evento) - retraso_inyectado_ms * 1000) // 1000000) * 1000000) AS ts_mediawiki,
         UNNEST(CASE WHEN dup THEN [0, 1] ELSE [0] END) AS copia
  FROM inj0
),
tagged AS (
  SELECT meta_id, ts_evento, ts_cola,
         epoch_us(ts_cola) / 1000000.0 - epoch_us(ts_evento) / 1000000.0 AS retraso_s
  FROM inj
),
isilver AS (
  SELECT meta_id, ts_evento, tipo, wiki, servidor, espacio, titulo, usuario, es_bot,
         ts_mediawiki, ts_cola,
         epoch_us(ts_cola) / 1000000.0 - epoch_us(ts_evento) / 1000000.0 AS retraso_s,
         ingerido_en
  FROM inj
)
""" % (late, late, shift, u3, float(s["dup_pct"]))


def _streamed() -> str:
    """The streamed scenario: a row of queue file b is late if it is at or
    behind the newest event of the files before b - 1 less the lateness."""
    p = scenario.STREAM
    return """
n AS (SELECT count(*) AS n FROM events),
st0 AS (
  SELECT chg.* EXCLUDE (ts_evento, ts_mediawiki, ts_cola, ingerido_en),
         1704067200000 + event_id * %d // n.n AS ev_ms, (event_id * 7919) %% 90000 AS lag_ms,
         UNNEST(CASE WHEN %s * 100.0 < %r THEN [0, 1] ELSE [0] END) AS copia
  FROM chg, n
),
st AS (
  SELECT *, ev_ms + lag_ms + copia * %d AS cola_ms, (ev_ms + lag_ms + copia * %d - 1704067200000) // %d AS lote FROM st0
),
lots AS (SELECT lote, max(ev_ms) AS m, count(*) AS filas FROM st GROUP BY lote),
marks AS (SELECT lote, max(m) OVER (ORDER BY lote ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - %d AS wm FROM lots),
intime AS (SELECT st.* FROM st JOIN marks USING (lote) WHERE wm IS NULL OR ev_ms > wm),
kept AS (
  SELECT meta_id, make_timestamp(ev_ms * 1000) AS ts_evento, tipo, wiki, servidor, espacio, titulo, usuario, es_bot,
         make_timestamp((ev_ms // 1000) * 1000000) AS ts_mediawiki, make_timestamp(min(cola_ms) * 1000) AS ts_cola,
         min(cola_ms) / 1000.0 - ev_ms / 1000.0 AS retraso_s
  FROM intime GROUP BY meta_id, ev_ms, tipo, wiki, servidor, espacio, titulo, usuario, es_bot
)
""" % (p["span_s"] * 1000, seeded_unit_sql("event_id", p["seed"], 3), float(p["dup_pct"]),
       p["redelivery_s"] * 1000, p["redelivery_s"] * 1000, p["file_s"] * 1000, p["lateness_s"] * 1000)


BUCKET_SQL = ("CASE WHEN retraso_s < 5 THEN 'a) <5s' WHEN retraso_s < 15 THEN 'b) 5-15s' "
              "WHEN retraso_s < 30 THEN 'c) 15-30s' WHEN retraso_s < 45 THEN 'd) 30-45s' "
              "WHEN retraso_s < 60 THEN 'e) 45-60s' ELSE 'f) >60s' END")

ORACLE.update({
    "late_injected_duplicates": q("""
        SELECT count(*) AS filas, count(DISTINCT meta_id) AS distintos,
               count(*) - count(DISTINCT meta_id) AS duplicados FROM tagged
    """, _injected()),
    "late_stream_silver": q("SELECT * FROM kept", _streamed()),
    "late_stream_drops": q("""
        SELECT (SELECT count(*) FROM lots) AS lotes, CAST((SELECT count(*) FROM st) AS BIGINT) AS filas,
               CAST((SELECT count(*) FROM st) - (SELECT count(*) FROM intime) AS BIGINT) AS tardias,
               CAST((SELECT count(*) FROM intime) - (SELECT count(*) FROM kept) AS BIGINT) AS repetidas
    """, _streamed()),
    "stream_commit_history": q("""
        SELECT row_number() OVER (ORDER BY lote) - 1 AS batch_id, filas AS rows, true AS fechado FROM lots
    """, _streamed()),
    "stream_ingest_stamp": q("SELECT count(*) AS sellos, CAST(0 AS BIGINT) AS sin_sello FROM lots", _streamed()),
    "stream_restart_verdict": q(_verdict(True), _streamed(),
        "q AS (SELECT CAST(event_id % 3 AS VARCHAR) AS particion, CAST(event_id // 3 AS VARCHAR) AS desplazamiento FROM st)",
        CONT),
    "late_dedup_proof": q("""
        SELECT count(*) AS filas, count(DISTINCT meta_id) AS distintos,
               count(*) - count(DISTINCT meta_id) AS duplicados FROM kept
    """, _streamed()),
    "late_survival": q("""
        , sttag AS (SELECT meta_id, cola_ms / 1000.0 - ev_ms / 1000.0 AS retraso_s FROM st),
        b AS (SELECT DISTINCT meta_id, %s AS tramo FROM sttag),
        p AS (SELECT DISTINCT meta_id FROM kept)
        SELECT tramo, count(*) AS en_bronce,
               CAST(sum(CASE WHEN p.meta_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS en_plata,
               round(100.0 * CAST(sum(CASE WHEN p.meta_id IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE)
                     / CAST(count(*) AS DOUBLE), 1) AS pct_superviviente
        FROM b LEFT JOIN p USING (meta_id)
        GROUP BY tramo ORDER BY tramo
    """ % BUCKET_SQL, _streamed()),
    "inject_tally": q("""
        SELECT CASE WHEN copia > 0 THEN 'duplicado' WHEN tardio THEN 'tardio' ELSE 'normal' END AS clase,
               count(*) AS filas
        FROM inj GROUP BY ALL
    """, _injected()),
})


# --- source profile (I1-I10) -------------------------------------------------

CAPTURE = """
cap AS (
  SELECT epoch_us(ts_cola) / 1000000.0 AS recibido,
         (event_id // 3) * 1000 + event_id % 3 AS seq,
         json_object(
           '$schema', '/mediawiki/recentchange/1.0.0',
           'meta', json_object('id', meta_id,
                               'dt', strftime(ts_evento, '%Y-%m-%dT%H:%M:%S.%g') || 'Z',
                               'domain', servidor),
           'id', event_id, 'type', tipo, 'namespace', espacio, 'title', titulo,
           'comment', 'evento sintetico s42',
           'timestamp', epoch_us(ts_evento) // 1000000, 'user', usuario, 'bot', es_bot,
           'server_name', servidor, 'wiki', wiki)::VARCHAR AS evento,
         ts_evento
  FROM inj
)
"""


def _cq(body: str) -> str:
    return q(body, _injected(), CAPTURE)


def _top(field: str, path: str, missing: str, n: int | None = None) -> str:
    val = "coalesce(json_extract_string(evento, '%s'), '%s')" % (path, missing)
    if field == "bot":
        val = "CASE WHEN lower(coalesce(json_extract_string(evento, '$.bot'), 'false')) = 'true' THEN 'bot' ELSE 'humano' END"
    return _cq("""
        SELECT '%s' AS campo, %s AS valor, count(*) AS eventos,
               100.0 * CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM cap) AS DOUBLE) AS pct
        FROM cap GROUP BY 2 ORDER BY eventos DESC, valor %s
    """ % (field, val, "LIMIT %d" % n if n else ""))


ORACLE.update({
    "profile_throughput": _cq("""
        SELECT count(*) AS eventos, coalesce(max(recibido) - min(recibido), 0.0) AS duracion_s,
               CASE WHEN max(recibido) - min(recibido) > 0
                    THEN count(*) / (max(recibido) - min(recibido)) ELSE 0.0 END AS eps_medio,
               CAST(0 AS BIGINT) AS errores_parseo
        FROM cap
    """),
    "profile_rate_percentiles": _cq("""
        , per_s AS (SELECT floor(recibido) AS s, count(*) AS n FROM cap GROUP BY 1),
        inner_s AS (SELECT n FROM per_s
                    WHERE s > (SELECT min(s) FROM per_s) AND s < (SELECT max(s) FROM per_s)
                      AND (SELECT count(*) FROM per_s) > 2)
        SELECT coalesce(CAST(quantile_cont(n, 0.5) AS DOUBLE), 'NaN'::DOUBLE) AS eps_p50,
               coalesce(CAST(quantile_cont(n, 0.95) AS DOUBLE), 'NaN'::DOUBLE) AS eps_p95,
               CAST(coalesce(max(n), 0) AS BIGINT) AS eps_pico
        FROM inner_s
    """),
    "profile_sizes": _cq("""
        , b AS (SELECT octet_length(evento::BLOB) AS b, recibido FROM cap)
        SELECT avg(b) AS media, CAST(quantile_cont(b, 0.5) AS DOUBLE) AS p50,
               CAST(quantile_cont(b, 0.95) AS DOUBLE) AS p95, CAST(max(b) AS BIGINT) AS maximo,
               CAST(sum(b) AS DOUBLE) / 1e6 AS total_mb,
               CASE WHEN max(recibido) - min(recibido) > 0
                    THEN CAST(sum(b) AS DOUBLE) / (max(recibido) - min(recibido)) / 1e3 END AS kb_s
        FROM b
    """),
    "profile_top_types": _top("type", "$.type", "(sin tipo)"),
    "profile_top_schemas": _top("$schema", '$."$schema"', "(sin schema)"),
    "profile_top_servers": _top("server_name", "$.server_name", "(sin server_name)", 12),
    "profile_bot_share": _top("bot", "$.bot", ""),
    "profile_top_namespaces": _top("namespace", "$.namespace", "(sin namespace)"),
    "profile_duplicates": _cq("""
        , m AS (SELECT json_extract_string(evento, '$.meta.id') AS k, count(*) AS c FROM cap
                WHERE coalesce(json_extract_string(evento, '$.meta.id'), '') <> '' GROUP BY 1 HAVING count(*) > 1),
        w AS (SELECT json_extract_string(evento, '$.wiki') AS kw, json_extract_string(evento, '$.id') AS ki,
                     count(*) AS c FROM cap
              WHERE json_extract_string(evento, '$.id') IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)
        SELECT 'meta.id' AS clave, count(*) AS repetidos, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS entregas_de_mas FROM m
        UNION ALL
        SELECT '(wiki, id)', count(*), CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM w
    """),
    "profile_disorder": _cq("""
        , t AS (SELECT recibido, seq, epoch_us(ts_evento) / 1000000.0 AS t FROM cap),
        s AS (SELECT t, max(t) OVER (ORDER BY recibido, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM t),
        l AS (SELECT CASE WHEN t < mx THEN mx - t END AS lag FROM s)
        SELECT (SELECT count(*) FROM cap) AS con_tiempo, CAST(0 AS BIGINT) AS sin_tiempo,
               count(lag) AS desordenados,
               100.0 * CAST(count(lag) AS DOUBLE) / CAST((SELECT count(*) FROM cap) AS DOUBLE) AS pct,
               quantile_cont(lag, 0.5) AS p50, quantile_cont(lag, 0.95) AS p95,
               quantile_cont(lag, 0.99) AS p99, max(lag) AS maximo
        FROM l
    """),
    "profile_disorder_timestamp": _cq("""
        , t AS (SELECT recibido, seq, CAST(epoch_us(ts_evento) // 1000000 AS DOUBLE) AS t FROM cap),
        s AS (SELECT t, max(t) OVER (ORDER BY recibido, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM t),
        l AS (SELECT CASE WHEN t < mx THEN mx - t END AS lag FROM s)
        SELECT (SELECT count(*) FROM cap) AS con_tiempo, CAST(0 AS BIGINT) AS sin_tiempo,
               count(lag) AS desordenados,
               100.0 * CAST(count(lag) AS DOUBLE) / CAST((SELECT count(*) FROM cap) AS DOUBLE) AS pct,
               quantile_cont(lag, 0.5) AS p50, quantile_cont(lag, 0.95) AS p95,
               quantile_cont(lag, 0.99) AS p99, max(lag) AS maximo
        FROM l
    """),
    "profile_arrival_latency": _cq("""
        , l AS (SELECT recibido - epoch_us(ts_evento) / 1000000.0 AS lat FROM cap)
        SELECT count(lat) AS con_tiempo, CAST(0 AS BIGINT) AS sin_tiempo, min(lat) AS minimo,
               quantile_cont(lat, 0.5) AS p50, quantile_cont(lat, 0.95) AS p95,
               quantile_cont(lat, 0.99) AS p99, max(lat) AS maximo
        FROM l
    """),
    "profile_examples": _cq("""
        SELECT json_extract_string(evento, '$.type') AS tipo,
               first(evento ORDER BY recibido, seq) AS ejemplo
        FROM cap GROUP BY 1
    """),
})

PATHS = """
pt AS (
  SELECT coalesce(json_extract_string(cap.evento, '$.type'), '(sin tipo)') AS tipo,
         CASE WHEN t.path = '$' THEN t.key ELSE substr(t.path, 3) || '.' || t.key END AS ruta,
         CASE t.type WHEN 'OBJECT' THEN 'struct' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null'
                     WHEN 'BOOLEAN' THEN 'bool' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
                     WHEN 'UBIGINT' THEN 'int' WHEN 'BIGINT' THEN 'int' ELSE lower(t.type) END AS tipo_json
  FROM cap, json_tree(cap.evento) t
  WHERE t.key IS NOT NULL AND t.fullkey NOT LIKE '%[%'
)
"""

ORACLE.update({
    "profile_schema": q("""
        , per_type AS (SELECT ruta, tipo_json, count(*) AS n FROM pt GROUP BY ALL)
        SELECT ruta, 100.0 * CAST(sum(n) AS DOUBLE) / CAST((SELECT count(*) FROM cap) AS DOUBLE) AS presencia_pct,
               string_agg(tipo_json, ', ' ORDER BY n DESC, tipo_json) AS tipos,
               count(*) > 1 AS mixto, CAST(0 AS BIGINT) AS ilegibles
        FROM per_type GROUP BY ruta ORDER BY ruta
    """, _injected(), CAPTURE, PATHS),
    "profile_type_fields": q("""
        , ptype AS (SELECT coalesce(json_extract_string(evento, '$.type'), '(sin tipo)') AS tipo, count(*) AS n
                    FROM cap GROUP BY 1),
        common AS (SELECT ruta FROM pt GROUP BY ruta HAVING count(*) = (SELECT count(*) FROM cap)),
        per AS (SELECT tipo, ruta, count(*) AS k FROM pt WHERE ruta NOT IN (SELECT ruta FROM common) GROUP BY ALL),
        sel AS (SELECT per.tipo, string_agg(ruta, ', ' ORDER BY ruta) AS campos
                FROM per JOIN ptype USING (tipo) WHERE k >= 0.9 * n GROUP BY per.tipo)
        SELECT ptype.tipo, ptype.n, coalesce(sel.campos, '-') AS campos
        FROM ptype LEFT JOIN sel USING (tipo) ORDER BY n DESC, tipo
    """, _injected(), CAPTURE, PATHS),
})

# The documents as a capture file with faults: of three one good record, one
# error record, one broken line.
DIRTY = """
cap AS (
  SELECT doc_id + 0.5 AS recibido,
         '{"id":' || doc_id || CASE WHEN doc_id % 5 = 0 OR lang IS NULL THEN '' ELSE ',"type":"' || lang || '"' END
           || ',"size":' || CASE WHEN doc_id % 2 = 0 THEN CAST(n_chars AS VARCHAR) ELSE '"' || source || '"' END || '}' AS evento
  FROM documents WHERE doc_id % 3 = 0
)
"""


# windows, and how many an approximate count gets wrong by more than its bound
NO_ERROR = q("""SELECT count(*) AS ventanas, CAST(0 AS BIGINT) AS fuera,
                       CASE WHEN count(*) > 0 THEN 0.0::DOUBLE END AS error_maximo FROM p3c""", P3)

GAPS = """
, o AS (SELECT DISTINCT particion, TRY_CAST(desplazamiento AS BIGINT) AS o FROM q),
g AS (SELECT particion, o, lag(o) OVER (PARTITION BY particion ORDER BY o) AS before FROM o WHERE o IS NOT NULL)
SELECT particion, before + 1 AS desde, o - 1 AS hasta, o - before - 1 AS faltan FROM g WHERE o > before + 1
"""


def _dirty(query: str) -> str:
    """The body of a profile oracle over the dirty capture."""
    body = ORACLE[query].split(PATHS.strip())[-1].lstrip()
    return with_ctes(DIRTY, PATHS) + body


ORACLE.update({
    "profile_dirty_throughput": with_ctes(DIRTY) + """
        SELECT count(*) AS eventos, max(CAST(recibido AS DOUBLE)) - min(CAST(recibido AS DOUBLE)) AS duracion_s,
               count(*) / (max(CAST(recibido AS DOUBLE)) - min(CAST(recibido AS DOUBLE))) AS eps_medio,
               (SELECT count(*) FROM documents WHERE doc_id % 3 <> 0) AS errores_parseo
        FROM cap""",
    "profile_dirty_types": with_ctes(DIRTY) + """
        SELECT 'type' AS campo, coalesce(json_extract_string(evento, '$.type'), '(sin tipo)') AS valor, count(*) AS eventos,
               100.0 * CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM cap) AS DOUBLE) AS pct
        FROM cap GROUP BY 2""",
    "profile_dirty_schema": _dirty("profile_schema"),
    "profile_dirty_type_fields": _dirty("profile_type_fields"),
    "envelope_kafka": q("SELECT * EXCLUDE (ingerido_en) FROM bronze", BRONZE),
    "envelope_kinesis": q("""
        SELECT clave, valor, origen, CAST(NULL AS VARCHAR) AS particion,
               '4959' || lpad(desplazamiento || particion, 52, '0') AS desplazamiento, ts_cola FROM bronze
    """, BRONZE),
    "publish_keyed": q("""
        SELECT wiki || '|' || titulo AS key,
               json_object('meta_id', meta_id, 'wiki', wiki, 'titulo', titulo, 'tipo', tipo)::VARCHAR AS value FROM silver
    """),
    "gold_concurrent_error": NO_ERROR,
    "stream_gold_concurrent_error": NO_ERROR,
    "gold_concurrent_panes_error": NO_ERROR,
    "gold_concurrent_panes": ORACLE["gold_concurrent_exact"],
    "stream_gold_concurrent_panes": ORACLE["gold_concurrent_exact"],
    # whole minutes; a sketch of fewer values than its size holds them all and
    # gives the smallest value of at least the wanted rank
    "serve_latency_states": q("""
        , recent AS (
          SELECT epoch_us(ingerido_en) / 1000000.0 - epoch_us(ts_evento) / 1000000.0 AS lat
          FROM silver
          WHERE date_trunc('minute', ts_evento) >= (SELECT max(ts_evento) - INTERVAL 15 MINUTE FROM silver)
            AND ingerido_en > ts_evento),
        ranked AS (SELECT lat, row_number() OVER (ORDER BY lat) AS r, count(*) OVER () AS n FROM recent)
        SELECT count(*) AS filas, round(min(lat), 2) AS minimo,
               round(min(lat) FILTER (WHERE r >= 0.50 * n), 2) AS p50,
               round(min(lat) FILTER (WHERE r >= 0.95 * n), 2) AS p95,
               round(min(lat) FILTER (WHERE r >= 0.99 * n), 2) AS p99,
               round(max(lat), 2) AS maximo
        FROM ranked
    """),
    "serve_latency_states_error": q("""
        SELECT unnest(['p50', 'p95', 'p99']) AS cuantil, count(*) AS filas, false AS fuera FROM silver
    """),
    "profile_arrival_states_error": _cq("""
        SELECT unnest(['p50', 'p95', 'p99']) AS cuantil, count(*) AS filas, false AS fuera FROM cap
    """),
    "stream_latency_states": q("""
        SELECT date_trunc('minute', ts_evento) AS ventana_inicio, count(*) AS filas FROM silver, wm
        WHERE date_trunc('minute', ts_evento) + INTERVAL 1 MINUTE <= bound GROUP BY ALL
    """),
    "integrity_bitmap_continuity_conversations": ORACLE["integrity_continuity_conversations"],
    "integrity_bitmap_continuity_lineitem": ORACLE["integrity_continuity_lineitem"],
    "integrity_bitmap_verdict_bronze": ORACLE["integrity_verdict_bronze"],
    "integrity_gaps_conversations": with_ctes(_queue("conversations", "conv_id", "turn")) + GAPS,
    "integrity_gaps_lineitem": with_ctes(_queue("lineitem", "l_orderkey", "l_linenumber")) + GAPS,
    "integrity_gaps_orders": with_ctes(_queue("orders", "o_orderstatus", "o_orderkey")) + GAPS,
})

# Streaming chain: the append streams equal their batch twins.
ORACLE.update({
    "stream_gold_activity": ORACLE["gold_activity"],
    "stream_gold_activity_folded": ORACLE["gold_activity"],
    "stream_gold_bot_counts": ORACLE["gold_bot_counts"],
    "stream_silver_dedup_proof": q("""
        SELECT count(*) AS filas, count(DISTINCT meta_id) AS distintos,
               count(*) - count(DISTINCT meta_id) AS duplicados FROM silver
    """),
})

# The quarantine judges by the newest event of all earlier micro-batches.
VERDICTS = """
qmarks AS (SELECT lote, max(m) OVER (ORDER BY lote ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - %d AS wm FROM lots),
judged AS (SELECT st.*, wm IS NOT NULL AND ev_ms <= wm AS tarde FROM st JOIN qmarks USING (lote)),
firsts AS (SELECT *, row_number() OVER (PARTITION BY meta_id, tarde ORDER BY cola_ms) AS nth FROM judged)
""" % (scenario.STREAM["lateness_s"] * 1000)
FAULTS = """
SELECT count(*) AS leidas, count(*) FILTER (WHERE doc_id %% 5 = 0) AS ilegibles, count(*) FILTER (WHERE doc_id %% 5 = 1) AS sin_id,
       count(*) FILTER (WHERE doc_id %% 5 IN (2, 3)) AS sin_hora FROM documents
""".replace("%%", "%")

ORACLE.update({
    "parts_gold_activity": ORACLE["gold_activity"],
    "parts_gold_bot_counts": ORACLE["gold_bot_counts"],
    "parts_gold_concurrent": ORACLE["gold_concurrent_exact"],
    "quarantine_silver": q("""
        SELECT meta_id, make_timestamp(ev_ms * 1000) AS ts_evento, tipo, wiki, servidor, espacio, titulo, usuario, es_bot,
               make_timestamp((ev_ms // 1000) * 1000000) AS ts_mediawiki, make_timestamp(cola_ms * 1000) AS ts_cola,
               cola_ms / 1000.0 - ev_ms / 1000.0 AS retraso_s
        FROM firsts WHERE NOT tarde AND nth = 1
    """, _streamed(), VERDICTS),
    "quarantine_rows": q("""
        SELECT CASE WHEN tarde THEN 'tardia' WHEN nth = 1 THEN 'conservada' ELSE 'repetida' END AS motivo, count(*) AS filas
        FROM firsts GROUP BY 1
    """, _streamed(), VERDICTS),
    "refine_faults": FAULTS,
    "stream_refine_faults": FAULTS,
})

ORACLE.update({
    "late_survival_joined": ORACLE["late_survival"],
    "late_lost_ids": q("""
        SELECT DISTINCT meta_id, %s AS tramo
        FROM (SELECT meta_id, cola_ms / 1000.0 - ev_ms / 1000.0 AS retraso_s FROM st)
        WHERE meta_id NOT IN (SELECT meta_id FROM kept)
    """ % BUCKET_SQL, _streamed()),
})

ORACLE.update({
    "serve_layer_volumes_footers": ORACLE["serve_layer_volumes"],
    "serve_silver_days_footers": q("SELECT CAST(ts_evento AS DATE) AS dia, count(*) AS filas FROM silver GROUP BY 1"),
    "serve_activity_latest_stored": ORACLE["serve_activity_latest"],
    "profile_top_all": _cq("""
        , pairs AS (
          SELECT unnest([struct_pack(campo := 'type', valor := coalesce(json_extract_string(evento, '$.type'), '(sin tipo)')),
                         struct_pack(campo := '$schema', valor := coalesce(json_extract_string(evento, '$."$schema"'), '(sin schema)')),
                         struct_pack(campo := 'server_name', valor := coalesce(json_extract_string(evento, '$.server_name'), '(sin server_name)')),
                         struct_pack(campo := 'bot', valor := CASE WHEN lower(coalesce(json_extract_string(evento, '$.bot'), 'false')) = 'true'
                                                               THEN 'bot' ELSE 'humano' END),
                         struct_pack(campo := 'namespace', valor := coalesce(json_extract_string(evento, '$.namespace'), '(sin namespace)'))]) AS p
          FROM cap),
        n AS (SELECT p.campo, p.valor, count(*) AS eventos FROM pairs GROUP BY ALL)
        SELECT campo, valor, eventos, 100.0 * CAST(eventos AS DOUBLE) / CAST((SELECT count(*) FROM cap) AS DOUBLE) AS pct
        FROM n QUALIFY row_number() OVER (PARTITION BY campo ORDER BY eventos DESC, valor)
                       <= CASE campo WHEN 'server_name' THEN 12 ELSE 2147483647 END
    """),
    "late_survival_bucketed": ORACLE["late_survival"],
    "late_first_delivery_bucketed": q("""
        SELECT meta_id, make_timestamp(ev_ms * 1000) AS ts_evento, make_timestamp(min(cola_ms) * 1000) AS ts_cola,
               min(cola_ms) / 1000.0 - ev_ms / 1000.0 AS retraso_s
        FROM st GROUP BY meta_id, ev_ms
    """, _streamed()),
})


def _mix() -> str:
    """The draws of the synthetic mix over the ids of ``events``."""
    from changeflow.operators import inject
    seed = scenario.LATE["seed"]

    def u(stream):
        return seeded_unit_sql("event_id", seed, stream)

    def pick(values, stream):
        return "[%s][least(CAST(floor(%s * %d) AS INTEGER), %d) + 1]" % (", ".join(values), u(stream), len(values), len(values) - 1)

    cum, kinds = 0.0, []
    for name, share in inject.TYPE_SHARES:
        cum += share
        kinds.append("WHEN %s <= %r THEN '%s'" % (u(10), cum, name))
    return """
WITH m AS (
  SELECT CASE %s ELSE 'edit' END AS tipo, %s AS wiki, %s AS servidor, %s AS espacio, %s < %r AS es_bot,
         CAST(floor(%s * %d) AS INTEGER) AS t, CAST(floor(%s * %d) AS INTEGER) AS u FROM events)
SELECT tipo, wiki, servidor, CAST(espacio AS INTEGER) AS espacio, es_bot, count(*) AS eventos, count(DISTINCT t) AS paginas,
       count(DISTINCT u) AS usuarios
FROM m GROUP BY ALL""" % (" ".join(kinds), pick(["'%s'" % w for _, w in inject.SITES], 11),
                          pick(["'%s'" % s for s, _ in inject.SITES], 11), pick([str(n) for n in inject.NAMESPACES], 14),
                          u(15), inject.BOT_SHARE, u(12), inject.N_TITLES, u(13), inject.N_USERS)


ORACLE["inject_mix"] = _mix()
