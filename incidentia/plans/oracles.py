"""The same answers in plain SQL, on the same tables."""

from __future__ import annotations

from incidentia.plans.queries import SOURCE_LABEL, SPEC
from incidentia.plans.standins import STANDIN_BOX
from incidentia.schemas import AGE_BANDS, AREAS, CLEAN, RAW, SHIFT_NAMES, UNKNOWN_AREA


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)


def _literal(value) -> str:
    return str(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


def _in(column: str, chosen) -> str:
    return f"{column} IN ({', '.join(_literal(v) for v in chosen)})"


MORNING, AFTERNOON, EVENING, NIGHT = SHIFT_NAMES


def _shift(hour: str) -> str:
    return (
        f"CASE WHEN {hour} IS NULL THEN NULL "
        f"WHEN {hour} >= 6 AND {hour} < 12 THEN '{MORNING}' "
        f"WHEN {hour} >= 12 AND {hour} < 18 THEN '{AFTERNOON}' "
        f"WHEN {hour} >= 18 AND {hour} < 22 THEN '{EVENING}' ELSE '{NIGHT}' END"
    )


def _band(age: str) -> str:
    cases = " ".join(
        f"WHEN {age} > {low} AND {age} <= {high} THEN '{label}'" for label, low, high in AGE_BANDS
    )
    return f"CASE {cases} END"


def _zone(total: str, high: str, medium: str) -> str:
    return f"CASE WHEN {total} >= {high} THEN 'ALTO' WHEN {total} >= {medium} THEN 'MEDIO' ELSE 'BAJO' END"


def _inside(lat: str, lon: str) -> str:
    b = STANDIN_BOX
    return (
        f"coalesce({lat} BETWEEN {b.lat_min} AND {b.lat_max} "
        f"AND {lon} BETWEEN {b.lon_min} AND {b.lon_max}, false)"
    )


TIME_TEXT = (
    "CASE WHEN k = 0 THEN 'sin fecha' WHEN k = 1 THEN strftime(ts, '%Y-%m-%d %H:%M') "
    "WHEN k = 7 THEN strftime(ts, '%-d/%-m/%Y  %-H:%M') WHEN k = 8 THEN strftime(ts, '%-d/%-m/%Y 99:%M') "
    "ELSE strftime(ts, '%-d/%-m/%Y %-H:%M') END"
)


def _hour_from_text(text: str) -> str:
    half = (
        f"CASE WHEN contains({text}, 'T') THEN split_part({text}, 'T', 2) "
        f"WHEN contains({text}, ' ') THEN split_part(regexp_replace({text}, ' +', ' ', 'g'), ' ', 2) END"
    )
    hour = f"TRY_CAST(split_part({half}, ':', 1) AS INTEGER)"
    return f"(CASE WHEN {hour} BETWEEN 0 AND 23 THEN {hour} END)"


def _parsed(text: str) -> str:
    return f"try_strptime(regexp_replace({text}, '\\s+', ' ', 'g'), '%d/%m/%Y %H:%M')"


# Common table expressions, each with those it builds on.
CTES = {
    "areas": ([], f"SELECT * FROM (VALUES {_values(AREAS)}) t(code, name)"),
    "bands": ([], f"SELECT * FROM (VALUES {_values([(b[0],) for b in AGE_BANDS])}) t(rango)"),
    "ev": ([], "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"),
    "user_areas": (
        ["areas"],
        f"SELECT c_custkey AS user_id, coalesce(name, '{UNKNOWN_AREA}') AS comuna "
        "FROM customer LEFT JOIN areas ON c_nationkey = code",
    ),
    "inc": (
        ["ev"],
        f"""SELECT event_id, user_id, ts AS fecha_dt, CAST(hour(ts) AS INTEGER) AS hora,
            {_shift('hour(ts)')} AS turno_dia, event_type AS modalidad,
            'Objeto ' || CAST(floor(value / 20) AS BIGINT) AS bien_hurtado,
            'Lugar ' || CAST(floor(k / 5) AS BIGINT) AS lugar,
            CAST(k AS DOUBLE) AS edad, value AS lat, CAST(k AS DOUBLE) AS lon FROM ev""",
    ),
    "located": (
        ["inc", "user_areas"],
        f"SELECT inc.*, coalesce(comuna, '{UNKNOWN_AREA}') AS comuna "
        "FROM inc LEFT JOIN user_areas USING (user_id)",
    ),
    "area_counts": (["located"], "SELECT comuna, count(*) AS total FROM located GROUP BY comuna"),
    "cuts": (
        ["area_counts"],
        "SELECT quantile_cont(total, 0.75) AS p75, quantile_cont(total, 0.5) AS p50 FROM area_counts",
    ),
    "zones": (
        ["cuts"],
        f"SELECT comuna, total, p75, p50, {_zone('total', 'p75', 'p50')} AS zona_riesgo "
        "FROM area_counts, cuts",
    ),
    "raw": (
        ["ev"],
        f"""SELECT {TIME_TEXT} AS fecha_hecho, CAST(c_nationkey AS VARCHAR) AS codigo_comuna,
            c_name AS nombre_barrio,
            CASE WHEN k = 2 THEN 'abc'
                 ELSE CAST(CAST(round(value * 1e8) AS BIGINT) AS VARCHAR) END AS latitud,
            CASE WHEN k <> 3 THEN CAST(CAST(k AS BIGINT) * 100000000 AS VARCHAR) END AS longitud,
            event_type AS modalidad,
            CASE WHEN value < 10 THEN 'Sin dato' WHEN value < 40 THEN 'Arma blanca'
                 WHEN value < 90 THEN 'Arma de fuego' ELSE 'No' END AS arma_medio,
            CASE WHEN k < 50 THEN 'Sin dato' ELSE 'Mayor' END AS conducta_especial,
            'Transporte ' || CAST(floor(k / 8) AS BIGINT) AS medio_transporte,
            CASE WHEN value < 20 THEN 'Sin dato mercancías'
                 ELSE 'Objeto ' || CAST(floor(value / 20) AS BIGINT) END AS bien,
            'Categoría ' || CAST(floor(value / 100) AS BIGINT) AS categoria_bien,
            CASE WHEN value < 100 THEN 'NA' ELSE 'Grupo alto' END AS grupo_bien,
            'Lugar ' || CAST(floor(k / 5) AS BIGINT) AS lugar,
            CASE WHEN c_acctbal < 0 THEN 'Sin dato' WHEN c_acctbal < 5000 THEN 'Mujer'
                 ELSE 'Hombre' END AS sexo,
            CASE WHEN k = 4 THEN 'None' ELSE CAST(k AS VARCHAR) END AS edad,
            CASE WHEN c_mktsegment = 'BUILDING' THEN 'Sin dato' ELSE c_mktsegment END AS estado_civil
            FROM (SELECT *, unnest(CASE WHEN event_type = 'error' THEN [1, 2] ELSE [1] END) AS r
                  FROM ev) LEFT JOIN customer ON user_id = c_custkey""",
    ),
    "normal": (
        ["raw"],
        """SELECT * REPLACE (
            nullif(grupo_bien, 'NA') AS grupo_bien, nullif(edad, 'None') AS edad,
            CASE WHEN arma_medio = 'Sin dato' THEN 'No especificado' ELSE arma_medio END AS arma_medio,
            CASE WHEN conducta_especial = 'Sin dato' THEN 'No especificado'
                 ELSE conducta_especial END AS conducta_especial,
            CASE WHEN sexo = 'Sin dato' THEN 'No especificado' ELSE sexo END AS sexo,
            CASE WHEN estado_civil = 'Sin dato' THEN 'No especificado'
                 ELSE estado_civil END AS estado_civil) FROM raw""",
    ),
    "valid": (
        ["normal", "areas"],
        f"""SELECT n.*, coalesce(name, '{UNKNOWN_AREA}') AS comuna, {_parsed('fecha_hecho')} AS fecha_dt,
            TRY_CAST(latitud AS DOUBLE) / 1e8 AS raw_lat, TRY_CAST(longitud AS DOUBLE) / 1e8 AS raw_lon
            FROM normal n LEFT JOIN areas ON TRY_CAST(codigo_comuna AS INTEGER) = code
            WHERE {_parsed('fecha_hecho')} IS NOT NULL""",
    ),
    "valid_zones": (
        ["valid"],
        f"""SELECT comuna, {_zone('n', 'p75', 'p50')} AS zona_riesgo FROM
            (SELECT comuna, count(*) AS n FROM valid GROUP BY comuna),
            (SELECT quantile_cont(n, 0.75) AS p75, quantile_cont(n, 0.5) AS p50
             FROM (SELECT count(*) AS n FROM valid GROUP BY comuna))""",
    ),
}

DERIVED = f"""fecha_hecho, fecha_dt, CAST(year(fecha_dt) AS INTEGER) AS anio,
    CAST(month(fecha_dt) AS INTEGER) AS mes, CAST(hour(fecha_dt) AS INTEGER) AS hora,
    dayname(fecha_dt) AS dia_semana, {_shift('hour(fecha_dt)')} AS turno_dia, comuna,
    nombre_barrio AS barrio, CAST(codigo_comuna AS INTEGER) AS codigo_comuna, modalidad,
    conducta_especial AS tipo_conducta, arma_medio AS arma, medio_transporte AS transporte_victima,
    bien AS bien_hurtado, categoria_bien, grupo_bien, lugar, sexo, CAST(edad AS DOUBLE) AS edad,
    estado_civil, CASE WHEN {_inside('raw_lat', 'raw_lon')} THEN raw_lat END AS lat,
    CASE WHEN {_inside('raw_lat', 'raw_lon')} THEN raw_lon END AS lon"""

CTES["clean"] = (
    ["valid", "valid_zones"],
    f"SELECT {DERIVED}, zona_riesgo FROM (SELECT DISTINCT * FROM valid) "
    "LEFT JOIN valid_zones USING (comuna)",
)

_BROKEN = "'{broken ' || event_id"
CTES["sent"] = (
    ["ev"],
    f"""SELECT k, ev.event_id AS number, ts AS kafka_ts, k = 5 AS broken, 'EVT-' || event_id AS event_id,
        CASE WHEN k = 6 THEN NULL ELSE {TIME_TEXT} END AS fecha_hecho,
        CAST(user_id AS VARCHAR) AS comuna, event_type AS modalidad,
        CASE WHEN k <> 4 THEN CAST(k AS VARCHAR) END AS edad,
        CASE WHEN k NOT IN (2, 3) THEN value END AS lat, CAST(k AS DOUBLE) AS lon,
        {_BROKEN} AS texto FROM ev""",
)
CTES["judged"] = (
    ["sent"],
    f"""SELECT *, CASE WHEN broken THEN 'unreadable_json' WHEN fecha_hecho IS NULL THEN 'no_time'
        WHEN {_hour_from_text('fecha_hecho')} IS NULL THEN 'unreadable_hour' END AS motivo FROM sent""",
)

# The micro-batch in which each event arrives, of three.
_OWN_PART = """least(floor((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) * 3
    / greatest((SELECT max(epoch_us(ts)) - min(epoch_us(ts)) FROM events), 1)), 2)"""
_PART = f"""CAST(CASE WHEN event_id % 101 = 0 THEN 2
    WHEN event_id % 17 = 0 THEN least({_OWN_PART} + 1, 2) ELSE {_OWN_PART} END AS INTEGER)"""
CTES["arrived"] = ([], f"SELECT event_id AS number, ts, event_type, {_PART} AS part FROM events")
CTES["batches"] = (
    ["judged", "arrived"],
    "SELECT judged.*, number, part FROM judged JOIN arrived USING (number)",
)
CTES["good"] = (
    ["judged"],
    f"""SELECT *, CAST(hour({_parsed('fecha_hecho')}) AS INTEGER) AS hora_num,
        {_band('CAST(edad AS DOUBLE)')} AS rango FROM judged WHERE motivo IS NULL""",
)


def _needed(names) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for before in CTES[name][0]:
            visit(before)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def _sql(names: str, body: str) -> str:
    parts = ", ".join(f"{n} AS ({CTES[n][1]})" for n in _needed(names.split()))
    return f"WITH {parts} {body}" if parts else body


def _counted(source: str, key: str, name: str, total: str = "total", tail: str = "") -> str:
    return (
        f"SELECT {key} AS {name}, count(*) AS {total} FROM {source} "
        f"WHERE {key} IS NOT NULL GROUP BY 1 {tail}"
    )


def _top(total: str, name: str, k: int) -> str:
    return f"ORDER BY {total} DESC, {name} LIMIT {k}"


def _mode(source: str, column: str) -> str:
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} "
        f"ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


# Lists of the snapshot as SQL: list, key expression, name of the count, order, limit.
_LISTS = [
    ("por_comuna", "comuna", "comuna", "total_hurtos", None),
    ("por_turno", "turno_dia", "turno", "total", None),
    ("por_modalidad", "modalidad", "modalidad", "total", None),
    ("por_hora", "hora", "hora", "total", None),
    ("por_bien", "bien_hurtado", "bien", "total", 10),
    ("por_arma", "arma", "arma", "total", None),
    ("por_lugar", "lugar", "lugar", "total", 8),
    ("por_sexo", "sexo", "sexo", "total", None),
    ("por_barrio", "barrio", "barrio", "total", 15),
]
_AGES = (
    "SELECT b.rango, coalesce(n, 0) AS total FROM bands b LEFT JOIN "
    f"(SELECT {_band('edad')} AS rango, count(*) AS n FROM clean GROUP BY 1) USING (rango)"
)


def _list_table(column: str, key: str, total: str, top: int | None) -> str:
    limit = _top(total, key, top) if top else ""
    return _counted("clean", column, key, total, limit)


_LONG = " UNION ALL ".join(
    [
        f"SELECT '{name}' AS lista, CAST({key} AS VARCHAR) AS clave, CAST(NULL AS VARCHAR) AS zona, "
        f"{total} AS total FROM ({_list_table(column, key, total, top)})"
        for name, column, key, total, top in _LISTS
    ]
    + [
        f"SELECT 'por_edad', rango, NULL, total FROM ({_AGES})",
        "SELECT 'zona_riesgo', comuna, zona_riesgo, count(*) FROM clean GROUP BY comuna, zona_riesgo",
    ]
)

_ITEMS = "lineitem JOIN part ON l_partkey = p_partkey"
_SUPPLIED = "lineitem JOIN supplier ON l_suppkey = s_suppkey"
_CLEAN_COLUMNS = ", ".join(CLEAN.fieldNames())
_EVENT_COLUMNS = f"""event_id, fecha_hecho, comuna, modalidad, edad, lat, lon,
    CAST(year({_parsed('fecha_hecho')}) AS INTEGER) AS anio,
    CAST(month({_parsed('fecha_hecho')}) AS INTEGER) AS mes,
    CAST(hour({_parsed('fecha_hecho')}) AS INTEGER) AS hora_num,
    {_parsed('fecha_hecho')} AS fecha_dt, kafka_ts"""
_STORED_EVENTS = _sql("judged", f"SELECT {_EVENT_COLUMNS} FROM judged WHERE motivo IS NULL")
_RAW_BLANK = [f"coalesce({c}, '')" for c in RAW.fieldNames()]
_BEFORE_MODALITY = f"{_in('comuna', SPEC.comuna)} AND {_in('turno_dia', SPEC.turno_dia)}"

ORACLES = {
    "by_area": _sql("located", _counted("located", "comuna", "comuna", "total_hurtos")),
    "by_shift": _sql("inc", _counted("inc", "turno_dia", "turno")),
    "by_category": _sql("inc", _counted("inc", "modalidad", "modalidad")),
    "by_hour": _sql("inc", _counted("inc", "hora", "hora")),
    "top_goods": _counted(_ITEMS, "p_brand", "bien", tail=_top("total", "bien", 10)),
    "by_weapon": _counted(_ITEMS, "p_type", "arma"),
    "top_places": _counted("documents", "source", "lugar", tail=_top("total", "lugar", 8)),
    "by_sex": _counted("orders", "o_orderstatus", "sexo"),
    "age_bands": _sql(
        "inc bands",
        "SELECT b.rango, coalesce(n, 0) AS total FROM bands b LEFT JOIN "
        f"(SELECT {_band('edad')} AS rango, count(*) AS n FROM inc GROUP BY 1) USING (rango)",
    ),
    "top_neighbourhoods": _counted(_SUPPLIED, "s_name", "barrio", tail=_top("total", "barrio", 15)),
    "top_areas_12": _sql(
        "located", _counted("located", "comuna", '"Comuna"', '"Hurtos"', _top('"Hurtos"', '"Comuna"', 12))
    ),
    "top_transport": _counted(
        f"{_SUPPLIED} JOIN nation ON s_nationkey = n_nationkey",
        "n_name", '"Transporte"', '"Total"', _top('"Total"', '"Transporte"', 8),
    ),
    "multi_dim_counts": _sql(
        "inc",
        " UNION ALL ".join(
            f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS value, count(*) AS total "
            f"FROM inc WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in ("turno_dia", "modalidad", "hora", "bien_hurtado", "lugar")
        )
        + " UNION ALL SELECT NULL, NULL, count(*) FROM inc",
    ),
    "kpis": _sql(
        "located",
        f"""SELECT count(*) AS total_hurtos, {_mode('located', 'comuna')} AS comuna_mas_afectada,
            {_mode('located', 'turno_dia')} AS turno_mas_peligroso,
            {_mode('located', 'bien_hurtado')} AS bien_mas_hurtado FROM located""",
    ),
    "ingest_summary": _sql(
        "located",
        """SELECT count(*) AS total, min(fecha_dt) AS desde, max(fecha_dt) AS hasta,
            count(DISTINCT comuna) AS comuna_distintos,
            count(DISTINCT bien_hurtado) AS bien_hurtado_distintos FROM located""",
    ),
    "risk_zones": _sql("zones", "SELECT * FROM zones"),
    "risk_rows": _sql(
        "located zones",
        "SELECT event_id, comuna, zona_riesgo FROM located JOIN zones USING (comuna)",
    ),
    "risk_table": _sql(
        "zones",
        """SELECT comuna AS "Comuna", CASE zona_riesgo WHEN 'ALTO' THEN '🔴 ALTO'
            WHEN 'MEDIO' THEN '🟠 MEDIO' WHEN 'BAJO' THEN '🟢 BAJO' END AS "Zona",
            total AS "Hurtos" FROM zones""",
    ),
    "annual_trend": """WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, count(*) AS total
            FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
        l AS (SELECT *, lag(total) OVER (ORDER BY anio) AS anterior FROM y)
        SELECT anio, total, anterior,
            round(CAST(total - anterior AS DOUBLE) * 100.0 / anterior, 4) AS cambio_pct FROM l""",
    "concentration_cube": _sql(
        "located",
        """SELECT comuna, turno_dia, modalidad,
            CAST(grouping(comuna, turno_dia, modalidad) AS INTEGER) AS nivel, count(*) AS total,
            round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM located), 8) AS share
            FROM located GROUP BY CUBE (comuna, turno_dia, modalidad)""",
    ),
    "geo_grid": _sql(
        "inc",
        """SELECT CAST(floor(lat / 5.0) AS BIGINT) AS fila, CAST(floor(lon / 5.0) AS BIGINT) AS columna,
            count(*) AS total FROM inc WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY 1, 2""",
    ),
    "clean_incidents": _sql("clean", f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "date_parts": _sql(
        "ev",
        f"""SELECT CAST(year(t) AS INTEGER) AS anio, CAST(month(t) AS INTEGER) AS mes,
            CAST(hour(t) AS INTEGER) AS hora, dayname(t) AS dia_semana,
            {_hour_from_text('texto')} AS hora_texto, count(*) AS total
            FROM (SELECT {TIME_TEXT} AS texto, {_parsed(TIME_TEXT)} AS t FROM ev)
            WHERE t IS NOT NULL GROUP BY ALL""",
    ),
    "scalar_suite": _sql(
        "ev areas",
        f"""SELECT event_id, coalesce(name, '{UNKNOWN_AREA}') AS comuna,
            CAST(hour(ts) AS INTEGER) AS hora, dayname(ts) AS dia_semana,
            {_shift('hour(ts)')} AS turno_dia, CASE WHEN k <> 2 THEN value END AS numero,
            CASE WHEN k < 50 THEN 'No especificado' ELSE 'Sin dato ' || event_type END AS texto_normal,
            {_band('k')} AS rango, {_hour_from_text(f'({TIME_TEXT})')} AS hora_texto,
            contains({TIME_TEXT}, ' ') AS tiene_espacio FROM ev LEFT JOIN areas ON k = code""",
    ),
    "geo_repair": _sql(
        "raw",
        f"""SELECT nombre_barrio, latitud, longitud, CASE WHEN {_inside('y', 'x')} THEN y END AS lat,
            CASE WHEN {_inside('y', 'x')} THEN x END AS lon FROM (SELECT *,
            TRY_CAST(latitud AS DOUBLE) / 1e8 AS y, TRY_CAST(longitud AS DOUBLE) / 1e8 AS x FROM raw)""",
    ),
    "dim_lookup": _sql(
        "areas",
        f"""SELECT c_custkey, c_nationkey AS codigo_comuna, coalesce(name, '{UNKNOWN_AREA}') AS comuna
            FROM customer LEFT JOIN areas ON c_nationkey = code""",
    ),
    "dim_lookup_large": "SELECT event_id, user_id, c_name FROM events "
    "LEFT JOIN customer ON user_id = c_custkey",
    "dedupe": "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem",
    "dq_report": _sql(
        "normal valid",
        f"""SELECT (SELECT count(*) FROM raw) AS rows_in,
            (SELECT count(*) FROM raw) - (SELECT count(*) FROM valid) AS bad_dates,
            (SELECT count(*) FROM valid
             WHERE NOT {_inside('raw_lat', 'raw_lon')} AND raw_lat IS NOT NULL) AS bad_coords,
            (SELECT count(*) FROM valid) - (SELECT count(*) FROM (SELECT DISTINCT * FROM valid))
                AS duplicates,
            (SELECT count(*) FROM (SELECT DISTINCT * FROM valid)) AS rows_out""",
    ),
    "facet_filter": _sql(
        "located",
        f"""SELECT event_id, comuna, turno_dia, modalidad, hora FROM located
            WHERE {_BEFORE_MODALITY} AND {_in('modalidad', SPEC.modalidad)}
            AND hora BETWEEN {SPEC.hora[0]} AND {SPEC.hora[1]}""",
    ),
    "facet_filter_semi": _sql(
        "located zones",
        "SELECT event_id, comuna FROM located "
        "WHERE comuna IN (SELECT comuna FROM zones WHERE zona_riesgo = 'ALTO')",
    ),
    "facet_values": _sql(
        "located",
        f"""SELECT DISTINCT 'comuna' AS facet, comuna AS valor FROM located
            UNION ALL SELECT DISTINCT 'modalidad', modalidad FROM located WHERE {_BEFORE_MODALITY}""",
    ),
    "served_views": _sql(
        "located",
        f"SELECT * FROM (WITH f AS (SELECT * FROM located WHERE {_BEFORE_MODALITY} "
        f"AND {_in('modalidad', SPEC.modalidad)} AND hora BETWEEN {SPEC.hora[0]} AND {SPEC.hora[1]}) "
        + " UNION ALL ".join(
            f"SELECT '{view}' AS vista, clave, total FROM (SELECT CAST({column} AS VARCHAR) AS clave, "
            f"count(*) AS total FROM f GROUP BY 1 ORDER BY total DESC, clave{limit})"
            for view, column, limit in (
                ("comunas", "comuna", " LIMIT 12"),
                ("modalidades", "modalidad", ""),
                ("turnos", "turno_dia", ""),
                ("bienes", "bien_hurtado", " LIMIT 10"),
                ("horas", "hora", ""),
            )
        )
        + ")",
    ),
    "map_points": _sql("inc", f"SELECT lat, lon FROM inc WHERE {_inside('lat', 'lon')}"),
    "scan_clean": _sql(
        "clean",
        "SELECT count(*) AS filas, "
        + ", ".join(f"count({c}) AS {c}" for c in CLEAN.fieldNames())
        + " FROM clean",
    ),
    "csv_roundtrip": _sql(
        "raw",
        "SELECT * REPLACE (nullif(grupo_bien, 'NA') AS grupo_bien, nullif(edad, 'None') AS edad) FROM raw",
    ),
    "clean_csv_roundtrip": _sql("clean", f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "pruned_scan": """SELECT CAST(year(o_orderdate) AS INTEGER) AS anio,
            CAST(month(o_orderdate) AS INTEGER) AS mes, o_orderpriority AS comuna,
            o_orderdate AS fecha_dt, o_orderkey FROM orders
        WHERE year(o_orderdate) = 1997 AND month(o_orderdate) BETWEEN 3 AND 5
            AND o_orderpriority = '2-HIGH'""",
    "source_fallback": "SELECT event_id, event_type AS modalidad, 'files' AS source FROM events",
    "snapshot_doc": _sql(
        "clean bands",
        f"SELECT (SELECT count(*) FROM clean) AS total_eventos, '{SOURCE_LABEL}' AS fuente, l.* "
        f"FROM ({_LONG}) l",
    ),
    "ingest_job": _sql("clean", f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "served_from_csv": _sql("clean", "SELECT count(*) AS total_hurtos, 'csv' AS fuente FROM clean"),
    "incidents_union": _sql(
        "clean judged",
        f"""SELECT origen, modalidad, hora, count(*) AS total, count(edad) AS con_edad, sum(edad) AS edades
            FROM (SELECT 'batch' AS origen, modalidad, hora, edad FROM clean UNION ALL
                  SELECT 'stream', modalidad, CAST(hour({_parsed('fecha_hecho')}) AS INTEGER),
                  CAST(edad AS DOUBLE) FROM judged WHERE motivo IS NULL) GROUP BY ALL""",
    ),
    "served_job": _sql(
        "clean judged",
        # The hour range of the page, 0 to 23 at first, leaves out rows without an hour.
        f"""SELECT modalidad AS clave, count(*) AS total FROM (SELECT modalidad FROM clean UNION ALL
            SELECT modalidad FROM judged WHERE motivo IS NULL AND {_parsed('fecha_hecho')} IS NOT NULL)
            GROUP BY 1
            UNION ALL SELECT 'store+stream', (SELECT count(*) FROM clean) + (SELECT count(*) FROM judged
                WHERE motivo IS NULL AND {_parsed('fecha_hecho')} IS NOT NULL)""",
    ),
    "stream_quarantine": _sql(
        "judged",
        """SELECT CASE WHEN NOT broken THEN event_id END AS event_id,
            CASE WHEN NOT broken THEN fecha_hecho END AS fecha_hecho,
            CASE WHEN broken THEN texto END AS texto, motivo FROM judged WHERE motivo IS NOT NULL""",
    ),
    "snapshot_read": _sql("clean bands", f"SELECT * FROM ({_LONG})"),
    "served_view": _sql(
        "clean", _counted("clean", "barrio", '"Barrio"', '"Hurtos"', _top('"Hurtos"', '"Barrio"', 15))
    ),
    "run_log": _sql(
        "clean",
        " UNION ALL ".join(
            f"SELECT '{name}' AS mapa, {column} AS clave, count(*) AS total, "
            "(SELECT count(*) FROM clean) AS total_registros, "
            f"CAST({len(CLEAN)} AS INTEGER) AS columnas FROM clean WHERE {column} IS NOT NULL GROUP BY {column}"
            for name, column in (("comunas", "comuna"), ("modalidades", "modalidad"))
        ),
    ),
    "json_events": _STORED_EVENTS,
    "quarantine": _sql(
        "judged",
        """SELECT CASE WHEN NOT broken THEN event_id END AS event_id,
            CASE WHEN NOT broken THEN fecha_hecho END AS fecha_hecho,
            CASE WHEN broken THEN texto END AS texto, motivo FROM judged WHERE motivo IS NOT NULL""",
    ),
    "acceptance_counts": _sql(
        "judged", "SELECT count(*) - count(motivo) AS enviados, count(motivo) AS errores FROM judged"
    ),
    "event_envelope": _sql(
        "raw",
        f"""SELECT {', '.join(f'{e} AS {c}' for e, c in zip(_RAW_BLANK, RAW.fieldNames()))},
            {_shift(_hour_from_text('fecha_hecho'))} AS turno_dia,
            'EVT-' || md5(concat_ws(chr(31), {', '.join(_RAW_BLANK)})) AS event_id,
            '{SOURCE_LABEL}' AS fuente, {_hour_from_text('fecha_hecho')} AS hora_hecho FROM raw""",
    ),
    "pruned_box": _sql(
        "inc",
        """SELECT event_id, lat, lon, modalidad FROM inc
            WHERE lat BETWEEN 20 AND 24 AND lon BETWEEN 40 AND 48""",
    ),
    "stream_etl": _STORED_EVENTS,
    "stream_compacted": _sql(
        "judged", f"""SELECT {_EVENT_COLUMNS} FROM judged, (VALUES (1), (2)) WHERE motivo IS NULL"""
    ),
    "stream_dedup": _sql(
        "judged",
        f"""SELECT {_EVENT_COLUMNS} FROM judged WHERE motivo IS NULL UNION ALL
            SELECT {_EVENT_COLUMNS} FROM judged WHERE motivo IS NULL AND number % 5 = 0""",
    ),
    "stream_counters": _sql(
        "batches",
        """SELECT CAST(part AS BIGINT) AS lote, count(*) - count(motivo) AS enviados,
            count(motivo) AS errores FROM batches GROUP BY part""",
    ),
    "stream_restart": _sql(
        "batches",
        """SELECT CAST(part AS BIGINT) AS lote, count(*) - count(motivo) AS enviados, count(motivo) AS errores,
            (SELECT count(*) FROM judged WHERE motivo IS NULL) AS guardados,
            (SELECT count(motivo) FROM judged) AS apartados FROM batches GROUP BY part""",
    ),
    "stream_lookup_large": _sql("area_counts", "SELECT comuna, total FROM area_counts"),
    "snapshot_incremental": _sql(
        "good bands",
        f"""SELECT (SELECT count(*) FROM good) AS total_eventos, '{SOURCE_LABEL}' AS fuente, lista, clave,
                CAST(NULL AS VARCHAR) AS zona, total FROM (
            SELECT 'por_comuna' AS lista, comuna AS clave, count(*) AS total FROM good GROUP BY comuna
            UNION ALL SELECT 'por_modalidad', modalidad, count(*) FROM good GROUP BY modalidad
            UNION ALL SELECT 'por_hora', CAST(hora_num AS VARCHAR), count(*) FROM good
                WHERE hora_num IS NOT NULL GROUP BY hora_num
            UNION ALL SELECT 'por_edad', b.rango, count(g.rango) FROM bands b LEFT JOIN good g
                ON g.rango = b.rango GROUP BY b.rango)""",
    ),
    "stream_clean": _sql("valid", f"SELECT {DERIVED} FROM valid"),
    "stream_hourly": _sql(
        "arrived",
        # An hour is final once the events of earlier micro-batches have gone an hour beyond it;
        # what comes for it later is left out.
        """SELECT desde, event_type AS modalidad, count(*) AS total
        FROM (SELECT date_trunc('hour', ts) AS desde, event_type, part FROM arrived) h
        WHERE desde + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
          AND NOT EXISTS (SELECT 1 FROM (SELECT part AS earlier, max(ts) AS newest FROM arrived GROUP BY 1)
              WHERE earlier < h.part AND h.desde + INTERVAL 1 HOUR <= newest - INTERVAL 1 HOUR)
        GROUP BY 1, 2""",
    ),
    "stream_risk": _sql("zones", "SELECT * FROM zones"),
}
