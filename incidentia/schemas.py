"""Column names, schemas and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_S, _I, _L, _D = StringType(), IntegerType(), LongType(), DoubleType()

# Delimited input: every column is read as text, cleaning does the casts.
RAW = _struct(
    fecha_hecho=_S, codigo_comuna=_S, nombre_barrio=_S, latitud=_S, longitud=_S,
    modalidad=_S, arma_medio=_S, conducta_especial=_S, medio_transporte=_S,
    bien=_S, categoria_bien=_S, grupo_bien=_S, lugar=_S, sexo=_S, edad=_S,
    estado_civil=_S,
)

CLEAN = _struct(
    fecha_hecho=_S, fecha_dt=TimestampNTZType(), anio=_I, mes=_I, hora=_I,
    dia_semana=_S, turno_dia=_S, comuna=_S, barrio=_S, codigo_comuna=_I,
    modalidad=_S, tipo_conducta=_S, arma=_S, transporte_victima=_S,
    bien_hurtado=_S, categoria_bien=_S, grupo_bien=_S, lugar=_S, sexo=_S,
    edad=_D, estado_civil=_S, lat=_D, lon=_D, zona_riesgo=_S,
)

# JSON event payload. Coordinates are taken as text because producers quote
# them; ``parse_events`` casts them afterwards.
EVENT = _struct(
    fecha_hecho=_S, comuna=_S, barrio=_S, modalidad=_S, bien_hurtado=_S, arma=_S,
    lugar=_S, sexo=_S, edad=_S, turno_dia=_S, hora=_S, zona_riesgo=_S, lat=_S,
    lon=_S, event_id=_S, timestamp_ingesta=_S,
)

# What the stream stores per event.
STREAM_STORE = StructType(
    [StructField(f.name, _D if f.name in ("lat", "lon") else _S) for f in EVENT]
    + [
        StructField("kafka_ts", TimestampType()),
        StructField("fecha_dt", TimestampNTZType()),
        StructField("anio", _I),
        StructField("mes", _I),
        StructField("hora_num", _I),
        StructField("procesado_en", TimestampType()),
    ]
)


# Result documents, one row per list entry: their length has no limit.
SNAPSHOT = _struct(
    procesado_en=_S, total_eventos=_L, fuente=_S, lista=_S, clave=_S, zona=_S, total=_L
)

RUN_LOG = _struct(
    timestamp=_S, fuente=_S, total_registros=_L, columnas=ArrayType(_S), archivo_salida=_S,
    mapa=_S, clave=_S, total=_L,
)

# ---- Fixed values -----------------------------------------------------------

# Area codes and names.
AREAS = [
    (1, "Popular"),
    (2, "Santa Cruz"),
    (3, "Manrique"),
    (4, "Aranjuez"),
    (5, "Castilla"),
    (6, "Doce de Octubre"),
    (7, "Robledo"),
    (8, "Villa Hermosa"),
    (9, "Buenos Aires"),
    (10, "La Candelaria"),
    (11, "Laureles-Estadio"),
    (12, "La América"),
    (13, "San Javier"),
    (14, "El Poblado"),
    (15, "Guayabal"),
    (16, "Belén"),
    (50, "Palmitas"),
    (60, "San Cristóbal"),
    (70, "Altavista"),
    (80, "San Antonio de Prado"),
    (90, "Santa Elena"),
]
UNKNOWN_AREA = "Desconocida"

# Sentinel text, its replacement, and the raw columns it is replaced in.
SENTINEL = "Sin dato"
SENTINEL_REPLACEMENT = "No especificado"
SENTINEL_COLUMNS = [
    "modalidad",
    "arma_medio",
    "conducta_especial",
    "medio_transporte",
    "sexo",
    "estado_civil",
]

# Raw column -> clean column.
RENAMES = {
    "nombre_barrio": "barrio",
    "bien": "bien_hurtado",
    "arma_medio": "arma",
    "conducta_especial": "tipo_conducta",
    "medio_transporte": "transporte_victima",
}

# Shifts of the day: name, first hour, first hour after it.
SHIFTS = [("Mañana", 6, 12), ("Tarde", 12, 18), ("Noche", 18, 22)]
OTHER_SHIFT = "Madrugada"
SHIFT_NAMES = ["Mañana", "Tarde", "Noche", "Madrugada"]

# Age bands: label, open lower edge, closed upper edge.
AGE_BANDS = [
    ("<18", 0, 17),
    ("18-25", 17, 25),
    ("26-35", 25, 35),
    ("36-50", 35, 50),
    ("51-65", 50, 65),
    ("65+", 65, 120),
]

# Risk zones and how the served table labels them.
HIGH, MEDIUM, LOW = "ALTO", "MEDIO", "BAJO"
HIGH_QUANTILE, MEDIUM_QUANTILE = 0.75, 0.50
RISK_LABELS = {"ALTO": "🔴 ALTO", "MEDIO": "🟠 MEDIO", "BAJO": "🟢 BAJO"}

# Text the pandas CSV reader takes as missing by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
