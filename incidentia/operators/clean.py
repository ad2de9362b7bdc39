"""Cleaning: raw text rows to the typed 24-column incident table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentia.functions.dates import parse_event_time, shift_of, time_parts
from incidentia.functions.geo import CITY_BOX, Box, repaired_pair, scaled
from incidentia.functions.values import missing_to_null, to_code, to_number, without_sentinel
from incidentia.operators.joins import lookup
from incidentia.operators.risk import risk_rows, risk_zones
from incidentia.schemas import CLEAN, RENAMES, SENTINEL_COLUMNS, UNKNOWN_AREA
from incidentia.session import written
from incidentia.sources.dimension import area_dimension


def normalise_missing(raw: DataFrame) -> DataFrame:
    """Null for every text that stands for a missing value."""
    texts = [name for name, kind in raw.dtypes if kind == "string"]
    return raw.withColumns({c: missing_to_null(F.col(c)) for c in texts})


def normalise_sentinels(raw: DataFrame, columns: list[str] = SENTINEL_COLUMNS) -> DataFrame:
    present = [c for c in columns if c in raw.columns]
    return raw.withColumns({c: without_sentinel(F.col(c)) for c in present})


def with_event_time(raw: DataFrame) -> DataFrame:
    """Add ``fecha_dt``. It comes out of a generator, so a filter on it does
    not parse the text a second time."""
    time = F.explode(F.array(parse_event_time(F.col("fecha_hecho"))))
    return raw.select("*", time.alias("fecha_dt"))


def with_time_parts(rows: DataFrame) -> DataFrame:
    parted = rows.withColumns(time_parts(F.col("fecha_dt")))
    return parted.withColumn("turno_dia", shift_of(F.col("hora")))


def with_area(
    rows: DataFrame, dimension: DataFrame | None = None, default: str = UNKNOWN_AREA
) -> DataFrame:
    """Add ``comuna``: the name of ``codigo_comuna``, or ``default``.

    The built-in areas are 21 rows and broadcast; another ``code, name``
    table is broadcast only if it proves small.
    """
    if dict(rows.dtypes)["codigo_comuna"] != "int":
        rows = rows.withColumn("codigo_comuna", to_code(F.col("codigo_comuna")))
    if dimension is None:
        areas = area_dimension(rows.sparkSession).toDF("codigo_comuna", "comuna")
        named = rows.join(F.broadcast(areas), "codigo_comuna", "left")
    else:
        named = lookup(rows, dimension.toDF("codigo_comuna", "comuna"), "codigo_comuna")
    return named.select(*rows.columns, F.coalesce("comuna", F.lit(default)).alias("comuna"))


def with_coordinates(rows: DataFrame, box: Box = CITY_BOX) -> DataFrame:
    located = rows.withColumns(
        {"lat": scaled(F.col("latitud")), "lon": scaled(F.col("longitud"))}
    )
    lat, lon = repaired_pair(F.col("lat"), F.col("lon"), box)
    return located.withColumns({"lat": lat, "lon": lon})


def dedupe(rows: DataFrame) -> DataFrame:
    """One of each group of equal rows; nulls are equal to each other.

    Copies are dropped in each task before the shuffle, so even a row that
    makes up a third of the table reaches the shuffle once per task.
    """
    return rows.dropDuplicates()


def project_clean(rows: DataFrame) -> DataFrame:
    """Renamed, in fixed order, without the columns that are not there."""
    renamed = rows.withColumnsRenamed(RENAMES)
    if "edad" in renamed.columns:
        renamed = renamed.withColumn("edad", to_number(F.col("edad")))
    return renamed.select([c for c in CLEAN.fieldNames() if c in renamed.columns])


def normalised(raw: DataFrame) -> DataFrame:
    return normalise_sentinels(normalise_missing(raw))


def valid_rows(normal: DataFrame) -> DataFrame:
    """Normalised rows whose time parses, with that time."""
    return with_event_time(normal).where(F.col("fecha_dt").isNotNull())


def copies(raw: DataFrame) -> DataFrame:
    """Normalised raw rows, equal ones once, with their number in ``_n``.

    Copies are counted in each task before the shuffle. Zones, counters and
    unique rows all follow from this table; ``written`` keeps it, so the raw
    source is read and shuffled once for all of them.
    """
    normal = normalised(raw)
    return normal.groupBy(*normal.columns).agg(F.count("*").alias("_n"))


def derive(rows: DataFrame, box: Box = CITY_BOX) -> DataFrame:
    """Row-by-row part of cleaning; also runs on a stream."""
    return with_coordinates(with_area(with_time_parts(rows)), box)


def clean_copies(
    counted: DataFrame, *, box: Box = CITY_BOX, dedupe_first: bool = False
) -> DataFrame:
    """The cleaning of the rows that ``copies`` counted; reads them twice.

    Zones come from the counts before duplicates are dropped, or from those
    after it with ``dedupe_first``. Areas are looked up once per code.
    """
    valid = valid_rows(counted)
    weight = F.lit(1) if dedupe_first else F.col("_n")
    by_code = valid.groupBy("codigo_comuna").agg(F.sum(weight).alias("total"))
    by_area = with_area(by_code).groupBy("comuna").agg(F.sum("total").alias("total"))
    zones = risk_zones(by_area, "comuna").select("comuna", "zona_riesgo")
    return project_clean(risk_rows(derive(valid.drop("_n"), box), "comuna", zones))


def clean(raw: DataFrame, *, box: Box = CITY_BOX, dedupe_first: bool = False) -> DataFrame:
    """The whole cleaning; see ``clean_copies``.

    Derived columns follow from the raw ones, so duplicates are dropped on the
    raw columns and derived afterwards.
    """
    counted = written(copies(raw), "copies")
    return clean_copies(counted, box=box, dedupe_first=dedupe_first)


def clean_stream(raw: DataFrame, *, box: Box = CITY_BOX) -> DataFrame:
    """Cleaning without the two steps that need the whole table (zones, duplicates)."""
    return project_clean(derive(valid_rows(normalised(raw)), box))
