"""Result documents: the aggregates snapshot and the run log.

Both are tables with one row per list entry and the fields of the document
repeated in each row, so a list may be of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from incidentia.functions.dates import iso_text
from incidentia.functions.values import age_band
from incidentia.operators.counts import complete_domain, multi_dim_counts
from incidentia.schemas import AGE_BANDS, RUN_LOG, SNAPSHOT
from incidentia.session import written

# Snapshot list -> counted column, names inside the list, entries kept.
LISTS = {
    "por_comuna": ("comuna", "comuna", "total_hurtos", None),
    "por_turno": ("turno_dia", "turno", "total", None),
    "por_modalidad": ("modalidad", "modalidad", "total", None),
    "por_hora": ("hora", "hora", "total", None),
    "por_bien": ("bien_hurtado", "bien", "total", 10),
    "por_arma": ("arma", "arma", "total", None),
    "por_lugar": ("lugar", "lugar", "total", 8),
    "por_sexo": ("sexo", "sexo", "total", None),
    "por_edad": ("rango_edad", "rango", "total", None),
    "por_barrio": ("barrio", "barrio", "total", 15),
}
LONGEST_TOP = max(top for _, _, _, top in LISTS.values() if top)


def with_age_band(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rango_edad", age_band(F.col("edad")))


PAIR = ("comuna", "zona_riesgo")
COUNTED = [column for column, _, _, _ in LISTS.values()]
COUNTS = StructType(
    [StructField(n, StringType()) for n in ("dimension", "value", "other")]
    + [StructField("total", LongType())]
)


def section_counts(rows: DataFrame) -> DataFrame:
    """All groups of all lists, none cut, from one scan: ``dimension, value, other, total``.

    Counts of parts of the rows add up to the counts of all; see ``added``.
    """
    return multi_dim_counts(with_age_band(rows), COUNTED, pairs=(PAIR,), with_all=True)


def added(counts: DataFrame) -> DataFrame:
    """The counts of several parts of the rows as counts of all of them."""
    groups = counts.groupBy("dimension", "value", "other").agg(F.sum("total").alias("total"))
    return groups.select(COUNTS.fieldNames())


def sections(rows: DataFrame) -> DataFrame:
    """All lists of the snapshot as ``lista, clave, zona, total``, from one scan."""
    return cut_sections(written(section_counts(rows), "counts"))


def cut_sections(counts: DataFrame) -> DataFrame:
    """The lists from the counts of all groups.

    Top-k lists are cut here: the row-number filter with a constant limit
    keeps at most that many rows per task before its shuffle.
    """
    lista = F.when(F.col("dimension").isNull(), "total").when(
        F.col("dimension") == "+".join(PAIR), "zona_riesgo"
    )
    for name, (column, _, _, _) in LISTS.items():
        lista = lista.when(F.col("dimension") == column, name)
    named = counts.select(
        lista.alias("lista"),
        F.col("value").alias("clave"),
        F.col("other").alias("zona"),
        "total",
    )

    tops = {name: top for name, (_, _, _, top) in LISTS.items() if top}
    place = F.row_number().over(Window.partitionBy("lista").orderBy(F.desc("total"), "clave"))
    kept = F.lit(LONGEST_TOP)
    for name, top in tops.items():
        kept = F.when(F.col("lista") == name, top).otherwise(kept)
    cut = (
        named.where(F.col("lista").isin(list(tops)))
        .withColumn("_place", place)
        .where(F.col("_place") <= LONGEST_TOP)
        .where(F.col("_place") <= kept)
        .drop("_place")
    )
    bands = complete_domain(
        named.where(F.col("lista") == "por_edad").select("clave", "total"),
        "clave",
        [label for label, _, _ in AGE_BANDS],
    ).select(F.lit("por_edad").alias("lista"), "clave", F.lit(None).alias("zona"), "total")
    whole = named.where(~F.col("lista").isin(list(tops) + ["por_edad"]))
    return whole.unionByName(cut).unionByName(bands)


def _with_fields(entries: DataFrame, everything: DataFrame, names: list[str], **fields) -> DataFrame:
    total = everything.agg(F.coalesce(F.max("total"), F.lit(0)))
    name = next(n for n in names if n.startswith("total_"))
    return entries.withColumns({name: total.scalar(), **fields}).select(names)


def snapshot_doc(rows: DataFrame, source: str, processed_at: Column | None = None) -> DataFrame:
    """The aggregates document: one row per entry of its eleven lists.

    The age bands are always listed, so there are rows even for an empty table.
    """
    return snapshot_of_counts(written(section_counts(rows), "counts"), source, processed_at)


def snapshot_of_counts(
    counts: DataFrame, source: str, processed_at: Column | None = None
) -> DataFrame:
    """The document from ``section_counts``, which may have been added up from
    increments: the rows behind them are not read."""
    entries = written(cut_sections(counts), "sections")
    whole = F.col("lista") == "total"
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return _with_fields(
        entries.where(~whole),
        entries.where(whole),
        SNAPSHOT.fieldNames(),
        procesado_en=iso_text(stamp),
        fuente=F.lit(source),
    )


def run_log(
    rows: DataFrame, source: str, output: str, logged_at: Column | None = None
) -> DataFrame:
    """When, from where, how many rows, which columns; one row per entry of the
    two count maps, and one without an entry."""
    names = {"comuna": "comunas", "modalidad": "modalidades"}
    counts = written(multi_dim_counts(rows, list(names), with_all=True), "log")
    stamp = F.current_timestamp() if logged_at is None else logged_at
    mapa = F.lit(None).cast("string")
    for dimension, name in names.items():
        mapa = F.when(F.col("dimension") == dimension, name).otherwise(mapa)
    entries = counts.select(
        mapa.alias("mapa"),
        F.col("value").alias("clave"),
        F.when(F.col("dimension").isNotNull(), F.col("total")).alias("total"),
    )
    if_empty = rows.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("mapa"),
        F.lit(None).cast("string").alias("clave"),
        F.lit(None).cast("bigint").alias("total"),
    )
    return _with_fields(
        entries.where("mapa IS NOT NULL").unionByName(if_empty),
        counts.where("dimension IS NULL"),
        RUN_LOG.fieldNames(),
        timestamp=iso_text(stamp),
        fuente=F.lit(source),
        columnas=F.array(*[F.lit(c) for c in rows.columns]),
        archivo_salida=F.lit(output),
    )
