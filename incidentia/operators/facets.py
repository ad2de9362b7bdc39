"""Facet filters, facet values and the served views."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentia.functions.geo import CITY_BOX, Box
from incidentia.functions.values import to_number
from incidentia.operators.counts import (
    KPI_NAMES,
    by_count,
    count_by,
    modes_of,
    multi_dim_counts,
)
from incidentia.operators.joins import keep_selected
from incidentia.operators.risk import captioned
from incidentia.operators.snapshot import COUNTED
from incidentia.session import written


@dataclass(frozen=True)
class FilterSpec:
    """Selections of the served page; an empty selection does not filter."""

    comuna: tuple[str, ...] = ()
    turno_dia: tuple[str, ...] = ()
    modalidad: tuple[str, ...] = ()
    sexo: tuple[str, ...] = ()
    hora: tuple[int, int] = (0, 23)

    @property
    def unfiltered(self) -> bool:
        return self == FilterSpec()

    def selection(self, column: str, present: list[str]) -> list[Column]:
        chosen = getattr(self, column)
        return [F.col(column).isin(list(chosen))] if chosen and column in present else []

    def predicate(self, present: list[str]) -> Column:
        """All selections together; the hour range drops rows without an hour."""
        tests = [
            test
            for column in ("comuna", "turno_dia", "modalidad", "sexo")
            for test in self.selection(column, present)
        ]
        if "hora" in present:
            tests.append(F.col("hora").between(*self.hora))
        return reduce(lambda a, b: a & b, tests, F.lit(True))


def with_numbers(rows: DataFrame) -> DataFrame:
    """Numeric hour, age and area code where those columns came as text."""
    texts = [n for n, t in rows.dtypes if t == "string" and n in ("hora", "edad", "codigo_comuna")]
    return rows.withColumns({c: to_number(F.col(c)) for c in texts}) if texts else rows


def apply_filters(rows: DataFrame, spec: FilterSpec) -> DataFrame:
    return with_numbers(rows).where(spec.predicate(rows.columns))


def apply_selections(rows: DataFrame, selections: Mapping[str, DataFrame]) -> DataFrame:
    """Keep rows whose column value occurs in the selection of the same name.

    For selections too long for a literal list; each is a one-column table.
    """
    for column, chosen in selections.items():
        rows = keep_selected(rows, chosen, column)
    return rows


def facet_values(rows: DataFrame, spec: FilterSpec = FilterSpec()) -> DataFrame:
    """``facet, valor``: the values each list offers, given the selections before it."""
    before: list[Column] = []
    offered = []
    for column in ("comuna", "turno_dia", "modalidad", "sexo"):
        if column in rows.columns and column != "turno_dia":
            seen = reduce(lambda a, b: a & b, before, F.lit(True))
            offered.append(F.when(seen, F.col(column)).alias(column))
        before += spec.selection(column, rows.columns)
    columns = [c for c in ("comuna", "modalidad", "sexo") if c in rows.columns]
    counts = multi_dim_counts(rows.select(*offered), columns)
    return counts.select(
        F.col("dimension").alias("facet"), F.col("value").alias("valor")
    ).orderBy("facet", "valor")


def map_points(rows: DataFrame, box: Box = CITY_BOX) -> DataFrame:
    points = rows.select(to_number(F.col("lat")).alias("lat"), to_number(F.col("lon")).alias("lon"))
    return points.where(box.holds(F.col("lat"), F.col("lon")))


# View -> column counted, names of the two output columns, rows kept.
COUNT_VIEWS = {
    "comunas": ("comuna", "Comuna", "Hurtos", 12),
    "modalidades": ("modalidad", "Modalidad", "Total", None),
    "turnos": ("turno_dia", "Turno", "Total", None),
    "sexos": ("sexo", "Sexo", "Total", None),
    "armas": ("arma", "Arma", "Total", None),
    "transportes": ("transporte_victima", "Transporte", "Total", 8),
    "bienes": ("bien_hurtado", "Bien", "Total", 10),
    "lugares": ("lugar", "Lugar", "Total", 8),
    "barrios": ("barrio", "Barrio", "Hurtos", 15),
}


def views(
    rows: DataFrame,
    spec: FilterSpec = FilterSpec(),
    box: Box = CITY_BOX,
    counted: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every served table, by name, for the filtered rows.

    All counts come from one scan, written as one small table of which each
    view is a part. Views on columns that are not there are left out. What
    ``counted`` has (see ``snapshot.section_counts``) is not counted again.
    """
    kept = apply_filters(rows, spec)
    present = [column for column, _, _, _ in COUNT_VIEWS.values() if column in kept.columns]
    present += ["hora"] if "hora" in kept.columns else []
    zoned = ("comuna", "zona_riesgo")
    pairs = (zoned,) if set(zoned) <= set(kept.columns) else ()
    if counted is None:
        counts = written(multi_dim_counts(kept, present, pairs=pairs, with_all=True), "views")
    else:
        missing = [c for c in present if c not in COUNTED]
        counts = counted
        if missing:
            more = multi_dim_counts(kept, missing)
            counts = written(counted.unionByName(more, allowMissingColumns=True), "views")

    def part(dimension: str) -> DataFrame:
        return counts.where(F.col("dimension") == dimension)

    named = {k: v for k, v in KPI_NAMES.items() if k in present}
    served = {"kpis": modes_of(counts, named, total_as="total_hurtos")}
    for name, (column, key, total, top) in COUNT_VIEWS.items():
        if column in present:
            listed = part(column).select(F.col("value").alias(key), F.col("total").alias(total))
            served[name] = by_count(listed, total, key, top=top)
    if "hora" in present:
        hour = F.col("value").try_cast("double").try_cast("int")
        served["horas"] = part("hora").select(
            hour.alias("Hora"), F.col("total").alias("Total")
        ).orderBy("Hora")
    if pairs:
        pair_counts = part("+".join(zoned)).select(
            F.col("value").alias("comuna"), F.col("other").alias("zona_riesgo"), "total"
        )
        served["riesgo"] = captioned(pair_counts)
    if {"lat", "lon"} <= set(kept.columns):
        served["mapa"] = map_points(kept, box)
    return served


def served_counts(
    rows: DataFrame, spec: FilterSpec, view: str, snapshot: DataFrame | None = None
) -> DataFrame:
    """One counting view, from the stored snapshot if no filter is set.

    The snapshot has the same lists for areas, shifts, modalities, goods,
    weapons, places and sexes; the rows are then not read at all.
    """
    column, key, total, top = COUNT_VIEWS[view]
    stored = {
        "comunas": "por_comuna",
        "turnos": "por_turno",
        "modalidades": "por_modalidad",
        "bienes": "por_bien",
        "armas": "por_arma",
        "lugares": "por_lugar",
        "sexos": "por_sexo",
        "barrios": "por_barrio",
    }
    if snapshot is not None and spec.unfiltered and view in stored:
        listed = snapshot.where(F.col("lista") == stored[view]).select(
            F.col("clave").alias(key), F.col("total").alias(total)
        )
        ordered = listed.orderBy(F.desc(total), key)
        return ordered if top is None else ordered.limit(top)
    return count_by(apply_filters(rows, spec), column, key_as=key, total_as=total, top=top)
