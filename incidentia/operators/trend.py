"""Annual trend, concentration with subtotals, density grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from incidentia.functions.geo import grid_cell
from incidentia.session import written


def annual_trend(rows: DataFrame, time: str = "fecha_dt") -> DataFrame:
    """Incidents per year, the year before's, and the change in per cent.

    The window runs over one row per year, not over incidents.
    """
    years = (
        rows.where(F.col(time).isNotNull())
        .groupBy(F.year(time).alias("anio"))
        .agg(F.count("*").alias("total"))
    )
    before = F.lag("total").over(Window.orderBy("anio"))
    change = (F.col("total") - F.col("anterior")) * F.lit(100.0) / F.col("anterior")
    return (
        years.withColumn("anterior", before)
        .withColumn("cambio_pct", F.round(change, 4))
        .orderBy("anio")
    )


def concentration_cube(counts: DataFrame, keys: list[str], total: str = "total") -> DataFrame:
    """Counts and shares of every combination of ``keys``, subtotals included.

    Takes counts per combination: the cube then multiplies groups, not rows.
    They are written first, as the shares need their sum too. A subtotal has
    null keys and a level above 0.
    """
    cells = written(counts.select(*keys, total), "cells")
    everything = cells.agg(F.sum(total)).scalar()
    return (
        cells.cube(*keys)
        .agg(
            F.sum(total).alias("total"),
            F.grouping_id().cast("int").alias("nivel"),
        )
        .select(*keys, "nivel", "total", F.round(F.col("total") / everything, 8).alias("share"))
    )


def geo_grid(rows: DataFrame, cell: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Incidents per square of ``cell`` degrees."""
    located = rows.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return located.groupBy(
        grid_cell(F.col(lat), cell).alias("fila"), grid_cell(F.col(lon), cell).alias("columna")
    ).agg(F.count("*").alias("total"))
