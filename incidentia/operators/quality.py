"""Data-quality counters and the split into good and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentia.functions.dates import hour_from_text, parse_event_time
from incidentia.functions.geo import CITY_BOX, Box, scaled
from incidentia.operators.clean import copies


def dq_report(raw: DataFrame, box: Box = CITY_BOX) -> DataFrame:
    """One row of counters for cleaning ``raw``."""
    return dq_of_copies(copies(raw), box)


def dq_of_copies(counted: DataFrame, box: Box = CITY_BOX) -> DataFrame:
    """The counters from the rows that ``copies`` counted.

    Every counter is a sum over distinct rows. Coordinates count as bad if the
    pair is outside the box and its latitude is a number.
    """
    checked = counted.select(
        "_n",
        parse_event_time(F.col("fecha_hecho")).isNotNull().alias("dated"),
        scaled(F.col("latitud")).alias("lat"),
        scaled(F.col("longitud")).alias("lon"),
    )
    dated = F.col("dated")
    bad_pair = dated & ~box.holds(F.col("lat"), F.col("lon")) & F.col("lat").isNotNull()

    def rows_where(condition: Column, weight: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0))

    n = F.col("_n")
    return checked.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("rows_in"),
        rows_where(~dated, n).alias("bad_dates"),
        rows_where(bad_pair, n).alias("bad_coords"),
        rows_where(dated, n - 1).alias("duplicates"),
        F.count_if(dated).alias("rows_out"),
    )


def with_rejection(events: DataFrame) -> DataFrame:
    """Add ``motivo``: why a parsed event is rejected, null for a good one."""
    hour = hour_from_text(F.col("fecha_hecho"))
    reason = (
        F.when(F.col("_corrupt").isNotNull(), "unreadable_json")
        .when(F.col("fecha_hecho").isNull(), "no_time")
        .when(hour.isNull(), "unreadable_hour")
    )
    return events.withColumn("motivo", reason)


def accepted(events: DataFrame) -> DataFrame:
    return with_rejection(events).where(F.col("motivo").isNull()).drop("motivo", "_corrupt")


def quarantine(events: DataFrame) -> DataFrame:
    return with_rejection(events).where(F.col("motivo").isNotNull())


def acceptance_counts(events: DataFrame) -> DataFrame:
    """One row: accepted and rejected events."""
    return with_rejection(events).agg(
        F.count_if(F.col("motivo").isNull()).alias("enviados"),
        F.count_if(F.col("motivo").isNotNull()).alias("errores"),
    )
