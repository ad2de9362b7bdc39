"""Risk zones: groups ranked by exact quantiles of their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentia.functions.values import risk_caption, risk_label
from incidentia.operators.counts import by_count, count_by_pair
from incidentia.operators.joins import lookup
from incidentia.schemas import HIGH_QUANTILE, MEDIUM_QUANTILE
from incidentia.session import written


def risk_zones(counts: DataFrame, key: str, total: str = "total") -> DataFrame:
    """Add ``p75``, ``p50`` and ``zona_riesgo`` to one-row-per-group counts.

    The counts are written first, because the quantiles and the labels both
    read them and the rows behind them should be read once.

    Both quantiles interpolate linearly and are exact. Their state holds each
    distinct count once, and N rows have fewer than sqrt(2 N) distinct group
    sizes, so it stays small however many groups there are.
    """
    stored = written(counts.select(key, total), "group-counts")

    def cut(quantile: float) -> Column:
        return stored.agg(F.percentile(total, quantile)).scalar()

    cuts = stored.withColumns({"p75": cut(HIGH_QUANTILE), "p50": cut(MEDIUM_QUANTILE)})
    return cuts.withColumn("zona_riesgo", risk_label(F.col(total), F.col("p75"), F.col("p50")))


def zones_of(rows: DataFrame, key: str) -> DataFrame:
    """``key, zona_riesgo`` for every group of ``rows``."""
    named = rows.where(F.col(key).isNotNull())
    counts = named.groupBy(key).agg(F.count("*").alias("total"))
    return risk_zones(counts, key).select(key, "zona_riesgo")


def risk_rows(rows: DataFrame, key: str, zones: DataFrame | None = None) -> DataFrame:
    """Every row with the zone of its group."""
    return lookup(rows, zones_of(rows, key) if zones is None else zones, key)


def captioned(pair_counts: DataFrame) -> DataFrame:
    """``comuna, zona_riesgo, total`` as served: area, zone caption, incidents."""
    served = pair_counts.select(
        F.col("comuna").alias("Comuna"),
        risk_caption(F.col("zona_riesgo")).alias("Zona"),
        F.col("total").alias("Hurtos"),
    )
    return by_count(served, "Hurtos", "Comuna", "Zona")


def risk_table(rows: DataFrame) -> DataFrame:
    return captioned(count_by_pair(rows, "comuna", "zona_riesgo"))
