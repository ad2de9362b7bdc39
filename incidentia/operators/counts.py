"""Grouped counts, top-k lists, modes and summaries.

Null keys are not counted. Equal counts are ordered by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentia.functions.values import age_band
from incidentia.schemas import AGE_BANDS


def by_count(counts: DataFrame, total: str, *keys: str, top: int | None = None) -> DataFrame:
    ordered = counts.orderBy(F.desc(total), *keys)
    return ordered if top is None else ordered.limit(top)


def count_by(
    rows: DataFrame,
    key: str,
    *,
    key_as: str | None = None,
    total_as: str = "total",
    top: int | None = None,
) -> DataFrame:
    """Rows per key, most frequent first, optionally only the first ``top``."""
    name = key_as or key
    counts = (
        rows.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(name))
        .agg(F.count("*").alias(total_as))
    )
    return by_count(counts, total_as, name, top=top)


def count_by_in_key_order(rows: DataFrame, key: str) -> DataFrame:
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("total"))
    return counts.orderBy(key)


def count_by_pair(rows: DataFrame, first: str, second: str) -> DataFrame:
    counts = (
        rows.where(F.col(first).isNotNull() & F.col(second).isNotNull())
        .groupBy(first, second)
        .agg(F.count("*").alias("total"))
    )
    return by_count(counts, "total", first, second)


def complete_domain(counts: DataFrame, key: str, values: list[str]) -> DataFrame:
    """One row per listed value, with 0 where ``counts`` has none.

    Only listed keys are kept of ``counts``, so the broadcast side is no
    longer than the list.
    """
    domain = counts.sparkSession.createDataFrame([(v,) for v in values], f"{key} string")
    known = counts.where(F.col(key).isin(values))
    return domain.join(F.broadcast(known), key, "left").select(
        key, F.coalesce("total", F.lit(0)).cast("bigint").alias("total")
    )


def age_bands(rows: DataFrame, age: str = "edad") -> DataFrame:
    """Rows per age band, empty bands included."""
    counts = (
        rows.select(age_band(F.col(age)).alias("rango"))
        .where(F.col("rango").isNotNull())
        .groupBy("rango")
        .agg(F.count("*").alias("total"))
    )
    complete = complete_domain(counts, "rango", [label for label, _, _ in AGE_BANDS])
    return by_count(complete, "total", "rango")


def multi_dim_counts(
    rows: DataFrame,
    keys: list[str],
    *,
    pairs: tuple[tuple[str, str], ...] = (),
    with_all: bool = False,
) -> DataFrame:
    """Counts per value of several columns in one scan: ``dimension, value, total``.

    ``pairs`` adds counts per two columns, with the second value in ``other``
    and the names joined by ``+`` as the dimension. ``with_all`` adds the
    number of rows, with null dimension and value.
    """
    sets = [(k,) for k in keys] + list(pairs) + ([()] if with_all else [])
    columns = list(dict.fromkeys(k for s in sets for k in s))

    def mask(group: tuple[str, ...]) -> int:
        return sum(1 << i for i, k in enumerate(reversed(columns)) if k not in group)

    nothing = F.lit(None).cast("string")
    dimension, value, other = nothing, nothing, nothing
    wanted = F.lit(False)
    for group in sets:
        mine = F.col("_set") == mask(group)
        present = mine
        for k in group:
            present = present & F.col(k).isNotNull()
        wanted = wanted | present
        if group:
            dimension = F.when(mine, "+".join(group)).otherwise(dimension)
            value = F.when(mine, F.col(group[0]).cast("string")).otherwise(value)
        if len(group) == 2:
            other = F.when(mine, F.col(group[1]).cast("string")).otherwise(other)

    counts = (
        rows.select(*columns)
        .groupingSets([[F.col(k) for k in s] for s in sets], *columns)
        .agg(F.count("*").alias("total"), F.grouping_id().alias("_set"))
        .where(wanted)
    )
    named = [dimension.alias("dimension"), value.alias("value")]
    if pairs:
        named.append(other.alias("other"))
    return counts.select(*named, "total")


def modes_of(counts: DataFrame, keys: dict[str, str], *, total_as: str = "total") -> DataFrame:
    """``modes`` from counts that ``multi_dim_counts`` made, with ``with_all``."""
    winners = [
        F.min(
            F.when(F.col("dimension") == key, F.struct((-F.col("total")).alias("n"), "value"))
        )["value"].alias(name)
        for key, name in keys.items()
    ]
    everything = F.max(F.when(F.col("dimension").isNull(), F.col("total")))
    return counts.agg(F.coalesce(everything, F.lit(0)).alias(total_as), *winners)


def modes(rows: DataFrame, keys: dict[str, str], *, total_as: str = "total") -> DataFrame:
    """One row: number of rows and the most frequent value of each column.

    ``keys`` maps a column to its output name. The winner is the least of
    (-count, value), which combines per task; no list of values is gathered.
    """
    return modes_of(multi_dim_counts(rows, list(keys), with_all=True), keys, total_as=total_as)


KPI_NAMES = {
    "comuna": "comuna_mas_afectada",
    "turno_dia": "turno_mas_peligroso",
    "bien_hurtado": "bien_mas_hurtado",
}


def kpis(rows: DataFrame) -> DataFrame:
    """Total, and the leading area, shift and stolen good."""
    named = {k: v for k, v in KPI_NAMES.items() if k in rows.columns}
    return modes(rows, named, total_as="total_hurtos")


def summary(
    rows: DataFrame, time: str = "fecha_dt", distinct: tuple[str, ...] = ("comuna", "barrio")
) -> DataFrame:
    """One row: number of rows, first and last time, distinct values per column."""
    return rows.agg(
        F.count("*").alias("total"),
        F.min(time).alias("desde"),
        F.max(time).alias("hasta"),
        *[F.count_distinct(c).alias(f"{c}_distintos") for c in distinct],
    )
