"""Equi lookups that stay even when one key holds a large share of the rows.

Three ways, from cheap to general:

* dimension proven small: broadcast it, the rows are not shuffled;
* only counts wanted: count per key first, then join one row per key;
* anything else: shuffle join, with the hot keys spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentia.session import written

# Largest dimension that is broadcast, as measured on its values.
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows of one key that go to one task; a key with more is spread.
SLICE_ROWS = 500_000
STREAM_SPREAD = 16


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values, plus a fixed 16 per cell."""
    width: Column = F.lit(16 * len(df.columns))
    for name in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def lookup(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    *,
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join on ``key``; ``dimension`` has one row per key."""
    if measured_bytes(dimension) <= limit_bytes:
        return rows.join(F.broadcast(dimension), key, "left")
    if rows.isStreaming:
        return spread_stream_join(rows, dimension, key)
    return spread_join(rows, dimension, key)


def hot_keys(rows: DataFrame, key: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(key, slices) of the keys with more than ``slice_rows`` rows: at most
    (all rows / ``slice_rows``) of them."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    slices = F.ceil(F.col("_rows") / slice_rows).cast("int").alias("_slices")
    return written(counts.where(F.col("_rows") > slice_rows).select(key, slices), "hot-keys")


def _every_slice(spread: int) -> Column:
    return F.sequence(F.lit(0), F.lit(spread - 1))


def _join_slices(sliced: DataFrame, copied: DataFrame, key: str) -> DataFrame:
    columns = sliced.columns + [c for c in copied.columns if c not in sliced.columns]
    joined = sliced.join(copied, [key, "_slice"], "left")
    return joined.select([c for c in columns if c != "_slice"])


def _content(rows: DataFrame) -> Column:
    """Hash of a whole row: a task that is run again sends each row to the same place."""
    return F.xxhash64(*[F.to_json(c) if "<" in t else F.col(c) for c, t in rows.dtypes])


def spread_join(
    rows: DataFrame, dimension: DataFrame, key: str, *, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Left shuffle join in which a hot key goes to as many tasks as its rows fill.

    Rows without a key match nothing and are not joined at all. Only the
    dimension rows of hot keys are copied, together at most once for every
    ``slice_rows`` rows. The broadcast list holds the hot keys alone.
    """
    hot = hot_keys(rows, key, slice_rows)
    named = rows.where(F.col(key).isNotNull())
    sliced = (
        named.withColumn("_by", _content(rows))
        .join(F.broadcast(hot), key, "left")
        .withColumn("_slice", F.coalesce(F.pmod("_by", "_slices").cast("int"), F.lit(0)))
        .drop("_by", "_slices")
    )
    last = F.coalesce(F.col("_slices"), F.lit(1)) - 1
    copied = (
        dimension.join(F.broadcast(hot), key, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), last)))
        .drop("_slices")
    )
    joined = _join_slices(sliced, copied, key)
    unnamed = rows.where(F.col(key).isNull())
    return joined.unionByName(unnamed, allowMissingColumns=True)


def spread_stream_join(
    rows: DataFrame, dimension: DataFrame, key: str, *, spread: int = STREAM_SPREAD
) -> DataFrame:
    """The same for a stream, whose hot keys cannot be counted beforehand:
    every key is spread, over fewer tasks."""
    sliced = rows.withColumn("_slice", F.pmod(_content(rows), F.lit(spread)).cast("int"))
    copied = dimension.withColumn("_slice", F.explode(_every_slice(spread)))
    return _join_slices(sliced, copied, key)


def keep_selected(rows: DataFrame, chosen: DataFrame, key: str, **limits: int) -> DataFrame:
    """Rows whose ``key`` occurs in ``chosen``."""
    listed = written(chosen.select(key).distinct(), "chosen").withColumn("_in", F.lit(True))
    return lookup(rows, listed, key, **limits).where(F.col("_in")).select(rows.columns)


def counts_by_lookup(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    group: list[str],
    *,
    default: dict[str, str] | None = None,
    total: str = "total",
) -> DataFrame:
    """Rows per ``group``, where ``group`` may name columns of the dimension.

    Rows are counted per key before the join, so the join sees each key once
    and a hot key costs no more than any other. ``default`` names the group
    of keys that the dimension lacks.
    """
    own = [c for c in group if c in rows.columns and c != key]
    per_key = rows.groupBy(key, *own).agg(F.count("*").alias("_rows"))
    named = per_key.join(dimension, key, "left").fillna(default or {})
    return named.groupBy(*group).agg(F.sum("_rows").alias(total))
