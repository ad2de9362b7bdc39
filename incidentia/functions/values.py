"""Missing values, sentinels, numbers, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from incidentia.schemas import (
    AGE_BANDS,
    HIGH,
    LOW,
    MEDIUM,
    NA_TOKENS,
    RISK_LABELS,
    SENTINEL,
    SENTINEL_REPLACEMENT,
)


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(NA_TOKENS), text)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def without_sentinel(text: Column) -> Column:
    """Replace the exact sentinel; text that merely contains it stays."""
    return F.when(text == SENTINEL, SENTINEL_REPLACEMENT).otherwise(text)


def to_number(text: Column) -> Column:
    """Double, null where the text is no plain number (``1d`` and NaN are none)."""
    number = text.cast("string").try_cast("double")
    return F.when(~F.isnan(number) & ~text.cast("string").rlike("[dDfF]\\s*$"), number)


def to_code(text: Column) -> Column:
    """Integer code from ``10``, ``10.0`` or a numeric column; else null."""
    number = to_number(text)
    whole = F.when(number == F.floor(number), number).try_cast("int")
    return F.coalesce(text.try_cast("int"), whole)


def age_band(age: Column) -> Column:
    """Band label; ages outside every band, and null, have none."""
    band = F.lit(None).cast("string")
    for label, low, high in reversed(AGE_BANDS):
        band = F.when((age > low) & (age <= high), label).otherwise(band)
    return band


def risk_label(total: Column, high_cut: Column, medium_cut: Column) -> Column:
    return F.when(total >= high_cut, HIGH).when(total >= medium_cut, MEDIUM).otherwise(LOW)


def risk_caption(zone: Column) -> Column:
    """Served label of a zone, null for any other text."""
    caption = F.lit(None).cast("string")
    for name, text in RISK_LABELS.items():
        caption = F.when(zone == name, text).otherwise(caption)
    return caption
