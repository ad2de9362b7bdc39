"""Coordinates: scaling, bounding box, grid cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from incidentia.functions.values import to_number

COORDINATE_SCALE = 1e8


@dataclass(frozen=True)
class Box:
    """Inclusive latitude and longitude limits."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float

    def holds(self, lat: Column, lon: Column) -> Column:
        """True or false, never null: a missing coordinate is outside."""
        inside = lat.between(self.lat_min, self.lat_max) & lon.between(
            self.lon_min, self.lon_max
        )
        return F.coalesce(inside, F.lit(False))


# The city's limits.
CITY_BOX = Box(6.10, 6.45, -75.75, -75.45)


def scaled(text: Column) -> Column:
    """Coordinate from its integer coding; null where it is no number."""
    return to_number(text) / F.lit(COORDINATE_SCALE)


def repaired_pair(lat: Column, lon: Column, box: Box) -> tuple[Column, Column]:
    """Both coordinates, or neither if the pair is not inside the box."""
    inside = box.holds(lat, lon)
    return F.when(inside, lat), F.when(inside, lon)


def grid_cell(coordinate: Column, size: float) -> Column:
    return F.floor(coordinate / F.lit(float(size))).cast("bigint")


def place_curve(lat: Column, lon: Column, box: Box, bits: int = 16) -> Column:
    """Place on a curve that keeps near points of the box together: the bits of
    both coordinates in turn. Points beyond the box count as its edge; without
    both coordinates it is -1."""

    def cell(value: Column, low: float, high: float) -> Column:
        share = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(1 << bits)))
        spread = F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), share)).cast("bigint")
        # Each step moves half of the bits apart: 8, 4, 2, then 1.
        for step, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            spread = spread.bitwiseOR(F.shiftleft(spread, step)).bitwiseAND(F.lit(mask).cast("bigint"))
        return spread

    place = cell(lat, box.lat_min, box.lat_max).bitwiseOR(
        F.shiftleft(cell(lon, box.lon_min, box.lon_max), 1)
    )
    known = lat.isNotNull() & lon.isNotNull()
    return F.when(known, place).otherwise(F.lit(-1).cast("bigint"))
