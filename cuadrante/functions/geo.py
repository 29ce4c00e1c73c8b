"""Distances and nested grid cells from latitude and longitude in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
KM_PER_DEGREE = 111.19492664455873  # EARTH_KM * pi / 180


def _col(c) -> Column:
    if isinstance(c, Column):
        return c
    return F.col(c) if isinstance(c, str) else F.lit(c)


def great_circle_km(lat1, lon1, lat2, lon2, max_km: float | None = None) -> Column:
    """Distance on the sphere by the law of cosines; null beyond ``max_km``."""
    a1, o1, a2, o2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    cosine = F.sin(a1) * F.sin(a2) + F.cos(a1) * F.cos(a2) * F.cos(o2 - o1)
    km = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))) * F.lit(EARTH_KM)
    return km if max_km is None else F.when(km <= F.lit(float(max_km)), km)


def grid_index(degrees, offset: float, level: int) -> Column:
    """Row (offset 90) or column (offset 180) of the cell at ``level``."""
    return F.floor((_col(degrees) + F.lit(offset)) * F.lit(float(2**level)) / F.lit(180.0)).cast("bigint")


def grid_cell(lat, lon, level: int) -> Column:
    """Cell id ``level:row:column``.  The side is 180/2^level degrees, so a cell's
    parent has both indices halved and the levels nest.  A row without a latitude or a
    longitude has no cell."""
    return F.concat(
        F.lit(f"{level}:"),
        grid_index(lat, 90.0, level).cast("string"),
        F.lit(":"),
        grid_index(lon, 180.0, level).cast("string"),
    )


def grid_parent(cell, levels_up: int = 1) -> Column:
    """Id of the cell that holds ``cell`` a number of levels further up."""
    parts = F.split(_col(cell), ":")
    step = F.lit(2**levels_up).cast("bigint")

    def index(i: int) -> Column:
        return F.floor(parts[i].cast("bigint") / step).cast("string")

    level = (parts[0].cast("int") - F.lit(levels_up)).cast("string")
    return F.concat(level, F.lit(":"), index(1), F.lit(":"), index(2))
