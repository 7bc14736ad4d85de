"""Distances on the sphere, bounding boxes, and a grid for equi-joins on nearness."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Earth radius in km used with each formula, and miles per km.
COSINE_RADIUS_KM = 6371.0
HAVERSINE_RADIUS_KM = 6373.0
MILES_PER_KM = 0.621371

WORLD_KM = math.pi * HAVERSINE_RADIUS_KM

# Up to this square of half the straight line the next term of the arc sine's
# series is less than a fifth of a double's last bit.
_SHORT_ARC = 1e-3


@dataclass(frozen=True)
class Box:
    """Open rectangle: points on an edge are outside."""

    south: float
    north: float
    west: float
    east: float


# The box new stations are looked for in.
CITY = Box(south=40.674611, north=40.817894, west=-74.104557, east=-73.92718)


def _column(value: str | float | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(float(value))


_ANGLES = ("phi", "theta", "cos")


def _angles(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    phi = F.radians(lat)
    return phi, F.radians(lon), F.cos(phi)


def with_angles(df: DataFrame, lat: str, lon: str, prefix: str) -> DataFrame:
    """Add latitude and longitude in radians and the cosine of the first, as
    ``prefix`` phi, theta and cos."""
    angles = _angles(F.col(lat), F.col(lon))
    return df.withColumns({f"{prefix}{n}": a for n, a in zip(_ANGLES, angles, strict=True)})


def great_circle_km(
    lat_a: str | Column,
    lon_a: str | Column,
    lat_b: str | Column,
    lon_b: str | Column,
    method: str = "haversine",
    angles: tuple[str, str] | None = None,
) -> Column:
    """Distance in km; null if a coordinate is null or no number, 0 for equal points.

    ``cosine`` is the law of cosines, ``haversine`` the half-angle formula.
    ``full_angle`` takes the whole angles where haversine takes half of them:
    about twice the distance, and the scale of older published lists.
    ``angles`` names the prefixes under which ``with_angles`` has added what
    depends on one point only, so that a join does not compute it per pair.
    """
    lat_a, lon_a, lat_b, lon_b = map(_column, (lat_a, lon_a, lat_b, lon_b))
    if angles is None:
        (phi_a, theta_a, cos_a), (phi_b, theta_b, cos_b) = _angles(lat_a, lon_a), _angles(lat_b, lon_b)
    else:
        (phi_a, theta_a, cos_a), (phi_b, theta_b, cos_b) = (
            [F.col(f"{prefix}{name}") for name in _ANGLES] for prefix in angles
        )
    if method == "cosine":
        cosine = F.sin(phi_a) * F.sin(phi_b) + cos_a * cos_b * F.cos(theta_a - theta_b)
        cosine = F.nanvl(cosine, F.lit(None).cast("double"))
        # Rounding can push the cosine just past 1, where acos is undefined.
        inside = F.when(cosine > 1.0, 1.0).when(cosine < -1.0, -1.0).otherwise(cosine)
        same = cosine.isNotNull() & (lat_a == lat_b) & (lon_a == lon_b)
        return F.when(same, 0.0).otherwise(F.acos(inside) * COSINE_RADIUS_KM)
    share = {"haversine": 0.5, "full_angle": 1.0}[method]
    sin_lat = F.sin((phi_b - phi_a) * share)
    sin_lon = F.sin((theta_b - theta_a) * share)
    a = sin_lat * sin_lat + cos_a * cos_b * sin_lon * sin_lon
    a = F.nanvl(a, F.lit(None).cast("double"))
    a = F.when(a > 1.0, 1.0).otherwise(a)
    return 2 * HAVERSINE_RADIUS_KM * F.atan2(F.sqrt(a), F.sqrt(1.0 - a))


def with_unit_vector(df: DataFrame, lat: str, lon: str, prefix: str) -> DataFrame:
    """Add the point on the unit sphere as ``prefix`` x, y and z.

    Plain columns, as reading fields of a struct in a lambda costs more than
    the arithmetic.
    """
    phi, theta = F.radians(F.col(lat)), F.radians(F.col(lon))
    return df.withColumns(
        {
            f"{prefix}x": F.cos(phi) * F.cos(theta),
            f"{prefix}y": F.cos(phi) * F.sin(theta),
            f"{prefix}z": F.sin(phi),
        }
    )


def squared_chord(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Squared straight-line distance of two unit vectors."""
    dx, dy, dz = (p - q for p, q in zip(a, b, strict=True))
    return dx * dx + dy * dy + dz * dz


def arc_km(chord: Column) -> Column:
    """Great-circle km of two points from their ``squared_chord``, null if that is no number.

    It equals the haversine ``great_circle_km`` to about a nanometre.  Within some
    400 km the arc sine is a short series, exact to the last bits of a double, so
    that a pair costs a square root and no trigonometry.
    """
    a = F.nanvl(chord, F.lit(None).cast("double")) * 0.25
    series = 1.0 + a * (1 / 6 + a * (3 / 40 + a * (5 / 112 + a * (35 / 1152))))
    far = F.atan2(F.sqrt(a), F.sqrt(F.greatest(1.0 - a, F.lit(0.0))))
    return 2 * HAVERSINE_RADIUS_KM * F.when(a < _SHORT_ARC, F.sqrt(a) * series).otherwise(far)


def most_squared_chord(km: float) -> float:
    """Points at most ``km`` apart have no larger ``squared_chord``, rounding included."""
    half = min(km / HAVERSINE_RADIUS_KM, math.pi) / 2
    return (2 * math.sin(half) * (1 + 1e-9) + 1e-12) ** 2


def chord_mm(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Straight-line distance of two unit vectors in whole millimetres on Earth.

    It grows with the great-circle distance and costs no trigonometry, so it
    orders points by nearness; distances equal but for rounding become equal.
    """
    return F.floor(F.sqrt(squared_chord(a, b)) * (HAVERSINE_RADIUS_KM * 1e6))


def in_bbox(lat: str | Column, lon: str | Column, box: Box = CITY) -> Column:
    """True strictly inside ``box``."""
    lat, lon = _column(lat), _column(lon)
    return (lat > box.south) & (lat < box.north) & (lon > box.west) & (lon < box.east)


# --- grid -------------------------------------------------------------------
# Level b cuts the circle into 2**b cells, so a cell is 360 / 2**b degrees wide
# and high.  Level 0 is one cell for the whole world.


def cell_diagonal_km(bits: int) -> float:
    """No two points of one cell of this level are farther apart."""
    if bits < 3:
        return WORLD_KM
    half = math.radians(360 / 2**bits) / 2
    return 2 * HAVERSINE_RADIUS_KM * math.asin(math.sqrt(2) * math.sin(half)) * (1 + 1e-9)


def level_for_km(km: float) -> int:
    """The finest level whose cells are at least ``km`` high."""
    degrees = math.degrees(km / HAVERSINE_RADIUS_KM)
    return max(0, math.floor(math.log2(360 / degrees)))


def _cells(bits: Column | int) -> Column:
    return F.pow(F.lit(2.0), bits if isinstance(bits, Column) else F.lit(float(bits)))


def with_cell(df: DataFrame, lat: str, lon: str, bits: Column | int) -> DataFrame:
    """Add ``cell_x`` and ``cell_y``, the cell that holds the point."""
    cells = _cells(bits)
    return df.withColumns(
        {
            "cell_x": F.pmod(F.floor((F.col(lon) + 180.0) / 360.0 * cells), cells.cast("bigint")),
            "cell_y": F.floor((F.col(lat) + 90.0) / 360.0 * cells),
        }
    )


def with_neighbour_cells(df: DataFrame, bits: Column | int) -> DataFrame:
    """One row per cell that touches the row's cell, and for the cell itself."""
    cells = _cells(bits).cast("bigint")
    steps = F.array(*(F.lit(d) for d in (-1, 0, 1)))
    # On a narrow ring the eastern neighbour is the western one.
    around = F.array_distinct(F.transform(steps, lambda d: F.pmod(F.col("cell_x") + d, cells)))
    return df.withColumn("cell_x", F.explode(around)).withColumn(
        "cell_y", F.explode(F.transform(steps, lambda d: F.col("cell_y") + d))
    )


def with_cells_within(
    df: DataFrame, lat: str, lon: str, km: Column | float, bits: Column | int
) -> DataFrame:
    """One row per cell that may hold a point within ``km`` of the row's point.

    No cell comes twice for a row: on a narrow ring of cells the range of
    longitudes is cut to one turn.
    """
    cells = _cells(bits)
    reach = _column(km) / HAVERSINE_RADIUS_KM * (1 + 1e-9) + 1e-12
    phi = F.radians(F.col(lat))
    # Beyond a pole every longitude is in reach.
    polar = F.abs(phi) + reach >= math.pi / 2
    spread = F.when(polar, math.pi).otherwise(
        F.asin(F.least(F.lit(1.0), F.sin(F.least(reach, F.lit(math.pi / 2))) / F.cos(phi)))
    )

    def index(degrees: Column) -> Column:
        return F.floor(degrees / 360.0 * cells)

    lat0, lon0 = F.col(lat) + 90.0, F.col(lon) + 180.0
    rows = F.sequence(
        index(F.greatest(lat0 - F.degrees(reach), F.lit(0.0))),
        index(F.least(lat0 + F.degrees(reach), F.lit(180.0))),
    )
    west = index(lon0 - F.degrees(spread))
    east = F.least(index(lon0 + F.degrees(spread)), west + cells.cast("bigint") - 1)
    return (
        df.withColumn("cell_y", F.explode(rows))
        .withColumn("cell_x", F.explode(F.sequence(west, east)))
        .withColumn("cell_x", F.pmod("cell_x", cells.cast("bigint")))
    )
