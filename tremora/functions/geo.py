"""Distances on the sphere, and the grid that turns a radius test into an equality."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremora.fixed import EARTH_RADIUS_KM

# Widens every cell a little, so that rounding can never lose a pair at the exact radius.
_SLACK = 1 + 1e-9
# A half, short by less than results can show, so that opposite points never give asin over 1.
_HALF = 0.5 * (1 - 1e-15)
KM_PER_HALF_ANGLE = 2 * EARTH_RADIUS_KM
_CELLS_PER_BAND = 100_000_000


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    a = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def unit(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The point on a sphere of diameter one, on which a chord is the sine of half its angle."""
    phi, theta = F.radians(lat), F.radians(lon)
    flat = F.cos(phi) * _HALF
    return flat * F.cos(theta), flat * F.sin(theta), F.sin(phi) * _HALF


def with_unit(df: DataFrame, lat: str, lon: str, prefix: str) -> DataFrame:
    """Add ``{prefix}_x``, ``_y``, ``_z``: all trigonometry once per row and none per pair."""
    return df.withColumns({f"{prefix}_{axis}": value for axis, value in
                           zip("xyz", unit(F.col(lat), F.col(lon)))})


def chord(one: str, other: str) -> Column:
    """Squared straight-line distance between two prefixes of ``with_unit``.

    Equal to the ``a`` of the haversine formula, and as exact for small distances.
    """
    x, y, z = (F.col(f"{one}_{axis}") - F.col(f"{other}_{axis}") for axis in "xyz")
    return x * x + y * y + z * z


def half_angle(squared: Column) -> Column:
    """Half the central angle of a squared chord; ``KM_PER_HALF_ANGLE`` turns it into km."""
    return F.asin(F.sqrt(squared))


def chord_km(squared: Column) -> Column:
    return half_angle(squared) * KM_PER_HALF_ANGLE


def product(one: str, other: str) -> Column:
    """Scalar product of two prefixes of ``with_unit``. The shortest radius test there is
    (``product >= product_limit(km)``), but too coarse for distances below a metre."""
    x, y, z = (F.col(f"{one}_{axis}") * F.col(f"{other}_{axis}") for axis in "xyz")
    return x + y + z


def product_limit(km: float) -> float:
    return math.cos(km / EARTH_RADIUS_KM) / 4


# The grid is written as SQL text: as Column objects, one cell takes a hundred calls to build.

def _band_height(km: float) -> float:
    return math.degrees(km / EARTH_RADIUS_KM) * _SLACK


def _band(lat: str, km: float) -> str:
    return f"floor(({lat}) / {_band_height(km)!r}D)"


def _steepest(band: str, km: float) -> str:
    height = f"{_band_height(km)!r}D"
    return f"greatest(abs(({band}) * {height}), abs((({band}) + 1) * {height}))"


def _reach(steepest_lat: str, km: float) -> str:
    """Degrees of longitude that ``km`` can span up to the given latitude."""
    half = math.sin(min(km / (2 * EARTH_RADIUS_KM), math.pi / 2))
    cosine = f"greatest(cos(radians(least({steepest_lat}, 90.0D))), 1e-12D)"
    return f"(degrees(2 * asin(least({half!r}D / {cosine}, 1.0D))) * {_SLACK!r}D)"


def _cells_in(band: str, km: float) -> str:
    """How many cells go round the globe in a band, each at least the radius wide."""
    return f"greatest(floor(360.0D / {_reach(_steepest(band, km), km)}), 1)"


def _code(band: str, cell: str) -> str:
    return f"(({band}) * {_CELLS_PER_BAND}L + ({cell}))"


def cell_sql(lat: str, lon: str, km: float) -> str:
    band = _band(lat, km)
    count = _cells_in(band, km)
    return _code(band, f"pmod(floor((({lon}) + 180.0D) * {count} / 360.0D), {count})")


def around_sql(lat: str, lon: str, km: float) -> str:
    height = f"{_band_height(km)!r}D"
    bands = f"sequence({_band(f'{lat} - {height}', km)}, {_band(f'{lat} + {height}', km)})"
    reach = _reach(f"greatest({_steepest('band', km)}, abs({lat}))", km)
    count = _cells_in("band", km)
    first = f"floor(({lon} + 180.0D - {reach}) * {count} / 360.0D)"
    last = f"floor(({lon} + 180.0D + {reach}) * {count} / 360.0D)"
    cells = f"sequence({first}, least({last}, {first} + {count} - 1))"
    return (f"flatten(transform({bands}, band -> transform({cells}, cell -> "
            f"{_code('band', f'pmod(cell, {count})')})))")


def cell_of(lat: str, lon: str, km: float) -> Column:
    """The one grid cell of a point (a long), of the columns of these names."""
    return F.expr(cell_sql(lat, lon, km))


def cells_around(lat: str, lon: str, km: float) -> Column:
    """All cells that can hold a point within ``km``, each once (array<long>).

    The cell width depends on the band alone, so no pass over the data is needed to choose it;
    bands close on themselves at +-180 degrees and grow to the whole circle at the poles.
    """
    return F.expr(around_sql(lat, lon, km))
