"""GEO-1..7 coordinate scalars and MSK-1/2 masks as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.physics import clip

# Coordinate bounds used when wrapping (GEO-1) and the location batch size / format (GEO-3).
LON_LIMIT = 180.0
LAT_LIMIT = 89.9999
LOCATION_BATCH = 80
LOCATION_FORMAT = "%.4f,%.4f"  # lat, lon


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wrap_lon(lon: str | Column) -> Column:
    """GEO-1: 0..360 → -180..180, then bounded to ±180."""
    x = _c(lon)
    return clip(F.when(x > 180.0, x - 360.0).otherwise(x), -LON_LIMIT, LON_LIMIT)


def bound_lat(lat: str | Column) -> Column:
    """GEO-1: latitude bounded to ±89.9999."""
    return clip(lat, -LAT_LIMIT, LAT_LIMIT)


def location_text(lon: str | Column, lat: str | Column) -> Column:
    """GEO-3: ``lat,lon`` with 4 decimals."""
    return F.format_string(LOCATION_FORMAT, _c(lat), _c(lon))


def axis_order(df: DataFrame, a: str, b: str) -> DataFrame:
    """GEO-2: return ``df`` with columns ``lon``, ``lat`` taken from (a, b) or (b, a).

    If max|a| > 90 then a is longitude; else if max|b| > 90 the pair is flipped;
    otherwise (a, b) is assumed to be (lon, lat).  The two maxima are scalar
    subqueries (one partial aggregate each), so no data moves to the driver.
    """
    stats = df.agg(F.max(F.abs(a)).alias("ma"), F.max(F.abs(b)).alias("mb"))
    flip = (stats.select((F.col("ma") <= 90.0) & (F.col("mb") > 90.0)).scalar())
    return df.withColumns({"lon": F.when(flip, F.col(b)).otherwise(F.col(a)),
                           "lat": F.when(flip, F.col(a)).otherwise(F.col(b))})


def min_max_scaled(df: DataFrame, columns: list[str], suffix: str = "_norm") -> DataFrame:
    """GEO-5 / AGG-8: ``(x - min) / (max - min)`` per column; a constant column maps to 0.

    Minimum and maximum are scalar subqueries over a partial aggregate.
    """
    stats = df.agg(*[F.min(c).alias(f"mn_{c}") for c in columns], *[F.max(c).alias(f"mx_{c}") for c in columns])
    out = {}
    for c in columns:
        mn = stats.select(f"mn_{c}").scalar()
        mx = stats.select(f"mx_{c}").scalar()
        rng = mx - mn
        out[c + suffix] = F.when(rng == 0, F.lit(0.0)).otherwise((F.col(c) - mn) / rng)
    return df.withColumns(out)


def sphere_xyz(lon: str | Column, lat: str | Column) -> Column:
    """GEO-6 (our definition): unit-sphere ``[cos φ cos λ, cos φ sin λ, sin φ]``."""
    lam, phi = F.radians(_c(lon)), F.radians(_c(lat))
    return F.array(F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi))


def grid_points(north: float, west: float, south: float, east: float, lat_step: float, lon_step: float) -> tuple[int, int]:
    """GEO-4: number of latitude and longitude points of an area at a step.

    Latitude counts both ends; longitude wraps when east < west, and a 360° span
    is global (no closing point).
    """
    n_lat = int(round((north - south) / lat_step)) + 1
    span = (east + 360.0 - west) if east < west else (east - west)
    n_lon = int(round(span / lon_step)) if abs(span - 360.0) < 1e-6 else int(round(span / lon_step)) + 1
    return n_lat, n_lon


def grid_shape(north: Column, west: Column, south: Column, east: Column,
               lat_step: float, lon_step: float) -> tuple[Column, Column]:
    """GEO-4 as Column expressions (half-even rounding, as the integer rounding of the rule)."""
    n_lat = (F.bround((north - south) / lat_step, 0) + 1).cast("int")
    span = F.when(east < west, east + 360.0 - west).otherwise(east - west)
    lon_pts = F.bround(span / lon_step, 0)
    n_lon = F.when(F.abs(span - 360.0) < 1e-6, lon_pts).otherwise(lon_pts + 1).cast("int")
    return n_lat, n_lon


def global_grid_points(lat_step: float, lon_step: float) -> tuple[int, int]:
    """GEO-4 without an area: both poles, and longitudes without the closing 360° point."""
    return int(round(180.0 / lat_step)) + 1, int(round(360.0 / lon_step))


def sensor_mask(sample_id: str | Column, node: str | Column, rate: float, seed: int = 0) -> Column:
    """MSK-1 (our definition): repeatable per-(sample, node) failure mask without RNG state.

    The first 32 bits of md5("seed|sample|node") are compared with the rate, so nodes, samples
    and seeds are independent of each other.
    """
    key = F.concat_ws("|", F.lit(str(seed)), _c(sample_id).cast("bigint").cast("string"), _c(node).cast("bigint").cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") < F.lit(int(rate * 2 ** 32))


def apply_mask(value: str | Column, mask: str | Column) -> Column:
    """MSK-2: masked values become 0.0 (targets keep the true value)."""
    return F.when(_c(mask), F.lit(0.0)).otherwise(_c(value))
