"""PHY-1..7 physical quantities and unit rules as Column expressions.

Everything here is a plain Catalyst expression, so it stays inside whole-stage
codegen next to the scan and the projections around it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Physical constants and the two Magnus parameter sets (quirk Q10).
KELVIN_OFFSET = 273.15
R_DRY = 287.05        # J/(kg K), dry air
R_VAPOUR = 461.495    # J/(kg K), water vapour
MAGNUS_DENSITY = (6.112, 17.62, 243.12)   # hPa, -, degC: used by the air-density formula
MAGNUS_HUMIDITY = (6.112, 17.67, 243.5)   # hPa, -, degC: used by the relative-humidity formula
GRAVITY_KM = 9806.65  # geopotential (m2/s2) per km of height


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: str | Column, lower: float | None = None, upper: float | None = None) -> Column:
    """PHY-6: bound a value; NULL stays NULL (``greatest``/``least`` would not keep it)."""
    x = _c(c)
    out = x
    if lower is not None:
        out = F.when(x < lower, F.lit(float(lower))).otherwise(out)
    if upper is not None:
        out = F.when(x > upper, F.lit(float(upper))).otherwise(out)
    return out


def saturation_pressure(t_c: str | Column, magnus: tuple[float, float, float]) -> Column:
    a, b, c = magnus
    t = _c(t_c)
    return F.lit(a) * F.exp((F.lit(b) * t) / (t + F.lit(c)))


def air_density(t_c: str | Column, slp_hpa: str | Column, rh_pct: str | Column) -> Column:
    """PHY-1: moist air density (kg/m3) from temperature (degC), pressure (hPa), RH (%)."""
    t = _c(t_c)
    p_pa = _c(slp_hpa) * 100.0
    e_pa = (_c(rh_pct) / 100.0) * saturation_pressure(t, MAGNUS_DENSITY) * 100.0
    return (p_pa / (F.lit(R_DRY) * (t + KELVIN_OFFSET))) * (1.0 - (e_pa / p_pa) * (1.0 - R_DRY / R_VAPOUR))


def relative_humidity(t2m_k: str | Column, d2m_k: str | Column) -> Column:
    """PHY-2: RH (%) from temperature and dew point in Kelvin, ratio clipped to [0, 1]."""
    es = saturation_pressure(_c(t2m_k) - KELVIN_OFFSET, MAGNUS_HUMIDITY)
    e = saturation_pressure(_c(d2m_k) - KELVIN_OFFSET, MAGNUS_HUMIDITY)
    return clip(e / es, 0.0, 1.0) * 100.0


def wind_x(speed: str | Column, direction_deg: str | Column) -> Column:
    return F.sin(F.radians(_c(direction_deg))) * _c(speed)


def wind_y(speed: str | Column, direction_deg: str | Column) -> Column:
    return F.cos(F.radians(_c(direction_deg))) * _c(speed)


def magnitude(x: str | Column, y: str | Column) -> Column:
    """PHY-4: sqrt(x^2 + y^2) (wind speed, gust)."""
    return F.sqrt(_c(x) * _c(x) + _c(y) * _c(y))


def wind_components(df: DataFrame, pairs: list[tuple[str, str]], suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """PHY-3: for each (speed, direction) pair add ``<speed>_x`` / ``<speed>_y`` and drop the pair."""
    sx, sy = suffixes
    for speed, direction in pairs:
        df = df.withColumns({f"{speed}{sx}": wind_x(speed, direction),
                             f"{speed}{sy}": wind_y(speed, direction)}).drop(speed, direction)
    return df


# Reanalysis unit rules, column -> (factor, divisor, offset, lower, upper);
# value = x * factor / divisor + offset, then bounded.
REANALYSIS_UNITS = {
    "t2m": (1.0, 1.0, -KELVIN_OFFSET, None, None),
    "d2m": (1.0, 1.0, -KELVIN_OFFSET, None, None),
    "skt": (1.0, 1.0, -KELVIN_OFFSET, None, None),
    "sp": (1.0, 1000.0, 0.0, None, None),
    "msl": (1.0, 1000.0, 0.0, None, None),
    "z": (1.0, GRAVITY_KM, 0.0, None, None),
    "blh": (1.0, 1.0, 0.0, None, None),
    "lcc": (1.0, 1.0, 0.0, 0.0, 1.0),
    "tcc": (1.0, 1.0, 0.0, 0.0, 1.0),
    "tp": (1000.0, 1.0, 0.0, 0.0, None),
    "ssrd": (1.0, 3600.0, 0.0, 0.0, None),
}
# Station unit rules (SLP hPa -> kPa).
STATION_UNITS = {"slp": (1.0, 10.0, 0.0, None, None)}
# Long-tail columns that get log1p.
REANALYSIS_LOG = ("ssrd", "tp", "cape", "i10fg")
STATION_LOG = ("v", "rain01h", "rain02h", "rain03h", "rain06h", "rain24h")


def unit_rule(x: Column, factor: float, divisor: float, offset: float,
              lower: float | None, upper: float | None) -> Column:
    if factor != 1.0:
        x = x * F.lit(factor)
    if divisor != 1.0:
        x = x / F.lit(divisor)
    if offset != 0.0:
        x = x + F.lit(offset)
    return clip(x, lower, upper)


def convert_units(df: DataFrame, rules: dict = REANALYSIS_UNITS) -> DataFrame:
    """PHY-5 (+ PHY-6 bounds): apply the rule of every present column."""
    changes = {name: unit_rule(F.col(name), *rule) for name, rule in rules.items() if name in df.columns}
    return df.withColumns(changes) if changes else df


def log1p_columns(df: DataFrame, columns: tuple[str, ...] | list[str], clip_at_zero: bool | dict = False) -> DataFrame:
    """PHY-7: ``log1p`` on the present long-tail columns; optional clip at 0 first (station rule).

    ``clip_at_zero`` may be a per-column dict (quirk Q12).  Spark yields NULL for x <= -1.
    """
    changes = {}
    for name in columns:
        if name in df.columns:
            do_clip = clip_at_zero.get(name, False) if isinstance(clip_at_zero, dict) else clip_at_zero
            x = clip(name, 0.0) if do_clip else F.col(name)
            changes[name] = F.log1p(x)
    return df.withColumns(changes) if changes else df
