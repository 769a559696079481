"""Column functions: time grids, half precision, solar position, map projection."""

from __future__ import annotations

from collections.abc import Callable
from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_minutes(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / 60_000_000)


def from_minutes(minutes: Column) -> Column:
    return F.timestamp_micros((minutes * 60_000_000).cast("long"))


def floor_minutes(ts: Column, step: int) -> Column:
    """A time floored to a grid of ``step`` minutes."""
    return from_minutes(F.floor(epoch_minutes(ts) / step) * step)


def ceil_minutes(ts: Column, step: int) -> Column:
    return from_minutes(F.ceil(F.unix_micros(ts.cast("timestamp")) / 60_000_000 / step) * step)


def plus_minutes(ts: Column, minutes: Column | int) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + (minutes if isinstance(minutes, Column) else F.lit(minutes)).cast("long") * 60_000_000)


def time_range(start: Column, stop: Column, step: int) -> Column:
    """Times from start to stop, both included; empty if stop is before start (a plain sequence would fail)."""
    times = F.sequence(epoch_minutes(start), epoch_minutes(stop), F.lit(step).cast("long"))
    return F.when(stop >= start, F.transform(times, from_minutes)).otherwise(F.array().cast("array<timestamp>"))


def to_float16(v: Column) -> Column:
    """Round to half precision, ties to even; beyond the range the result is infinite, NaN stays."""
    exponent = F.greatest(F.floor(F.log2(F.abs(v))), F.lit(-14)) - 10
    ulp = F.pow(F.lit(2.0), exponent.cast("double"))
    return F.when(v.isNull() | F.isnan(v) | (v == 0), v).when(F.abs(v) >= 65520, F.signum(v) * float("inf")).otherwise(F.rint(v / ulp) * ulp)


#: Periodic terms of the Earth's heliocentric longitude (VSOP87, cut off below 1e-6 radian; fixed values): for each power of time
#: the amplitude in 1e-8 radian, the phase in radians and the frequency in radians a Julian millennium.
LONGITUDE_TERMS = [
    [
        (175347046, 0.0, 0.0), (3341656, 4.6692568, 6283.07585), (34894, 4.6261, 12566.1517), (3497, 2.7441, 5753.3849), (3418, 2.8289, 3.5231),
        (3136, 3.6277, 77713.7715), (2676, 4.4181, 7860.4194), (2343, 6.1352, 3930.2097), (1324, 0.7425, 11506.7698), (1273, 2.0371, 529.691),
        (1199, 1.1096, 1577.3435), (990, 5.233, 5884.927), (902, 2.045, 26.298), (857, 3.508, 398.149), (780, 1.179, 5223.694),
        (753, 2.533, 5507.553), (505, 4.583, 18849.228), (492, 4.205, 775.523), (357, 2.92, 0.067), (317, 5.849, 11790.629),
        (284, 1.899, 796.298), (271, 0.315, 10977.079), (243, 0.345, 5486.778), (206, 4.806, 2544.314), (205, 1.869, 5573.143),
        (202, 2.458, 6069.777), (156, 0.833, 213.299), (132, 3.411, 2942.463), (126, 1.083, 20.775), (115, 0.645, 0.98),
        (103, 0.636, 4694.003), (102, 0.976, 15720.839), (102, 4.267, 7.114),
    ],
    [(628331966747, 0.0, 0.0), (206059, 2.678235, 6283.07585), (4303, 2.6351, 12566.1517), (425, 1.59, 3.523), (119, 5.796, 26.298), (109, 2.966, 1577.344)],
    [(52919, 0.0, 0.0), (8720, 1.0721, 6283.0758), (309, 0.867, 12566.152)],
]
#: Terrestrial less universal time in seconds, as the published algorithm's users commonly take it.
DELTA_T = 67.0


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sun_place(ts: Column) -> Column:
    """A struct of the sun's apparent right ascension and declination, the apparent sidereal time at Greenwich (``ascension,
    declination, sidereal`` in radians), and its ``distance`` (au).

    The published solar position algorithm with its series cut off; nutation by its four largest terms. Good to about 0.0005 degree
    in this century and the last. ``ts`` is in UTC.
    """

    def place(c: Column) -> Column:
        century, days = c, c * 36_525 - DELTA_T / 86_400
        powers = [sum((a * F.cos(b + f / 10 * century) if f else F.lit(float(a))) for a, b, f in terms) for terms in LONGITUDE_TERMS]
        longitude = (powers[0] + powers[1] * (century / 10) + powers[2] * (century * century / 100)) / 1e8 + pi
        distance = 1.00013989 + 0.01670700 * F.cos(3.0984635 + 628.307585 * century) + 0.00013956 * F.cos(3.05525 + 1256.61517 * century)
        node, sun, moon = (F.radians(a + b * century) for a, b in ((125.04452, -1934.136261), (280.4665, 36000.7698), (218.3165, 481267.8813)))
        in_longitude = F.radians((-17.20 * F.sin(node) - 1.32 * F.sin(2 * sun) - 0.23 * F.sin(2 * moon) + 0.21 * F.sin(2 * node)) / 3600)
        in_tilt = F.radians((9.20 * F.cos(node) + 0.57 * F.cos(2 * sun) + 0.10 * F.cos(2 * moon) - 0.09 * F.cos(2 * node)) / 3600)
        turned = days / 36_525
        turn = F.radians(280.46061837 + 360.98564736629 * days + 0.000387933 * turned * turned)
        tilt = F.radians(23.4392911111 - 0.0130041667 * century) + in_tilt
        return F.struct(longitude.alias("longitude"), in_longitude.alias("psi"), tilt.alias("tilt"), turn.alias("turn"), distance.alias("distance"))

    def apparent(p: Column) -> Column:
        own = p["longitude"] + p["psi"] - F.radians(20.4898 / 3600 / p["distance"]) - F.radians(F.lit(0.09033 / 3600))
        return F.struct(own.alias("own"), p["tilt"].alias("tilt"), (p["turn"] + p["psi"] * F.cos(p["tilt"])).alias("sidereal"), p["distance"].alias("distance"))

    def seen(p: Column) -> Column:
        ascension, declination = F.atan2(F.cos(p["tilt"]) * F.sin(p["own"]), F.cos(p["own"])), F.asin(F.sin(p["tilt"]) * F.sin(p["own"]))
        return F.struct(ascension.alias("ascension"), declination.alias("declination"), p["sidereal"].alias("sidereal"), p["distance"].alias("distance"))

    century = (F.unix_micros(ts) / 86_400_000_000 - 10_957.5 + DELTA_T / 86_400) / 36_525  # since J2000
    return _let(_let(_let(century, place), apparent), seen)


def solar_elevation(ts: Column, latitude: float | Column, longitude: float | Column) -> Column:
    """Elevation of the sun's middle in degrees, without refraction, for an observer at sea level; see ``sun_place``."""
    lat = F.radians(latitude if isinstance(latitude, Column) else F.lit(float(latitude)))
    lon = F.radians(longitude if isinstance(longitude, Column) else F.lit(float(longitude)))
    above = lambda p: F.asin(F.sin(lat) * F.sin(p["declination"]) + F.cos(lat) * F.cos(p["declination"]) * F.cos(p["sidereal"] + lon - p["ascension"]))
    # Seen from the surface, the sun is lower by its parallax.
    lower = lambda p: _let(above(p), lambda height: F.degrees(height) - 8.794 / 3600 / p["distance"] * F.cos(height))
    return _let(sun_place(ts), lower)


#: WGS84 and the projection's centre (fixed values).
AXIS, FLATTENING, LAT_0, LON_0 = 6_378_137.0, 1 / 298.257223563, 54.9, -2.5


def lonlat_of_laea(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude, in degrees, of Lambert azimuthal equal-area metres (inverse series on
    the ellipsoid; the centre and false origin as above)."""
    from math import asin, cos, log, radians, sin, sqrt

    e2 = FLATTENING * (2 - FLATTENING)
    e = sqrt(e2)

    def q(phi: float) -> float:
        s = sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - log((1 - e * s) / (1 + e * s)) / (2 * e))

    q_pole, phi_0 = q(pi / 2), radians(LAT_0)
    beta_0, r_q = asin(q(phi_0) / q_pole), AXIS * sqrt(q_pole / 2)
    d = AXIS * cos(phi_0) / sqrt(1 - e2 * sin(phi_0) ** 2) / (r_q * cos(beta_0))
    rho = F.sqrt(F.pow(x / d, 2) + F.pow(y * d, 2))
    c = 2 * F.asin(rho / (2 * r_q))
    ratio = F.when(rho == 0, 0.0).otherwise(y * d * F.sin(c) / rho)
    beta = F.asin(F.cos(c) * sin(beta_0) + ratio * cos(beta_0))
    lon = LON_0 + F.degrees(F.atan2(x * F.sin(c), d * rho * cos(beta_0) * F.cos(c) - d * d * y * sin(beta_0) * F.sin(c)))
    lon = F.when(rho == 0, F.lit(LON_0)).otherwise(lon)
    lat = beta
    for k, a in ((2, e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040), (4, 23 * e2**2 / 360 + 251 * e2**3 / 3780), (6, 761 * e2**3 / 45360)):
        lat = lat + a * F.sin(k * beta)
    return lon, F.degrees(lat)


def laea_of_lonlat(lon: Column, lat: Column) -> tuple[Column, Column]:
    """x and y in metres of longitude and latitude in degrees: the other way round from ``lonlat_of_laea``, in closed form."""
    from math import asin, cos, log, radians, sin, sqrt

    e2 = FLATTENING * (2 - FLATTENING)
    e = sqrt(e2)
    of = lambda s, ln: (1 - e2) * (s / (1 - e2 * s * s) - ln((1 - e * s) / (1 + e * s)) / (2 * e))
    phi_0, q_pole = radians(LAT_0), of(1.0, log)
    beta_0, r_q = asin(of(sin(phi_0), log) / q_pole), AXIS * sqrt(q_pole / 2)
    d = AXIS * cos(phi_0) / sqrt(1 - e2 * sin(phi_0) ** 2) / (r_q * cos(beta_0))
    beta, east = F.asin(of(F.sin(F.radians(lat)), F.log) / q_pole), F.radians(lon - LON_0)
    b = r_q * F.sqrt(2 / (1 + sin(beta_0) * F.sin(beta) + cos(beta_0) * F.cos(beta) * F.cos(east)))
    return b * d * F.cos(beta) * F.sin(east), b / d * (cos(beta_0) * F.sin(beta) - sin(beta_0) * F.cos(beta) * F.cos(east))


def place_on_axis(v: Column, axis: Column) -> Column:
    """Where a value lies on a sorted axis, rising or falling, in steps from its first entry; null outside.

    A binary search, then a share of the step that it falls into; steps may differ.
    """
    n = F.size(axis)
    up = F.get(axis, n - 1) >= F.get(axis, F.lit(0))
    below = lambda at: F.when(up, F.get(axis, at) <= v).otherwise(F.get(axis, at) >= v)
    half = lambda s: F.floor((s["low"] + s["high"]) / 2).cast("int")
    narrowed = lambda s, _: F.when(s["high"] - s["low"] <= 1, s).when(below(half(s)), F.struct(half(s).alias("low"), s["high"].alias("high"))).otherwise(F.struct(s["low"].alias("low"), half(s).alias("high")))
    whole = F.struct(F.lit(0).alias("low"), (n - 1).alias("high"))
    low = F.aggregate(F.sequence(F.lit(1), F.ceil(F.log2(F.greatest(n, F.lit(2)))).cast("int") + 1), whole, narrowed, lambda s: s["low"])
    share = lambda low: low + F.coalesce((v - F.get(axis, low)) / F.nullif(F.get(axis, low + 1) - F.get(axis, low), F.lit(0.0)), F.lit(0.0))
    inside = v.between(F.least(F.get(axis, F.lit(0)), F.get(axis, n - 1)), F.greatest(F.get(axis, F.lit(0)), F.get(axis, n - 1)))
    return F.when(inside, _let(low, share))


def is_number(v: Column) -> Column:
    """Neither null nor NaN; Spark orders NaN above all numbers, so comparisons need this guard."""
    return v.isNotNull() & ~F.isnan(v)
