"""Great-circle distance as a JVM-side column expression (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripwise.config import ANCHOR_LAT, ANCHOR_LON, EARTH_RADIUS_KM


def _col(c: Column | str | float) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(float(c))


def haversine_m(
    lon: Column | str,
    lat: Column | str,
    lon0: Column | str | float = ANCHOR_LON,
    lat0: Column | str | float = ANCHOR_LAT,
    radius_km: float = EARTH_RADIUS_KM,
) -> Column:
    """Haversine distance in metres between (lon, lat) and (lon0, lat0), degrees in.

    Literal reference points are constant-folded by Catalyst, so per row only the
    trigonometry of the moving point is evaluated.
    """
    lam1, phi1 = F.radians(_col(lon)), F.radians(_col(lat))
    lam2, phi2 = F.radians(_col(lon0)), F.radians(_col(lat0))
    a = F.pow(F.sin((phi2 - phi1) / 2.0), 2.0) + F.cos(phi1) * F.cos(phi2) * F.pow(
        F.sin((lam2 - lam1) / 2.0), 2.0
    )
    return F.asin(F.sqrt(a)) * F.lit(2.0 * radius_km * 1000.0)


def haversine_m_sql(lon: str, lat: str, lon0: float = ANCHOR_LON, lat0: float = ANCHOR_LAT,
                    radius_km: float = EARTH_RADIUS_KM) -> str:
    """``haversine_m`` as a Spark SQL expression string over columns ``lon``, ``lat``."""
    return (f"(asin(sqrt(power(sin((radians(CAST({lat0!r} AS DOUBLE)) - radians({lat})) / 2D), 2D) + "
            f"cos(radians({lat})) * cos(radians(CAST({lat0!r} AS DOUBLE))) * "
            f"power(sin((radians(CAST({lon0!r} AS DOUBLE)) - radians({lon})) / 2D), 2D))) "
            f"* CAST({2.0 * radius_km * 1000.0!r} AS DOUBLE))")
