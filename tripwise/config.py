"""Job configuration: every constant the feature and model code depends on."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that must equal the original job's for equal results:
# reference point of the distance feature (decimal degrees), earth radius (km).
ANCHOR_LON = 113.9177317
ANCHOR_LAT = 22.54334333
EARTH_RADIUS_KM = 6371.0


@dataclass(frozen=True)
class FeatureConfig:
    """Parameters of the telemetry feature plan.

    tz                 zone used for hour-of-day and weekday (the original used the
                       process zone; tables here are UTC).
    trip_split_seconds rows of one trip are spread over (driver, trip, time // this)
                       sub-groups for the ordered speed difference, so a single huge
                       trip never lands in one task.  None keeps whole trips together.
    drop_unknown_direction  exclude negative DIRECTION (the "unknown" sentinel) from
                       the direction variance; the original kept it.
    """

    tz: str = "UTC"
    anchor_lon: float = ANCHOR_LON
    anchor_lat: float = ANCHOR_LAT
    earth_radius_km: float = EARTH_RADIUS_KM
    trip_split_seconds: int | None = 3600
    drop_unknown_direction: bool = False
