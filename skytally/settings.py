"""The polled region and its request budget."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Request cost by box area in square degrees; fixed values.
COST_BANDS = ((25, 1), (100, 2), (400, 3))
COST_ABOVE = 4

# Requests' worth of credits granted per day; fixed values.
ALLOWANCE_ANONYMOUS = 400
ALLOWANCE_REGISTERED = 4000

SECONDS_PER_DAY = 86400
POLL_FLOOR_SECONDS = 10


@dataclass(frozen=True)
class Region:
    """A latitude/longitude box, edges included."""

    lat_min: float = 49.0
    lat_max: float = 61.0
    lon_min: float = -10.0
    lon_max: float = 3.0

    def __post_init__(self) -> None:
        for low, high, limit, axis in (
            (self.lat_min, self.lat_max, 90.0, "latitude"),
            (self.lon_min, self.lon_max, 180.0, "longitude"),
        ):
            if not (-limit <= low <= limit and -limit <= high <= limit):
                raise ValueError(f"{axis} edge outside ±{limit}")
            if low >= high:
                raise ValueError(f"{axis} minimum must be below the maximum")

    @property
    def area_sq_deg(self) -> float:
        return (self.lat_max - self.lat_min) * (self.lon_max - self.lon_min)

    def contains(self, latitude: Column, longitude: Column) -> Column:
        return latitude.between(self.lat_min, self.lat_max) & longitude.between(
            self.lon_min, self.lon_max
        )

    def as_struct(self) -> Column:
        return F.struct(
            F.lit(self.lat_min).alias("lamin"),
            F.lit(self.lat_max).alias("lamax"),
            F.lit(self.lon_min).alias("lomin"),
            F.lit(self.lon_max).alias("lomax"),
        )


def credit_cost(area_sq_deg: Column) -> Column:
    cost = None
    for limit, credits in COST_BANDS:
        hit = area_sq_deg <= limit
        cost = F.when(hit, credits) if cost is None else cost.when(hit, credits)
    return cost.otherwise(COST_ABOVE)


def bbox_area(bbox: Column) -> Column:
    return (bbox["lamax"] - bbox["lamin"]) * (bbox["lomax"] - bbox["lomin"])


def daily_allowance(auth_mode: Column) -> Column:
    return F.when(auth_mode == "oauth2_client_credentials", ALLOWANCE_REGISTERED).otherwise(
        ALLOWANCE_ANONYMOUS
    )


@dataclass(frozen=True)
class Feed:
    """How the snapshots were requested; stamped on every run."""

    region: Region = field(default_factory=Region)
    poll_interval_seconds: int = 120
    registered: bool = False
    source: str = "public_adsb"
    endpoint: str = "/states/all"

    def __post_init__(self) -> None:
        if self.poll_interval_seconds < POLL_FLOOR_SECONDS:
            raise ValueError(f"poll interval below {POLL_FLOOR_SECONDS} s")

    @property
    def auth_mode(self) -> str:
        return "oauth2_client_credentials" if self.registered else "anonymous"

    @property
    def allowance(self) -> int:
        return ALLOWANCE_REGISTERED if self.registered else ALLOWANCE_ANONYMOUS
