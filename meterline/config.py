"""Parameters of the trip models and of a run."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CleaningRules:
    """Upper bounds of a plausible trip; rows beyond them are dropped."""

    max_fare_usd: float = 1000
    max_trip_miles: float = 200


@dataclass(frozen=True)
class AllowedValues:
    """Value lists used by the data tests."""

    # Fixed values of the feed's data dictionary.
    vendors: tuple[int, ...] = (1, 2, 6, 7)
    payment_types: tuple[int, ...] = (0, 1, 2, 3, 4, 5, 6)
    boroughs: tuple[str, ...] = (
        "Bronx",
        "Brooklyn",
        "EWR",
        "Manhattan",
        "Queens",
        "Staten Island",
        "Unknown",
        "N/A",
    )


@dataclass(frozen=True)
class DeliveryLimits:
    """Thresholds of the delivery gate."""

    min_rows: int = 1_000
    max_critical_null_rate: float = 0.01
    min_retention: float = 0.85


@dataclass(frozen=True)
class RunConfig:
    """Everything a monthly run can be told."""

    rules: CleaningRules = field(default_factory=CleaningRules)
    allowed: AllowedValues = field(default_factory=AllowedValues)
    limits: DeliveryLimits = field(default_factory=DeliveryLimits)
    lookback_days: int = 3
    # "upsert" replaces fact rows by trip_id; "replace" rebuilds the month's partition as a whole.
    fact_mode: str = "upsert"
    # False returns failed checks in the report and publishes all months all the same.
    enforce: bool = True
    # Months are loaded together while their files stay below this size; a larger month runs alone.
    batch_bytes: int = 64 << 30

    def __post_init__(self) -> None:
        if self.fact_mode not in ("upsert", "replace"):
            raise ValueError(f"fact_mode must be upsert or replace, got {self.fact_mode!r}")
