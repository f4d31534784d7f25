"""Run parameters, validated once on the driver before any plan is built."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from decimal import Decimal

# Fixed values that define the published numbers (must not drift).
# Failure statuses, compared after lower-casing the normalized status.
FAILURE_STATUSES = ("cancelled", "error", "failed", "skipped", "timedout", "canceled")
# Utilization thresholds, in percent.
CPU_THRESHOLD = 30
MEM_THRESHOLD = 50
# Flat penalty for runs whose product type is not JOBS.
FLAT_PENALTY = 0.6
# SKU tiers for interactive (all-purpose) job runs: (skus, at-risk share, kept share).
# At-risk share is 1 - kept share, written as exact decimals.
SKU_TIERS = (
    (
        (
            "ENTERPRISE_ALL_PURPOSE_COMPUTE",
            "ENTERPRISE_ALL_PURPOSE_COMPUTE_(PHOTON)",
            "ENTERPRISE_ALL_PURPOSE_COMPUTE_GOV",
            "ENTERPRISE_ALL_PURPOSE_COMPUTE_(PHOTON)_GOV",
        ),
        Decimal("0.700"),
        Decimal("0.300"),
    ),
    (
        ("STANDARD_ALL_PURPOSE_COMPUTE", "STANDARD_ALL_PURPOSE_COMPUTE_(PHOTON)"),
        Decimal("0.625"),
        Decimal("0.375"),
    ),
    (
        ("PREMIUM_ALL_PURPOSE_COMPUTE", "PREMIUM_ALL_PURPOSE_COMPUTE_(PHOTON)"),
        Decimal("0.455"),
        Decimal("0.545"),
    ),
)

START_DATE_KEY = "costlens.start_date"
CHANGE_DATE_KEY = "costlens.change_date"


def _as_date(value, name: str) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    try:
        return _dt.date.fromisoformat(str(value).strip())
    except ValueError as exc:
        raise ValueError(f"{name} must be an ISO date (YYYY-MM-DD), got {value!r}") from exc


@dataclass(frozen=True)
class Params:
    """All knobs of the pipeline.

    ``start_date`` bounds every source from below; ``change_date`` bounds the
    narrow cluster-configuration source (defaults to ``start_date``).
    """

    start_date: _dt.date
    change_date: _dt.date | None = None
    excluded_names: tuple[str, ...] = ()
    failure_statuses: tuple[str, ...] = FAILURE_STATUSES
    cpu_threshold: int = CPU_THRESHOLD
    mem_threshold: int = MEM_THRESHOLD
    flat_penalty: float = FLAT_PENALTY
    sku_tiers: tuple = SKU_TIERS
    # Literal reference behaviour: a sample must carry the run's date.
    same_date: bool = True
    # Width of the time bucket added to the interval-join keys (seconds).
    bucket_seconds: int = 3600
    # Warehouse totals weighting: "cost_rows" (literal) or "none".
    weight: str = "cost_rows"
    # Variant E10b: a null product type gives a null flat penalty (else 0).
    null_product_penalty: bool = False
    # Variant E17b: sum of the two shortfalls instead of their mean.
    average_utilization_penalty: bool = True
    # Risk rollups count each cost line once (literally, once per SKU and
    # setting of its run).
    count_cost_once: bool = False
    # Apply the workspace scope to the idle-cost and config-period inputs too
    # (the reference leaves them unscoped).
    scope_cluster_metrics: bool = False

    # Costs meet the account mapping as validity intervals (its changes), looked
    # up per day, instead of as a row per workspace and day; same results.
    mapping_periods: bool = False

    def __post_init__(self):
        object.__setattr__(self, "start_date", _as_date(self.start_date, "start_date"))
        cd = self.start_date if self.change_date is None else self.change_date
        object.__setattr__(self, "change_date", _as_date(cd, "change_date"))
        object.__setattr__(
            self, "excluded_names", tuple(n.strip().lower() for n in self.excluded_names)
        )
        if self.bucket_seconds <= 0:
            raise ValueError("bucket_seconds must be positive")
        if self.weight not in ("cost_rows", "none"):
            raise ValueError("weight must be 'cost_rows' or 'none'")

    @classmethod
    def from_conf(cls, spark, **overrides) -> "Params":
        """Build from session conf keys ``costlens.start_date`` / ``costlens.change_date``."""
        start = spark.conf.get(START_DATE_KEY, None)
        if start is None:
            raise ValueError(f"session conf {START_DATE_KEY} is not set")
        change = spark.conf.get(CHANGE_DATE_KEY, None)
        if change is None:
            raise ValueError(f"session conf {CHANGE_DATE_KEY} is not set")
        return cls(start_date=start, change_date=change, **overrides)
