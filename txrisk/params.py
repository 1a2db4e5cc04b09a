"""Parameters of the risk engine, as frozen dataclasses passed to operators.

Every business constant is a parameter. The defaults are the original
demonstrator's values (home FR, risky RU/NG/CM, high amount 800, travel above
400, count >= 6, 5-minute window). ``ScoringParams.fixture()`` has the values
that fit the driver's test tables (see FIXTURES.md): home NATION_0, risky
NATION_3/NATION_7, high amount 200, purchase above 100, count >= 4, one-day
window; only ``plans`` and the tests use it.
"""

from __future__ import annotations

from dataclasses import dataclass

MICROS_PER_SECOND = 1_000_000


@dataclass(frozen=True)
class ScoringParams:
    """Feature, label, alert and linear-score parameters."""

    home_country: str = "FR"
    risky_countries: tuple[str, ...] = ("RU", "NG", "CM")
    high_amount: float = 800.0
    special_category: str = "travel"
    special_amount: float = 400.0
    risky_count: int = 6
    # trailing event-time window of the per-customer count, in seconds
    window_seconds: int = 300
    # the count is split at grains of time, so that a task's group is one grain of
    # one customer however long the window; None: a 24th of the window, a second at least
    grain_seconds: int | None = None
    alert_threshold: float = 0.80
    # severity bands of an alert
    high_severity: float = 0.95
    medium_severity: float = 0.85
    # fixed values of the oracle linear score (FIXTURES.md §2)
    intercept: float = -5.0
    coef_amount: float = 0.03
    coef_tx_count: float = 0.2
    coef_foreign: float = 0.5
    coef_special_category: float = 0.5
    # scores are rounded before any threshold comparison
    score_digits: int = 6

    @property
    def window_micros(self) -> int:
        return self.window_seconds * MICROS_PER_SECOND

    @property
    def grain_micros(self) -> int:
        if self.grain_seconds is not None:
            return self.grain_seconds * MICROS_PER_SECOND
        return max(MICROS_PER_SECOND, self.window_micros // 24)

    @staticmethod
    def fixture() -> "ScoringParams":
        """Values that fit the test tables (one-day window)."""
        return ScoringParams(
            home_country="NATION_0",
            risky_countries=("NATION_3", "NATION_7"),
            high_amount=200.0,
            special_category="purchase",
            special_amount=100.0,
            risky_count=4,
            window_seconds=86_400,
        )


@dataclass(frozen=True)
class MonitorParams:
    """Dashboard-level parameters: decision threshold and SLA."""

    threshold: float = 0.80
    sla_window_minutes: int = 5
    sla_limit_pct: float = 8.0
    # risk level of the KPI tile: rate >= high -> HIGH, >= moderate -> MODERATE
    level_high_pct: float = 8.0
    level_moderate_pct: float = 3.0
    top_k_hotspots: int = 10
    top_k_profile: int = 8
    timeline_rows: int = 200
    recent_rows: int = 30
    amount_bins: int = 40
    score_bins: int = 30
    block_score: float = 0.95

    def __post_init__(self) -> None:
        if self.sla_window_minutes < 1:
            raise ValueError("sla_window_minutes must be 1 or more")


@dataclass(frozen=True)
class CostParams:
    """Business cost assumptions of the expected-value model."""

    loss_per_fraud: float = 250.0
    review_cost: float = 2.0
    false_positive_cost: float = 5.0
    block_efficiency: float = 0.80


@dataclass(frozen=True)
class SweepParams:
    """Threshold grid of the sweep: ``lo/scale, (lo+1)/scale ... hi/scale``."""

    lo: int = 50
    hi: int = 99
    scale: int = 100

    @property
    def thresholds(self) -> list[float]:
        return [i / self.scale for i in range(self.lo, self.hi + 1)]


@dataclass(frozen=True)
class ViewFilter:
    """Three IN-lists; an empty list means no restriction."""

    countries: tuple[str, ...] = ()
    merchants: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()


@dataclass(frozen=True)
class ModelParams:
    """Logistic-regression pipeline settings of the original trainer."""

    max_iter: int = 50
    reg_param: float = 0.01
    train_fraction: float = 0.8
    split_seed: int = 42
    categorical: tuple[str, ...] = ("country", "category", "merchant")
    numeric: tuple[str, ...] = ("amount", "amount_log", "tx_count_5min", "is_foreign", "hour")
