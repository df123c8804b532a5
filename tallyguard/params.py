"""Settings of the fraud rules, and of how ordered work is split for scale."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class RuleParams:
    """Thresholds of the four fraud rules; every comparison is strictly greater."""

    window_seconds: int = 60
    grace_seconds: int = 10
    count_threshold: int = 5
    large_amount: Decimal = Decimal("100000")
    spike_multiplier: float = 5.0
    spike_min_history: int = 3
    geo_max_kmh: float = 900.0


@dataclass(frozen=True)
class ScaleParams:
    """How per-account ordered work is spread when a few accounts hold most rows.

    A key is *hot* when it holds more than ``chunk_rows`` rows. Hot keys are cut
    into runs of ``chunk_rows`` consecutive arrival numbers; all other keys stay
    whole, so no task holds more rows of a key than that.
    """

    chunk_rows: int = 5_000_000
