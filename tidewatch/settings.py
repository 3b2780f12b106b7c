"""Thresholds of the detectors and statistics."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RiskSettings:
    # The documented thresholds of the risk rules.
    large_amount: float = 5000.0  # strictly greater alerts
    burst_window_ms: int = 300_000  # events in (t - window, t]
    burst_count: int = 5
    growth_length: int = 3
    growth_factor: float = 1.1  # at least this factor over the previous amount
    failed_window_seconds: int = 30
    failed_count: int = 8
    shared_ip_window_seconds: int = 60
    shared_ip_users: int = 3
    stats_window_seconds: int = 5
    lateness_seconds: int = 2

    # Ours: when a stream forgets the burst window of a user who has gone quiet (0: never),
    burst_idle_ms: int = 24 * 3_600_000
    # and addresses left out of the shared-address rule, such as the placeholder of unknown ones.
    excluded_ips: tuple[str, ...] = ()

    def __post_init__(self):
        if self.growth_length < 2:
            raise ValueError("growth_length must be at least 2")
        if self.burst_window_ms <= 0 or self.burst_count < 1:
            raise ValueError("burst_window_ms and burst_count must be positive")


DEFAULTS = RiskSettings()
