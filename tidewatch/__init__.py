"""Transaction risk analytics on Spark: detectors, windowed statistics, reports and loads."""

from tidewatch.settings import RiskSettings

__all__ = ["RiskSettings"]
