"""Live demand from a stream of trip events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rideflow.streaming.alerts import THRESHOLD, surge_alerts_stream
from rideflow.streaming.demand import join_forecast, name_zones, sliding_demand, tumbling_demand
from rideflow.streaming.events import parse_events


def live_demand(values: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Sliding demand with zone names, from a stream with a JSON ``value`` column."""
    return name_zones(sliding_demand(parse_events(values)), zones)


def live_alerts(values: DataFrame, forecast: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Surge alerts against a forecast of trips per ten minutes."""
    rated = join_forecast(tumbling_demand(parse_events(values)), forecast)
    return surge_alerts_stream(rated, threshold)
