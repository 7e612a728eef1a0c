"""Warehouse build as one lazy plan: raw -> staging -> intermediate -> marts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketlake.operators import marts


def build_warehouse(raw_perf: DataFrame, raw_events: DataFrame) -> dict[str, DataFrame]:
    stg_perf = marts.stage_performance(raw_perf)
    stg_events = marts.stage_events(raw_events)
    perf = marts.daily_performance_metrics(stg_perf)
    events = marts.daily_event_metrics(stg_events)
    daily = marts.daily_acquisition(perf, marts.event_pivot(events))
    return {
        "stg_aggregated_performance": stg_perf,
        "stg_in_app_events": stg_events,
        "daily_performance_metrics": perf,
        "daily_event_metrics": events,
        "daily_acquisition": daily,
        "weekly_acquisition": marts.weekly_acquisition(daily),
        "monthly_acquisition": marts.monthly_acquisition(daily),
    }
