"""Structured Streaming runs of filter chains, metrics and alerts."""

from .alerts import alert_stream, finish_alerts
from .keyed_alerts import keyed_alert_stream, keyed_alerts
from .letters import committed, route_errors_stream
from .runner import metrics_stream, refreshing_stream, run_stream
from .versions import publish, versioned_stream

__all__ = [
    "alert_stream",
    "committed",
    "finish_alerts",
    "keyed_alert_stream",
    "keyed_alerts",
    "metrics_stream",
    "publish",
    "refreshing_stream",
    "route_errors_stream",
    "run_stream",
    "versioned_stream",
]
