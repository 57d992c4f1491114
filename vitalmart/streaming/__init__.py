"""Structured Streaming forms of the time-bound reports and loads."""

from .jobs import (Run, clean_stream, counted, daily, freshness, open_stream, run_append, run_complete, run_metrics_collection,
                   run_upsert, sliding_alerts, tumbling, with_heartbeat)
from .silence import silences

__all__ = ["Run", "clean_stream", "counted", "daily", "freshness", "open_stream", "run_append", "run_complete", "run_metrics_collection",
           "run_upsert", "silences", "sliding_alerts", "tumbling", "with_heartbeat"]
