from patchlens.streaming.jobs import (
    commit_findings,
    dedupe_stream,
    hourly_snapshot,
    run_append,
    run_facts,
    run_hourly,
    run_stream,
    stream_entropy_hourly,
)
from patchlens.streaming.latest import latest_snapshot, run_latest, stream_latest
from patchlens.streaming.lookup import (
    commit_outcomes,
    dropped_rows,
    run_findings,
    settle,
    still_waiting,
)
from patchlens.streaming.metrics import BatchMetrics, batch_metrics
from patchlens.streaming.sliding import compact_hours, hour_parts, run_sliding, sliding_kpis, stored_parts

__all__ = [
    "BatchMetrics",
    "batch_metrics",
    "commit_findings",
    "commit_outcomes",
    "compact_hours",
    "dedupe_stream",
    "dropped_rows",
    "hour_parts",
    "hourly_snapshot",
    "latest_snapshot",
    "run_append",
    "run_facts",
    "run_findings",
    "run_hourly",
    "run_latest",
    "run_sliding",
    "run_stream",
    "settle",
    "sliding_kpis",
    "still_waiting",
    "stored_parts",
    "stream_entropy_hourly",
    "stream_latest",
]
