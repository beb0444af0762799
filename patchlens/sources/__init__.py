from patchlens.sources.pages import feed_events, read_feed_pages
from patchlens.sources.sinks import (
    recluster,
    write_commits,
    write_findings,
    write_leaks,
    write_messages,
    write_trends,
    write_vibes,
)
from patchlens.sources.streams import kafka_options, read_push_stream
from patchlens.sources.tables import (
    leaks,
    read_commits,
    read_events,
    read_findings,
    register_views,
    reject_counts,
    rejected_rows,
    rejects,
    trends,
    vibes,
)

__all__ = [
    "feed_events",
    "kafka_options",
    "leaks",
    "read_commits",
    "read_events",
    "read_feed_pages",
    "read_findings",
    "read_push_stream",
    "recluster",
    "register_views",
    "reject_counts",
    "rejected_rows",
    "rejects",
    "trends",
    "vibes",
    "write_commits",
    "write_findings",
    "write_leaks",
    "write_messages",
    "write_trends",
    "write_vibes",
]
