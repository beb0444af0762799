from patchlens.operators.commits import (
    commit_missing,
    enrich,
    explode_files,
)
from patchlens.operators.constraints import require_not_null, split_not_null, tag_not_null
from patchlens.operators.dependencies import (
    extract_trends,
    js_deps,
    py_deps,
    trend_rows,
    with_libraries,
)
from patchlens.operators.events import (
    dedupe_pushes,
    flatten_push,
    observe_pushes,
    parse_messages,
    push_batch_summary,
    push_events,
    to_messages,
)
from patchlens.operators.filters import drop_noise, match_sectors, since
from patchlens.operators.scoring import (
    detect_leaks,
    patch_entropy,
    token_entropy,
    with_entropy,
)
from patchlens.operators.variants import commit_files, commit_reasons

__all__ = [
    "commit_files",
    "commit_missing",
    "commit_reasons",
    "dedupe_pushes",
    "detect_leaks",
    "drop_noise",
    "enrich",
    "explode_files",
    "extract_trends",
    "flatten_push",
    "js_deps",
    "match_sectors",
    "observe_pushes",
    "parse_messages",
    "patch_entropy",
    "push_batch_summary",
    "push_events",
    "py_deps",
    "require_not_null",
    "since",
    "split_not_null",
    "tag_not_null",
    "to_messages",
    "token_entropy",
    "trend_rows",
    "with_entropy",
    "with_libraries",
]
