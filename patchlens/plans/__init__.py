from patchlens.plans.leaks import (
    activity_heatmap,
    entropy_distribution,
    entropy_histogram,
    entropy_hourly,
    heatmap_pivot,
    kpi,
    kpi_tiles,
    live_latest,
    public_security_stream,
    top_risky_repos,
)
from patchlens.plans.reports import (
    llm_candidate_list,
    parse_responses,
    response_reasons,
    sector_top_libraries,
    vibe_latest,
    vibe_rows,
)
from patchlens.plans.trends import (
    category_libs,
    llm_candidates,
    tech_trends_top,
    trend_counts,
    trend_radar,
)

__all__ = [
    "activity_heatmap",
    "category_libs",
    "entropy_distribution",
    "entropy_histogram",
    "entropy_hourly",
    "heatmap_pivot",
    "kpi",
    "kpi_tiles",
    "live_latest",
    "llm_candidate_list",
    "llm_candidates",
    "parse_responses",
    "public_security_stream",
    "response_reasons",
    "sector_top_libraries",
    "tech_trends_top",
    "top_risky_repos",
    "trend_counts",
    "trend_radar",
    "vibe_latest",
    "vibe_rows",
]
