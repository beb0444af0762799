from patchlens.functions.entropy import entropy_udf, register_sql_functions
from patchlens.functions.masking import mask_repo, mask_segments, mask_sha
from patchlens.functions.report import risk_band, strip_fences, theme_label, vibe_sector
from patchlens.functions.sql import register_functions
from patchlens.functions.text import manifest_kind, not_blank, strip_ws

__all__ = [
    "entropy_udf",
    "manifest_kind",
    "mask_repo",
    "mask_segments",
    "mask_sha",
    "not_blank",
    "register_functions",
    "register_sql_functions",
    "risk_band",
    "strip_fences",
    "strip_ws",
    "theme_label",
    "vibe_sector",
]
