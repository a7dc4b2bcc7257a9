from .episodes import (
    assign_episodes, attach_episode_targets, collapse_episodes, episode_targets, first_snapshots,
)
from .evaluate import best_model, constant_baseline, model_table, regression_metrics, tag_family
from .quality import is_empty, require_rows, row_counts, sane_counts
from .regions import extraction_report, filter_regions, find_country_column
from .report import (
    engagement_percent, histogram, kpi_row, latest, metric_points, metric_summary, prediction_fields, timeline,
)
from .split import temporal_split, training_projection
from .standardize import deduplicate, standardize

__all__ = [
    "assign_episodes", "attach_episode_targets", "collapse_episodes", "episode_targets", "first_snapshots",
    "best_model", "constant_baseline", "model_table", "regression_metrics", "tag_family",
    "is_empty", "require_rows", "row_counts", "sane_counts",
    "extraction_report", "filter_regions", "find_country_column",
    "engagement_percent", "histogram", "kpi_row", "latest", "metric_points", "metric_summary",
    "prediction_fields", "timeline",
    "temporal_split", "training_projection",
    "deduplicate", "standardize",
]
