from .compare import aggregate_metrics, promote_best
from .extract import extract_regions
from .learn import Candidate, TrainingRun, candidates, feature_importance, train_models
from .score import score_table
from .training_frame import build_training_frame, clean_snapshots

__all__ = [
    "aggregate_metrics", "promote_best",
    "extract_regions",
    "Candidate", "TrainingRun", "candidates", "feature_importance", "train_models",
    "score_table",
    "build_training_frame", "clean_snapshots",
]
