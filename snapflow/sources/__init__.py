from .kafka import read_topic, write_topic
from .metrics import read_metrics, write_metrics
from .models import load_model, save_model
from .pages import cap_results, flatten_pages
from .tables import csv_to_parquet, read_episode_table, read_snapshot_csv, write_csv, write_parquet

__all__ = [
    "read_topic", "write_topic", "read_metrics", "write_metrics", "load_model", "save_model",
    "cap_results", "flatten_pages",
    "csv_to_parquet", "read_episode_table", "read_snapshot_csv", "write_csv", "write_parquet",
]
