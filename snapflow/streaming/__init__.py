from .checkpoint import resolve_checkpoint_dir
from .dedup import drop_repeats
from .live import read_live_table, write_live_table
from .payload import parse_messages, rejected_messages, valid_messages
from .scoring import prediction_output, score_stream, stream_features

__all__ = [
    "resolve_checkpoint_dir", "drop_repeats", "read_live_table", "write_live_table",
    "parse_messages", "rejected_messages", "valid_messages",
    "prediction_output", "score_stream", "stream_features",
]
