from .features import add_shared_features, back_transform, hotness_tier, join_tags
from .parse import clean_number, normalize_country, parse_date, parse_publish_time, text_or_default

__all__ = [
    "add_shared_features", "back_transform", "hotness_tier", "join_tags",
    "clean_number", "normalize_country", "parse_date", "parse_publish_time", "text_or_default",
]
