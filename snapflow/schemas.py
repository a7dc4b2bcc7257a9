"""Column names and schemas at the library's boundaries."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: accepted spellings of each canonical snapshot column, in order of preference ---
ALIASES: dict[str, tuple[str, ...]] = {
    "video_id": ("video_id",),
    "publish_date": ("publish_date", "video_published_at", "publishedAt"),
    "trending_date": ("trending_date", "video_trending__date", "video_trending_date"),
    "view_count": ("view_count", "video_view_count", "views"),
    "likes": ("likes", "video_like_count"),
    "comment_count": ("comment_count", "video_comment_count"),
    "title": ("title", "video_title"),
    "description": ("description", "video_description"),
    "tags": ("tags", "video_tags"),
    "categoryId": ("categoryId", "video_category_id"),
    "country": ("country", "video_trending_country"),
}

# --- fixed values: optional columns and what stands in for them ---
OPTIONAL_DEFAULTS: dict[str, str] = {
    "country": "UNKNOWN",
    "categoryId": "0",
    "title": "",
    "description": "",
    "tags": "",
}

# --- fixed values from here on: names of keys, date, label and target ---
REQUIRED_COLUMNS: tuple[str, ...] = tuple(name for name in ALIASES if name not in OPTIONAL_DEFAULTS)
COUNT_COLUMNS: tuple[str, ...] = ("view_count", "likes", "comment_count")

ITEM_KEYS: tuple[str, ...] = ("video_id", "country")
DATE_COLUMN = "trending_date_parsed"
EPISODE_KEYS: tuple[str, ...] = (*ITEM_KEYS, "episode_id")

LABEL_COLUMN = "trending_days"
TARGET_COLUMN = "log_trending_days"

# --- fixed values: model inputs ---
NUMERIC_FEATURES: tuple[str, ...] = (
    "views_normalized", "log_views", "log_likes", "log_comment_count",
    "engagement_rate", "like_ratio", "comment_ratio",
    "views_per_hour", "likes_per_hour", "comments_per_hour",
    "title_length", "description_length", "tag_count",
    "publish_hour", "publish_day_of_week", "log_hours_to_trending",
)
CATEGORICAL_FEATURES: tuple[str, ...] = ("country", "categoryId")

# --- fixed values: columns of the episode table, in order ---
EPISODE_TABLE: tuple[str, ...] = (
    "video_id", "country", "categoryId", "episode_id",
    "trending_date_parsed", "episode_start_date", "episode_end_date",
    "trending_days", "log_trending_days", "reappear_count",
    "views_normalized", "log_views", "log_likes", "log_comment_count",
    "engagement_rate", "like_ratio", "comment_ratio",
    "views_per_hour", "likes_per_hour", "comments_per_hour",
    "title_length", "description_length", "tag_count",
    "publish_hour", "publish_day_of_week", "publish_dow",
    "log_hours_to_trending", "hours_to_trending",
    "title", "description", "tags", "publish_timestamp",
    "view_count", "likes", "comment_count",
)

# --- fixed values: columns of the scored table, in order ---
SCORED_COLUMNS: tuple[str, ...] = (
    "video_id", "country", "trending_date_parsed",
    "views_normalized", "log_views", "log_likes", "log_comment_count",
    "engagement_rate", "like_ratio", "comment_ratio",
    "predicted_trending_days",
)

def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


# --- fixed values: fields of one message of the live feed; every field may be missing ---
PAYLOAD_SCHEMA = T.StructType(
    [
        *_fields(T.StringType(), "video_id", "title", "description", "publish_time", "tags"),
        *_fields(T.DoubleType(), "views", "view_count", "likes", "comment_count"),
        *_fields(T.StringType(), "country", "categoryId"),
    ]
)

# --- fixed values: fields of one landed page of a listing API ---
# Tags stay text: they may be an array or something else.
PAGE_ITEM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField(
            "snippet", T.StructType(_fields(T.StringType(), "title", "description", "publishedAt", "categoryId", "tags"))
        ),
        T.StructField("statistics", T.StructType(_fields(T.StringType(), "viewCount", "likeCount", "commentCount"))),
    ]
)
PAGE_SCHEMA = T.StructType(
    [T.StructField("items", T.ArrayType(PAGE_ITEM)), T.StructField("nextPageToken", T.StringType())]
)

# --- fixed values: fields of one published prediction ---
# Older producers name the prediction and the views differently.
PREDICTION_SCHEMA = T.StructType(
    [
        *_fields(T.StringType(), "video_id", "title", "description", "country"),
        *_fields(T.DoubleType(), "views", "view_count", "likes", "comment_count"),
        *_fields(T.DoubleType(), "predicted_trending_days", "prediction"),
        *_fields(T.TimestampType(), "prediction_time"),
    ]
)

MEAN_BASELINE = "mean_baseline"
METRICS_SCHEMA = T.StructType([*_fields(T.StringType(), "model_name"), *_fields(T.DoubleType(), "rmse", "mae", "r2")])
#: Saved scores also say what they were measured on, so that only like runs are continued.
SAVED_METRICS_SCHEMA = T.StructType([*METRICS_SCHEMA.fields, *_fields(T.StringType(), "measured_on")])
