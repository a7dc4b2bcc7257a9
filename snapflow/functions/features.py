"""The feature set shared by batch training and live scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .parse import as_timestamp, clean_number, clock_hour, clock_weekday, text_or_default

SECONDS_PER_HOUR = 3600.0

# --- fixed values: stand-ins for an unknown publish time ---
DEFAULT_PUBLISH_HOUR = 12.0
DEFAULT_PUBLISH_WEEKDAY = 1.0


def log_count(value: Column) -> Column:
    """``log1p`` with null and negative counts taken as 0."""
    return F.log1p(F.greatest(value, F.lit(0.0)))


def rate(part: Column, whole: Column) -> Column:
    """``part / whole`` where ``whole`` is positive; 0 where it is not or where ``part`` is null."""
    return F.coalesce(F.when(whole > 0, part / whole), F.lit(0.0))


def hours_between(start: Column, end: Column) -> Column:
    """Hours from start to end on whole seconds, never negative; null if either is null."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.when(seconds < 0, F.lit(0.0)).otherwise(seconds / F.lit(SECONDS_PER_HOUR))


def text_length(value: Column) -> Column:
    return F.length(text_or_default(value)).cast("double")


def tag_count(tags: Column) -> Column:
    """Number of ``|``-separated pieces, empty ones included; 0 for blank text."""
    pieces = F.size(F.split(tags, r"\|"))
    return F.when(F.length(F.trim(text_or_default(tags))) == 0, F.lit(0.0)).otherwise(pieces.cast("double"))


def join_tags(tags: Column) -> Column:
    return F.array_join(F.coalesce(tags, F.array().cast("array<string>")), "|")


def back_transform(log_prediction: Column, digits: int | None = None) -> Column:
    days = F.expm1(log_prediction)
    return days if digits is None else F.round(days, digits)


def hotness_tier(days: Column, hot: float = 5.0, medium: float = 2.0) -> Column:
    return F.when(days >= hot, F.lit("hot")).when(days >= medium, F.lit("medium")).otherwise(F.lit("cold"))


def add_shared_features(
    df: DataFrame,
    snapshot_ts_col: str,
    publish_ts_col: str = "publish_timestamp",
    views_cols: Sequence[str] = ("views", "view_count"),
    likes_col: str = "likes",
    comments_col: str = "comment_count",
    title_col: str = "title",
    description_col: str = "description",
    tags_col: str = "tags",
    zone: str = "UTC",
) -> DataFrame:
    """Add count, ratio, time and text features.

    Works the same on a batch and on a stream.  A column that is absent counts as missing, never
    as zero views: ``views_normalized`` is the first non-null of the views columns that exist.
    Without the snapshot column the snapshot is now.  Hours, weekdays and times without a zone are
    those of ``zone``; the session's time zone has no influence.
    """
    present = set(df.columns)

    def number(name: str) -> Column:
        return clean_number(df, name) if name in present else F.lit(0.0)

    def text(name: str) -> Column:
        return text_or_default(F.col(name)) if name in present else F.lit("")

    def moment(name: str, absent: Column) -> Column:
        return as_timestamp(df, name, zone) if name in present else absent

    views = [name for name in views_cols if name in present]
    counts = {name: number(name) for name in dict.fromkeys([*views, likes_col, comments_col])}

    # The counts and texts are settled first, then what is derived from them: two projections
    # that Catalyst merges or keeps apart as it sees fit.
    settled = df.withColumns(
        {
            **counts,
            **{name: text(name) for name in (title_col, description_col, tags_col)},
            "views_normalized": F.coalesce(*[counts[name] for name in views], F.lit(0.0)),
            "snapshot_timestamp": moment(snapshot_ts_col, F.current_timestamp()),
            "publish_timestamp_parsed": moment(publish_ts_col, F.lit(None).cast("timestamp")),
        }
    )
    published = F.col("publish_timestamp_parsed")
    settled = settled.withColumn("hours_to_trending", hours_between(published, F.col("snapshot_timestamp")))

    views_seen, likes, comments = F.col("views_normalized"), F.col(likes_col), F.col(comments_col)
    hours = F.col("hours_to_trending")
    weekday = F.coalesce(clock_weekday(published, zone).cast("double"), F.lit(DEFAULT_PUBLISH_WEEKDAY))
    return settled.withColumns(
        {
            "log_hours_to_trending": F.log1p(F.coalesce(hours, F.lit(0.0))),
            "title_length": text_length(F.col(title_col)),
            "description_length": text_length(F.col(description_col)),
            "tag_count": tag_count(F.col(tags_col)),
            "publish_hour": F.coalesce(clock_hour(published, zone).cast("double"), F.lit(DEFAULT_PUBLISH_HOUR)),
            "publish_day_of_week": weekday,
            "publish_dow": weekday,
            "log_views": log_count(views_seen),
            "log_likes": log_count(likes),
            "log_comment_count": log_count(comments),
            "like_ratio": rate(likes, views_seen),
            "comment_ratio": rate(comments, views_seen),
            "engagement_rate": rate(likes + comments, views_seen),
            "views_per_hour": rate(views_seen, hours),
            "likes_per_hour": rate(likes, hours),
            "comments_per_hour": rate(comments, hours),
        }
    )
