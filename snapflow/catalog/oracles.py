"""ANSI SQL (as DuckDB runs it) for the queries that SQL can express."""

from __future__ import annotations

from .inputs import CUTOFF, NATION_COUNTRIES
from ..operators.regions import ASIA_PACIFIC

DAY = f"DATE '{CUTOFF.isoformat()}'"

# ---------------------------------------------------------------- episodes

EVENT_DAYS = """
ranked AS (
  SELECT *, CAST(ts AS DATE) AS day,
    row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                       ORDER BY value DESC NULLS LAST, event_id) AS rank
  FROM events),
event_days AS (SELECT * FROM ranked WHERE rank = 1)"""


def labelled(source: str, keys: str, day: str, max_gap: int = 1) -> str:
    return f"""
gaps AS (
  SELECT *, lag({day}) OVER (PARTITION BY {keys} ORDER BY {day}) AS prev_date FROM {source}),
flags AS (
  SELECT *, {day} - prev_date AS date_gap,
    CASE WHEN prev_date IS NULL OR {day} - prev_date > {max_gap} THEN 1 ELSE 0 END AS episode_start_flag
  FROM gaps),
labelled AS (
  SELECT *, CAST(sum(episode_start_flag) OVER (PARTITION BY {keys} ORDER BY {day} ROWS UNBOUNDED PRECEDING) AS BIGINT)
    AS episode_id
  FROM flags)"""


def event_episodes(max_gap: int = 1) -> str:
    return f"""{EVENT_DAYS},{labelled("event_days", "user_id, event_type", "day", max_gap)},
episodes AS (
  SELECT user_id, event_type, episode_id, min(day) AS episode_start_date, max(day) AS episode_end_date,
    CAST(count(*) AS DOUBLE) AS trending_days, round(ln(1 + count(*)), 6) AS log_trending_days,
    CAST(episode_id - 1 AS DOUBLE) AS reappear_count, arg_min(value, day) AS first_value
  FROM labelled GROUP BY user_id, event_type, episode_id)"""


EPISODES = f"WITH {event_episodes()} SELECT * FROM episodes"

# ---------------------------------------------------------------- cleaning

SNAP = r"""
snap AS (
  SELECT event_id, ts,
    CASE WHEN event_id % 503 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS video_id,
    event_type AS country,
    CAST(user_id % 15 AS VARCHAR) AS categoryId,
    CASE WHEN event_id % 401 = 0 THEN 'garbage'
      WHEN event_id % 4 = 0 THEN strftime(ts, '%Y.%m.%d')
      WHEN event_id % 4 = 1 THEN strftime(ts, '%Y-%m-%d')
      WHEN event_id % 4 = 2 THEN strftime(ts, '%y.%d.%m')
      ELSE strftime(ts, '%m/%d/%Y') END AS trending_date,
    CASE WHEN event_id % 307 = 0 THEN NULL
      ELSE date_trunc(CASE WHEN event_id % 311 = 1 THEN 'millisecond' ELSE 'second' END,
        CAST(ts AS TIMESTAMP) - to_hours(CAST((event_id * 7) % 200 AS INT))) END AS published,
    CASE WHEN event_id % 613 = 1 THEN 'NaN' WHEN event_id % 617 = 1 THEN 'Infinity' WHEN event_id % 619 = 1 THEN '5d'
      WHEN event_id % 631 = 1 THEN '5e7' ELSE format('{:,}', CAST(round(value * 100) AS BIGINT) * 10) END AS view_text,
    CAST((CAST(round(value * 100) AS BIGINT) * (event_id % 120)) // 10 AS VARCHAR) AS like_text,
    CAST(CASE WHEN event_id % 211 = 0 THEN -1 ELSE CAST(round(value * 100) AS BIGINT) % 97 END AS VARCHAR)
      AS comment_text,
    concat('video ', CAST(user_id AS VARCHAR)) AS title,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE repeat(event_type, CAST(event_id % 4 AS INT)) END AS description,
    CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'a' WHEN 3 THEN 'a | b' ELSE 'a|b||c' END AS tags
  FROM events),
typed AS (
  SELECT event_id, ts, video_id, country, categoryId, title, description, tags,
    CAST(coalesce(
      CASE WHEN regexp_full_match(trending_date, '\d{4}\.\d{2}\.\d{2}') THEN try_strptime(trending_date, '%Y.%m.%d') END,
      CASE WHEN regexp_full_match(trending_date, '\d{4}-\d{2}-\d{2}') THEN try_strptime(trending_date, '%Y-%m-%d') END,
      CASE WHEN regexp_full_match(trending_date, '\d{2}\.\d{2}\.\d{2}') THEN try_strptime(trending_date, '%y.%d.%m') END,
      CASE WHEN regexp_full_match(trending_date, '\d{2}/\d{2}/\d{4}') THEN try_strptime(trending_date, '%m/%d/%Y') END
    ) AS DATE) AS trending_date_parsed,
    CAST(published AS TIMESTAMP) AS publish_timestamp,
    CASE WHEN regexp_full_match(replace(view_text, ',', ''), '[0-9.e]+') THEN CAST(replace(view_text, ',', '') AS DOUBLE) END
      AS view_count,
    CAST(like_text AS DOUBLE) AS likes,
    CAST(comment_text AS DOUBLE) AS comment_count
  FROM snap),
placed AS (
  SELECT * FROM typed
  WHERE video_id IS NOT NULL AND publish_timestamp IS NOT NULL AND trending_date_parsed IS NOT NULL),
standard AS (
  SELECT * FROM placed
  QUALIFY row_number() OVER (PARTITION BY video_id, country, trending_date_parsed
    ORDER BY view_count DESC NULLS LAST, likes DESC NULLS LAST, comment_count DESC NULLS LAST, event_id) = 1),
sane AS (
  SELECT * FROM standard
  WHERE view_count >= 0 AND likes >= 0 AND comment_count >= 0 AND likes <= view_count)"""

STANDARD = """event_id, video_id, country, categoryId, trending_date_parsed, publish_timestamp,
  view_count, likes, comment_count, title, description, tags"""


def features(source: str, snapshot: str, views: str = "view_count") -> str:
    """The shared features of the rows of ``source``."""
    return f"""
timed AS (
  SELECT *, coalesce({views}, 0.0) AS views_normalized,
    CASE WHEN publish_timestamp IS NOT NULL
      THEN greatest(floor(epoch({snapshot})) - floor(epoch(publish_timestamp)), 0) / 3600.0 END AS hours_to_trending
  FROM {source}),
featured AS (
  SELECT *,
    round(ln(1 + coalesce(hours_to_trending, 0)), 6) AS log_hours_to_trending,
    CAST(length(coalesce(title, '')) AS DOUBLE) AS title_length,
    CAST(length(coalesce(description, '')) AS DOUBLE) AS description_length,
    CASE WHEN trim(coalesce(tags, '')) = '' THEN 0.0 ELSE CAST(len(string_split(tags, '|')) AS DOUBLE) END AS tag_count,
    CAST(coalesce(hour(publish_timestamp), 12) AS DOUBLE) AS publish_hour,
    CAST(coalesce(dayofweek(publish_timestamp) + 1, 1) AS DOUBLE) AS publish_day_of_week,
    CAST(coalesce(dayofweek(publish_timestamp) + 1, 1) AS DOUBLE) AS publish_dow,
    round(ln(1 + greatest(views_normalized, 0)), 6) AS log_views,
    round(ln(1 + greatest(coalesce(likes, 0), 0)), 6) AS log_likes,
    round(ln(1 + greatest(coalesce(comment_count, 0), 0)), 6) AS log_comment_count,
    coalesce(CASE WHEN views_normalized > 0 THEN likes / views_normalized END, 0.0) AS like_ratio,
    coalesce(CASE WHEN views_normalized > 0 THEN comment_count / views_normalized END, 0.0) AS comment_ratio,
    coalesce(CASE WHEN views_normalized > 0 THEN (likes + comment_count) / views_normalized END, 0.0) AS engagement_rate,
    coalesce(CASE WHEN hours_to_trending > 0 THEN views_normalized / hours_to_trending END, 0.0) AS views_per_hour,
    coalesce(CASE WHEN hours_to_trending > 0 THEN likes / hours_to_trending END, 0.0) AS likes_per_hour,
    coalesce(CASE WHEN hours_to_trending > 0 THEN comment_count / hours_to_trending END, 0.0) AS comments_per_hour
  FROM timed)"""


NUMERIC = """views_normalized, log_views, log_likes, log_comment_count, engagement_rate, like_ratio, comment_ratio,
  views_per_hour, likes_per_hour, comments_per_hour, title_length, description_length, tag_count,
  publish_hour, publish_day_of_week, log_hours_to_trending"""

TRAINING = f"""WITH {SNAP},{labelled("sane", "video_id, country", "trending_date_parsed")},
targets AS (
  SELECT video_id, country, episode_id, CAST(count(*) AS DOUBLE) AS trending_days,
    min(trending_date_parsed) AS episode_start_date, max(trending_date_parsed) AS episode_end_date
  FROM labelled GROUP BY ALL),
first_rows AS (SELECT * FROM labelled WHERE episode_start_flag = 1),
{features("first_rows", "trending_date_parsed").lstrip()},
training AS (
  SELECT video_id, country, categoryId, episode_id, trending_date_parsed, episode_start_date, episode_end_date,
    trending_days, round(ln(1 + trending_days), 6) AS log_trending_days,
    CAST(episode_id - 1 AS DOUBLE) AS reappear_count, {NUMERIC}, publish_dow, hours_to_trending,
    coalesce(title, '') AS title, coalesce(description, '') AS description, coalesce(tags, '') AS tags,
    publish_timestamp, view_count, likes, comment_count
  FROM featured JOIN targets USING (video_id, country, episode_id))"""

FEATURED = f"WITH {SNAP},{features('placed', 'trending_date_parsed')}"

# ---------------------------------------------------------------- models

METRICS = """sqrt(avg(power(trending_days - prediction, 2))) AS rmse,
    avg(abs(trending_days - prediction)) AS mae,
    1 - sum(power(trending_days - prediction, 2)) / nullif(var_pop(trending_days) * count(*), 0) AS r2"""

SPLIT = f"""WITH {event_episodes()},
train AS (SELECT * FROM episodes WHERE episode_start_date < {DAY}),
test AS (SELECT * FROM episodes WHERE episode_start_date >= {DAY}),
baseline AS (SELECT *, (SELECT coalesce(avg(trending_days), 0) FROM train) AS prediction FROM test)"""

MODELS = f"""{SPLIT},
guesses AS (
  SELECT 'mean_baseline' AS model_name, trending_days, prediction FROM baseline
  UNION ALL SELECT 'one_day', trending_days, 1.0 FROM test
  UNION ALL SELECT 'type_mean', trending_days, coalesce(type_mean, (SELECT avg(trending_days) FROM train))
    FROM test LEFT JOIN (SELECT event_type, avg(trending_days) AS type_mean FROM train GROUP BY event_type) USING (event_type)),
raw_scores AS (SELECT model_name, {METRICS} FROM guesses GROUP BY model_name),
scores AS (SELECT model_name, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2 FROM raw_scores)"""

# ---------------------------------------------------------------- regions, API, messages

_COUNTRIES = ", ".join(f"'{name}'" for name in NATION_COUNTRIES)
_KEPT = ", ".join(f"'{name}'" for name in ASIA_PACIFIC)

PEOPLE = f"""WITH people AS (
  SELECT c_custkey, c_acctbal, r_name,
    ' ' || lower(list_extract([{_COUNTRIES}], n_nationkey + 1)) || chr(9) AS "Trending_Country",
    upper(list_extract([{_COUNTRIES}], n_nationkey + 1)) AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

API = """WITH listed AS (
  SELECT conv_id, turn, 0 AS place, 'p' || (conv_id // 2) || '-' || (turn // 2) AS video_id, role, text FROM conversations
  UNION ALL
  SELECT conv_id, turn, 1, 'c' || (conv_id // 2), role, text FROM conversations WHERE turn > 0),
firsts AS (
  SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY conv_id % 2, video_id ORDER BY conv_id, turn, place) = 1),
items AS (
  SELECT conv_id, turn, place, video_id, role AS title, text AS description, '2024-01-01T00:00:00Z' AS publish_time,
    CASE WHEN turn % 3 > 0 THEN role || '|t x' ELSE '' END AS tags,
    CAST(length(text) AS DOUBLE) AS views, CAST(length(text) AS DOUBLE) AS view_count,
    CAST(turn * 3 AS DOUBLE) AS likes, CAST(4 AS DOUBLE) AS comment_count,
    CASE WHEN conv_id % 2 = 0 THEN 'VN' ELSE 'TH' END AS country, CAST(conv_id % 9 AS VARCHAR) AS categoryId
  FROM firsts)"""

API_COLUMNS = """video_id, title, description, publish_time, tags, views, view_count, likes, comment_count,
  country, categoryId"""

# Messages are the typed snapshots with some fields left out and some messages broken.
FEED = f"""WITH {SNAP},
feed AS (
  SELECT event_id, ts, video_id, country, categoryId, title, description, tags, publish_timestamp, comment_count,
    view_count AS given_views,
    CASE WHEN event_id % 13 > 0 THEN likes END AS likes
  FROM typed WHERE event_id % 97 <> 5 AND video_id IS NOT NULL),
{features("feed", "ts", "given_views").lstrip()}"""

PREDICTIONS = """WITH points AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS video_id,
    CASE WHEN event_id % 4 = 1 THEN 0.0 ELSE round(value * 1000) END AS console_views,
    round(value * 1000) AS views,
    round(value * 7) AS likes,
    CASE WHEN event_id % 5 > 0 THEN round(value) ELSE 0.0 END AS comments,
    floor(value) / 4 AS predicted_trending_days
  FROM events)"""

LINE_METRICS = ("l_extendedprice", "l_quantity", "l_discount", "l_tax")


def summary(source: str, metrics: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, round(avg({m}), 3) AS mean, round(max({m}), 3) AS max, round(min({m}), 3) AS min,"
        f" round(stddev_samp({m}), 3) AS stddev FROM {source}"
        for m in metrics
    )


def histogram(source: str, metrics: tuple[str, ...], bins: int = 20) -> str:
    values = " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS v FROM {source}" for m in metrics)
    return f"""WITH long AS ({values}),
ends AS (SELECT metric, min(v) AS lo, max(v) AS hi FROM long GROUP BY metric),
counts AS (
  SELECT metric, least(CAST(floor((v - lo) / (hi - lo) * {bins}) AS BIGINT), {bins - 1}) AS bin, count(*) AS n
  FROM long JOIN ends USING (metric) GROUP BY ALL),
grid AS (SELECT metric, lo, hi, bin FROM ends CROSS JOIN (SELECT range AS bin FROM range({bins})))
SELECT metric, bin, round(lo + bin * ((hi - lo) / {bins}), 4) AS bin_start,
  round(lo + (bin + 1) * ((hi - lo) / {bins}), 4) AS bin_end, coalesce(n, 0) AS n
FROM grid LEFT JOIN counts USING (metric, bin)"""


ORACLES: dict[str, str] = {
    "episodes": EPISODES,
    "episodes_gap3": f"WITH {event_episodes(3)} SELECT * FROM episodes",
    "episode_rows": f"""WITH {EVENT_DAYS},{labelled("event_days", "user_id, event_type", "day")}
SELECT user_id, event_type, day, prev_date, CAST(date_gap AS INT) AS date_gap, episode_start_flag, episode_id
FROM labelled""",
    "episode_targets": f"""WITH {event_episodes()}
SELECT user_id, event_type, episode_id, trending_days, episode_start_date, episode_end_date, log_trending_days
FROM episodes""",
    "episode_join": EPISODES,
    "typed_snapshots": f"WITH {SNAP} SELECT {STANDARD} FROM typed",
    "standardize": f"WITH {SNAP} SELECT {STANDARD} FROM standard",
    "default_dedup": f"""WITH {SNAP}
SELECT video_id, country, trending_date_parsed, view_count, likes, comment_count FROM standard""",
    "optional_defaults": f"WITH {SNAP} SELECT event_id, video_id, 'UNKNOWN' AS country, '0' AS categoryId, '' AS title,"
    " '' AS description, '' AS tags, view_count FROM typed",
    "sane_snapshots": f"WITH {SNAP} SELECT {STANDARD} FROM sane",
    "clean_counts": f"""WITH {SNAP}
SELECT count(*) AS raw_rows,
  count(*) FILTER (video_id IS NOT NULL AND publish_timestamp IS NOT NULL AND trending_date_parsed IS NOT NULL)
    AS placed_rows,
  count(*) FILTER (video_id IS NULL) AS no_id,
  count(*) FILTER (publish_timestamp IS NULL) AS no_publish_time,
  count(*) FILTER (trending_date_parsed IS NULL) AS no_date,
  count(*) FILTER (likes > view_count) AS liked_beyond_views,
  count(*) FILTER (comment_count < 0) AS negative_comments
FROM typed""",
    "training_frame": f"{TRAINING} SELECT * FROM training",
    "training_columns": f"""{TRAINING}
SELECT trending_date_parsed, country, categoryId, trending_days, log_trending_days, {NUMERIC} FROM training""",
    "split_counts": f"""SELECT count(*) AS all_rows, count(*) FILTER (CAST(ts AS DATE) < {DAY}) AS train_rows,
  count(*) FILTER (CAST(ts AS DATE) >= {DAY}) AS test_rows FROM events""",
    "split_train": f"{EPISODES} WHERE episode_start_date < {DAY}",
    "split_test": f"{EPISODES} WHERE episode_start_date >= {DAY}",
    "split_train_purged": f"{EPISODES} WHERE episode_start_date < {DAY} AND episode_end_date < {DAY}",
    "features_numeric": f"""{FEATURED}
SELECT event_id, views_normalized, log_views, log_likes, log_comment_count FROM featured""",
    "features_time": f"""{FEATURED}
SELECT event_id, hours_to_trending, log_hours_to_trending, publish_hour, publish_day_of_week, publish_dow
FROM featured""",
    "features_ratio": f"""{FEATURED}
SELECT event_id, like_ratio, comment_ratio, engagement_rate, views_per_hour, likes_per_hour, comments_per_hour
FROM featured""",
    "features_text": """WITH tagged AS (
  SELECT *, CASE doc_id % 5 WHEN 2 THEN lang WHEN 3 THEN lang || '|' || source
    WHEN 4 THEN lang || '||' || source ELSE '' END AS tags FROM documents)
SELECT doc_id, tags, CAST(length(source || ' ' || lang) AS DOUBLE) AS title_length,
  CAST(length(text) AS DOUBLE) AS description_length,
  CASE WHEN tags = '' THEN 0.0 ELSE CAST(len(string_split(tags, '|')) AS DOUBLE) END AS tag_count
FROM tagged""",
    "mean_baseline": f"""{SPLIT}, raw AS (SELECT {METRICS} FROM baseline)
SELECT round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2, 'mean_baseline' AS model_name FROM raw""",
    "metrics_by_type": f"""{SPLIT}, raw AS (SELECT event_type, {METRICS} FROM baseline GROUP BY event_type)
SELECT event_type, round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(r2, 6) AS r2 FROM raw""",
    "model_table": f"{MODELS} SELECT * FROM scores ORDER BY rmse, model_name",
    "model_best": f"""{MODELS}
SELECT best.model_name AS best_model, best.rmse, best.mae, best.r2,
  base.rmse AS baseline_rmse, base.mae AS baseline_mae, base.r2 AS baseline_r2,
  (SELECT count(*) FROM scores) AS n_models
FROM (SELECT * FROM scores WHERE model_name <> 'mean_baseline' ORDER BY rmse, model_name LIMIT 1) best,
  (SELECT * FROM scores WHERE model_name = 'mean_baseline') base""",
    "model_union": f"""{MODELS}
SELECT *, CASE WHEN model_name = 'type_mean' THEN 'spark' ELSE 'optional' END AS model_family FROM scores""",
    "metrics_roundtrip": f"{MODELS} SELECT * FROM scores ORDER BY rmse, model_name",
    "category_index": """SELECT category, n,
  CAST(row_number() OVER (ORDER BY n DESC, category) - 1 AS DOUBLE) AS category_idx
FROM (SELECT CAST(user_id % 15 AS VARCHAR) AS category, count(*) AS n FROM events GROUP BY 1)""",
    "one_hot_slots": """WITH counts AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
known AS (SELECT *, row_number() OVER (ORDER BY n DESC, event_type) - 1 AS place FROM counts WHERE event_type <> 'error'),
size AS (SELECT count(*) AS labels FROM known)
SELECT event_type, counts.n, CAST(coalesce(place, labels) AS DOUBLE) AS idx, CAST(labels + 1 AS INT) AS slots,
  CAST(coalesce(place, labels) AS BIGINT) AS slot
FROM counts LEFT JOIN known USING (event_type) CROSS JOIN size""",
    "score_rule": f"""{TRAINING}
SELECT video_id, country, trending_date_parsed, views_normalized, log_views, log_likes, log_comment_count,
  engagement_rate, like_ratio, comment_ratio,
  round(exp(ln(1 + view_count) / 10 + like_ratio) - 1, 2) AS predicted_trending_days FROM training""",
    "stream_score_rule": f"""{FEED}
SELECT video_id, coalesce(title, '') AS title, coalesce(description, '') AS description, country,
  views_normalized AS views, likes, comment_count,
  round(exp(ln(1 + views_normalized) / 10 + like_ratio) - 1, 2) AS predicted_trending_days FROM featured""",
    "region_filter": f"""{PEOPLE} SELECT c_custkey, c_acctbal, r_name, "Trending_Country" FROM people
WHERE country IN ({_KEPT})""",
    "region_semi_join": f"""{PEOPLE} SELECT c_custkey, c_acctbal, r_name, "Trending_Country" FROM people
WHERE country IN (SELECT country FROM people WHERE c_acctbal > 9900)""",
    "extract_report": f"""{PEOPLE} SELECT count(*) AS scanned_rows, count(*) FILTER (country IN ({_KEPT})) AS kept_rows,
  string_agg(DISTINCT country, ',' ORDER BY country) FILTER (country IN ({_KEPT})) AS kept_countries FROM people""",
    "api_flatten": f"{API} SELECT {API_COLUMNS} FROM items",
    "api_category": f"{API} SELECT {API_COLUMNS} FROM items WHERE categoryId = '3' AND country = 'VN'",
    "api_capped": f"""{API}
SELECT {API_COLUMNS}, row_number() OVER (ORDER BY conv_id, turn, place) <= 500 AS within_limit FROM items""",
    "events_props_json": """SELECT event_id, CAST(regexp_extract(props, '"k": (-?[0-9]+)', 1) AS INT) AS k FROM events""",
    "to_json_roundtrip": "SELECT event_id, user_id, event_type, value, props FROM events",
    "message_checks": """SELECT count(*) AS messages,
  count(*) FILTER (event_id % 97 <> 5 AND event_id % 503 <> 0) AS valid,
  count(*) FILTER (event_id % 97 = 5) AS broken,
  count(*) FILTER (event_id % 97 <> 5 AND event_id % 503 = 0) AS blank_id FROM events""",
    "messages_rejected": "SELECT event_id, '{bad' AS message FROM events WHERE event_id % 97 = 5",
    "metric_summary": summary("lineitem", LINE_METRICS),
    "kpi_row": f"""SELECT {', '.join(f'round(avg({m}), 3) AS avg_{m}' for m in LINE_METRICS)}, count(*) AS points
FROM lineitem""",
    "histogram20": histogram("lineitem", LINE_METRICS),
    "engagement_norm": f"""WITH top AS (SELECT {', '.join(f'max({m}) AS max_{m}' for m in LINE_METRICS[:3])} FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {', '.join(LINE_METRICS[:3])},
  {', '.join(f'{m} / coalesce(nullif(max_{m}, 0), 1) * 100 AS {m}_pct' for m in LINE_METRICS[:3])}
FROM lineitem CROSS JOIN top""",
    "prediction_fields": f"""{PREDICTIONS}
SELECT event_id, video_id, console_views AS views, predicted_trending_days FROM points""",
    "metric_points": f"""{PREDICTIONS}
SELECT video_id, count(*) AS points, max(ts) AS last_seen, sum(views) AS views, sum(likes) AS likes,
  sum(comments) AS comments, max(predicted_trending_days) AS most_days FROM points GROUP BY video_id""",
    "latest_n": f"""{PREDICTIONS}
SELECT event_id, video_id,
  CASE WHEN predicted_trending_days >= 7 THEN 'hot' WHEN predicted_trending_days >= 2 THEN 'medium' ELSE 'cold' END AS tier,
  round(predicted_trending_days, 1) AS days
FROM points ORDER BY ts DESC, event_id DESC LIMIT 10""",
    "keep_last_n": """SELECT event_id, ts, user_id, event_type, value FROM events
ORDER BY ts DESC, event_id DESC LIMIT 500""",
    "timeline": "SELECT event_id, ts, value FROM events ORDER BY ts, event_id",
    "hotness": f"""{PREDICTIONS}
SELECT event_id,
  CASE WHEN predicted_trending_days >= 5 THEN 'hot' WHEN predicted_trending_days >= 2 THEN 'medium' ELSE 'cold' END
    AS console_tier,
  CASE WHEN predicted_trending_days >= 7 THEN 'hot' WHEN predicted_trending_days >= 2 THEN 'medium' ELSE 'cold' END
    AS dashboard_tier FROM points""",
    "csv_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "region_csv": f"""{PEOPLE} SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal,
  r_name, "Trending_Country" FROM people WHERE country IN ({_KEPT})""",
    "parquet_roundtrip": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, length(text) AS characters,
  md5(text) AS digest FROM documents""",
    "stream_features": f"""{FEED}
SELECT event_id, video_id, country, categoryId, hours_to_trending, {NUMERIC} FROM featured""",
    "stream_batch_time": """SELECT count(*) AS valid_rows, true AS after_start,
  CAST(least(count(*), 1) AS BIGINT) AS batch_times
FROM events WHERE event_id % 97 <> 5 AND event_id % 503 <> 0""",
    "stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_dedup_bounded": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_report": f"{PREDICTIONS} {summary('points', ('views', 'likes', 'comments', 'predicted_trending_days'))}",
}
