"""Command line: ``python -m snapflow <job> ...`` (or give this file to ``spark-submit``)."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from snapflow.operators.report import engagement_percent, histogram, kpi_row, latest_feed, metric_summary, timeline
from snapflow.operators.split import DEFAULT_CUTOFF
from snapflow.plans import (
    aggregate_metrics, candidates, clean_snapshots, extract_regions, promote_best, score_table, train_models,
)
from snapflow.plans.episode_store import EpisodeStore
from snapflow.plans.learn import DEFAULT_DEPTH, DEFAULT_TREES, MODES
from snapflow.plans.training_frame import frame_of_episodes, intake_snapshots
from snapflow.sources import (
    csv_to_parquet, load_model, read_episode_table, read_snapshot_csv, read_topic, save_model,
    write_metrics, write_parquet, write_topic,
)
from snapflow.sources.kafka import as_messages
from snapflow.sources.pages import cap_results, flatten_pages
from snapflow.sources.registry import ModelRegistry
from snapflow.streaming import drop_repeats, read_live_table, resolve_checkpoint_dir, score_stream
from snapflow.streaming.checkpoint import POLICIES
from snapflow.streaming.live import compact_live_table, live_aggregates, live_histogram

logger = logging.getLogger("snapflow")


def _raw(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.format == "parquet":
        return spark.read.parquet(args.raw)
    return read_snapshot_csv(spark, args.raw, multi_line=not args.single_line)


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    """Raw snapshots (CSV or parquet) -> episode table."""
    if args.late_texts and args.format != "parquet":
        raise SystemExit("--late-texts needs --format parquet")
    rows = clean_snapshots(_raw(spark, args), args.out, args.max_gap_days, args.co_locate, args.late_texts)
    logger.info("Wrote %s episodes to %s", rows, args.out)


def intake(spark: SparkSession, args: argparse.Namespace) -> None:
    """Raw snapshots of new days -> store of episodes, which is brought up to date; with --out its episode table is written."""
    store = EpisodeStore(spark, args.store, args.max_gap_days)
    if args.raw:
        logger.info("Commit %s, days up to %s", intake_snapshots(_raw(spark, args), store), store.last_day())
    if args.out:
        write_parquet(frame_of_episodes(store.episodes()), args.out)


def convert(spark: SparkSession, args: argparse.Namespace) -> None:
    """CSV -> parquet."""
    csv_to_parquet(spark, args.source, args.target, multi_line=not args.single_line)


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rows of the Asia-Pacific countries -> CSV, with a report."""
    raw = read_snapshot_csv(spark, args.source, multi_line=not args.single_line)
    report = extract_regions(raw, args.target, column=args.column)
    logger.info("Wrote %s: %s", args.target, report)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    """Episode table -> models, their scores and a summary."""
    tries = candidates(args.model, args.num_trees, args.max_depth, tune=not args.no_tune)
    run = train_models(
        read_episode_table(spark, args.data), tries, args.cutoff, args.purge, args.model_dir, args.resume
    )
    if args.save_model:
        save_model(run.best, args.save_model)
    write_metrics(run.summary(), args.metrics)
    logger.info("Best model: %s %s", run.best_name, run.best_row)


def compare(spark: SparkSession, args: argparse.Namespace) -> None:
    """Scores of models trained apart -> one report, and the best model under a fixed path."""
    write_metrics(aggregate_metrics(spark, args.model_dir), args.metrics)
    logger.info("Best model: %s", promote_best(spark, args.model_dir, args.save_model))


def predict(spark: SparkSession, args: argparse.Namespace) -> None:
    """Episode table -> predictions."""
    scored = score_table(load_model(args.model_path), read_episode_table(spark, args.data))
    if args.out:
        write_parquet(scored, args.out)
    else:
        scored.show(truncate=False)


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """Trained model -> next version of a registry; streams that score from it take it with their next batch."""
    logger.info("Version %s of %s", ModelRegistry(spark, args.registry).publish(load_model(args.model_path)), args.registry)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """Topic of messages -> topic of predictions."""
    bound = {"maxOffsetsPerTrigger": str(args.max_offsets_per_trigger)} if args.max_offsets_per_trigger else {}
    messages = read_topic(
        spark, args.kafka_servers, args.input_topic, args.starting_offsets, not args.tolerate_lost_offsets, **bound
    )
    predictions = score_stream(
        messages, load_model(args.model_path), event_time_col=args.event_time_col, country_names=args.country_names
    )
    checkpoint = resolve_checkpoint_dir(spark, args.checkpoint_dir, args.checkpoint_policy)
    write_topic(predictions, args.kafka_servers, args.output_topic, checkpoint).awaitTermination()


def pages(spark: SparkSession, args: argparse.Namespace) -> None:
    """Landed pages of a listing API (parquet) -> one message per item and fetch, as files of JSON; with --once one per item."""
    rows = flatten_pages(
        spark.read.parquet(args.source), fetch_keys=args.fetch_keys, page_order=args.page_order, region=args.region, category_id=args.category
    )
    if args.limit is not None:
        rows = cap_results(rows, args.limit, [*args.page_order, "place"])
    if args.once:
        rows = drop_repeats(rows)
    as_messages(rows.drop("place", *args.page_order), "video_id").select("value").write.mode("overwrite").text(args.target)


REPORTS = {
    "summary": lambda rows, args: metric_summary(rows),
    "kpi": lambda rows, args: kpi_row(rows),
    "histogram": lambda rows, args: histogram(rows),
    "engagement": lambda rows, args: engagement_percent(rows),
    "timeline": lambda rows, args: timeline(rows),
    "feed": lambda rows, args: latest_feed(rows, args.newest, "timestamp", ["video_id"]),
}
KEPT_REPORTS = {"live-summary": live_aggregates, "live-histogram": live_histogram}


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Live table -> one of the reports; the live ones are read from the aggregates that its stream keeps."""
    if args.kind in KEPT_REPORTS:
        write_metrics(KEPT_REPORTS[args.kind](spark, args.live), args.out)
    else:
        write_metrics(REPORTS[args.kind](read_live_table(spark, args.live), args), args.out)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Batches of a live table -> few large files."""
    logger.info("Compacted %s batches of %s", compact_live_table(spark, args.live), args.live)


# --- fixed values: names of options and the paths and topics they default to ---
def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="snapflow", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(run) -> argparse.ArgumentParser:
        sub = jobs.add_parser(run.__name__, help=run.__doc__)
        sub.set_defaults(run=run)
        return sub

    p = job(clean)
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--format", choices=["csv", "parquet"], default="csv")
    p.add_argument("--max-gap-days", type=int, default=1)
    p.add_argument("--single-line", action="store_true", help="no cell holds a line break, so files can be split")
    p.add_argument("--co-locate", action="store_true", help="one exchange, for items with few snapshots per day")
    p.add_argument("--late-texts", action="store_true", help="read long texts only of the rows that stay; needs parquet")

    p = job(intake)
    p.add_argument("--store", required=True)
    p.add_argument("--raw", help="snapshots of days after those in the store")
    p.add_argument("--out", help="write the episode table here")
    p.add_argument("--format", choices=["csv", "parquet"], default="csv")
    p.add_argument("--max-gap-days", type=int, default=1)
    p.add_argument("--single-line", action="store_true", help="no cell holds a line break, so files can be split")

    p = job(convert)
    p.add_argument("source")
    p.add_argument("target")
    p.add_argument("--single-line", action="store_true", help="no cell holds a line break, so files can be split")

    p = job(extract)
    p.add_argument("source")
    p.add_argument("target")
    p.add_argument("--column", help="country column, found by name if not given")
    p.add_argument("--single-line", action="store_true", help="no cell holds a line break, so files can be split")

    p = job(train)
    p.add_argument("--data", required=True)
    p.add_argument("--model", choices=MODES, default="all")
    p.add_argument("--num-trees", type=int, default=DEFAULT_TREES)
    p.add_argument("--max-depth", type=int, default=DEFAULT_DEPTH)
    p.add_argument("--no-tune", action="store_true")
    p.add_argument("--cutoff", type=date.fromisoformat, default=DEFAULT_CUTOFF)
    p.add_argument("--purge", action="store_true", help="drop training episodes that run past the cutoff")
    p.add_argument("--resume", action="store_true", help="skip models that have scores already")
    p.add_argument("--model-dir", default="models")
    p.add_argument("--save-model")
    p.add_argument("--metrics", default="metrics/regression_metrics.json")

    p = job(compare)
    p.add_argument("--model-dir", default="models")
    p.add_argument("--metrics", default="metrics/regression_metrics.json")
    p.add_argument("--save-model", default="models/best")

    p = job(predict)
    p.add_argument("--model-path", required=True)
    p.add_argument("--data", required=True)
    p.add_argument("--out", help="write parquet here instead of showing rows")

    p = job(publish)
    p.add_argument("--model-path", required=True)
    p.add_argument("--registry", required=True)

    p = job(stream)
    p.add_argument("--model-path", required=True)
    p.add_argument("--checkpoint-dir", required=True)
    p.add_argument("--checkpoint-policy", choices=POLICIES, default="keep")
    p.add_argument("--kafka-servers", default="localhost:9092")
    p.add_argument("--input-topic", default="videos")
    p.add_argument("--output-topic", default="predictions")
    p.add_argument("--starting-offsets", choices=["earliest", "latest"], default="earliest")
    p.add_argument("--max-offsets-per-trigger", type=int, help="most messages of a batch; without it the first holds all")
    p.add_argument("--tolerate-lost-offsets", action="store_true", help="go on when the topic has dropped messages")
    p.add_argument("--event-time-col", help="column with the snapshot time, such as the broker's timestamp")
    p.add_argument("--country-names", type=json.loads, help="JSON object: country code of the feed -> name in training")

    p = job(pages)
    p.add_argument("source")
    p.add_argument("target")
    p.add_argument("--fetch-keys", nargs="+", required=True, help="columns that tell fetches apart")
    p.add_argument("--page-order", nargs="+", default=["page_no"])
    p.add_argument("--region", help="only pages of this region")
    p.add_argument("--category", help="only items of this category")
    p.add_argument("--limit", type=int, help="only so many items, in listing order")
    p.add_argument("--once", action="store_true", help="one message per item, whatever the fetch")

    p = job(report)
    p.add_argument("--live", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--kind", choices=[*REPORTS, *KEPT_REPORTS], default="summary")
    p.add_argument("--newest", type=int, default=10, help="length of the feed")

    p = job(compact)
    p.add_argument("--live", required=True)
    return top


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName(f"snapflow-{args.job}").getOrCreate(), args)


if __name__ == "__main__":
    main()
