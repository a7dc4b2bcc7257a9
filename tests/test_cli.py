import datetime as dt
import json
import random

import pytest
from snapflow.__main__ import main, parser
from snapflow.plans.learn import MODES
from snapflow.sources.tables import read_snapshot_csv, write_csv


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    """Raw snapshots of 60 videos over 40 days, in CSV."""
    base = tmp_path_factory.mktemp("cli")
    rng = random.Random(2)
    rows = []
    for v in range(60):
        for day in range(40):
            if rng.random() < 0.6:
                date = dt.date(2025, 12, 10) + dt.timedelta(day)
                country = rng.choice(["Vietnam", " japan ", "France"])
                rows.append((f"v{v}", country, "2025-12-01T00:00:00Z", date.isoformat(), "1,000", "10", "1", 'a "b"\nc'))
    ddl = "video_id string, video_trending_country string, publish_date string, trending_date string, views string, likes string, comment_count string, title string"
    write_csv(spark.createDataFrame(rows, ddl), str(base / "raw"))
    return base


def test_jobs_end_to_end(spark, work):
    at = lambda name: str(work / name)
    main(["extract", at("raw"), at("asia")])
    kept = {r[0].strip().upper() for r in read_snapshot_csv(spark, at("asia")).select("video_trending_country").distinct().collect()}
    assert kept == {"VIETNAM", "JAPAN"}
    main(["convert", at("asia"), at("asia.parquet")])
    main(["clean", "--raw", at("asia.parquet"), "--format", "parquet", "--out", at("episodes")])
    main(["clean", "--raw", at("asia"), "--out", at("episodes_csv")])
    episodes = spark.read.parquet(at("episodes"))
    assert episodes.exceptAll(spark.read.parquet(at("episodes_csv"))).count() == 0 < episodes.count()
    main(["train", "--data", at("episodes"), "--model", "linear_regression", "--model-dir", at("models"),
          "--save-model", at("best"), "--metrics", at("metrics")])
    assert spark.read.json(at("metrics")).first()["best_model"] == "linear_regression"
    main(["compare", "--model-dir", at("models"), "--metrics", at("compared"), "--save-model", at("promoted")])
    main(["predict", "--model-path", at("promoted"), "--data", at("episodes"), "--out", at("scored")])
    assert spark.read.parquet(at("scored")).count() == episodes.count()
    main(["predict", "--model-path", at("best"), "--data", at("episodes")])


def test_pages_and_report(spark, work):
    page = {"items": [{"id": "a", "snippet": {"title": "t"}, "statistics": {"viewCount": "5", "likeCount": "1", "commentCount": "0"}}]}
    rows = [(json.dumps(page), region, 1, day) for region in ("VN", "TH") for day in (1, 2)]
    spark.createDataFrame(rows, "value string, region_code string, page_no int, day int").write.parquet(str(work / "pages"))
    main(["pages", str(work / "pages"), str(work / "messages"), "--fetch-keys", "region_code", "day"])
    sent = [json.loads(r[0]) for r in spark.read.text(str(work / "messages")).collect()]
    assert sorted((m["country"], m["day"], m["views"]) for m in sent) == [("TH", 1, 5.0), ("TH", 2, 5.0), ("VN", 1, 5.0), ("VN", 2, 5.0)]
    points = "video_id string, timestamp timestamp, views double, likes double, comments double, predicted_trending_days double"
    spark.createDataFrame([("a", None, 2.0, 1.0, 0.0, 3.0)], points).write.parquet(str(work / "live/run_id=x/batch_id=0"))
    main(["report", "--live", str(work / "live"), "--out", str(work / "report")])
    assert spark.read.json(str(work / "report")).count() > 0


def test_arguments():
    args = parser().parse_args(["train", "--data", "x", "--cutoff", "2025-05-01", "--no-tune"])
    assert (args.cutoff, args.no_tune, args.model) == (dt.date(2025, 5, 1), True, MODES[0])
    with pytest.raises(SystemExit):
        parser().parse_args(["stream", "--model-path", "m"])
