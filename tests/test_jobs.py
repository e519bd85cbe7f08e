"""The jobs from raw JSON to results, in both table formats."""

import json
import gzip

import pytest
from pyspark.sql import functions as F

from sentiseries.__main__ import main
from sentiseries.plans import jobs
from sentiseries.plans.settings import Settings
from sentiseries.sources import submissions

TITLES = ["great day", "bad news", "very good", "not good", "a crisis", "nothing", None]


def raw_posts():
    for i in range(1200):
        yield {
            "archived": False, "author": f"u{i % 9}", "created": i, "downs": 0, "gilded": 0, "name": f"t3_{i}",
            "num_comments": i % 5, "score": (i * 37) % 101, "selftext": "", "ups": 1,
            "subreddit": ("nyc", "london", "sydney", "elsewhere")[i % 4] if i % 97 else None,
            "title": TITLES[(i * i + i // 7) % len(TITLES)], "year": 2019 + (i // 400), "month": i % 12 + 1,
        }


@pytest.fixture(scope="module", params=["parquet", "json"])
def finished(spark, tmp_path_factory, request):
    root = tmp_path_factory.mktemp(request.param)
    raw = root / "raw" / "part"
    raw.mkdir(parents=True)
    with gzip.open(raw / "posts.json.gz", "wt") as file:
        file.writelines(json.dumps(post) + "\n" for post in raw_posts())
    target = str(root / "subset" / "submissions")
    options = ["--format", request.param]
    main(["extract", "--input", str(root / "raw"), "--target", target, *options])
    out = str(root / "out")
    for job in ("process", "tests", "charts"):
        main([job, "--input", str(root / "subset"), "--output", out, "--top-k", "3", *options])
    return Settings(input_dir=str(root / "subset"), output_dir=out, top_k=3, table_format=request.param)


def read(spark, settings, name):
    return spark.read.format(settings.table_format).load(settings.table(name))


def test_extract_keeps_the_communities(spark, finished):
    communities = {r[0] for r in read(spark, finished, jobs.SCORED).select("subreddit").distinct().collect()}
    assert communities == {"nyc", "london", "sydney"}


def test_rows_survive_scoring(spark, finished):
    expected = sum(p["subreddit"] in ("nyc", "london", "sydney") for p in raw_posts())
    assert read(spark, finished, jobs.SCORED).count() == expected
    assert jobs.quarantined(spark, finished).count() == 0


def test_series_cover_every_month(spark, finished):
    months = {(p["year"], p["month"]) for p in raw_posts() if p["title"] and p["subreddit"] in ("nyc", "london", "sydney")}
    assert read(spark, finished, jobs.OVERALL).count() == len(months)


def test_results_tables(spark, finished):
    overall = read(spark, finished, "results_overall")
    assert {r[0] for r in overall.select("test").distinct().collect()} == {
        "shapiro_wilk", "levene", "mann_whitney", "ttest_student", "mean_difference", "cohens_d",
    }
    assert overall.count() == 12
    significant = read(spark, finished, "results_significant")
    assert significant.count() == 6 + 3 + 1 + 2 + 6 + 6
    groups = read(spark, finished, "results_communities")
    assert groups.count() == 4 + 2 + 4 + 6 + 6 + 2 + 1 + 8 + 1 + 1


def test_period_means_and_quarantine_counts(spark, finished):
    means = read(spark, finished, "period_means").collect()
    assert len(means) == 2 * (2 + 3 + 3) and sum(r["n"] for r in means) > 0
    counted = {r["has_keys"]: r["posts"] for r in read(spark, finished, "quarantine_counts").collect()}
    assert counted == {True: read(spark, finished, jobs.SCORED).count()}


def test_scored_table_has_few_files(spark, finished):
    months = {(p["year"], p["month"]) for p in raw_posts()}
    files = read(spark, finished, jobs.SCORED).select(F.input_file_name()).distinct().count()
    assert files <= 2 * len(months)


def one_post(folder, name, **more):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt") as file:
        file.write(json.dumps({"subreddit": "nyc", "title": "x", "score": 1, **more}) + "\n")


def test_columns_come_from_folders_and_from_records(spark, tmp_path):
    one_post(tmp_path / "monthly" / "year=2019" / "month=3", "a.json.gz")
    one_post(tmp_path / "monthly" / "year=2020" / "month=11", "b.json.gz")
    one_post(tmp_path / "plain" / "deep", "c.json.gz", year=2021, month=5)
    one_post(tmp_path, "d.json.gz", year=2018, month=1)
    scan = submissions.scan_submissions(spark, str(tmp_path))
    assert {(r["year"], r["month"]) for r in scan.collect()} == {(2019, 3), (2020, 11), (2021, 5), (2018, 1)}
    subset = submissions.extract_subset(submissions.scan_submissions(spark, str(tmp_path / "monthly")), ["nyc"], [2019])
    assert subset.count() == 1
    plan = subset._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_extract_runs_twice_and_refuses_its_own_input(spark, tmp_path):
    one_post(tmp_path / "raw", "a.json.gz", year=2019, month=3)
    for _ in range(2):
        main(["extract", "--input", str(tmp_path / "raw"), "--target", str(tmp_path / "subset" / "submissions")])
        assert submissions.scan_submissions(spark, str(tmp_path / "subset")).count() == 1
    for target in (tmp_path / "raw" / "submissions", tmp_path / "raw", tmp_path):
        with pytest.raises(ValueError):
            main(["extract", "--input", str(tmp_path / "raw"), "--target", str(target)])
    assert submissions.scan_submissions(spark, str(tmp_path / "raw")).count() == 1


def test_chart_tables_exist(spark, finished):
    for name in jobs.chart_tables(spark, finished):
        assert read(spark, finished, f"charts/{name}").count() > 0
