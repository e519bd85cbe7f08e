"""Records that cannot be read, and runs that make only the months again whose files changed."""

import gzip
import json
import os

import pytest

from sentiseries import schemas
from sentiseries.plans import inputs, jobs
from sentiseries.plans.settings import Settings
from sentiseries.sources import submissions

TABLES = (jobs.COMMUNITY, jobs.OVERALL, jobs.OVERALL_BY_POSTS, jobs.SIGNIFICANT, jobs.SIGNIFICANT_BY_GROUP, "quarantine_counts")


def post(i, month, year=2020, **more):
    return {"subreddit": ("nyc", "london")[i % 2], "title": ("good", "bad", "very good", "x")[i % 4], "score": i, "year": year, "month": month} | more


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with (gzip.open if path.suffix == ".gz" else open)(path, "wt") as file:
        file.writelines((line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines)


def finished(spark, settings):
    rows = {name: sorted(map(str, spark.read.parquet(settings.table(name)).collect())) for name in TABLES}
    for name, schema in ((jobs.CLEANED, schemas.CLEANED_MARKED), (jobs.SCORED, schemas.SCORED)):
        table = submissions.read_table(spark, settings.table(name), schema)
        rows[name] = sorted(map(str, table.select(*schema.fieldNames()).collect()))
    return rows


def files(settings):
    top = settings.table(jobs.SCORED)
    return {os.path.join(d, f) for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")}


@pytest.fixture
def study(spark, tmp_path):
    for month in (1, 2, 3):
        write(tmp_path / "in" / "a" / f"m{month}.json.gz", [post(i, month) for i in range(30)])
    write(tmp_path / "in" / "b" / "mixed.json", [post(i, i % 3 + 1) for i in range(9)] + ["not json", post(1, 13), {"year": 2020, "month": 1}])
    settings = Settings(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"))
    assert jobs.process(spark, settings) is None
    return tmp_path, settings


def equals_a_full_run(spark, root, settings):
    other = Settings(input_dir=settings.input_dir, output_dir=str(root / "full"))
    jobs.process(spark, other, full=True)
    assert finished(spark, settings) == finished(spark, other)
    known = [sorted(map(str, spark.read.parquet(s.table(jobs.MANIFEST)).collect())) for s in (settings, other)]
    assert known[0] == known[1]


def test_bad_records_are_set_apart(spark, study):
    _, settings = study
    rows = jobs.quarantined(spark, settings).collect()
    assert sorted((r["reason"], r["unread"]) for r in rows) == [("no community", None), ("no month", None), ("not readable", "not json")] or {
        (r["reason"], r["unread"]) for r in rows
    } == {("no community", None), ("no month", None), ("not readable", "not json")}
    assert all(r["input_file"].endswith("mixed.json") for r in rows)
    counts = {(r["has_keys"], r["reason"]): r["posts"] for r in jobs.quarantine_counts(spark, settings).collect()}
    assert counts == {(True, None): 99, (False, "no community"): 1, (False, "no month"): 1, (False, "not readable"): 1}


def test_nothing_changed(spark, study):
    _, settings = study
    before = files(settings)
    assert jobs.process(spark, settings) == [] and files(settings) == before


def test_one_month_changed(spark, study):
    root, settings = study
    before = files(settings)
    write(root / "in" / "a" / "m2.json.gz", [post(i, 2, title="a crisis") for i in range(41)])
    assert jobs.process(spark, settings) == [(2020, 2)]
    kept = {f for f in before if "/month=2/" not in f}
    assert kept <= files(settings) and not (files(settings) - kept) & before
    equals_a_full_run(spark, root, settings)


def test_file_added_and_file_gone(spark, study):
    root, settings = study
    write(root / "in" / "c" / "new.json", [post(i, 7, 2021) for i in range(4)] + ['{"subreddit":"nyc","year":'])
    assert jobs.process(spark, settings) == [(2021, 7), (None, None)]
    equals_a_full_run(spark, root, settings)
    (root / "in" / "c" / "new.json").unlink()
    write(root / "in" / "b" / "mixed.json", [post(3, 1)])
    months = jobs.process(spark, settings)
    assert set(months) == {(2020, 1), (2020, 2), (2020, 3), (2020, 13), (2021, 7), (None, None)}
    assert not any("year=2021" in f for f in files(settings))
    assert jobs.quarantined(spark, settings).count() == 0
    equals_a_full_run(spark, root, settings)


def test_other_settings_make_all_months(spark, study):
    root, settings = study
    lexicon = root / "lexicon.txt"
    lexicon.write_text("good\t1.0\n")
    other = Settings(input_dir=settings.input_dir, output_dir=settings.output_dir, lexicon_path=str(lexicon))
    assert jobs.process(spark, other) is None and jobs.process(spark, other) == []
    lexicon.write_text("good\t1.0\nbad\t-1.0\n")
    assert jobs.process(spark, other) is None


def test_folders_of_months(spark, tmp_path):
    for month in (3, 11):
        rows = [{k: v for k, v in post(i, month).items() if k not in ("year", "month")} for i in range(5)]
        write(tmp_path / "in" / "year=2020" / f"month={month}" / "part one.json.gz", rows)
    settings = Settings(input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"))
    assert jobs.process(spark, settings) is None
    write(tmp_path / "in" / "year=2020" / "month=11" / "part two.json", [{"subreddit": "nyc", "title": "bad", "score": 3}, "{cut"])
    assert jobs.process(spark, settings) == [(2020, 11)]
    assert [r["unread"] for r in jobs.quarantined(spark, settings).collect()] == ["{cut"]
    equals_a_full_run(spark, tmp_path, settings)


def test_extract_passes_unread_records_on(spark, tmp_path):
    write(tmp_path / "raw" / "a.json", [post(0, 1), post(1, 1, 1999), post(0, 2, subreddit="other"), "broken {", post(2, 3, score="many")])
    settings = Settings(raw_dir=str(tmp_path / "raw"), input_dir=str(tmp_path / "subset"), output_dir=str(tmp_path / "out"), communities=("nyc",))
    jobs.extract(spark, settings, str(tmp_path / "subset" / "submissions"))
    jobs.process(spark, settings)
    apart = {r["unread"] for r in jobs.quarantined(spark, settings).collect()}
    assert apart == {"broken {", json.dumps(post(2, 3, score="many"))}
    assert spark.read.parquet(settings.table(jobs.SCORED)).count() == 1


@pytest.mark.parametrize("months", [None, [], [(2020, 1)], [(None, None)], [(2020, None), (2020, 1), (None, 1)]])
def test_in_months(spark, months):
    rows = [(y, m) for y in (2020, 2021, None) for m in (1, 2, None)]
    got = spark.createDataFrame(rows, "year int, month int").filter(inputs.in_months(months)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(r) for r in rows if months is None or r in months)
