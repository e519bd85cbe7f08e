"""Which months a run has to make again: the input files and what is known of them.

A finished run leaves a manifest: for each input file its size, time and the months of its
rows. The next run lists the files again. Months of files that are new, changed or gone
are made again, from those files and the unchanged ones that share a month with them;
nothing else is read. The manifest is written last, so a run that broke off is made again
by the next one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sentiseries import schemas
from sentiseries.sources import submissions
from sentiseries.sources.storage import stored

KEYS = ("file", "size", "modified")
MONTH = ("year", "month")
FILE = "input_file"
Month = tuple[int | None, int | None]


@dataclass
class Change:
    """What a run reads and makes again.

    ``months`` are the months to make, or None for all; ``files`` the files to read for
    them, or None for all; ``listing`` all input files; ``manifest`` what holds after the
    run, None if only the cleaned rows will tell; ``stale`` the (has_keys, year, month)
    that hold no rows any more.
    """

    months: list[Month] | None
    files: list[str] | None
    listing: DataFrame
    manifest: DataFrame | None
    stale: list[tuple[bool, int | None, int | None]]

    @property
    def nothing(self) -> bool:
        return self.months == []


def in_months(months: list[Month] | None) -> Column:
    """Rows of ``months``, nulls included; of all months for None."""
    if months is None:
        return F.lit(True)
    one = F.lit(False)
    by_year: dict[int | None, list[int | None]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    for year, inside in by_year.items():
        of = F.col("month").isin([m for m in inside if m is not None])
        of = F.coalesce(of, F.lit(False)) | F.col("month").isNull() if None in inside else of
        one = one | (F.col("year").eqNullSafe(F.lit(year).cast("int")) & of)
    return one


def manifest_of(listing: DataFrame, marked: DataFrame) -> DataFrame:
    """The manifest of ``listing`` given cleaned rows; a file without rows has one row without a month."""
    months = marked.select(F.col(FILE).alias("from"), "has_keys", *MONTH).distinct()
    return listing.join(months, F.col("file") == F.col("from"), "left").select(*schemas.INPUT_MONTHS.fieldNames())


def changes(spark: SparkSession, path: str, known: DataFrame | None) -> Change:
    """What is to be made again for the input under ``path``, given the last run's manifest."""
    listing = stored(submissions.list_files(spark, path), "input_files")
    if known is None:
        return Change(None, None, listing, None, [])
    fresh = listing.join(known.select(*KEYS).distinct(), list(KEYS), "left_anti").select(*listing.columns)
    gone = known.join(listing.select(*KEYS), list(KEYS), "left_anti").select(*known.columns)
    same = known.join(listing.select(*KEYS), list(KEYS), "left_semi").select(*known.columns)
    rows = submissions.scan_multi_dir(spark, path, unread=True, files=[r["path"] for r in fresh.select("path").collect()], source=FILE)
    new = stored(manifest_of(fresh, submissions.clean_marked(rows)), "fresh_months")
    manifest = stored(same.union(new), "manifest")
    touched = new.union(gone).filter("has_keys is not null").select(*MONTH).distinct()
    months = sorted((tuple(r) for r in touched.collect()), key=repr)
    held = manifest.filter("has_keys is not null").filter(in_months(months))
    here = {tuple(r) for r in held.select("has_keys", *MONTH).distinct().collect()}
    stale = [(keys, *m) for m in months for keys in (True, False) if (keys, *m) not in here]
    return Change(months, [r["path"] for r in held.select("path").distinct().collect()], listing, manifest, stale)
