"""Command line: ``spark-submit -m``-style entry to the jobs.

    python -m sentiseries extract  --input RAW --target SUBSET
    python -m sentiseries process  --input SUBSET --output OUT [--lexicon FILE]
    python -m sentiseries tests    --output OUT
    python -m sentiseries charts   --output OUT
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sentiseries.functions.scalars import Labels
from sentiseries.plans import jobs
from sentiseries.plans.settings import Settings


def main(arguments: list[str] | None = None) -> None:
    defaults = Settings()
    parser = argparse.ArgumentParser(prog="sentiseries")
    parser.add_argument("job", choices=("extract", "process", "tests", "charts"))
    parser.add_argument("--input", help="the collection for extract, its subset for process")
    parser.add_argument("--output", default=defaults.output_dir)
    parser.add_argument("--target", default="data/input/submissions")
    parser.add_argument("--lexicon")
    parser.add_argument("--full", action="store_true", help="process: make all months again, not only those whose files changed")
    parser.add_argument("--cut-date", default=defaults.cut_date)
    parser.add_argument("--top-k", type=int, default=defaults.top_k)
    parser.add_argument("--top-k-salts", type=int, default=defaults.top_k_salts)
    parser.add_argument("--alpha", type=float, default=defaults.alpha)
    parser.add_argument("--significant-cut", type=float, default=defaults.significant_cut)
    parser.add_argument("--bin-width", type=float, default=defaults.bin_width)
    names = defaults.labels
    parser.add_argument("--labels", nargs=3, default=[names.positive, names.neutral, names.negative],
                        metavar=("POSITIVE", "NEUTRAL", "NEGATIVE"))
    parser.add_argument("--communities", nargs="+", default=list(defaults.communities))
    parser.add_argument("--years", nargs="+", type=int, default=list(defaults.years))
    parser.add_argument("--format", choices=("parquet", "json"), default=defaults.table_format)
    options = parser.parse_args(arguments)
    settings = Settings(
        raw_dir=options.input or defaults.raw_dir, input_dir=options.input or defaults.input_dir,
        output_dir=options.output, lexicon_path=options.lexicon, labels=Labels(*options.labels),
        significant_cut=options.significant_cut, bin_width=options.bin_width, top_k_salts=options.top_k_salts,
        cut_date=options.cut_date, top_k=options.top_k, alpha=options.alpha,
        communities=tuple(options.communities), years=tuple(options.years),
        table_format=options.format,
    )
    spark = SparkSession.builder.appName(f"sentiseries {options.job}").getOrCreate()
    if options.job == "extract":
        jobs.extract(spark, settings, options.target)
    elif options.job == "process":
        jobs.process(spark, settings, options.full)
    elif options.job == "tests":
        jobs.run_tests(spark, settings)
    else:
        jobs.write_charts(spark, settings)


if __name__ == "__main__":
    main()
