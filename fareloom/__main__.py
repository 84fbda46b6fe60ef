"""Batch jobs, for spark-submit or ``python -m fareloom``.

    medallion RAW_DIR OUT_DIR               store the bronze, silver and gold layers
        [--drifted] [--pattern FEED=GLOB]... [--partition-by COLUMN]... [--source-files]
    wordcount PATH [-k K]                   show the most frequent words of text files
"""

import argparse

from fareloom.operators.text import top_words
from fareloom.plans import medallion
from fareloom.session import get_spark
from fareloom.sources.readers import read_text_lines


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="fareloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    layers = jobs.add_parser("medallion")
    layers.add_argument("raw_dir")
    layers.add_argument("out_dir")
    layers.add_argument("--drifted", action="store_true")
    layers.add_argument("--pattern", action="append", default=[], metavar="FEED=GLOB")
    layers.add_argument("--partition-by", action="append", default=[], metavar="COLUMN")
    layers.add_argument("--source-files", action="store_true")
    count = jobs.add_parser("wordcount")
    count.add_argument("path")
    count.add_argument("-k", type=int, default=20)
    options = parser.parse_args(arguments)

    spark = get_spark(f"fareloom-{options.job}")
    if options.job == "medallion":
        patterns = medallion.FEED_PATTERNS | dict(p.split("=", 1) for p in options.pattern)
        medallion.run(
            spark,
            options.raw_dir,
            options.out_dir,
            patterns,
            options.drifted,
            options.partition_by,
            options.source_files,
        )
    else:
        top_words(read_text_lines(spark, options.path), options.k).show(options.k, truncate=False)


if __name__ == "__main__":
    main()
