"""Command line: python -m millrace RAW OUT [--config FILE] [option=value ...]

Reads the sources under RAW that the option ``names`` lists (all of the domain without it), and prepares training data in OUT,
unless it is there. Options are those of ``millrace.plans.corpus.Options``; those given here go before the file's.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.plans.corpus import Options, prepare
from millrace.sources.readers import read_config, read_sources, source_names


def main(args: list[str], spark: SparkSession | None = None) -> bool:
    """Whether anything was written."""
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    parser.add_argument("raw")
    parser.add_argument("out")
    parser.add_argument("--config")
    parser.add_argument("options", nargs="*", metavar="option=value")
    given = parser.parse_intermixed_args(args)
    values = read_config(given.config) if given.config else {}
    for x in given.options:
        name, equals, value = x.partition("=")
        if not equals:
            parser.error(f"not of the form option=value: {x}")
        values[name] = value
    options = Options.of(values)
    spark = spark or SparkSession.builder.appName("millrace").getOrCreate()
    found = read_sources(spark, options.names or source_names(options.domain), given.raw, options.domain)
    # Rows that bring no order of their own have that of the files.
    raw = {n: df if "_rid" in df.columns else df.withColumn("_rid", F.monotonically_increasing_id()) for n, df in found.items()}
    return prepare(raw, given.out, options)


if __name__ == "__main__":
    print("written" if main(sys.argv[1:]) else "already there")
