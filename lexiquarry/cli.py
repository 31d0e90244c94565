"""Command line: `pairs` makes training pairs of a directory, `splits` of several below one root, `renamed` renames files
one by one, `classes` makes sources of a file of lines."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from lexiquarry.plans import training_pairs
from lexiquarry.session import ship
from lexiquarry.sources import files, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lexiquarry", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    pairs = sub.add_parser("pairs", help="training pairs of a directory of .java files")
    pairs.add_argument("-i", "--input", required=True)
    pairs.add_argument("-o", "--output", required=True)
    pairs.add_argument("-j", "--jsonl-output", help="where pairs go, if not to the output")
    pairs.add_argument("-b", "--blanked-subdir", action="store_true", help="keep recovered sources, blanked, beside the output")
    splits = sub.add_parser("splits", help="training pairs of the directories of several splits, one after the other")
    splits.add_argument("-i", "--input", required=True, help="where {split} stands for the split's name")
    splits.add_argument("-o", "--output", required=True, help="the same")
    splits.add_argument("-b", "--blanked-subdir", action="store_true")
    splits.add_argument("splits", nargs="*", default=["test", "val", "train"])
    renamed = sub.add_parser("renamed", help="a renamed .java file for each in a directory")
    renamed.add_argument("-i", "--input", required=True)
    renamed.add_argument("-o", "--output", required=True)
    classes = sub.add_parser("classes", help="one class per line of a text file")
    classes.add_argument("-f", "--file", required=True)
    classes.add_argument("-d", "--dir", required=True)
    classes.add_argument("-s", "--size", choices=sorted(files.SIZES), default="s")
    return top


def main(args: list[str] | None = None) -> int:
    options = parser().parse_args(args)
    spark = SparkSession.builder.appName("lexiquarry").getOrCreate()  # the master is spark-submit's, or local
    ship(spark)
    if options.command == "classes":
        sinks.write_texts(files.classes_of(spark, options.file, options.size), options.dir)
        return 0
    jobs = [(options.input, options.output)]
    if options.command == "splits":
        jobs = [(options.input.replace("{split}", x), options.output.replace("{split}", x)) for x in options.splits]
    for source, _ in jobs:
        if not sinks._exists(spark, source)[2]:
            print(f"no such directory: {source}", file=sys.stderr)
            return 1
    if options.command == "renamed":
        for r in training_pairs.obfuscate_files(spark, options.input, options.output).toLocalIterator():
            print(f"{r['source_file']}: {r['error']}", file=sys.stderr)
        return 0
    for source, target in jobs:
        pairs = getattr(options, "jsonl_output", None)
        tell = lambda name, n: print(f"{source}: {name} {n}", file=sys.stderr)  # noqa: E731, B023
        counts = training_pairs.run(spark, source, target, pairs, options.blanked_subdir, tell)
        print(", ".join(f"{k}: {n}" for k, n in counts.items()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
