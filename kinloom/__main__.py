"""Commands: ``python -m kinloom block | validate | check``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from kinloom.plans import validate as V
from kinloom.plans.files import passed, run_blocking, validate
from kinloom.plans.run import Settings
from kinloom.sources import tsv


def parsed(args: list[str] | None = None) -> argparse.Namespace:
    top = argparse.ArgumentParser(prog="kinloom")
    commands = top.add_subparsers(dest="command", required=True)
    block = commands.add_parser("block", help="candidate lists of source 1 among sources 2 and 3")
    for name in ("--s1", "--s2", "--s3", "--out"):
        block.add_argument(name, required=True)
    block.add_argument("--s1-limit", type=int, default=0, help="first rows of source 1 only; 0 is all")
    block.add_argument("--no-header", action="store_true")
    check = commands.add_parser("validate", help="rules of result files; exit code 1 where one is broken")
    check.add_argument("-m", "--matching", required=True)
    check.add_argument("-c", "--candidate")
    check.add_argument("-t", "--test-dir", required=True)
    check.add_argument("--check-ids", action=argparse.BooleanOptionalAction, default=True)
    quick = commands.add_parser("check", help="shape of a header-less candidate file")
    quick.add_argument("file")
    return top.parse_args(args)


def main(args: list[str] | None = None) -> int:
    told = parsed(args)
    spark = SparkSession.builder.appName(f"kinloom {told.command}").getOrCreate()
    if told.command == "block":
        report = run_blocking(spark, told.s1, told.s2, told.s3, told.out, header=not told.no_header, settings=Settings(limit=max(0, told.s1_limit)))
        print("\n".join(report.lines()))
        return 0
    if told.command == "validate":
        rows = validate(spark, told.matching, told.candidate, told.test_dir, told.check_ids).orderBy("place").cache()
        for r in rows.collect():  # a row per rule
            print(f"{r.severity.upper()} {r.file} {r.check}: {r.n} ({r.examples})")
        good = passed(rows)
        print("passed" if good else "failed")
        return 0 if good else 1
    lines = tsv.read_lines(spark, told.file)
    print(V.output_check(lines).first().asDict())
    for r in V.output_examples(lines).orderBy("kind", "line").collect():  # ten rows at most
        print(f"line {r.line}: {r.kind} {r.example}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
