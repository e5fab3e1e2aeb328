"""Command lines: ``python -m kinlink.plans.cli run|audit ...``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .audit import Report, audit
from .pipeline import Options, run


def _session() -> SparkSession:
    return SparkSession.builder.appName("kinlink").getOrCreate()


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kinlink")
    sub = p.add_subparsers(dest="command", required=True)
    # The contract's option names and defaults.
    r = sub.add_parser("run", help="index, match and write both result files")
    r.add_argument("--data-dir", default="dataset")
    r.add_argument("--output-dir", default="output")
    r.add_argument("--work-dir", default="work")
    r.add_argument("--mode", choices=("baseline", "xgboost", "trees"), default="baseline", help="xgboost is an alias of trees")
    r.add_argument("--max-candidates", type=int, default=60)
    r.add_argument("--validation-entities", type=int, default=1000)
    r.add_argument("--training-entities", type=int, default=4000)
    r.add_argument("--batch-size", type=int, default=250, help="accepted for parity; partitions bound memory")
    r.add_argument("--index-chunk-size", type=int, default=10_000, help="accepted for parity; partitions bound memory")
    r.add_argument("--threshold", type=float, default=0.78)
    a = sub.add_parser("audit", help="check result files")
    a.add_argument("--matching", default="output/matching_results.tsv")
    a.add_argument("--candidate", default="output/candidate_pairs.tsv")
    a.add_argument("--test-dir", default="dataset/test")
    a.add_argument("--check-ids", action="store_true")
    return p


def _tell(report: Report) -> int:
    for name, (rows, empty) in report.counts.items():
        print(f"{name}: {rows} rows, {empty} empty, {rows - empty} with ids")
    for w in report.warnings:
        print(f"warning: {w}")
    for e in report.errors:
        print(f"error: {e}")
    print("rejected" if report.errors else "accepted")
    return report.exit_code


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = _session()
    try:
        if args.command == "audit":
            return _tell(audit(spark, args.matching, args.candidate, args.test_dir, args.check_ids))
        options = Options(args.data_dir, args.output_dir, args.work_dir, args.mode, args.max_candidates, args.validation_entities, args.training_entities, args.threshold)
        score, report = run(spark, options)
        print(f"validation F0.5: {score:.6f}")
        return _tell(report)
    except (OSError, UnicodeDecodeError) as e:
        print(f"error: {e}")
        return 1


if __name__ == "__main__":
    sys.exit(main())
