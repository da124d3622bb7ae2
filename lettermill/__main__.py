"""Command line: build a dataset, import synthetic mail, show one message's record."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lettermill.config import BuildConfig


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lettermill", description=__doc__)
    does = top.add_subparsers(dest="command", required=True)

    d = BuildConfig()
    build = does.add_parser("build", help="raw mail to a split dataset of JSON lines")
    build.add_argument("--raw", default="data/raw", help="folder with one folder for each source")
    build.add_argument("--out", default="data/dataset.jsonl")
    build.add_argument("--seed", type=int, default=d.seed)
    build.add_argument("--sample-files", type=int, default=d.sample_files, help=f"files read of {d.sampled_source}; 0: all")
    build.add_argument("--limit-per-source", type=int, default=d.limit_per_source, help="0: no limit")
    build.add_argument("--near", choices=("lsh", "exact", "off"), default=d.near)
    build.add_argument("--near-threshold", type=float, default=d.near_threshold)
    build.add_argument("--near-permutations", type=int, default=d.near_permutations)
    build.add_argument("--near-max-cluster", type=int, default=d.near_max_cluster, help="members kept of a cluster; 0: all")
    build.add_argument("--shingle-words", type=int, default=d.shingle_words)
    build.add_argument("--language", choices=("any", "english"), default="english", help="which texts stay")

    take = does.add_parser("import", help="ready synthetic mail into a dataset's training part")
    take.add_argument("--dataset", default="data/dataset.jsonl")
    take.add_argument("--eml-dir", default="data/synthetic_raw", help="folder with one folder for each class")
    take.add_argument("--limit-per-class", type=int, default=0, help="0: no limit")
    take.add_argument("--manifest", help="where to write the run's settings and statistics")
    take.add_argument("--dry-run", action="store_true", help="report only")

    show = does.add_parser("record", help="the record of one message as JSON")
    show.add_argument("message", help="a file, or - for standard input")
    show.add_argument("--runtime", action="store_true", help="the detector's eighteen fields")
    for name in ("id", "source", "label", "split"):
        show.add_argument(f"--{name}")
    return top


def run(spark: SparkSession, argv: Sequence[str]) -> str:
    """What a command prints."""
    from lettermill import report
    from lettermill.functions.language import english
    from lettermill.operators import mime
    from lettermill.plans import build
    from lettermill.sources import mail, sinks

    args = parser().parse_args(argv)
    if args.command == "build":
        names = ("seed", "sample_files", "limit_per_source", "near", "near_threshold", "near_permutations", "near_max_cluster", "shingle_words")
        done = build.build_dataset(spark, args.raw, args.out, BuildConfig(**{n: getattr(args, n) for n in names}), english if args.language == "english" else build.every_language)
        return report.build_report(done.stats, args.out)
    if args.command == "import":
        stats = build.import_classes(spark, args.eml_dir, args.dataset, dry_run=args.dry_run, limit_per_class=args.limit_per_class, manifest=args.manifest)
        return report.import_report(stats, args.dry_run)
    if args.message == "-":
        raw = sys.stdin.buffer.read()
    else:
        with open(args.message, "rb") as f:
            raw = f.read()
    given = {n: F.lit(getattr(args, n)) for n in ("id", "source", "label", "split") if getattr(args, n) is not None}
    parsed = mime.parse_messages(mail.read_message(spark, raw))
    record = mime.runtime_record(parsed, **given) if args.runtime else mime.epi_record(parsed, **given)
    return sinks.to_json(record).first()["json"]


def main(argv: Sequence[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    parser().parse_args(argv)  # before a session starts
    spark = SparkSession.builder.appName("lettermill").getOrCreate()
    print(run(spark, argv))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
