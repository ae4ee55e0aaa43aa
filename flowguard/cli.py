"""Command line: ``spark-submit -m flowguard`` / ``python -m flowguard`` with the runner's flags.

    python -m flowguard --data-dir s3://bucket/cicids --output-dir s3://bucket/out \
        --split both --size full --sample 0.3 --mode binary [--fast] [--models gbt,rf] [--no-class-weights]

The session comes from the environment (``spark-submit`` or an existing session); nothing about
memory, cores or partitions is set here.
"""

from __future__ import annotations

import argparse
import json
import sys

from flowguard.config import CICIDS_NORMAL_LABEL, KDD_NORMAL_LABEL, ExperimentConfig


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="flowguard", description="Train and compare flow classifiers on Spark.")
    p.add_argument("--data-dir", required=True, help="folder holding the capture files (any Hadoop file system)")
    p.add_argument("--output-dir", required=True, help="folder for result tables")
    p.add_argument("--dataset", choices=["cicids", "kdd"], default="cicids")
    p.add_argument("--split", choices=["random", "file", "hash", "both"], default="both")
    p.add_argument("--size", choices=["small", "medium", "full"], default="full", dest="data_size")
    p.add_argument("--sample", type=float, default=0.3, help="share of the training rows to fit on; test rows are all scored")
    p.add_argument("--keys", default="", help="comma-separated key columns of --split hash")
    p.add_argument("--mode", choices=["binary", "multiclass"], default="binary")
    p.add_argument("--fast", action="store_true", help="just the quick pair of models")
    p.add_argument("--no-class-weights", action="store_true")
    p.add_argument("--models", default="", help="comma-separated names or aliases (gbt, rf, nb, lr)")
    p.add_argument("--gbt-one-vs-rest", action="store_true", help="multiclass: GBT one-vs-rest instead of skipping it")
    args = p.parse_args(argv)
    if not 0.05 <= args.sample <= 1.0:
        p.error(f"--sample {args.sample:g} is outside 0.05 to 1")
    if (args.split == "hash") != bool(args.keys):
        p.error("--split hash and --keys go together")
    return args


def config_from_args(args: argparse.Namespace) -> ExperimentConfig:
    return ExperimentConfig(
        dataset=args.dataset,
        mode=args.mode,
        split="file" if args.split == "both" else args.split,
        data_size=args.data_size,
        sample_fraction=args.sample,
        key_cols=tuple(k.strip() for k in args.keys.split(",") if k.strip()),
        fast=args.fast,
        class_weights=not args.no_class_weights,
        models=tuple(m.strip().lower() for m in args.models.split(",") if m.strip()),
        normal_label=KDD_NORMAL_LABEL if args.dataset == "kdd" else CICIDS_NORMAL_LABEL,
        gbt_one_vs_rest=args.gbt_one_vs_rest,
    )


def main(argv: list[str] | None = None, spark=None) -> int:
    from pyspark.sql import SparkSession

    from flowguard.plans.run import run_and_export
    from flowguard.session import checkpoint_dir

    args = parse_args(argv)
    spark = spark or SparkSession.builder.appName("flowguard").getOrCreate()
    checkpoint_dir(spark)
    try:
        written = run_and_export(spark, args.data_dir, args.output_dir, config_from_args(args),
                                 both_splits=args.split == "both")
    except (FileNotFoundError, ValueError) as exc:
        print(f"flowguard: {exc}", file=sys.stderr)
        return 1
    print(json.dumps(written, indent=2))
    return 0
