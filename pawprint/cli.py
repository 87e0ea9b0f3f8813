"""Command-line entry points: ``python -m pawprint {prepare,train,evaluate}``.

Thin wrappers over the job functions of ``pawprint.plans.search``; argument
names and defaults follow the reference's scripts. Evaluation takes the
folder of per-species models written by ``train`` (not a single model file).
"""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import functions as F


# Argument names and defaults follow the reference's scripts.
def parse_args(args_list: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pawprint", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)

    prep = sub.add_parser("prepare", help="split raw records into train/test")
    prep.add_argument("raw_csv_path", type=Path, help="path to the raw records CSV")
    prep.add_argument("--output-dir", type=Path, default=Path("data/split_data"))
    prep.add_argument("--test-size", type=float, default=0.2)
    prep.add_argument("--random-state", type=int, default=42)

    train = sub.add_parser("train", help="one model tournament per species")
    train.add_argument("features_path", type=Path, nargs="?",
                       default=Path("data/split_data/train_features.csv"))
    train.add_argument("target_path", type=Path, nargs="?",
                       default=Path("data/split_data/train_target.csv"))
    train.add_argument("--models-dir", type=Path, default=Path("models"))
    train.add_argument("--grid", choices=("full", "minimal"), default="full",
                       help="full search grids, or one candidate per family")
    train.add_argument("--n-folds", type=int, default=5)

    ev = sub.add_parser("evaluate", help="score the saved models on the test split")
    ev.add_argument("--test-features", type=Path,
                    default=Path("data/split_data/test_features.csv"))
    ev.add_argument("--test-target", type=Path, default=Path("data/split_data/test_target.csv"))
    ev.add_argument("--models-dir", type=Path, default=Path("models"))
    ev.add_argument("--output-metrics", type=Path, default=Path("metrics.json"))
    return parser.parse_args(args_list)


def _features_and_target(spark, features_path: Path, target_path: Path):
    from pawprint.sources import io
    from pawprint.sources.schema import KEY, TARGET
    feats = io.read_raw(spark, str(features_path), "csv")
    target = io.read_raw(spark, str(target_path), "csv")
    feats = feats.withColumn(KEY, F.col(KEY).cast("bigint"))
    target = target.select(F.col(KEY).cast("bigint").alias(KEY), TARGET)
    return feats, target


def main(args_list: list[str] | None = None) -> None:
    from pawprint.plans import search
    from pawprint.session import get_spark
    from pawprint.sources import io
    args = parse_args(args_list)
    spark = get_spark()
    if args.command == "prepare":
        search.prepare_job(spark, str(args.raw_csv_path), str(args.output_dir),
                           args.test_size, args.random_state, four_way_csv=True)
    elif args.command == "train":
        feats, target = _features_and_target(spark, args.features_path, args.target_path)
        grids = None
        if args.grid == "minimal":
            grids = search.short_search_spaces()
        metas = search.train_all(feats, target, str(args.models_dir), grids=grids,
                                 n_folds=args.n_folds)
        print(json.dumps(metas, default=str, indent=2))
    else:
        feats, target = _features_and_target(spark, args.test_features, args.test_target)
        test = io.align_features_target(feats, target)
        rows = search.evaluate_models(spark, test, str(args.models_dir))
        io.write_json_row(spark, {"metrics": [r.asDict() for r in rows.collect()]},
                          str(args.output_metrics))
