"""Job: feature bars to a fitted model with metadata.

    spark-submit job.py train_model SYMBOL [options]
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .. import session
from ..operators import bars, labels, training
from ..sources import features, models, paths
from .build_features import DEFAULT_OUTDIR

DEFAULT_MODEL_DIR = "storage/models"


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("symbol")
    parser.add_argument("--features")
    parser.add_argument("--freq", default=bars.DEFAULT_RULE)
    parser.add_argument("--horizon", type=int, default=labels.DEFAULT_HORIZON)
    parser.add_argument("--threshold", type=float, default=labels.DEFAULT_THRESHOLD)
    parser.add_argument("--features-dir", default=DEFAULT_OUTDIR)
    parser.add_argument("--model-dir", default=DEFAULT_MODEL_DIR)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> tuple[str, dict[str, float]]:
    args = arguments(argv)
    spark = spark or session.create("train_model")
    source = args.features or paths.features_path(args.features_dir, args.symbol, args.freq)
    chunk_bits = labels.chunk_bits_of(args.freq, args.horizon)
    # The tables that training writes go when the model is saved.
    with session.scope(spark):
        dataset = labels.build_targets(features.load_features(spark, source), args.horizon, args.threshold, chunk_bits=chunk_bits)
        bundle, quality = training.train(dataset, labels.numeric_features(dataset))
        target = paths.model_path(args.model_dir, args.symbol, args.freq, args.horizon)
        metadata = {
            "symbol": args.symbol,
            "feature_path": source,
            "horizon": args.horizon,
            "threshold": args.threshold,
            "metrics": quality,
        }
        return models.save_model(spark, bundle, target, metadata), quality


if __name__ == "__main__":
    saved, scores = main()
    print(saved)
    print(json.dumps(scores, indent=2))
