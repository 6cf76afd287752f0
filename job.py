"""Run a job: spark-submit --py-files tapeloom.zip job.py NAME [arguments]

NAME is build_features, rebuild_features, train_model or run_stream; see its --help.
"""

from __future__ import annotations

import importlib
import sys

JOBS = ("build_features", "rebuild_features", "train_model", "run_stream")


def main(argv: list[str]) -> None:
    if not argv or argv[0] not in JOBS:
        sys.exit(f"usage: job.py {{{','.join(JOBS)}}} [arguments]")
    result = importlib.import_module(f"tapeloom.plans.{argv[0]}").main(argv[1:])
    if result is not None:
        print(result)


if __name__ == "__main__":
    main(sys.argv[1:])
