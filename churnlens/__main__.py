"""Steps of a run for ``spark-submit``; each reads what the ones before wrote.

    prepare JSON OUT      reports OUT      features OUT
    train OUT CLASSIFIER  choose OUT CHOICE
    chosen OUT CHOICE     (train the chosen classifier on the data of OUT)
"""

from __future__ import annotations

import sys

from churnlens.plans.features import write_features
from churnlens.plans.prepare import Layout, prepare
from churnlens.plans.reports import write_reports
from churnlens.plans.training import choose, train
from churnlens.session import build_session
from churnlens.sources.scores import read_choice

STEPS = {
    "prepare": (2, lambda spark, json, out: prepare(spark, json, out)),
    "reports": (1, lambda spark, out: write_reports(spark, Layout(out))),
    "features": (1, lambda spark, out: write_features(spark, Layout(out))),
    "train": (2, lambda spark, out, name: train(spark, Layout(out), name)),
    "choose": (2, lambda spark, out, choice: choose(spark, Layout(out), choice)),
    "chosen": (2, lambda spark, out, choice: train(spark, Layout(out), read_choice(spark, choice))),
}


def main(args: list[str]) -> int:
    if not args or args[0] not in STEPS or len(args) - 1 != STEPS[args[0]][0]:
        print(__doc__, file=sys.stderr)
        return 2
    STEPS[args[0]][1](build_session(f"churnlens {args[0]}"), *args[1:])
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
