"""The jobs on the command line: ``python -m loanlens train|score|explain``, or spark-submit.

The seven settings of ``Config.from_env`` are taken from the environment; ``--target``
overrides the label.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from loanlens.config import TARGET_DEFINITIONS, Config
from loanlens.plans.run import run_explain, run_full, run_score
from loanlens.sources.load import SourceLayout, load_all

SHEETS = ("dob", "income", "gender", "sales")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="loanlens", description=__doc__)
    out.add_argument("job", choices=("train", "score", "explain"))
    out.add_argument("--credit", required=True, help="folder with one file per snapshot date")
    for sheet in SHEETS:
        out.add_argument(f"--{sheet}", help=f"table of borrowers: {sheet}")
    out.add_argument("--nps", help="table of survey answers")
    out.add_argument("--out", required=True, help="folder for the results")
    out.add_argument("--model", help="folder of a saved model (score, explain)")
    out.add_argument("--target", choices=TARGET_DEFINITIONS, help="definition of the label")
    out.add_argument(
        "--snapshot",
        action="append",
        default=[],
        metavar="FILE=DATE",
        help="a snapshot file and its date; repeat for every file (default: the configured ones)",
    )
    out.add_argument("--early", action="append", default=[], metavar="DATE", help="an early date")
    return out


def config(args: argparse.Namespace) -> Config:
    cfg = Config.from_env()
    changes: dict = {}
    if args.target:
        changes["target_definition"] = args.target
    if args.snapshot:
        changes["snapshot_files"] = tuple(tuple(s.split("=", 1)) for s in args.snapshot)
    if args.early:
        changes["early_snapshots"] = tuple(args.early)
    return cfg.with_(**changes) if changes else cfg


def main(argv: Sequence[str] | None = None, cfg: Config | None = None) -> None:
    args = parser().parse_args(argv)
    if args.job != "train" and not args.model:
        raise SystemExit(f"{args.job} needs --model")
    cfg = cfg or config(args)
    spark = SparkSession.builder.appName(f"loanlens-{args.job}").getOrCreate()
    sheets = {name: getattr(args, name) for name in SHEETS if getattr(args, name)}
    sources = load_all(spark, SourceLayout(args.credit, sheets, args.nps), cfg)
    if args.job == "train":
        result = run_full(sources, args.out, cfg)
        result.metrics.show(truncate=False)
        result.bands.show(truncate=False)
    elif args.job == "score":
        run_score(spark, sources, args.model, args.out, cfg)
    else:
        rows = run_explain(spark, sources, args.model, cfg)
        rows.write.mode("overwrite").parquet(f"{args.out}/explanations")


if __name__ == "__main__":
    main()
