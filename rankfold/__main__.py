"""Command-line entry for spark-submit / ``python -m rankfold``.

Sub-commands mirror the reference's entry points:

  evaluate  metrics (+ group details) for one impression table
  tune      target-weight search on train / validation tables
  score     score a table with a saved pairwise model and measure it
  extract   training-slice extract (filter, project, ordered cut)

Inputs ending in ``.json`` / ``.jsonl`` / ``.ndjson`` (or directories of them,
with ``--format json``) are read as NDJSON with the explicit schema; anything
else as Parquet.  Results are written as Parquet.
"""

from __future__ import annotations

import argparse
import json

from rankfold.config import CLI_PLATFORMS, DEFAULT_FORMULA_PATH, DEFAULT_TARGETS, NAV_VIDEO_FOR_YOU
from rankfold.session import get_spark


def _read(spark, path: str, fmt: str, where=None):
    """The table at ``path``; ``where`` is applied before rows are numbered."""
    from rankfold.sources.extracts import read_impressions, with_file_positions
    if fmt == "json" or (fmt == "auto" and path.rstrip("/").endswith((".json", ".jsonl", ".ndjson"))):
        return read_impressions(spark, path, where=where)
    df = spark.read.parquet(path)
    if "pos" not in df.columns:
        return with_file_positions(df, where)
    return df if where is None else df.where(where)


def _vocab(spark, args) -> list[int]:
    from rankfold.operators.features import read_feature_names, resolve_vocabulary, vocabulary_ids
    if args.vocab_ids:
        return [int(x) for x in args.vocab_ids.split(",") if x]
    names = read_feature_names(spark, args.feature_names)
    dictionary = spark.read.parquet(args.dictionary) if not args.dictionary.endswith(".csv") else \
        spark.read.option("header", True).csv(args.dictionary).selectExpr("feature_name", "cast(feature_id as int) feature_id")
    return vocabulary_ids(resolve_vocabulary(names, dictionary))


def _slice_args(p):
    p.add_argument("--nav-screen", default=NAV_VIDEO_FOR_YOU)
    p.add_argument("--platforms", default=",".join(CLI_PLATFORMS))
    p.add_argument("--formula-path", default=DEFAULT_FORMULA_PATH)


def _vocab_args(p):
    p.add_argument("--vocab-ids", default="", help="comma-separated feature ids (else names + dictionary)")
    p.add_argument("--feature-names", default=None)
    p.add_argument("--dictionary", default=None, help="table with feature_name, feature_id")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="rankfold")
    ap.add_argument("--format", default="auto", choices=["auto", "json", "parquet"])
    common = argparse.ArgumentParser(add_help=False)  # the option may also stand behind the command
    common.add_argument("--format", default=argparse.SUPPRESS, choices=["auto", "json", "parquet"])
    commands = ap.add_subparsers(dest="cmd", required=True)

    class sub:
        @staticmethod
        def add_parser(name):
            return commands.add_parser(name, parents=[common])

    ev = sub.add_parser("evaluate")
    ev.add_argument("input")
    ev.add_argument("output")
    ev.add_argument("--targets", default=",".join(DEFAULT_TARGETS))
    ev.add_argument("--score-col", default="score")
    ev.add_argument("--no-slice", action="store_true")
    _slice_args(ev)

    tu = sub.add_parser("tune")
    tu.add_argument("train")
    tu.add_argument("validation")
    tu.add_argument("trials_path")
    tu.add_argument("--n-trials", type=int, default=3)
    tu.add_argument("--timeout", type=float, default=120.0)
    tu.add_argument("--seed", type=int, default=0)
    tu.add_argument("--target-name", default="watch_coverage_30s")
    tu.add_argument("--iterations", type=int, default=150)
    tu.add_argument("--metric", default="GAUCWeighted", help="a field of the target details")
    tu.add_argument("--together", type=int, default=8, help="trials fitted and measured in common passes")
    _slice_args(tu)
    tu.add_argument("--model-dir", default=None, help="save each trial's model as <dir>/trial_<n>")
    _vocab_args(tu)

    sc = sub.add_parser("score")
    sc.add_argument("validation")
    sc.add_argument("model_path")
    sc.add_argument("output")
    sc.add_argument("--target-name", default="watch_coverage_30s")
    sc.add_argument("--metric", default=None, help="print this field of the target details only")
    sc.add_argument("--no-slice", action="store_true")
    _slice_args(sc)
    _vocab_args(sc)

    ex = sub.add_parser("extract")
    ex.add_argument("input")
    ex.add_argument("output")
    ex.add_argument("--limit", type=int, default=500_000)
    ex.add_argument("--whole-sessions", action="store_true")
    _slice_args(ex)

    args = ap.parse_args(argv)
    spark = get_spark()

    if args.cmd == "evaluate":
        from rankfold.plans.evaluate import evaluate
        out = evaluate(_read(spark, args.input, args.format), args.targets.split(","), score_col=args.score_col,
                       sliced=not args.no_slice, platforms=args.platforms.split(","), nav_screen=args.nav_screen,
                       formula_path=args.formula_path)
        out["metrics"].write.mode("overwrite").parquet(f"{args.output}/metrics")
        out["group_details"].write.mode("overwrite").parquet(f"{args.output}/group_details")
        print(json.dumps([r.asDict() for r in out["summary"].collect()]))
    elif args.cmd == "tune":
        from rankfold.plans.jobs import tune_weights
        trials, best = tune_weights(spark, _read(spark, args.train, args.format),
                                    _read(spark, args.validation, args.format), _vocab(spark, args),
                                    trials_path=args.trials_path, n_trials=args.n_trials, timeout=args.timeout,
                                    seed=args.seed, target_name=args.target_name, max_iter=args.iterations,
                                    model_dir=args.model_dir, metric=args.metric, together=args.together,
                                    platforms=args.platforms.split(","), nav_screen=args.nav_screen, formula_path=args.formula_path)
        print(json.dumps(best.first().asDict()))
    elif args.cmd == "score":
        from rankfold.operators.metrics import lookup
        from rankfold.plans.jobs import score_and_measure
        vocab = _vocab(spark, args) if args.vocab_ids or args.feature_names else None  # the model names its own
        out = score_and_measure(_read(spark, args.validation, args.format), args.model_path, vocab,
                                {args.target_name: DEFAULT_TARGETS[args.target_name]},
                                output_path=f"{args.output}/scored", sliced=not args.no_slice, platforms=args.platforms.split(","),
                                nav_screen=args.nav_screen, formula_path=args.formula_path)
        out["metrics"].write.mode("overwrite").parquet(f"{args.output}/metrics")
        if args.metric:
            print(json.dumps({args.metric: lookup(out["target_details"], args.target_name, args.metric)}))
        else:
            print(json.dumps([r.asDict() for r in out["target_details"].collect()]))
    elif args.cmd == "extract":
        from rankfold.plans.jobs import write_training_extract
        from rankfold.sources.extracts import extract_predicate
        kept = extract_predicate(nav_screen=args.nav_screen, platforms=args.platforms.split(","), formula_path=args.formula_path)
        write_training_extract(_read(spark, args.input, args.format, kept), args.output, limit=args.limit,
                               whole_sessions=args.whole_sessions, nav_screen=args.nav_screen,
                               platforms=args.platforms.split(","), formula_path=args.formula_path)


if __name__ == "__main__":
    main()
