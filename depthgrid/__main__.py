"""Command line: ``python -m depthgrid <step> --help``. Submit with spark-submit on a cluster."""

from __future__ import annotations

import argparse

from depthgrid.models.boosting import BoostedModel
from depthgrid.models.params import load_config
from depthgrid.operators.describe import describe_numeric, table_shape
from depthgrid.plans import evaluate, prepare, train
from depthgrid.schema import BASELINE, PAIR, PIXEL, PREDICTED, TARGET
from depthgrid.session import build_session
from depthgrid.sources import tables


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="depthgrid")
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, *paths: str, log: bool = True) -> argparse.ArgumentParser:
        sub = steps.add_parser(name)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        if log:
            sub.add_argument("--log_target", action="store_true", help="the model was fitted on log depths")
        return sub

    for name in ("prepare", "prepare-benchmark"):
        make = step(name, "output", log=False)
        make.add_argument("--input", help="folder of rasters; else give --cells and --layers")
        make.add_argument("--cells")
        make.add_argument("--layers")
        if name == "prepare":
            make.add_argument("--test_size", type=float, default=0.3)
    step("describe", "input", "target", "output", log=False)
    for name in ("train", "train-search"):
        fit = step(name, "input", "output", "config")
        fit.add_argument("--target", default=TARGET)
        fit.add_argument("--store", help="folder from which an interrupted run goes on")
        if name == "train-search":
            fit.add_argument("--sample_frac", type=float, default=0.1)
    score = step("predict", "model")
    tests = score.add_mutually_exclusive_group(required=True)
    tests.add_argument("--input", help="test sets as prepare writes them")
    tests.add_argument("--root_dir", help="folder with {huc8}/{period}_test.parquet at any depth")
    where = score.add_mutually_exclusive_group(required=True)
    where.add_argument("--output")
    where.add_argument("--staged", help="replace the test sets of --input, by way of this folder")
    step("evaluate", "model", "benchmark", "output").add_argument("--target", default=TARGET)
    for name in ("metrics", "classify", "density"):
        report = step(name, "input", "output", log=False)
        if name == "metrics":
            report.add_argument("--strict", action="store_true", help="drop rows with any missing column first")
        report.add_argument("--unlog_truth", action="store_true")
        report.add_argument("--unlog_prediction", action="store_true")
        if name == "density":
            report.add_argument("--owp_plot", action="store_true", help="baseline in place of prediction")
    bench = step("density-benchmark", "input", "output")
    bench.add_argument("--model")
    bench.add_argument("--owp_plot", action="store_true")
    bench.add_argument("--min_depth", type=float, default=0.0)
    bench.add_argument("--unlog_truth", action="store_true", help="stored depths are logs")
    return parser


def _store(table, output: str) -> None:
    """Write a report whole and say where it is; nothing is only printed."""
    table.write.parquet(output)
    print(f"written: {output}")


def _write_panels(panels: evaluate.DensityPanels, output: str) -> None:
    for name in ("metrics", "hexagons", "line"):
        _store(getattr(panels, name), f"{output}/{name}")


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"depthgrid {args.step}")
    if args.step in ("prepare", "prepare-benchmark"):
        _prepare(spark, args)
    elif args.step == "describe":
        rows = spark.read.parquet(args.input)
        _store(table_shape(rows), f"{args.output}/shape")
        _store(describe_numeric(rows, args.target), f"{args.output}/columns")
    elif args.step in ("train", "train-search"):
        rows, config = spark.read.parquet(args.input), load_config(args.config)
        options = {"keys": (*PAIR, *PIXEL), "target": args.target, "log_target": args.log_target, "store": args.store}
        if args.step == "train":
            trained = train.train(rows, config, **options)
        else:
            trained = train.train_with_search(rows, config, sample_share=args.sample_frac, **options)
        trained.model.save(spark, args.output)
        _store(trained.report, f"{args.output}/report")
    elif args.step == "predict":
        _predict(spark, args)
    elif args.step == "evaluate":
        model = BoostedModel.load(spark, args.model)
        metrics, average = evaluate.evaluate_benchmarks(
            spark, model, args.benchmark, args.output, args.target, args.log_target
        )
        print(f"written: {args.output}")
        _store(average, f"{args.output}-average")
        _store(metrics, f"{args.output}-table")
    elif args.step == "density-benchmark":
        model = BoostedModel.load(spark, args.model) if args.model else None
        panels = evaluate.benchmark_density_report(
            tables.load_benchmarks(spark, args.input), model, args.owp_plot, args.min_depth,
            args.log_target, args.unlog_truth,
        )
        _write_panels(panels, args.output)
    else:
        needed = [TARGET, BASELINE if getattr(args, "owp_plot", False) else PREDICTED]
        if args.step == "metrics":
            needed = [TARGET, PREDICTED, BASELINE]
        scored, skipped = tables.load_complete(spark, args.input, needed)
        unlog = {"unlog_truth": args.unlog_truth, "unlog_prediction": args.unlog_prediction}
        if args.step == "metrics":
            _store(evaluate.metrics_report(scored, **unlog, strict=args.strict), args.output)
        elif args.step == "classify":
            for name, table in evaluate.classification_report(scored, **unlog).items():
                _store(table, f"{args.output}/{name}")
        else:
            _write_panels(evaluate.density_report(scored, args.owp_plot, **unlog), args.output)
        _store(skipped, f"{args.output}-skipped")


def _prepare(spark, args) -> None:
    if bool(args.input) == bool(args.cells and args.layers):
        raise SystemExit("give --input, or --cells and --layers")
    if args.step == "prepare":
        if args.input:
            prepared = prepare.prepare_folder(spark, args.input, args.output, test_share=args.test_size)
        else:
            cells, layers = tables.load_cells(spark, args.cells), tables.load_layers(spark, args.layers)
            prepared = prepare.prepare(cells, layers, args.output, test_share=args.test_size)
        _store(prepared.counts, f"{args.output}/counts")
        _store(prepared.skipped, f"{args.output}/skipped")
    elif args.input:
        prepare.prepare_benchmark_folder(spark, args.input, args.output)
    else:
        prepare.prepare_benchmarks(
            tables.load_cells(spark, args.cells), tables.load_layers(spark, args.layers), args.output
        )


def _predict(spark, args) -> None:
    if args.staged and args.root_dir:
        raise SystemExit("--staged replaces partitions of --input only")
    model = BoostedModel.load(spark, args.model)
    if args.staged:
        skipped = evaluate.predict_in_place(spark, model, args.input, args.staged, args.log_target)
    elif args.root_dir:
        skipped = evaluate.predict_folder(spark, model, args.root_dir, args.output, args.log_target)
    else:
        skipped = evaluate.predict(spark, model, args.input, args.output, args.log_target)
    _store(skipped, f"{args.output or args.staged}-skipped")


if __name__ == "__main__":
    main()
