"""Jobs from the command line: ``python -m reviewlens <job> ...`` or through spark-submit."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from reviewlens.errors import UNREADABLE, brief
from reviewlens.operators import prepare as steps
from reviewlens.operators.quality import validation_rollup
from reviewlens.operators.topk import MIN_REVIEWS, TOP
from reviewlens.plans.analysis import COMBINED, save_analysis
from reviewlens.plans.datasets import prepare, preprocess, union_all
from reviewlens.plans.scripts import run_scripts
from reviewlens.plans.staged import analyze_datasets, list_datasets, sample_datasets, validate_datasets
from reviewlens.plans.top_lists import integrated_report, top_job
from reviewlens.session import build_session
from reviewlens.sinks import export, replace, write_json, write_parquet
from reviewlens.sources import (
    file_inventory,
    json_profile,
    read_events,
    read_processed,
    read_rating_pairs,
)
from reviewlens.streaming import rating_updates, read_stream, run_available
from reviewlens.streaming.ratings import daily_ratings, read_state, update_state


def _named(text: str) -> tuple[str, str]:
    name, _, path = text.partition("=")
    if not path:
        raise argparse.ArgumentTypeError(f"{text}: give NAME=PATH")
    return name, path


def _processed(spark: SparkSession, args) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Datasets by name, and the errors of those that cannot be opened."""
    frames, errors = read_processed(spark, dict(args.inputs))
    for name, error in errors.items():
        logging.error("%s: %s", name, error)
    return frames, errors


def run_preprocess(spark, args):
    return {"errors": preprocess(spark, dict(args.inputs), args.output, args.partitions)}


def run_validate(spark, args):
    """Validation report and whole frequency tables as JSON; a glance at them on the console.

    A dataset that fails, while it is opened or at any row, is a row of the report and stops no other.
    """
    frames, errors = _processed(spark, args)
    results, errors = validate_datasets(spark, frames, errors)
    for name, df in results.items():
        path = args.output if name == "validation_report" else f"{args.output}_{name}"
        write_json(df, path)
        shown = spark.read.schema(df.schema).json(path)
        (validation_rollup(shown) if name == "validation_report" else shown).show(truncate=False)
    return {"errors": errors}


def run_prepare(spark, args):
    frames, errors = read_processed(spark, dict(args.inputs))
    counts = {name: prepare(df, f"{args.output}/{name}") for name, df in frames.items()}
    return {**counts, "errors": errors}


def run_convert(spark, args):
    outcome = export(spark, dict(args.inputs), args.output)
    failed = {name: what for name, what in outcome.items() if what == "missing" or what.startswith("error: ")}
    return {**outcome, "errors": failed}


def run_top(spark, args):
    """Top lists from event CSV files, or from rating pairs with the dataset as category."""
    if args.pairs:
        frames = {name: read_rating_pairs(spark, path) for name, path in args.inputs}
        reviews = union_all(frames, "category")
    else:
        events = read_events(spark, [path for _, path in args.inputs], args.multi_line)
        reviews = steps.good_events(events)
        write_json(steps.rejected_events(events), f"{args.output}/rejected")
    top_job(reviews, args.output, args.top, args.min_reviews)
    # the report itself holds all lines
    spark.read.text(f"{args.output}/report").show(4 * args.top, truncate=False)


def run_analyze(spark, args):
    """Analysis of each dataset and of all combined, with the integrated report.

    Every dataset is read on its own: one that fails at any row is an error and no part of the results.
    """
    frames, errors = _processed(spark, args)
    results, failed = analyze_datasets(frames, COMBINED, args.date, args.length, args.rating)
    errors |= failed
    good = {name: df for name, df in frames.items() if name not in errors}
    if good:
        for name in [*good, COMBINED]:
            failed = save_analysis(results, f"{args.output}/{name}", name)
            errors |= {f"{name}/{analysis}": error for analysis, error in failed.items()}
    keyed = {name: df for name, df in good.items() if {"category", "product_id"} <= set(df.columns)}
    lists, failed = list_datasets(keyed, COMBINED)
    errors |= {f"{name}/lists": error for name, error in failed.items()}
    if lists is not None:
        try:
            write_parquet(integrated_report(lists, results), f"{args.output}/integrated_report")
        except UNREADABLE as error:
            errors["integrated_report"] = brief(error)
    return {"errors": errors}


def run_mapreduce(spark, args):
    """Mapper and reducer scripts over each input's text lines."""
    for name, path in args.inputs:
        run_scripts(
            spark, args.mapper, args.reducer, path, f"{args.output}/{name}", args.combiner, args.partitions,
            hot=args.hot_keys,
        ).show(truncate=False)


def run_sample(spark, args):
    """A repeatable sample as JSON: a share of the rows, or a number of them."""
    frames, errors = _processed(spark, args)
    drawn, failed = sample_datasets(frames, args.fraction, args.rows)
    if drawn is not None:
        write_json(drawn, args.output)
    return {"errors": errors | failed}


def run_stream(spark, args):
    """Means and counts per product and day of all files that came since the last run."""
    for name, path in args.inputs:
        changes = f"{args.output}/{name}/changes"
        events = read_stream(spark, path, spark.read.parquet(path).schema)
        updates = rating_updates(events, ["product_id"], args.date, args.rating)
        run_available(updates, changes, f"{args.output}/{name}/checkpoint")
        state = f"{args.output}/{name}/state"
        update_state(spark, changes, ["product_id"], state)
        replace(daily_ratings(read_state(spark, state)), f"{args.output}/{name}/daily", write_parquet)


def run_profile(spark, args):
    """The profile of every file, as JSON with ``--output``; a glance at it on the console."""
    for name, path in args.inputs:
        _shown(json_profile(spark, path), args, name)


def run_inventory(spark, args):
    """Every file with its size, as JSON with ``--output``; a glance at it on the console."""
    for name, path in args.inputs:
        _shown(file_inventory(spark, path), args, name)


def _shown(df: DataFrame, args, name: str) -> None:
    if args.output:
        write_json(df, f"{args.output}/{name}")
        df = df.sparkSession.read.schema(df.schema).json(f"{args.output}/{name}")
    df.show(truncate=False)


JOBS = {
    "preprocess": run_preprocess,
    "validate": run_validate,
    "prepare": run_prepare,
    "convert": run_convert,
    "top": run_top,
    "analyze": run_analyze,
    "mapreduce": run_mapreduce,
    "sample": run_sample,
    "stream": run_stream,
    "profile": run_profile,
    "inventory": run_inventory,
}


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None):
    parser = argparse.ArgumentParser(prog="reviewlens", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("inputs", nargs="+", type=_named, metavar="NAME=PATH")
    parser.add_argument("--output", help="folder to write to")
    parser.add_argument("--partitions", type=int, help="tasks for rows read from gz files, or reducers")
    parser.add_argument("--mapper", help="script for mapreduce")
    parser.add_argument("--reducer", help="script for mapreduce")
    parser.add_argument("--combiner", help="script for mapreduce, same line format in and out")
    parser.add_argument("--hot-keys", default="whole", choices=("whole", "refuse", "split"), help="keys with very many lines")
    parser.add_argument("--pairs", action="store_true", help="inputs are tab-separated rating pairs")
    parser.add_argument("--multi-line", action="store_true", help="event fields may hold line breaks")
    parser.add_argument("--fraction", type=float, default=0.01, help="share of rows to sample")
    parser.add_argument("--rows", type=int, help="number of rows to sample instead")
    parser.add_argument("--top", type=int, default=TOP)
    parser.add_argument("--min-reviews", type=int, default=MIN_REVIEWS)
    parser.add_argument("--date", default="timestamp", help="date column")
    parser.add_argument("--length", default="review_length", help="length column")
    parser.add_argument("--rating", default="rating", help="rating column")
    args = parser.parse_args(argv)
    if args.job not in ("profile", "inventory") and not args.output:
        parser.error("--output is needed")
    if args.job == "mapreduce" and not (args.mapper and args.reducer):
        parser.error("--mapper and --reducer are needed")
    outcome = JOBS[args.job](spark or build_session(), args)
    outcome = {key: value for key, value in (outcome or {}).items() if key != "errors" or value}
    if outcome:
        print(outcome)
    return outcome


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, stream=sys.stderr)
    sys.exit(1 if main().get("errors") else 0)
