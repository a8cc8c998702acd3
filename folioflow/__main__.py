"""Commands: run, metrics, report, compact, bench, compare, single."""

from __future__ import annotations

import argparse
import json
import os

from .config import FIRST_PAGE, MODES, Config, load_tree, lookup, new_run_id
from .session import build
from .sources.shared import clear_written


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="folioflow")
    parser.add_argument("--log", help="folder for the driver's log")
    parser.add_argument("--settings", help="YAML or JSON file; its mapping 'run' holds settings by their names, which the environment overrides")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="run the stages over a folder of documents, by the protocol set")
    run.add_argument("corpus")
    run.add_argument("store")
    run.add_argument("--only", nargs="*")
    run.add_argument("--through")
    run.add_argument("--doc")
    run.add_argument("--force", action="store_true")
    run.add_argument("--first-page", action="store_true")
    metrics = commands.add_parser("metrics", help="write stage and document metrics and totals, a second copy for each device")
    metrics.add_argument("tables")
    metrics.add_argument("target")
    report = commands.add_parser("report", help="write the report of the stage tables, or of a run of a store")
    report.add_argument("tables")
    report.add_argument("target")
    report.add_argument("--run", help="a run of the store given instead of tables")
    compact = commands.add_parser("compact", help="leave the last result of each document and fingerprints")
    compact.add_argument("store")
    compare = commands.add_parser("compare", help="run two or more modes and compare neighbours")
    compare.add_argument("corpus")
    compare.add_argument("store")
    compare.add_argument("--modes", default="full,page1")
    bench = commands.add_parser("bench", help="time one query of the catalog, or a grid of settings")
    bench.add_argument("query")
    bench.add_argument("tables")
    bench.add_argument("--target", help="file for the figures")
    bench.add_argument("--partitions", type=int, nargs="*")
    bench.add_argument("--scan-bytes", nargs="*", default=["128m"])
    single = commands.add_parser("single", help="ask a model once for each text; flagged replies are set apart")
    single.add_argument("documents")
    single.add_argument("target")
    single.add_argument("--backend", default="leading")
    return parser


def main(argv: list[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    spark = build("folioflow")
    if args.log:
        from .plans.log import start

        start(args.log)
    given = lookup(load_tree(args.settings), "run", {}) if args.settings else {}
    env = {**{f"NLP_{name.upper()}": str(value) for name, value in given.items()}, **os.environ}

    if args.command == "run":
        from .plans.runner import by_protocol

        config = Config.from_env({**(FIRST_PAGE if args.first_page else {}), **env})
        options = {} if config.protocol.upper() == "B" else {"only": args.only, "through": args.through, "wanted": args.doc, "force": args.force}
        print(json.dumps(by_protocol(spark, args.corpus, args.store, config, **options)))
    elif args.command == "metrics":
        from .plans.metrics import export

        export(spark, args.tables, args.target)
    elif args.command == "report":
        from .catalog.readside import report
        from .plans.report import as_json
        from .plans.runner import run_report

        rows = run_report(spark, args.tables, args.run) if args.run else report(spark, args.tables).orderBy("pdf_id", "run_id")
        as_json(rows).write.mode("overwrite").text(f"{args.target}/results")
    elif args.command == "compact":
        from .plans.runner import compact

        print(json.dumps(compact(spark, args.store)))
    elif args.command == "compare":
        from .plans.compare import diff
        from .plans.runner import results, run
        from .sources.tables import write_json

        modes = args.modes.split(",")
        if len(modes) < 2 or not set(modes) <= set(MODES):
            parser.error(f"at least two of {sorted(MODES)}")
        runs = {m: run(spark, args.corpus, f"{args.store}/{m}", Config.from_env({**env, **MODES[m]})) for m in modes}
        pairs = []
        for a, b in zip(modes, modes[1:]):
            rows = diff(results(spark, f"{args.store}/{a}"), results(spark, f"{args.store}/{b}"), "doc_id")
            name = f"{args.store}/diff-{a}-{b}"
            rows.orderBy("doc_id").write.mode("overwrite").json(name)
            pairs.append({"left": a, "right": b, "seconds": round(sum(runs[b].seconds.values()) - sum(runs[a].seconds.values()), 3), "rows": name})
        write_json(spark, {"modes": modes, "pairs": pairs}, f"{args.store}/compare-{new_run_id()}.json")
    elif args.command == "single":
        from .operators.singleturn import set_apart, single_turn

        documents = spark.read.parquet(args.documents)
        counts = set_apart(single_turn(documents.withColumn("number", documents["doc_id"]), args.backend), args.target)
        print(json.dumps(counts))
    else:
        from .catalog import queries
        from .plans.harness import environment, grid, timed
        from .sources.tables import write_json

        job = lambda: queries()[args.query](spark, args.tables)
        figures = {"cells": grid(spark, job, tuple(args.partitions), tuple(args.scan_bytes))} if args.partitions else timed(job)
        figures = {"query": args.query, "environment": environment(spark), **figures}
        if args.target:
            write_json(spark, figures, args.target)
        print(json.dumps(figures))
    clear_written(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
