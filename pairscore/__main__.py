"""``spark-submit`` entry: ``python -m pairscore explore|features|search|fit|evaluate|explain|score|compare|translate|stream``."""

from __future__ import annotations

import argparse

from pairscore.plans import jobs
from pairscore.session import build_session, job_folder


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pairscore")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *required: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    made = command("explore", "source", "target", "scores", "out")
    made.add_argument("--bins", type=int, default=50)

    made = command("features", "source", "target", "scores", "out")
    made.add_argument("--sample-size", type=int)
    made.add_argument("--seed", type=int, default=42)
    made.add_argument("--limit", type=float, default=0.95)

    made = command("search", "features", "out")
    made.add_argument("--kind", choices=jobs.KINDS, default="mlp")
    made.add_argument("--space", help='JSON, {"name": [values]}')
    made.add_argument("--kfolds", type=int, default=5)
    made.add_argument("--test-ratio", type=float, default=0.1)

    made = command("fit", "table", "prepared", "params", "out")
    made.add_argument("--kind", choices=jobs.KINDS, default="mlp")

    made = command("evaluate", "table", "models", "out")
    made.add_argument("--kinds", nargs="+", choices=jobs.KINDS, required=True)

    made = command("explain", "table", "models", "out")
    made.add_argument("--kind", choices=jobs.KINDS, required=True)
    made.add_argument("--sample-size", type=int, default=200)

    command("score", "pairs", "model", "out")

    made = command("compare", "outputs", "model", "out")
    made.add_argument("--system", default="system")
    made.add_argument("--group", help="the column that tells outputs of one source; the source text by default")

    command("translate", "sources", "translator", "model", "out")

    made = command("stream", "pairs", "model", "out", "checkpoint")
    made.add_argument("--once", action="store_true")
    return top


def run(spark, arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    with job_folder(spark):
        run_command(spark, a)


def run_command(spark, a: argparse.Namespace) -> None:
    if a.command == "explore":
        jobs.run_explore(spark, a.source, a.target, a.scores, a.out, a.bins)
    elif a.command == "features":
        jobs.run_features(spark, a.source, a.target, a.scores, a.out, a.sample_size, a.seed, a.limit)
    elif a.command == "search":
        space = jobs.parse_space(a.space)
        jobs.run_search(spark, a.features, a.out, a.kind, space, a.kfolds, a.test_ratio)
    elif a.command == "fit":
        jobs.run_fit(spark, a.table, a.prepared, a.kind, a.params, a.out)
    elif a.command == "evaluate":
        jobs.run_evaluate(spark, a.table, a.models, a.kinds, a.out)
    elif a.command == "explain":
        jobs.run_explain(spark, a.table, a.models, a.kind, a.out, a.sample_size)
    elif a.command == "compare":
        jobs.run_compare(spark, a.outputs, a.model, a.out, a.system, a.group)
    elif a.command == "translate":
        jobs.run_translate(spark, a.sources, a.translator, a.model, a.out)
    elif a.command == "stream":
        jobs.run_stream(spark, a.pairs, a.model, a.out, a.checkpoint, a.once)
    else:
        jobs.run_score(spark, a.pairs, a.model, a.out)


if __name__ == "__main__":
    run(build_session())
