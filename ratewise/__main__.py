"""Run one job: ``spark-submit`` this package, or ``python -m ratewise JOB ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ratewise.plans import jobs


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ratewise", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    def command(name: str, *arguments: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=getattr(jobs, name).__doc__.splitlines()[0])
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    command("ingest", "input_path", "out")
    command("validate", "input_path", "out")
    command("label", "input_path", "out").add_argument("--run-id")
    features = command("build_features", "labeled_path", "out")
    features.add_argument("--run-id")
    features.add_argument("--fit-on", choices=("train", "all"), default="train")
    command("train", "out").add_argument("--run-id")
    command("evaluate", "out").add_argument("--run-id")
    scaling = command("summarise_scaling", "input_path", "output_path", "phase")
    scaling.add_argument("--extra", nargs="*", default=())
    return parser


def main(arguments: Sequence[str] | None = None) -> None:
    options = vars(_parser().parse_args(arguments))
    job = getattr(jobs, options.pop("job"))
    result = job(SparkSession.builder.appName("ratewise").getOrCreate(), **options)
    if isinstance(result, str):
        print(result)
    else:
        result.show(truncate=False)


if __name__ == "__main__":
    main()
