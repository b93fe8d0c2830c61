"""Commands: normalize, clean, transform, sample, pipeline. Exit code 0 if all went well, 1 if nothing could be done."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Callable

from fissure.operators import benchmark, review
from fissure.plans import pipeline
from fissure.session import session
from fissure.sources import sinks

log = logging.getLogger("fissure")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="fissure", description="Curate corpora of vulnerable and fixed code.")
    commands = out.add_subparsers(dest="command", required=True)
    for name, help_ in (("normalize", "raw datasets to canonical rows"), ("clean", "canonical rows to cleaned rows"), ("transform", "cleaned rows to entries"), ("sample", "one entry per source"), ("optimize", "entries cut down to their changes, as JSON lines"), ("pipeline", "all of these")):
        command = commands.add_parser(name, help=help_)
        command.add_argument("--config", default="")
        command.add_argument("--source", default="")
        command.add_argument("--out", default="")
        command.add_argument("--taxonomy", default="")
        command.add_argument("--datasets", nargs="*")
        command.add_argument("--limit", type=number(1))
        command.add_argument("--set", nargs="*", type=setting, default=[], metavar="KEY=VALUE", help="any other setting of the configuration")
    return out


def number(low: float | None = None, high: float | None = None, kind: type = int) -> Callable[[str], float]:
    """A parser of numbers from ``low`` to ``high``."""

    def parse(text: str) -> float:
        try:
            n = kind(text)
        except ValueError as e:
            raise argparse.ArgumentTypeError(f"{text!r} is no number") from e
        if not (low is None or n >= low) or not (high is None or n <= high):
            raise argparse.ArgumentTypeError(f"{text} isn't within {'-' if low is None else low} to {'-' if high is None else high}")
        return n

    return parse


def setting(text: str) -> tuple[str, object]:
    """``key=value``, cut at the first ``=``; the value is read as YAML, so that numbers, lists and truth values come out as such."""
    import yaml

    key, mark, value = text.partition("=")
    if not mark or not key.strip():
        raise argparse.ArgumentTypeError(f"{text!r} isn't KEY=VALUE")
    return key.strip(), yaml.safe_load(value) if value else ""


def main(args: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    asked = parser().parse_args(args)
    config = pipeline.Config.from_yaml(asked.config) if asked.config else pipeline.Config()
    for name in ("source", "out", "taxonomy", "datasets", "limit"):
        if getattr(asked, name):
            setattr(config, name, getattr(asked, name))
    if wrong := sorted({k for k, _ in asked.set} - set(config.__dataclass_fields__)):
        log.error("unknown settings: %s", ", ".join(wrong))
        return 1
    for name, value in asked.set:
        setattr(config, name, tuple(value) if isinstance(value, list) and name != "datasets" else value)
    spark = session()
    try:
        if asked.command == "normalize":
            _, errors = pipeline.normalize(spark, config)
            for name, error in errors.items():
                log.warning("%s: %s", name, error)
        elif asked.command == "clean":
            rows, funnel = pipeline.cleaned(pipeline.load(spark, config.source), config)
            sinks.parquet(rows, f"{config.out}/cleaned")
            funnel.orderBy("source", "step").show(100, truncate=False)
        elif asked.command == "transform":
            found = pipeline.transformed(spark, pipeline.load(spark, config.source), config)
            found.write.mode("overwrite").parquet(f"{config.out}/entries")
            sinks.json_lines(benchmark.group_lines(spark.read.parquet(f"{config.out}/entries")), f"{config.out}/benchmark")
        elif asked.command == "optimize":
            bad = review.optimize_files(spark, config.source, f"{config.out}/optimized")
            log.info("%d lines that are no JSON objects left out", bad)
        elif asked.command == "sample":
            sinks.samples(spark.read.parquet(config.source), f"{config.out}/samples", config.now)
        else:
            pipeline.run(spark, config).orderBy("language", "cwd").show(100, truncate=False)
    except Exception:
        log.exception("%s failed", asked.command)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
