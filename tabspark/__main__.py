"""Command line: ``python -m tabspark evaluate|generate|profile|catalogue|compare``; tables are Parquet paths."""

from __future__ import annotations

import argparse
import sys


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tabspark")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("catalogue")
    for name in ("evaluate", "generate", "profile"):
        c = sub.add_parser(name)
        c.add_argument("--source", required=True)
        c.add_argument("--name", default="table")
        for kind in ("key", "categorical", "numeric", "text", "temporal", "identity"):
            c.add_argument(f"--{kind}", default="", help="columns, with commas between")
        c.add_argument("--out")
    for name in ("evaluate",):
        c = sub.choices[name]
        c.add_argument("--synthetic", required=True)
        c.add_argument("--models", action="store_true")
        c.add_argument("--fail-on", default="", help="statuses that make the exit code 1")
        c.add_argument("--json", action="store_true")
    sub.choices["generate"].add_argument("--rows", type=int, required=True)
    sub.choices["generate"].add_argument("--salt", default="run")
    c = sub.add_parser("compare")
    c.add_argument("a")
    c.add_argument("b")
    return p


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    from .operators import scoring
    from .plans import evaluate as E

    a = parser().parse_args(argv)
    if a.command == "catalogue":
        print(E.render_catalogue())
        return 0
    spark = SparkSession.builder.getOrCreate()
    if a.command == "compare":
        runs = [spark.read.parquet(x) for x in (a.a, a.b)]
        scoring.compare_runs(*runs, ["metric_id", "table_name", "unit"]).where("change <> 'same'").show(1000, False)
        return 0
    columns = lambda x: [c for c in x.split(",") if c]
    spec = E.TableSpec(a.name, columns(a.key), columns(a.categorical), columns(a.numeric), columns(a.text), columns(a.temporal), columns(a.identity))
    source = spark.read.parquet(a.source)
    if a.command == "profile":
        for name, frame in E.profile(source, spec).items():
            print(name)
            frame.show(200, False)
        return 0
    if a.command == "generate":
        E.generate_table(spark, source, spec, a.rows, a.salt).write.mode("errorifexists").parquet(a.out)
        return 0
    rows = E.evaluate(source, spark.read.parquet(a.synthetic), spec, a.models)
    if a.out:
        rows.write.mode("errorifexists").parquet(a.out)
        rows = spark.read.parquet(a.out)
    print(E.report_json(rows) if a.json else E.report(rows))
    return scoring.fail_on(rows, columns(a.fail_on)).first().exit_code if a.fail_on else 0


if __name__ == "__main__":
    sys.exit(main())
