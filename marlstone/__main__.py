"""Command line: ``python -m marlstone list | query NAME TABLES OUT | verify RUN [--kind KIND] | report RUN OUT``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .operators.contracts import EngineError
from .plans import catalog, runs
from .sources.sinks import write_report


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="marlstone", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of all queries")
    query = commands.add_parser("query", help="run a query over a folder of tables and store its result as Parquet")
    query.add_argument("name")
    query.add_argument("tables")
    query.add_argument("out")
    verify = commands.add_parser("verify", help="check a stored run against its manifest")
    verify.add_argument("run")
    verify.add_argument("--kind")
    report = commands.add_parser("report", help="a Markdown report of a verified run")
    report.add_argument("run")
    report.add_argument("out")
    asked = parser.parse_args(argv)
    if asked.command == "list":
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    spark = spark or SparkSession.builder.appName("marlstone").getOrCreate()
    try:
        if asked.command == "query":
            if asked.name not in catalog.QUERIES:
                raise EngineError(f"no query is called {asked.name}")
            catalog.QUERIES[asked.name](spark, asked.tables).write.mode("errorifexists").parquet(asked.out)
            return 0
        manifest = runs.verify_run(spark, asked.run, getattr(asked, "kind", None))
        if asked.command == "report":
            facts = spark.createDataFrame([(k, json.dumps(v, ensure_ascii=False)) for k, v in manifest["facts"].items()], "fact string, value string")
            sizes = spark.createDataFrame([(n, t["rows"], t["logical_hash"]) for n, t in sorted(manifest["tables"].items())], "table string, rows long, logical_hash string")
            one = spark.createDataFrame([(manifest["kind"], manifest["created_utc"])], "kind string, created string")
            write_report(asked.out, f"Run of {manifest['kind']}", one, {"Facts": facts, "Tables": sizes})
        else:
            print(json.dumps({"kind": manifest["kind"], "tables": {n: t["rows"] for n, t in manifest["tables"].items()}}, sort_keys=True))
    except EngineError as refused:
        print(f"refused: {refused}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
