"""Command line: ``python -m chartmill audit|ingest|build|verify [--table NAME] ...``."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from chartmill.config import CleaningRules, Layout
from chartmill.plans import audit, bronze, silver, verify
from chartmill.schemas import BRONZE
from chartmill.session import configure


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="chartmill")
    parser.add_argument("step", choices=["audit", "ingest", "build", "verify"])
    parser.add_argument("--table", choices=sorted(BRONZE), help="one table instead of all")
    parser.add_argument("--warehouse", help="root folder; default from CHARTMILL_WAREHOUSE")
    parser.add_argument("--source", default=".", help="folder of the CSV exports")
    parser.add_argument("--rules", help="JSON file with site rules")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = configure(SparkSession.builder.appName(f"chartmill-{args.step}").getOrCreate())
    layout = Layout(args.warehouse) if args.warehouse else Layout.from_env()
    rules = CleaningRules.from_json(args.rules) if args.rules else CleaningRules()
    chosen = {"tables": (args.table,)} if args.table else {}
    if args.step == "audit":
        for row in audit.audit(spark, args.source, rules, **chosen).collect():  # one row per column, part and measure
            print(f"{row.table:32}{row.about:40}{row.measure:16}{row.value}")
    elif args.step == "ingest":
        bronze.ingest_all(spark, layout, args.source, rules, **chosen)
    elif args.step == "build":
        silver.build_all(spark, layout, rules, **chosen)
    else:
        results = verify.verify_layer(spark, layout, rules, **chosen)
        for row in results.collect():  # one row per rule
            print(f"{row.status:5}{row.table_name:32}{row.rule} -- {row.detail}")
        return 1 if verify.failed(results) else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
