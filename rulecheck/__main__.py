"""Command line: run a rule set over a directory of tables and write the report.

    python -m rulecheck kpi --tables /data/book --rules rules.json --out /reports/run1
    spark-submit -m ... (or any launcher that provides the session)

The Spark session comes from the environment (``spark-submit``, a cluster
launcher); ``--local N`` starts a local one. Reports are written by Spark
(``--format`` parquet, csv, json or orc), one directory per result table.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .plans.engine import run_fields, run_inferred, run_kpi, run_kpi_inputs
from .rules import load_rules
from .sinks.report import write_report
from .sources.sets import InputSets
from .sources.tables import TableSet


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rulecheck", description=__doc__.splitlines()[0])
    p.add_argument("dialect", choices=["kpi", "fields", "inferred"])
    p.add_argument("--tables", required=True, help="directory: one table per file or sub-directory")
    p.add_argument("--batch", action="store_true",
                   help="--tables holds many files of ONE table; results per source file")
    p.add_argument("--inputs", action="store_true",
                   help="kpi: --tables holds one folder (or file) for each input, each a set of tables; results per input")
    p.add_argument("--batch-name", default="Sheet1", help="table name of a --batch run")
    p.add_argument("--input-format", default=None, help="parquet, csv, orc or json (default: by extension)")
    p.add_argument("--rules", required=True, help="rule set: JSON file or JSON text")
    p.add_argument("--out", required=True, help="output directory of the report")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    p.add_argument("--as-of", default=None, help="date for stale-data rules (default: today)")
    p.add_argument("--local", default=None, help="start a local session with this many cores")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.batch and args.dialect == "inferred":
        _parser().error("--batch is not available for inferred: run it once for each file")
    if args.inputs and (args.dialect != "kpi" or args.batch):
        _parser().error("--inputs is for kpi, without --batch")
    if args.local:
        from .session import local_session

        spark = local_session(cores=args.local)
    else:
        spark = SparkSession.builder.appName("rulecheck").getOrCreate()
    rules = load_rules(args.rules)
    if args.inputs:
        ts = InputSets.from_dir(spark, args.tables, fmt=args.input_format)
    elif args.batch:
        ts = TableSet(spark).add_batch(args.batch_name, args.tables, fmt=args.input_format or "csv")
    else:
        ts = TableSet.from_dir(spark, args.tables, fmt=args.input_format)
    if args.inputs:
        result = run_kpi_inputs(ts, rules, as_of=args.as_of)
    elif args.dialect == "kpi":
        result = run_kpi(ts, rules, as_of=args.as_of, by_file=args.batch)
    elif args.dialect == "fields":
        result = run_fields(ts, rules, by_file=args.batch)
    else:
        result = run_inferred(ts, rules)
    result = result.once()
    parts = write_report(result, args.out, fmt=args.format,
                         partition_by=["source_file"] if args.batch or args.inputs else None)
    failed = result.summary.filter("status IN ('F', 'FAIL')").count()
    print(json.dumps({"report": parts, "failed_tests": failed}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
