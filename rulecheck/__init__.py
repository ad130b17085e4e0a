"""rulecheck: rule-driven validation and reconciliation of table sets on Spark.

    ts = TableSet.from_dir(spark, "/data/workbook")          # name -> DataFrame
    result = run_kpi(ts, json.load(open("rules.json")))       # lazy DataFrames
    result.summary.show()
"""

from .functions.cells import register_check
from .plans.engine import RunResult, kpi_outcomes, run_fields, run_inferred, run_kpi, run_kpi_inputs
from .plans.planner import materialize
from .rules import load_rules
from .sinks.report import write_report
from .sources.sets import InputSets
from .sources.tables import TableSet

__all__ = ["TableSet", "InputSets", "RunResult", "run_kpi", "run_kpi_inputs", "run_fields", "run_inferred", "kpi_outcomes", "materialize",
           "load_rules", "write_report", "register_check"]
