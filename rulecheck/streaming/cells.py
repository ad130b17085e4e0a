"""Cell checks on a Structured Streaming DataFrame.

Every cell check is stateless, so a ``readStream`` DataFrame goes through the
same Column predicates as a batch table: ``failed_cells_stream`` emits one
row per failing cell (append mode, no state), ``cell_counts_stream`` keeps
running ``(field, check) -> checked / failed`` counts, a streaming aggregate
whose state holds one row per (column, check) pair - bounded by the rule set,
not by the data - so no watermark is needed. Sinks and checkpoints are the
caller's (``writeStream ... option("checkpointLocation", <shared dir>)``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import check_passes, datatype_label, error_message
from ..functions.names import col
from ..functions.text import is_blank_cell


def _items(df: DataFrame, fields: Mapping[str, list], column_checks: Mapping):
    for column, checks in fields.items():
        if column not in df.columns:
            continue
        dtype = df.schema[column].dataType
        for check in checks:
            if check not in column_checks:
                continue
            ok = check_passes(check, col(column), dtype, column_checks[check])
            yield column, check, dtype, ok


def failed_cells_stream(df: DataFrame, sheet: str, fields: Mapping[str, list], column_checks: Mapping,
                        row_col: str | None = None) -> DataFrame:
    """Failing cells of a stream; ``row`` is taken from ``row_col`` if given."""
    structs = []
    for column, check, dtype, ok in _items(df, fields, column_checks):
        if ok is None:
            continue
        fail = ~is_blank_cell(col(column), dtype) & ~ok
        structs.append(F.when(fail, F.struct(
            F.lit(column).alias("field"), col(column).cast("string").alias("value"),
            F.lit(check).alias("validation_type"), F.lit(datatype_label(check)).alias("required_datatype"),
            F.lit(error_message(check, column)).alias("error_message"))))
    row = col(row_col).cast("long") if row_col else F.lit(None).cast("long")
    return (df.select(row.alias("row"), F.explode(F.filter(F.array(*structs), lambda s: s.isNotNull())).alias("_x"))
            .select(F.lit(sheet).alias("sheet_name"), "_x.field", "row", "_x.value", "_x.validation_type",
                    "_x.required_datatype", "_x.error_message"))


def cell_counts_stream(df: DataFrame, sheet: str, fields: Mapping[str, list], column_checks: Mapping) -> DataFrame:
    """Running ``(sheet_name, field, test_name, total_checked, failed_count)``."""
    structs = []
    for column, check, dtype, ok in _items(df, fields, column_checks):
        nonblank = ~is_blank_cell(col(column), dtype)
        fail = F.lit(False) if ok is None else (nonblank & ~ok)
        structs.append(F.struct(F.lit(column).alias("field"), F.lit(check).alias("test_name"),
                                nonblank.cast("long").alias("c"), fail.cast("long").alias("f")))
    return (df.select(F.inline(F.array(*structs)))
            .groupBy("field", "test_name")
            .agg(F.sum("c").alias("total_checked"), F.sum("f").alias("failed_count"))
            .select(F.lit(sheet).alias("sheet_name"), "field", "test_name", "total_checked", "failed_count"))


def write_batch_summaries(df: DataFrame, sheet: str, fields: Mapping[str, list], column_checks: Mapping,
                          path: str, checkpoint: str, fmt: str = "parquet"):
    """Start a stream that writes, for every micro-batch, the summary of that
    batch (``batch_id, field, test_name, total_checked, failed_count``) under
    ``path``, partitioned by batch id. The checkpoint makes the output
    exactly-once across restarts: a re-run batch overwrites its own
    partition only. Returns the StreamingQuery."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        summary = (cell_counts_stream(batch, sheet, fields, column_checks)
                   .withColumn("batch_id", F.lit(batch_id).cast("long")))
        (summary.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").format(fmt).save(path))

    return (df.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
