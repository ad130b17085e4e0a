"""Cell checks over a file stream give the same answer as the batch run."""

import tempfile

from rulecheck import TableSet, run_fields
from rulecheck.streaming.cells import cell_counts_stream, failed_cells_stream

SF = "/root/testdata/sf0.001"
CHECKS = {"number": {"min_value": 0, "max_value": 100}, "text_only": {}, "numeric_only": {}}
FIELDS = {"value": ["number"], "event_type": ["text_only"], "props": ["numeric_only"]}


def test_stream_matches_batch(spark):
    batch = spark.read.parquet(f"{SF}/events.parquet")
    stream = spark.readStream.schema(batch.schema).option("pathGlobFilter", "events.parquet").parquet(SF)
    scratch = tempfile.mkdtemp(prefix="rulecheck-stream-")
    q1 = (cell_counts_stream(stream, "events", FIELDS, CHECKS).writeStream.outputMode("complete")
          .format("memory").queryName("cell_counts").option("checkpointLocation", f"{scratch}/c1").start())
    q2 = (failed_cells_stream(stream, "events", FIELDS, CHECKS, row_col="event_id").writeStream.outputMode("append")
          .format("memory").queryName("cell_failures").option("checkpointLocation", f"{scratch}/c2").start())
    for q in (q1, q2):
        q.processAllAvailable()
        q.stop()
    got = {(r.field, r.test_name): (r.total_checked, r.failed_count) for r in spark.table("cell_counts").collect()}
    ts = TableSet.from_paths(spark, {"events": f"{SF}/events.parquet"})
    res = run_fields(ts, {"column_checks": CHECKS, "fields": {"events": FIELDS}})
    want = {(r.field, r.test_name): (r.total_checked, r.failed_count) for r in res.summary.collect()
            if r.test_type == "Data Validation"}
    assert got == want
    assert spark.table("cell_failures").count() == sum(f for _, f in want.values())


def test_batch_summaries(spark):
    from rulecheck.streaming.cells import write_batch_summaries

    batch = spark.read.parquet(f"{SF}/events.parquet")
    stream = (spark.readStream.schema(batch.schema).option("pathGlobFilter", "events.parquet")
              .option("maxFilesPerTrigger", 1).parquet(SF))
    scratch = tempfile.mkdtemp(prefix="rulecheck-batches-")
    q = write_batch_summaries(stream, "events", FIELDS, CHECKS, f"{scratch}/out", f"{scratch}/ckpt")
    q.awaitTermination(120)
    out = spark.read.parquet(f"{scratch}/out")
    got = {(r.field, r.test_name): (r.total_checked, r.failed_count) for r in
           out.groupBy("field", "test_name").sum("total_checked", "failed_count")
           .toDF("field", "test_name", "total_checked", "failed_count").collect()}
    ts = TableSet.from_paths(spark, {"events": f"{SF}/events.parquet"})
    res = run_fields(ts, {"column_checks": CHECKS, "fields": {"events": FIELDS}})
    want = {(r.field, r.test_name): (r.total_checked, r.failed_count) for r in res.summary.collect()
            if r.test_type == "Data Validation"}
    assert got == want
