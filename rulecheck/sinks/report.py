"""Report sinks: write run results as tables (Parquet / CSV / JSON / ORC).

Each result DataFrame is written by Spark's own writers, in parallel; nothing
is collected. ``partition_by`` gives one output directory per value.
``write_file_reports`` writes the results of a batch run as one report per input
file, each under a readable name of its own.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.engine import RunResult


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_report(result: RunResult, path: str, fmt: str = "parquet", mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> dict[str, str]:
    """Write summary, details (field dialects), failed records and execution
    totals under ``path``; returns ``{part: directory}``. A field run that is
    not split by file reads every table once."""
    out = {}

    def write(name: str, df: DataFrame) -> None:
        target = os.path.join(path, name)
        keys = [k for k in (partition_by or []) if k in df.columns]
        write_table(df, target, fmt, mode, keys or None)
        out[name] = target

    if one_pass := result.in_one_pass():
        failed, finish = one_pass
        write("failed_records", failed)  # reads the tables; all else is made from what it counts
        result = finish()
    else:
        result = result.once()
    parts = {"summary": result.summary}
    if result.style != "kpi":
        parts["details"] = result.details
    if result.failed is not None and "failed_records" not in out:
        parts["failed_records"] = result.failed
    if result.execution is not None:
        parts["execution_summary"] = result.execution
    for name, df in parts.items():
        write(name, df)
    return out


WHOLE = "whole_set"


def report_names(files: DataFrame, base: str = "report") -> DataFrame:
    """``(source_file, report)`` for files(source_file): ``<base>_<stem>``, made of the file's name without its ending and with
    anything but letters, digits, ``.``, ``-`` and ``_`` replaced. Files that would share a name (letter case does not count) get
    the hash of their path behind it, so a name depends on the set of paths alone. A NULL file - rows that concern the whole set - has none."""
    names = files.select("source_file").filter(F.col("source_file").isNotNull()).distinct()
    entry = F.url_decode(F.regexp_replace(F.regexp_extract("source_file", "[^/]*$", 0), r"%(?![0-9A-Fa-f]{2})", "%25"))
    stem = F.regexp_replace(F.regexp_replace(entry, r"(?<=.)(\.[A-Za-z0-9]{1,8}){1,2}$", ""), r"[^\p{L}\p{N}._-]+", "_")
    named = names.withColumn("_stem", F.when(stem == "", "file").otherwise(stem))
    shared = named.groupBy(F.lower("_stem").alias("_low")).agg((F.count(F.lit(1)) > 1).alias("_shared"))
    # a name in use twice, or one that only looks like such a name, carries the hash of its path
    tag = F.when(F.col("_shared") | F.col("_stem").rlike("_[0-9a-f]{12}$"), F.concat(F.lit("_"), F.substring(F.sha2("source_file", 256), 1, 12))).otherwise("")
    return (named.join(shared, F.lower("_stem") == F.col("_low"))
            .select("source_file", F.concat(F.lit(f"{base}_"), F.col("_stem"), tag).alias("report")))


def write_file_reports(result: RunResult, path: str, base: str = "report", fmt: str = "parquet") -> dict[str, str]:
    """A batch run (``by_file``) as one report per input: ``<path>/<part>/report=<name>/``, the rows that concern the whole
    set under ``report=<base>_whole_set``, and ``<path>/inputs`` with the name of each file's report. Everything is written to a
    folder beside ``path`` first and takes its place by one rename, so no reader sees half a report. Returns ``{part: directory}``."""
    result = result.once()
    spark = result.all_rows.sparkSession
    parts = {"summary": result.summary, **({"details": result.details} if result.style != "kpi" else {}),
             **({"failed_records": result.failed} if result.failed is not None else {})}
    if any("source_file" not in df.columns for df in parts.values()):
        raise ValueError("not a batch run: its results name no source file")
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    names = report_names(result.all_rows, base)
    write_table(names, f"{staged}/inputs", fmt)
    names = spark.read.schema(names.schema).format(fmt).options(header="true").load(f"{staged}/inputs")
    for part, df in parts.items():
        own = names.select(F.col("source_file").alias("_file"), "report")
        told = df.join(own, F.col("source_file") == F.col("_file"), "left").drop("_file")
        told = told.withColumn("report", F.coalesce("report", F.lit(f"{base}_{WHOLE}")))
        write_table(told, f"{staged}/{part}", fmt, partition_by=["report"])
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(place):
        raise FileExistsError(f"{path} is there already; the report is in {staged}")
    store.mkdirs(place.getParent())
    if not store.rename(spark._jvm.org.apache.hadoop.fs.Path(staged), place):
        raise OSError(f"{staged} cannot be renamed to {path}")
    return {part: f"{path.rstrip('/')}/{part}" for part in ("inputs", *parts)}
