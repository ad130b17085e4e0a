"""TableSet: an ordered set of named tables, each a lazy DataFrame.

A spreadsheet workbook in the original tool is an ordered set of sheets; here
it is an ordered ``name -> DataFrame`` map built from Parquet / CSV / ORC /
JSON files, a directory of such files, or existing DataFrames.

Ingestion rules (applied once, as a projection, so every check sees them):
* NaN in float/double columns becomes NULL (pandas treats both as missing).
* Optionally, missing-value tokens in text columns (``NA``, ``NULL``, ...)
  become NULL, as pandas' readers do by default (on for CSV).

Row order: checks that depend on the physical row order (first row per key,
first N values of a column, the reported row number of a failing cell) use
``Table.ordered`` which adds ``_row_no`` (0-based row within its file) and
``_file`` (the file's full path: part files of partitioned datasets often
share a name). For Parquet this is ``_metadata.row_index``: computed by the reader
inside each task, no shuffle and no global sort.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType

from ..functions.names import col

ROW_NO = "_row_no"
FILE = "_file"
PART = "_part"  # tables of several inputs: the file within the input
HIDDEN = (ROW_NO, FILE, PART)

# Text pandas' readers treat as missing by default.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_MARKERS = ("_SUCCESS", "_temporary", "_metadata", "_common_metadata")
_FORMATS = {".parquet": "parquet", ".csv": "csv", ".orc": "orc", ".json": "json"}


def _clean(df: DataFrame, na_tokens: Iterable[str] | None) -> DataFrame:
    tokens = list(na_tokens or [])
    out: list[Column] = []
    changed = False
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.nanvl(c, F.lit(None).cast(f.dataType)).alias(f.name)
            changed = True
        elif tokens and isinstance(f.dataType, StringType) and f.name not in HIDDEN:
            c = F.when(~c.isin(tokens), c).alias(f.name)
            changed = True
        out.append(c)
    return df.select(*out) if changed else df


def _ordinal_by_split(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Dense 0-based row number within each file, for readers without a row
    index (CSV, JSON, ORC).

    Rows of one file split are read in order by one task, so
    ``monotonically_increasing_id`` is consecutive inside a split. Per split
    ``(file, byte offset)`` the first id and the row count are aggregated (one
    row per split), a running sum over the splits of each file gives the
    split's offset, and ``offset + id - first id`` is the row number. No
    global sort and no single-partition window over the data."""
    base = raw.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("_blk"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    splits = base.groupBy(FILE, "_blk").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(FILE).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(FILE, "_blk", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # ``splits`` holds one row per file split, so it grows with the input: AQE
    # broadcasts it where its measured size allows, else both sides are dealt by split.
    return base.join(splits, [FILE, "_blk"]).select(
        *[col(c) for c in columns or raw.columns], (F.col("_off") + F.col("_mid") - F.col("_first")).alias(ROW_NO), col(FILE))


def listing(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, whether it is a folder) of the entries of a folder in any store Spark reads, sorted by name. The driver lists one
    level of names; no file is opened."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted((s.getPath().getName(), s.isDirectory()) for s in store.listStatus(where))


def table_entries(spark: SparkSession, path: str, fmt: str | None, wanted: set[str] | None, only: str | None = None):
    """(table name, path, format) of each table in a folder, as ``TableSet.from_dir`` says; ``only``: of that entry."""
    seen = set()
    for entry, folder in listing(spark, path) if only is None else [(only, False)]:
        if entry.startswith(("~$", ".")) or entry in _MARKERS:
            continue
        plain = entry[:-3] if entry.lower().endswith(".gz") else entry
        name, ext = os.path.splitext(plain)
        full = f"{path.rstrip('/')}/{entry}"
        if wanted is not None and name not in wanted:
            continue
        if entry.startswith("_"):
            raise ValueError(f"{full}: Spark does not read names that begin with an underscore; rename it or name the tables wanted")
        if not folder and fmt is None and ext.lower() not in _FORMATS:
            raise ValueError(f"{full}: not a known table format; name the tables wanted or give fmt")
        if name in seen:
            raise ValueError(f"two tables named {name!r} in {path}")
        seen.add(name)
        yield name, full, fmt or _FORMATS.get(ext.lower(), "parquet")


@dataclass
class Table:
    """One named table: ``df`` (data columns only) and, when known, ``ordered``
    (the same rows plus ``_row_no``/``_file``)."""

    name: str
    df: DataFrame
    ordered_df: DataFrame | None = None
    source: str | None = None

    @property
    def columns(self) -> list[str]:
        return [c for c in self.df.columns if c not in HIDDEN]

    @property
    def schema(self):
        return StructType([f for f in self.df.schema.fields if f.name not in HIDDEN])

    def dtype(self, column: str):
        return self.df.schema[column].dataType

    def ordered(self) -> DataFrame:
        """Rows with ``_row_no`` and ``_file``. Without a known physical order
        the order of ``monotonically_increasing_id`` is used and ``_row_no``
        is not a dense row number."""
        if self.ordered_df is not None:
            return self.ordered_df
        file = [] if FILE in self.df.columns else [F.lit(None).cast("string").alias(FILE)]
        return self.df.select("*", F.monotonically_increasing_id().alias(ROW_NO), *file)

    def row_order(self) -> list[Column]:
        """The columns of ``ordered()`` that put the rows in their order."""
        return [F.col(c) for c in (FILE, PART, ROW_NO) if c in self.ordered().columns]

    def has_row_numbers(self) -> bool:
        return self.ordered_df is not None


@dataclass
class TableSet:
    """Ordered ``name -> Table`` map plus optional cell-format sidecars."""

    spark: SparkSession
    tables: dict[str, Table] = field(default_factory=dict)
    formats: dict[str, DataFrame] = field(default_factory=dict)
    #: ``_file`` names the input in all tables, and rows of one input belong together.
    paired: bool = False

    # ------------------------------------------------------------------ build
    def add_frame(self, name: str, df: DataFrame, order_col: str | None = None,
                  na_tokens: Iterable[str] | None = None) -> TableSet:
        """Add a DataFrame. ``order_col`` names a column holding the 0-based
        physical row number (it is hidden from the table's columns)."""
        if order_col:
            full = df.withColumnRenamed(order_col, ROW_NO) if order_col != ROW_NO else df
            if FILE not in full.columns:
                full = full.withColumn(FILE, F.lit(None).cast("string"))
            full = _clean(full, na_tokens)
            data = full.drop(*HIDDEN)
            self.tables[name] = Table(name, data, full)
        else:
            self.tables[name] = Table(name, _clean(df, na_tokens))
        return self

    def add_path(self, name: str, path: str, fmt: str | None = None,
                 na_tokens: Iterable[str] | None = None, schema=None, **options) -> TableSet:
        """Add a table read from a file or directory (lazy; schema only).

        CSV: header row, pandas' missing tokens, and the column types inferred
        like pandas does - which costs a pass over the data; give ``schema``
        (DDL string or StructType) to skip it on large inputs."""
        fmt = fmt or _FORMATS.get(os.path.splitext(path)[1].lower(), "parquet")
        reader = self.spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        if fmt == "csv":
            options = {"header": "true", "inferSchema": "false" if schema is not None else "true", **options}
            if na_tokens is None:
                na_tokens = PANDAS_NA_TOKENS
        raw = reader.options(**options).load(path)
        data = _clean(raw, na_tokens)
        self.tables[name] = Table(name, data, self._ordered(raw, fmt, na_tokens), source=path)
        return self

    @staticmethod
    def _ordered(raw: DataFrame, fmt: str, na_tokens) -> DataFrame:
        if fmt == "parquet":
            with_order = raw.select("*", F.col("_metadata.row_index").alias(ROW_NO),
                                    F.col("_metadata.file_path").alias(FILE))
        else:
            with_order = _ordinal_by_split(raw)
        return _clean(with_order, na_tokens)

    def add_batch(self, name: str, path: str, fmt: str = "csv", glob: str | None = None,
                  na_tokens: Iterable[str] | None = None, schema=None, **options) -> TableSet:
        """Many files as ONE table (all files under ``path``, recursively,
        matching ``glob``; ``~$`` lock files skipped). Files may differ in
        columns (Parquet: merged schema). The file path is the hidden ``_file``
        column, so checks can be grouped per source file in one query."""
        reader = self.spark.read.format(fmt).option("recursiveFileLookup", "true")
        reader = reader.option("pathGlobFilter", glob or f"{{[!~],~[!$]}}*.{fmt}")
        if schema is not None:
            reader = reader.schema(schema)
        if fmt == "csv":
            options = {"header": "true", "inferSchema": "false" if schema is not None else "true", **options}
            if na_tokens is None:
                na_tokens = PANDAS_NA_TOKENS
        if fmt == "parquet":
            options = {"mergeSchema": "true", **options}
        raw = reader.options(**options).load(path)
        self.tables[name] = Table(name, _clean(raw, na_tokens), self._ordered(raw, fmt, na_tokens), source=path)
        return self

    def add_formats(self, name: str, formats: DataFrame) -> TableSet:
        """Cell-format sidecar ``(row_no long, field string, number_format string)``
        for table ``name``: the display format of each cell. An optional
        ``file`` column (the file path) addresses rows of multi-file tables."""
        self.formats[name] = formats
        return self

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame],
                    order_cols: Mapping[str, str] | None = None) -> TableSet:
        ts = cls(spark)
        for name, df in frames.items():
            ts.add_frame(name, df, (order_cols or {}).get(name))
        return ts

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: Mapping[str, str], fmt: str | None = None, **options) -> TableSet:
        ts = cls(spark)
        for name, path in paths.items():
            ts.add_path(name, path, fmt, **options)
        return ts

    @classmethod
    def from_dir(cls, spark: SparkSession, path: str, fmt: str | None = None,
                 names: Iterable[str] | None = None, **options) -> TableSet:
        """One table per file (or sub-directory) of ``path``, named by its stem,
        in sorted order. Only ``~$`` lock files, hidden files and the writers'
        markers are ignored; two entries of one name, a name with a leading
        underscore or a file of an unknown kind (without ``fmt``) raise. ``names`` limits the set to those tables
        (others are not opened). The folder lies in any store Spark reads."""
        ts = cls(spark)
        for name, full, kind in table_entries(spark, path, fmt, set(names) if names is not None else None):
            ts.add_path(name, full, kind, **options)
        return ts

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str, name: str = "Sheet1", **options) -> TableSet:
        """A single CSV is a set with one table, named ``Sheet1`` by default."""
        return cls(spark).add_path(name, path, "csv", **options)

    # ------------------------------------------------------------------ read
    @property
    def names(self) -> list[str]:
        return list(self.tables)

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def get(self, name: str) -> Table | None:
        return self.tables.get(name)

    def formats_for(self, name: str) -> DataFrame | None:
        return self.formats.get(name)

    def with_file_column(self) -> TableSet:
        """The same tables whose frames also carry the hidden ``_file``
        column, so checks can be grouped per source file (batch runs)."""
        out = TableSet(self.spark, formats=dict(self.formats))
        for name, t in self.tables.items():
            framed = t.ordered().drop(ROW_NO) if t.ordered_df is not None else t.df.withColumn(
                FILE, F.lit(None).cast("string"))
            out.tables[name] = Table(name, framed, t.ordered_df, source=t.source)
        return out

    def catalogue(self) -> DataFrame:
        """``(table_name, column_name, ordinal)`` of every table: schema metadata."""
        rows = [(t, c, i) for t, tab in self.tables.items() for i, c in enumerate(tab.columns)]
        return self.spark.createDataFrame(rows, "table_name string, column_name string, ordinal int")
