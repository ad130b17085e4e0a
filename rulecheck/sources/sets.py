"""Many inputs, each a set of tables: one workbook's worth of tables per folder.

Inputs that hold the same tables with the same columns make one group, and a
group's tables of one name are ONE DataFrame whose hidden ``_file`` column
names the input. A rule set is bound once for each group, not for each input;
every plan carries the input as its leading key, so any number of inputs is
checked by the same jobs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import col
from .tables import FILE, PANDAS_NA_TOKENS, PART, ROW_NO, Table, TableSet, _clean, _ordinal_by_split, listing, table_entries

#: The table of an input that is a single file.
SINGLE = "Sheet1"


@dataclass
class InputGroup:
    """Inputs with the same tables and columns: ``inputs(source_file)`` and their tables, rows marked with their input."""

    inputs: DataFrame
    tables: TableSet


@dataclass
class InputSets:
    """Groups of inputs. An input may lack tables or columns that others have; each is checked against its own."""

    spark: SparkSession
    groups: list[InputGroup] = field(default_factory=list)

    @classmethod
    def from_dir(cls, spark: SparkSession, path: str, fmt: str | None = None, names: Iterable[str] | None = None,
                 schemas: Mapping[str, object] | None = None, same_columns: bool = False, **options) -> InputSets:
        """One input for each sub-folder of ``path`` (its tables as ``TableSet.from_dir`` finds them) and for each file in it
        (its one table is named ``Sheet1``), named by the entry. The driver lists names and reads each table's columns;
        ``schemas`` (table -> schema) or ``same_columns`` (tables of one name are alike in all inputs) save the latter.
        Lock files and hidden files are no inputs; a folder without tables is an input without tables."""
        wanted = set(names) if names is not None else None
        found: dict[tuple, dict[str, list]] = {}
        root = path.rstrip("/")
        for entry, folder in listing(spark, path):
            if entry.startswith(("~$", ".", "_")):
                continue
            if folder:
                own = list(table_entries(spark, f"{root}/{entry}", fmt, wanted))
            else:
                (_, full, kind), = table_entries(spark, root, fmt, None, only=entry)
                own = [(SINGLE, full, kind)]
            sign = []
            for name, full, kind in own:
                told = (schemas or {}).get(name)
                columns = "" if same_columns or told is not None else _reader(spark, kind, None, options).load(full).schema.json()
                sign.append((name, kind, columns))
            group = found.setdefault(tuple(sign), {"inputs": [], "paths": [[] for _ in own]})
            group["inputs"].append(entry)
            for paths, (_, full, _) in zip(group["paths"], own, strict=True):
                paths.append(full)
        sets = cls(spark)
        for sign, group in found.items():
            ts = TableSet(spark, paired=True)
            for (name, kind, _), paths in zip(sign, group["paths"], strict=True):
                ts.tables[name] = _table(spark, name, paths, kind, root, (schemas or {}).get(name), options)
            sets.groups.append(InputGroup(spark.createDataFrame([(i,) for i in group["inputs"]], "source_file string"), ts))
        return sets

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame], input_col: str,
                    order_cols: Mapping[str, str] | None = None) -> InputSets:
        """Inputs that lie in common tables: ``input_col`` names each row's input and is no column of the tables any more. Every
        input of one table is an input of all; rows without one belong to none. ``order_cols``: as in ``TableSet.from_frames``."""
        ts, inputs = TableSet(spark, paired=True), []
        for name, df in frames.items():
            order = (order_cols or {}).get(name)
            marked = df.filter(col(input_col).isNotNull()).select(
                *[col(c) for c in df.columns if c not in (input_col, order, FILE)], *[col(c).alias(ROW_NO) for c in (order,) if c],
                col(input_col).cast("string").alias(FILE))
            full = _clean(marked, None)
            ts.tables[name] = Table(name, full.drop(ROW_NO), full if order else None)
            inputs.append(marked.select(F.col(FILE).alias("source_file")).distinct())
        every = inputs[0]
        for more in inputs[1:]:
            every = every.unionByName(more)
        return cls(spark, [InputGroup(every.distinct(), ts)])


def _reader(spark: SparkSession, kind: str, schema, options: Mapping):
    reader = spark.read.format(kind)
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        options = {"header": "true", "inferSchema": "false" if schema is not None else "true", **options}
    return reader.options(**options)


def _input_name(spark: SparkSession, root: str) -> Column:
    """The entry of ``root`` that a row's file lies in (or is)."""
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toUri().toString()
    depth = len([x for x in re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", whole).strip("/").split("/") if x])
    bare = F.regexp_replace(F.col("_metadata.file_path"), r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "")
    entry = F.element_at(F.split(bare, "/"), depth + 1)
    return F.url_decode(F.regexp_replace(entry, r"\+", "%2B"))


def _table(spark: SparkSession, name: str, paths: list[str], kind: str, root: str, schema, options: Mapping) -> Table:
    raw = _reader(spark, kind, schema, options).load(paths)
    tokens = PANDAS_NA_TOKENS if kind == "csv" else None
    own = _input_name(spark, root)
    if kind == "parquet":
        ordered = raw.select("*", F.col("_metadata.row_index").alias(ROW_NO), F.col("_metadata.file_path").alias(PART), own.alias(FILE))
    else:
        numbered = _ordinal_by_split(raw.select("*", own.alias("_own"), "_metadata"), [*raw.columns, "_own"])
        ordered = numbered.withColumnRenamed(FILE, PART).withColumnRenamed("_own", FILE)
    return Table(name, _clean(raw.select("*", own.alias(FILE)), tokens), _clean(ordered, tokens), source=root)
