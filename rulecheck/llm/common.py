"""Helpers shared by the corpus operators: tables, intermediate tables, small native array idioms, row numbers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space that ends a word: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Only a local session may fall back to a folder of its own."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", made := tempfile.mkdtemp(prefix="corpus-"))
    return made


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write as Parquet in the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row, however often body (or a lambda inside it) uses it."""
    return F.transform(F.array(value), body)[0]


def prefix_sums(numbers: Column) -> Column:
    """Exclusive running sums of array<bigint>: blocks of about sqrt(n), so n elements cost n * sqrt(n) steps, not n^2."""
    zero = F.lit(0).cast("bigint")
    total = lambda xs: F.aggregate(xs, zero, lambda a, x: a + x)

    def blocks(xs: Column, width: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.ceil((F.size(xs) - 1) / width).cast("int") - F.lit(0)),
                          lambda b: F.slice(xs, b * width + 1, width))
        return let(cut, lambda bs: let(F.transform(bs, total), lambda ts: F.flatten(F.transform(
            bs, lambda x, b: let(total(F.slice(ts, F.lit(1), b)), lambda off: F.transform(
                x, lambda _, j: off + total(F.slice(x, F.lit(1), j))))))))

    return F.when(F.size(numbers) == 0, F.array().cast("array<bigint>")).otherwise(
        let(numbers, lambda xs: let(F.ceil(F.sqrt(F.size(xs))).cast("int"), lambda w: blocks(xs, w))))


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that no column of df has, whatever its case."""
    taken, name = {c.lower() for c in df.columns}, wish
    while name.lower() in taken:
        name = "_" + name
    return name


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """df without the columns (whatever their case) that an operator is about to make: outputs replace such columns."""
    new = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in new])


def shield(df: DataFrame, *own: str) -> DataFrame:
    """The columns ``own`` beside one struct _rest of all others, so that no name can clash with an operator's."""
    rest = [c for c in df.columns if c not in own]
    return df.select(F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(None).alias("none")]).alias("_rest"), *own)


def restore(df: DataFrame, columns: Sequence[str], new: Sequence[str] = ()) -> list[Column]:
    """The select list that gives a shielded table's columns back in their order (but for those that new replaces), then new."""
    made = {n.lower() for n in new}
    own = set(df.columns) - {"_rest"}  # a column of that name lies inside the struct, like all others
    return [*[F.col(c) if c in own else F.col(f"_rest.`{c}`") for c in columns if c.lower() not in made], *map(F.col, new)]


def gapless_number(df: DataFrame, groups: Sequence[str], order: Sequence[str], out: str, total: int,
                   rows_per_task: int = 20_000) -> DataFrame:
    """Number the rows of each group 0, 1, 2, .. without one task for a group.

    Rows are dealt by (group, hash of the order columns) into sub-groups of about rows_per_task rows; each is numbered
    by itself and shifted by the counts of the sub-groups before it. The one exchange of the rows serves both the
    numbering and the join with the counts. The order inside a group is by sub-group, then by the order columns.
    """
    sub, rank, before, n = (free_name(df, x) for x in ("_sub", "_rank", "_before", "_n"))
    parts = max(1, -(-total // rows_per_task))
    dealt = df.withColumn(sub, F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    keys = [*groups, sub]
    shift = Window.partitionBy(*groups).orderBy(sub).rowsBetween(Window.unboundedPreceding, -1)
    counts = (dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
              .select(*keys, F.coalesce(F.sum(n).over(shift), F.lit(0)).cast("bigint").alias(before)))
    ranked = dealt.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return (ranked.join(counts, keys)
            .select(*df.columns, (F.col(before) + F.col(rank) - 1).cast("bigint").alias(out)))


def attach(df: DataFrame, totals: DataFrame, key: str, count: str, values: Sequence[str], share: int = 256) -> DataFrame:
    """df with the columns ``values`` of the one row of totals(key, count, ..) with its key (null keys are equal).

    ``count`` is a key's number of rows in df. At most ``share`` keys hold more than a share-th of all rows: these, and the
    null key, are broadcast (share + 1 rows at most, whatever the size of df), so their rows stay where they are; the rows
    of all other keys are joined by a shuffle in which none is large. df is read twice. Its names must not clash with values.
    """
    told, large, own, found = (free_name(df, x) for x in ("_told", "_large", "_own", "_found"))
    total = totals.agg(F.sum(count).alias(told))  # one row
    split = totals.crossJoin(F.broadcast(total)).select(
        F.col(key).alias(own), F.struct(*values).alias(found), (F.col(key).isNull() | (F.col(count) * share > F.col(told))).alias(large))
    few, many = split.filter(large).drop(large), split.filter(~F.col(large)).drop(large)
    marked = df.join(F.broadcast(few), df[key].eqNullSafe(few[own]), "left")
    rest = marked.filter(F.col(found).isNull()).select(*df.columns)
    columns = [*df.columns, *[F.col(found)[v].alias(v) for v in values]]
    return marked.filter(F.col(found).isNotNull()).select(*columns).unionByName(
        rest.join(many, rest[key] == many[own], "left").select(*columns))
