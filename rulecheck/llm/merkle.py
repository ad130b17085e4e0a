"""Document fingerprints: a Merkle tree over paragraphs and sections. Native: DataFrame functions only.

Lines are paragraphs, runs of lines between blank lines are sections. A paragraph's digest is the SHA-256 of its text, a
section's that of its paragraphs' digests, the root's that of the sections' digests; each level has its own prefix. So
equal roots mean equal texts, and where roots differ the branches whose digests differ lead to the edited paragraphs.
Under the paragraphs lie blocks of up to six words that end early after punctuation. They are aligned anew in every
sentence and line, so the share of equal blocks measures how much of two texts is alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulecheck.llm.common import free_name, let, table, without

_W, _N, _S = r"[^ \t\n\x0B\f\r]", r"[^ \t\n\x0B\f\r.,;:!?]", r"[ \t\x0B\f\r]"
BLOCK = rf"(?:{_W}*{_N}{_S}+){{0,5}}{_W}+"


def _digest(level: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(level), F.array_join(children, ",")), 256)


def tree(text: Column) -> Column:
    """array<struct<digest, paragraphs array<string>>>: the sections, each with its digest and its paragraphs' digests."""
    paragraph = lambda p: F.sha2(F.concat(F.lit("p:"), p), 256)
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n"), lambda s: let(
        F.transform(F.split(s, "\n"), paragraph), lambda ps: F.struct(_digest("s:", ps).alias("digest"), ps.alias("paragraphs"))))


def root(sections: Column) -> Column:
    return _digest("r:", F.transform(sections, lambda s: s["digest"]))


def blocks(text: Column) -> Column:
    """The distinct blocks of a text as hashes; a block is a run of words inside one line."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(BLOCK), F.lit(0)), lambda b: F.xxhash64(b)))


def likeness(root_a: Column, blocks_a: Column, root_b: Column, blocks_b: Column) -> Column:
    """1 for equal roots, else twice the shared blocks over the blocks of both (0 where neither has any)."""
    both = F.size(blocks_a) + F.size(blocks_b)
    return (F.when(root_a == root_b, F.lit(1.0)).when(both == 0, F.lit(0.0))
            .otherwise(2.0 * F.size(F.array_intersect(blocks_a, blocks_b)) / both))


def edited(sections_a: Column, sections_b: Column) -> Column:
    """Where two trees differ: struct<section, paragraph, sections>, null if they are equal.

    ``section`` and ``paragraph`` (from 0) lead to the first differing paragraph; ``sections`` counts the differing
    branches under the roots, by position.
    """
    def first(xs: Column, ys: Column, same) -> Column:
        return F.array_position(F.zip_with(xs, ys, lambda x, y: ~F.coalesce(same(x, y), F.lit(False))), True) - 1

    differing = F.zip_with(sections_a, sections_b, lambda x, y: ~F.coalesce(x["digest"] == y["digest"], F.lit(False)))
    return let(differing, lambda d: F.when(F.array_contains(d, True), let((F.array_position(d, True) - 1).cast("int"), lambda s: F.struct(
        s.alias("section"), F.greatest(F.lit(0), first(
            F.coalesce(F.get(sections_a, s)["paragraphs"], F.array().cast("array<string>")),
            F.coalesce(F.get(sections_b, s)["paragraphs"], F.array().cast("array<string>")), lambda x, y: x == y)).cast("int").alias("paragraph"),
        F.size(F.filter(d, lambda x: x)).alias("sections")))))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with sections, fingerprint (root) and blocks. Null text: as the empty text. New columns replace others of their names."""
    with_tree = without(docs, ["sections", "fingerprint", "blocks"]).withColumn("sections", tree(F.col(text)))
    return with_tree.withColumns({"fingerprint": root(F.col("sections")), "blocks": blocks(F.col(text))})


def with_next(docs: DataFrame, key: str, carried: list[str], compute=lambda df: df, rows_per_range: int = 2_000,
              most_ranges: int = 10_000) -> DataFrame:
    """docs (after compute) with next: struct of the carried columns of the next row by key (the last row's: the first).

    Rows are dealt by ranges of the long key in one exchange; compute adds columns after it, so they are made once a
    row and not sent. Range bounds are quantiles, taken once and written into the plan as literals. The first rows of a
    range are also sent, as copies, to the range before it (those of the first to the last), so every row finds its
    successor in its own range. Null keys come first; rows with equal keys lie in one range, ordered by their hash.
    """
    docs = without(docs, ["next"])
    o, at, place, first, before, to, copy, tie = (free_name(docs, f"_{x}") for x in ("o", "at", "range", "first", "before", "to", "copy", "tie"))
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(-(2**63)))
    ids = docs.select(order.cast("double").alias("o"))
    ranges = max(1, min(most_ranges, ids.count() // rows_per_range))
    cuts = sorted(set(ids.approxQuantile("o", [i / ranges for i in range(1, ranges)], 0.25 / ranges))) if ranges > 1 else []
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    literal = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    passed = lambda xs, v: F.size(F.filter(xs, lambda b: b <= v))

    def range_of(v: Column) -> Column:
        """The number of cuts at or below v: found among the first cuts of the groups, then within one group."""
        top = F.greatest(passed(literal([g[0] for g in groups]), v) - 1, F.lit(0))
        return let(top, lambda g: g * step + passed(F.get(F.array(*map(literal, groups)), g), v))

    ranged = docs.withColumns({o: order, place: range_of(order.cast("double")) if cuts else F.lit(0)})
    firsts = sorted((r[place], r["o"]) for r in ranged.groupBy(place).agg(F.min(o).alias("o")).collect())
    heads = docs.sparkSession.createDataFrame([(r, x, firsts[i - 1][0]) for i, (r, x) in enumerate(firsts)],
                                              f"`{place}` int, `{first}` long, `{before}` int")
    own, sent = (F.struct(F.col(x).alias(to), F.lit(n).alias(copy)) for n, x in enumerate((place, before)))
    dealt = (ranged.join(F.broadcast(heads), place)  # one row for each range: most_ranges at most
             .select(*docs.columns, o, F.explode(F.when(F.col(o) == F.col(first), F.array(own, sent)).otherwise(F.array(own))).alias(at))
             .select(*docs.columns, o, f"{at}.*", F.xxhash64(*docs.columns).alias(tie))
             .repartition(to).sortWithinPartitions(to, copy, o, tie))
    following = F.lead(F.struct(*carried)).over(Window.partitionBy(to).orderBy(copy, o, tie))
    return compute(dealt).withColumn("next", following).filter(F.col(copy) == 0).drop(to, copy, o, tie)


def op3_merkle_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and that of its edited text, and the likeness to the edited and the next document's."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", ["text", "fingerprint", "blocks"], fingerprints)
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    changed = F.concat(F.col("text").substr(F.lit(1), n - half), F.col("next.text").substr(F.lit(1), half))
    both = rows.withColumn("edited", changed)
    both = both.withColumns({"e_sections": tree(F.col("edited")), "e_blocks": blocks(F.col("edited"))})
    both = both.withColumn("edited_fingerprint", root(F.col("e_sections")))
    return both.select(
        "doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("blocks"), F.col("edited_fingerprint"), F.col("e_blocks")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("blocks"), F.col("next.fingerprint"), F.col("next.blocks")).alias("near_next"),
        edited(F.col("sections"), F.col("e_sections"))["section"].alias("edited_section"),
        edited(F.col("sections"), F.col("e_sections"))["paragraph"].alias("edited_paragraph"))
