"""Quality rules with risk-controlled thresholds. Native: DataFrame functions only.

Each document gets counts (words, symbols, repeated lines and word windows). A labelled holdout then selects, for every
stratum (a class of length) and signal, a cutoff whose false rejection rate - the share of good documents above it -
is at most ``alpha`` with confidence 1 - ``delta``. The bound is the exact binomial (Clopper-Pearson) one: a cutoff that
rejects k of n good documents is certified if P(Binomial(n, a) <= k) <= d. Corrections: a = alpha / signals (the
signals' rejections add up), d = delta / (strata * signals) (Bonferroni); along the fixed list of cutoffs the tests go
from loose to strict and stop at the first failure, which needs no further correction. Among the certified cutoffs the
loosest of those that reject the most bad documents is taken, so good ones are not given away for nothing.

``joint_cuts`` spends the same budget on one joint rule for each class (or pool of thin classes), which needs far fewer
good labels; the registered query and the pipeline use it.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulecheck.llm.common import WHITE, let, materialize, restore, shield, table

SYMBOLS = "#*$%&|<>"
#: Signals in thousandths: name -> (numerator, denominator) among the counts.
SIGNALS = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words")}
CUTOFFS = [900, 800, 700, 600, 500, 450, 400, 350, 300, 250, 200, 175, 150, 125, 100, 80, 60, 50, 40, 30, 20, 15, 10, 5]
#: Strata: the least number of words of each class.
STRATA = [0, 150, 400, 1200]
ALPHA, DELTA = 0.01, 0.05


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), lambda w: w != "")


def repeated_words(ws: Column) -> Column:
    """How many words lie in a window of three words that the text has twice or more.

    Linear but for sorts. A text whose windows all differ (by array_distinct of their hashes) ends there. Else the
    windows are sorted as longs that hold the high bits of the hash and the place; neighbours with equal high bits are
    the only candidates, and these few are sorted again by the whole hash.
    """
    def grouped(ordered: Column, key) -> Column:
        """The elements that share their key with a neighbour."""
        same = lambda x, j: F.coalesce(key(F.get(ordered, j)) == key(x), F.lit(False))
        return F.filter(ordered, lambda x, j: same(x, j - 1) | same(x, j + 1))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, j: F.least(F.lit(3), p - F.coalesce(F.get(at, j - 1), F.lit(-3)))),
                           F.lit(0).cast("bigint"), lambda a, x: a + x)

    def again(hs: Column) -> Column:
        bits = F.length(F.bin(F.size(hs).cast("bigint")))
        high = lambda x, b: F.call_function("shiftright", x, b)
        places = lambda b: let(
            F.sort_array(F.transform(hs, lambda h, i: F.call_function("shiftleft", high(h, b), b).bitwiseOR(i.cast("bigint")))),
            lambda o: F.transform(grouped(o, lambda x: high(x, b)), lambda x: (x - F.call_function("shiftleft", high(x, b), b)).cast("int")))
        exact = lambda at: F.sort_array(F.transform(at, lambda i: F.struct(F.get(hs, i).alias("h"), i.alias("i"))))
        return let(let(bits, places), lambda at: let(exact(at), lambda o: let(
            F.sort_array(F.transform(grouped(o, lambda x: x["h"]), lambda x: x["i"])), covered)))

    windows = lambda xs: F.transform(F.slice(xs, F.lit(3), F.size(xs)), lambda w, i: F.xxhash64(F.get(xs, i), F.get(xs, i + 1), w))
    none = F.lit(0).cast("bigint")
    return let(ws, lambda xs: F.when(F.size(xs) < 4, none).otherwise(let(windows(xs), lambda hs: F.when(
        F.size(F.array_distinct(hs)) == F.size(hs), none).otherwise(again(hs)))))


COUNTS = ["word_chars", "n_symbols", "n_words", "n_repeat_words", "n_lines", "n_dup_lines"]


def signals(docs: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """docs (without its text, unless kept) and the COUNTS, which replace columns of their names. Null text: all 0."""
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(whole, WHITE, "")
    lines = F.filter(F.split(whole, "\n"), lambda x: F.translate(x, WHITE, "") != "")
    counted = shield(docs, text).select(
        "_rest", text, F.char_length(bare).cast("bigint").alias("word_chars"),
        (F.char_length(bare) - F.char_length(F.translate(bare, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        let(words(whole), lambda ws: F.struct(F.size(ws).cast("bigint").alias("n"), repeated_words(ws).alias("r"))).alias("_w"),
        let(lines, lambda ls: F.struct(F.size(ls).cast("bigint").alias("n"), F.size(F.array_distinct(ls)).cast("bigint").alias("d"))).alias("_l"))
    named = counted.select("_rest", *[text] * keep_text, "word_chars", "n_symbols", F.col("_w.n").alias("n_words"), F.col("_w.r").alias("n_repeat_words"),
                           F.col("_l.n").alias("n_lines"), (F.col("_l.n") - F.col("_l.d")).alias("n_dup_lines"))
    return named.select(*restore(named, [c for c in docs.columns if keep_text or c != text], COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def stratum() -> Column:
    return reduce(lambda a, b: a + b, [(F.col("n_words") >= least).cast("int") for least in STRATA[1:]])


def signal(name: str) -> Column:
    above, below = SIGNALS[name]
    return F.when(F.col(below) > 0, F.floor(1000 * F.col(above) / F.col(below))).otherwise(0).cast("bigint")


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) for k < n * p: the last term by logarithms, the smaller ones by their ratios."""
    zero = F.lit(0.0)
    steps = F.sequence(F.lit(1).cast("bigint"), F.greatest(k, F.lit(1)))
    log_ways = F.when(k == 0, zero).otherwise(F.aggregate(steps, zero, lambda a, i: a + F.log((n - k + i) / i)))
    last = log_ways + k * math.log(p) + (n - k) * math.log1p(-p)
    down = F.aggregate(F.when(k == 0, F.array().cast("array<bigint>")).otherwise(steps),
                       F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
                       lambda a, j: let(a["term"] * (k - j + 1) * (1 - p) / ((n - k + j) * p),
                                        lambda t: F.struct(t.alias("term"), (a["sum"] + t).alias("sum"))))
    return F.exp(last) * down["sum"]


def thresholds(counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, symbols, dup_lines, repeats): the certified cutoffs in thousandths; null: none is certified.

    One row for each class of length, at most len(STRATA). ``labels``: doc_id, quality 0/1; a document with several
    labels counts as bad if one of them is 0; null labels and labels of unknown documents do not count, nor do documents that fail the base
    rules (they go whatever the cutoffs are).
    """
    told = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = counted.filter(~base_failed()).join(told, "doc_id")
    good = (F.col("quality") >= 1).cast("bigint")
    each = held.select(stratum().alias("stratum"), good.alias("good"), F.explode(F.array(*[
        F.struct(F.lit(name).alias("signal"), signal(name).alias("value")) for name in SIGNALS])).alias("s"))
    values = each.groupBy("stratum", "s.signal", "s.value").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad"))
    n = values.groupBy("stratum", "signal").agg(F.sum("good").alias("n"))
    over = values.select("*", F.explode(F.filter(F.array(*map(F.lit, CUTOFFS)), lambda c: c < F.col("value"))).alias("cutoff"))
    cells = (over.groupBy("stratum", "signal", "cutoff").agg(F.sum("good").alias("k"), F.sum("bad").alias("bad"))
             .join(n, ["stratum", "signal"]))
    tests = len(STRATA) * len(SIGNALS)
    a = alpha / len(SIGNALS)
    sure = F.when(F.col("k") < F.col("n") * a, binomial_tail(F.col("n"), F.col("k"), a) <= delta / tests).otherwise(False)
    best = cells.filter(sure & (F.col("bad") > 0)).groupBy("stratum").agg(*[
        F.max(F.when(F.col("signal") == name, F.struct("bad", "cutoff")))["cutoff"].alias(name) for name in SIGNALS])
    return best


def tail(n: int, k: int, p: float) -> float:
    """P(Binomial(n, p) <= k)."""
    ways = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
    return math.fsum(math.exp(ways(i) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))


def pools(good: list[int], alpha: float, delta: float) -> list[list[int]]:
    """Neighbouring strata, each pool with good labels enough to certify a rule that rejects none of them, or all in one.

    Only the numbers of labels decide, no signal of a document.
    """
    need = math.log(delta / len(STRATA)) / math.log1p(-alpha)
    found: list[list[int]] = [[]]
    for k in range(len(STRATA)):
        if sum(good[j] for j in found[-1]) >= need:
            found.append([])
        found[-1].append(k)
    if len(found) > 1 and sum(good[j] for j in found[-1]) < need:
        found[-2:] = [found[-2] + found[-1]]
    return found


def joint_cuts(counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> list[tuple[list[int], int, int, dict[str, int]]]:
    """(strata, n, k, cutoffs) of each pool: its joint rule rejects k of n good documents, and a share of at most ``alpha``
    of all good ones of the pool, for all pools at once with confidence 1 - ``delta``. Signals without a cutoff are not in it.

    The rules of a pool form a chain, each rejecting what the one before rejects and more: one signal's cutoffs from loose
    to strict, then the next signal's beside it. The chain is made from the bad documents alone (signals that reject more
    of them first, only cutoffs that reject further ones), so it is fixed for the good ones, which are tested along it up to
    the first failure: every test may have the whole alpha, and delta is divided by the pools only. The labels count as
    in ``thresholds``. The driver gets a row for each (stratum, signal, cutoff) and each (pool, rule).
    """
    told = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = materialize(counted.filter(~base_failed()).join(told, "doc_id").select(
        stratum().alias("stratum"), (F.col("quality") >= 1).alias("good"), *[signal(n).alias(n) for n in SIGNALS]), "quality-held")
    good = {r["stratum"]: r["count"] for r in held.filter("good").groupBy("stratum").count().collect()}
    over = [F.count_if(F.col(n) > c).alias(f"{n}_{c}") for n in SIGNALS for c in CUTOFFS]
    bad = {r["stratum"]: r for r in held.filter("NOT good").groupBy("stratum").agg(*over).collect()}
    groups = pools([good.get(k, 0) for k in range(len(STRATA))], alpha, delta)
    chains = []
    for own in groups:
        caught = {(n, c): sum(bad[k][f"{n}_{c}"] for k in own if k in bad) for n in SIGNALS for c in CUTOFFS}
        by_signal = {n: [c for c, before in zip(CUTOFFS, [None, *CUTOFFS]) if caught[n, c] > (caught[n, before] if before else 0)] for n in SIGNALS}
        first = sorted(SIGNALS, key=lambda n: -max(caught[n, c] for c in CUTOFFS))
        chains.append([(n, c) for n in first for c in by_signal[n]])
    step = F.lit(0)
    for own, chain in zip(groups, chains, strict=True):
        if chain:  # the first rule of the chain that rejects the document, from 1
            step = F.when(F.col("stratum").isin(own), F.array_position(F.array(*[F.col(n) > c for n, c in chain]), True)).otherwise(step)
    hit = {(r["stratum"], r["step"]): r["count"] for r in held.filter("good").groupBy("stratum", step.alias("step")).count().collect()}
    out = []
    for own, chain in zip(groups, chains, strict=True):
        n, k, cuts = sum(good.get(j, 0) for j in own), 0, {}
        for at, (name, cutoff) in enumerate(chain, 1):
            more = k + sum(hit.get((j, at), 0) for j in own)
            if more >= n * alpha or tail(n, more, alpha) > delta / len(groups):
                break
            k, cuts = more, cuts | {name: cutoff}
        out.append((own, n, k, cuts))
    return out


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", alpha: float = ALPHA, delta: float = DELTA,
          keep_text: bool = False, joint: bool = False) -> DataFrame:
    """docs (without its text, unless kept) with the COUNTS, base_failed and kept, which replace columns of their names.

    kept is false for a document that fails the base rules or has a signal above its stratum's certified cutoff. Null
    text counts as no words; every row of docs gives one row; without labels no cutoff is certified and the base rules
    decide alone. doc_id must be there. ``joint``: the cutoffs of ``joint_cuts``.
    """
    counted = materialize(signals(docs, text, keep_text), "quality-signals")
    if joint:
        over = reduce(lambda x, y: x | y, [stratum().isin(own) & (signal(n) > c) for own, _, _, cuts in joint_cuts(
            counted.select("doc_id", *COUNTS), labels, alpha, delta) for n, c in cuts.items()], F.lit(False))
        work = shield(counted, *COUNTS).withColumns({"base_failed": base_failed(), "kept": ~(base_failed() | over)})
        return work.select(*restore(work, counted.columns, ["base_failed", "kept"]))
    cut = thresholds(counted.select("doc_id", *COUNTS), labels, alpha, delta)
    cut = F.broadcast(cut.select(F.col("stratum").alias("_stratum"), F.struct(*SIGNALS).alias("_cut")))  # len(STRATA) rows at most
    work = shield(counted, *COUNTS)
    joined = work.join(cut, stratum() == F.col("_stratum"), "left")
    over = reduce(lambda x, y: x | y, [F.coalesce(signal(n) > F.col(f"_cut.{n}"), F.lit(False)) for n in SIGNALS])
    told = joined.withColumns({"base_failed": base_failed(), "kept": ~(base_failed() | over)})
    return told.select(*restore(told, counted.columns, ["base_failed", "kept"]))


def op9_risk_controlled_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, one joint rule for each pool of classes certified on the table labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = judge(docs, table(spark, sf_dir, "labels"), joint=True)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
