"""Periodic runs: stretches of words that repeat with a period, found by block convolution at dyadic scales.

A run is a stretch of consecutive words with smallest period q and at least max(24, 3 q) words that no neighbouring
word extends. At the scale P it has a period in (P/2, P] (the first scale takes 1 to 8), so the words it shares with
themselves q further on contain a whole aligned block of P/2 words. Each block is held against the words that follow it:
the sum of squared differences of the word numbers at every distance is one correlation, computed exactly by number
theoretic transforms, and zero just where the block occurs again. These distances are seeds, which are extended to both
sides by comparing words.

Blocks with a word that does not occur again within P words are left out first: they cannot match. The sums stay
below the product of the primes used, so a remainder of zero by each of them means zero.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulecheck.llm.arrow import with_columns
from rulecheck.llm.common import let, shield, table

WORD = r"[^\x20\x09-\x0D]+"
LEAST, POWER = 24, 3  # a run has at least LEAST words and POWER periods
FIRST = 8  # periods 1 .. FIRST are searched at the first scale, in blocks of FIRST words
#: Primes c * 2**k + 1 with k >= 26 and a generator of each. Transforms of up to 2**26 words.
PRIMES = ((2013265921, 31), (1811939329, 13), (469762049, 3))
CELLS = 1 << 19  # numbers in one transform call

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _roots(p: int, generator: int, n: int, back: bool) -> list[np.ndarray]:
    """For halves n/2, n/4, .. 1: the powers of the root of unity of order 2 * half (inverse roots when back)."""
    out, half = [], n // 2
    while half:
        w = pow(generator, (p - 1) // (2 * half), p)
        if back:
            w = pow(w, p - 2, p)
        powers = np.ones(half, np.uint64)
        done = 1
        while done < half:
            powers[done:2 * done] = powers[:done] * np.uint64(pow(w, done, p)) % np.uint64(p)
            done *= 2
        out.append(powers)
        half //= 2
    return out


def _forward(rows: np.ndarray, p: int, roots: list[np.ndarray]) -> np.ndarray:
    """Transforms of all rows; the results stay in bit-reversed order."""
    m, n = rows.shape
    mod = np.uint64(p)
    for powers in roots:
        half = len(powers)
        pair = rows.reshape(m, n // (2 * half), 2, half)
        a, b = pair[:, :, 0], pair[:, :, 1]
        low = a + b
        high = (a + (mod - b)) % mod * powers % mod
        low -= mod * (low >= mod)
        rows = np.stack((low, high), axis=2)
    return rows.reshape(m, n)


def _backward(rows: np.ndarray, p: int, roots: list[np.ndarray]) -> np.ndarray:
    """The inverse of _forward, from bit-reversed order."""
    m, n = rows.shape
    mod = np.uint64(p)
    for powers in reversed(roots):
        half = len(powers)
        pair = rows.reshape(m, n // (2 * half), 2, half)
        a, b = pair[:, :, 0], pair[:, :, 1] * powers % mod
        low, high = a + b, a + (mod - b)
        low -= mod * (low >= mod)
        high -= mod * (high >= mod)
        rows = np.stack((low, high), axis=2)
    return rows.reshape(m, n) * np.uint64(pow(n, p - 2, p)) % mod


def zero_lags(blocks: np.ndarray, windows: np.ndarray, lags: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, lag) of every lag < lags at which a row's block equals the part of the row's window from that lag on.

    blocks (m, b) and windows (m, b + lags - 1 at least) hold integers of zero or more.
    """
    m, size = blocks.shape
    n = 1 << max(1, (windows.shape[1] - 1).bit_length())
    most = size * int(max(blocks.max(initial=0), windows.max(initial=0))) ** 2
    rows, at = np.divmod(np.arange(m * lags), lags)
    bound = 1
    for p, generator in PRIMES:
        if not len(rows):
            break
        mod = np.uint64(p)
        live, inside = np.unique(rows, return_inverse=True)
        x, y = blocks[live].astype(np.uint64) % mod, windows[live].astype(np.uint64) % mod
        reversed_x = np.zeros((len(live), n), np.uint64)
        reversed_x[:, 0], reversed_x[:, n - size + 1:] = x[:, 0], x[:, :0:-1]
        padded = np.zeros((len(live), n), np.uint64)
        padded[:, :y.shape[1]] = y
        ahead, back = _roots(p, generator, n, False), _roots(p, generator, n, True)
        cross = _backward(_forward(reversed_x, p, ahead) * _forward(padded, p, ahead) % mod, p, back)[:, :lags]
        squares = np.zeros((len(live), y.shape[1] + 1), np.uint64)
        np.cumsum(y * y % mod, axis=1, out=squares[:, 1:])  # at most 2**26 numbers below 2**31
        own = (x * x % mod).sum(axis=1) % mod
        total = own[:, None] + (squares[:, size:size + lags] - squares[:, :lags]) % mod + 2 * (mod - cross)
        zero = (total % mod == 0)[inside, at]
        rows, at = rows[zero], at[zero]
        bound *= p
        if most < bound:
            break
    else:
        raise ValueError("the numbers are too large for the primes in use")
    return rows, at


def _first_difference(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal numbers that a and b begin with."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differs = a[at:min(at + step, n)] != b[at:min(at + step, n)]
        if differs.any():
            return at + int(differs.argmax())
        at, step = at + step, step * 2
    return n


def _prime_factors(n: int) -> list[int]:
    found, f = [], 2
    while f * f <= n:
        if n % f == 0:
            found.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return [*found, n] if n > 1 else found


def _next_distance(words: np.ndarray) -> np.ndarray:
    """How many words later each word occurs again; a very large number where it does not."""
    out = np.full(len(words), np.iinfo(np.int64).max)
    order = np.argsort(words, kind="stable")
    again = words[order[1:]] == words[order[:-1]]
    out[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return out


def find_runs(words: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of the word numbers, by start and period. No text has more than ``longest`` words
    (all of them, where not given); numbers that occur once may separate texts."""
    n = len(words)
    longest = n if longest is None else longest
    if longest < LEAST:
        return []
    words = words.astype(np.int64)
    far = _next_distance(words)
    padded = np.append(words, words.max() + 1)  # windows that leave the words see a number of no word
    covered = np.zeros(n, np.int64)  # the furthest end of a run of an earlier scale around each word
    runs: list[tuple[int, int, int]] = []
    period_to, size = FIRST, FIRST
    while True:
        least_period = 1 if period_to == FIRST else period_to // 2 + 1
        if POWER * least_period > longest:
            break
        lags, found = period_to - least_period + 1, len(runs)
        full = n // size
        live = np.flatnonzero((far[:full * size] <= period_to).reshape(full, size).all(axis=1)) * size
        stretches: dict[int, tuple[int, int]] = {}  # period -> the last stretch seen
        per_call = max(1, CELLS // (2 * period_to))
        for k in range(0, len(live), per_call):
            starts = live[k:k + per_call]
            blocks = words[starts[:, None] + np.arange(size)]
            windows = padded[np.minimum(starts[:, None] + np.arange(least_period, period_to + size), n)]
            row, lag = zero_lags(blocks, windows, lags)
            s, d = starts[row], lag + least_period
            new = covered[s] < s + d + size  # else the stretch repeats the shorter period of a run found before
            for start, period in zip(s[new].tolist(), d[new].tolist(), strict=True):
                low, high = stretches.get(period, (0, 0))
                if low <= start and start + period + size <= high:
                    continue
                high = start + size + _first_difference(words[start + size:n - period], words[start + size + period:]) + period
                low = start - _first_difference(words[:start][::-1], words[period:start + period][::-1])
                stretches[period] = (low, high)
                part = words[low:high]
                if high - low >= max(LEAST, POWER * period) and not any(
                        (part[period // f:] == part[:-(period // f)]).all() for f in _prime_factors(period)):
                    runs.append((low, high - low, period))
        for low, length, _ in runs[found:]:
            covered[low:low + length] = np.maximum(covered[low:low + length], low + length)
        period_to, size = period_to * 2, period_to
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _work() -> Callable[[list[str]], list[pa.Array]]:
    pattern = re.compile(WORD)

    def work(texts: list[str]) -> list[pa.Array]:
        told = [pattern.findall(t) for t in texts]
        counts = np.array([len(t) for t in told], np.int64)
        flat = pa.array(chain.from_iterable(told), pa.string(), size=int(counts.sum())).dictionary_encode()
        ends = counts.cumsum()
        # a number of its own after each text keeps the runs inside the texts
        words = np.insert(flat.indices.to_numpy().astype(np.int64), ends, len(flat.dictionary) + np.arange(len(told)))
        starts = ends - counts + np.arange(len(told))
        runs: list[list[dict]] = [[] for _ in told]
        for low, length, period in find_runs(words, int(counts.max(initial=0))):
            doc = int(starts.searchsorted(low, side="right")) - 1
            runs[doc].append({"start": low - int(starts[doc]), "length": length, "period": period})
        kept = [collapse(t, r) if r else " ".join(t) for t, r in zip(told, runs, strict=True)]
        return [pa.array(counts), pa.array(runs, pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN]))), pa.array(kept, pa.string())]

    return work


def collapse(words: list[str], runs: list[dict]) -> str:
    """The words without those that any run holds after its first period, joined by one space."""
    edge = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        edge[r["start"] + r["period"]] += 1
        edge[r["start"] + r["length"]] -= 1
    return " ".join([w for w, over in zip(words, edge.cumsum().tolist()[:-1], strict=True) if not over])


def periodic_runs(df: DataFrame, text: str) -> DataFrame:
    """df with n_words, runs (array of start, length, period, by start and period; starts count words from 0) and
    collapsed (the words, joined by one space, without those a run repeats after its first period).

    Words are stretches without ASCII white space. Null, empty and blank texts have no words, no runs and an empty
    collapsed text; texts of under 24 words have no runs. Rows are told apart by nothing but their place, so repeated rows
    and ties give equal results; an empty table stays empty. The three new columns replace others of their names. A text
    is read whole; memory follows the longest text. Periods above 2**26 words are refused.
    """
    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    return with_columns(df, text, fields, _work)


def planted(doc_id: Column, text: Column) -> Column:
    """The text in which, for a tenth of the ids, all words from one on repeat the first few of them."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def repeat(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return let(F.struct(a.alias("a"), p.alias("p")), lambda at: F.array_join(F.transform(
            words, lambda _, i: F.when(i < at["a"], words[i]).otherwise(words[at["a"] + (i - at["a"]) % at["p"]])), " "))

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.when((h % 10 == 0) & text.rlike(WORD), let(words, repeat)).otherwise(text)


def strongest(runs: Column) -> Column:
    """The run of most periods; among equals the first. Null where there is none."""
    better = lambda r, best: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, r: F.when(better(r, best), r).otherwise(best))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Every document's number of periodic runs, its strongest run and digests of all runs and of the collapsed text.

    Null, empty and blank texts: no run, four nulls, digests of the empty text. A null doc_id plants nothing.
    """
    docs = shield(table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")), "doc_id", "text")
    best = F.col("best")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    told = periodic_runs(docs, "text").withColumns({
        "best": strongest(F.col("runs")), "lines": F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")})
    return told.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(F.lit(1000).cast("bigint") * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
