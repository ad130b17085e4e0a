"""Token counts by prefix dynamic programming, for byte-pair vocabularies that merge any two neighbours whose
concatenation is a piece (highest score first, then leftmost).

In such an encoding every prefix of a text has exactly one last token t for which the encoding of the prefix without t,
followed by t, is stable: t and the token before it do not merge differently across their border. So a table over
prefixes holds the last token and the count of each prefix's own encoding; the next entry is found by trying the pieces
that end there (an automaton over all pieces names them). One pass answers the count of every prefix: truncation and budgets need no second encoding.

No piece of the vocabulary holds a space mark after another character, so the table of a text is put together from
those of its words, and those of common words are kept (a bounded number).
"""

from __future__ import annotations

import hashlib
import math
import sys
import types
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulecheck.llm.arrow import with_columns
from rulecheck.llm.common import table

SPACE = "▁"
KNOWN_WORDS, LONG_WORD = 400_000, 64


def merged(text: str, ranks: dict[str, float], until: int = 1) -> list[str]:
    """Plain merging of a short text: the lowest rank, then the leftmost pair, until none is left (or ``until`` parts are)."""
    parts = list(text)
    while len(parts) > until:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            return parts
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def last_merge(text: str, ranks: dict[str, float]) -> tuple[str, str] | None:
    """The two parts whose merge ends the merging of a whole text; None where its characters do not merge to it."""
    parts = merged(text, ranks, until=2)
    return (parts[0], parts[1]) if len(parts) == 2 and parts[0] + parts[1] in ranks else None


@dataclass(frozen=True)
class Pieces:
    """``ranks``: piece -> rank (lower merges first); ``whole``: pieces that their own characters merge to, with the two
    parts of their last merge (None for one character); ``digest`` names the vocabulary."""

    ranks: dict[str, float]
    whole: dict[str, tuple[str, str] | None]
    longest: int = field(default=0)
    digest: str = field(default="")

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size())
               if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        ranks = {model.id_to_piece(i): -model.get_score(i) for i in ids}
        whole = {p: parts for p in ranks if (parts := last_merge(p, ranks)) or len(p) == 1}
        for p in whole:
            if SPACE in p.lstrip(SPACE):
                raise ValueError(f"piece {p!r} holds a space mark after another character")
        digest = hashlib.sha256("\n".join(f"{p}\t{r!r}" for p, r in sorted(ranks.items())).encode()).hexdigest()
        return cls(ranks, whole, max(map(len, whole)), digest)


class _Totals(dict):
    """Word -> token count of the words met lately: when KNOWN_WORDS are kept they become the old ones, and the old ones that
    are not met again go. Unknown words are counted; long ones are not kept."""

    def __init__(self, count):
        super().__init__()
        self.count, self.old = count, {}

    def __missing__(self, word: str) -> int:
        total = self.old.get(word)
        if total is None:
            total = self.count(word)
        if len(word) <= LONG_WORD:
            self.keep(word, total)
        return total

    def keep(self, word: str, total: int) -> None:
        if len(self) >= KNOWN_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = total


class PrefixCounter:
    """Prefix tables of words and texts."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.names = sorted(p for p in pieces.whole if p[-1] in pieces.ranks)  # others end in bytes
        self.sizes = [*map(len, self.names)]
        self.ending = ahocorasick.Automaton(ahocorasick.STORE_INTS)  # finds all pieces that end at each character
        for n, p in enumerate(self.names):
            self.ending.add_word(p, n)
        self.ending.make_automaton()
        self.fits: dict[int, bool] = {}
        self.tables: dict[str, tuple[int, ...]] = {}
        self.runs = [0] + [len(merged(SPACE * k, pieces.ranks)) for k in range(1, 4 * pieces.longest + 1)]
        # a character that no piece holds is spelt in bytes and separates what stands beside it
        cut = "".join(c for c in "\n\t\r" if not any(c in p for p in pieces.ranks))
        own = f"|[{cut}]" if cut else ""
        self.word = regex.compile(f"{SPACE}+[^{SPACE}{cut}]*{own}|[^{SPACE}{cut}]+")
        self.totals = _Totals(self.total)
        self.spines: dict[tuple[str, int], list[tuple[str, float]] | None] = {}

    def run(self, k: int) -> int:
        """Tokens of k space marks alone: from the longest run piece on, the pattern repeats."""
        most, whole = len(self.runs) - 1, self.p.longest
        return self.runs[k] if k <= most else (k - most + whole - 1) // whole + self.runs[k - (k - most + whole - 1) // whole * whole]

    def spine(self, piece: str, side: int) -> list[tuple[str, float]] | None:
        """The parts of a piece that stand at its left (0) or right (1) end while it is merged, from the character to the
        piece, each with the rank of the merge that takes it up. None where a merge comes before one of its parts' own."""
        key = (piece, side)
        if key not in self.spines:
            if len(self.spines) > 4 * KNOWN_WORDS:
                self.spines.clear()
            ranks, whole, out, part, rank, todo = self.p.ranks, self.p.whole, [], piece, math.inf, [piece]
            while part is not None:
                out.append((part, rank))
                rank = ranks.get(part, math.inf)
                parts = whole.get(part)
                part = parts[side] if parts else None
            while todo and out is not None:
                whole_piece = todo.pop()
                for q in whole.get(whole_piece) or ():
                    if len(q) > 1:
                        todo.append(q)
                        if ranks[q] >= ranks[whole_piece]:
                            out = None
            self.spines[key] = out and out[::-1]
        return self.spines[key]

    def apart(self, a: str, b: str) -> bool:
        """Whether two pieces stay apart side by side: their ends are walked in the order in which they are merged, and no pair
        at the border may come first. Steps: the depths of the two pieces."""
        left, right = self.spine(a, 1), self.spine(b, 0)
        if left is None or right is None:
            return merged(a + b, self.p.ranks) == [a, b]
        ranks, i, j = self.p.ranks, 0, 0
        while True:
            (x, up_a), (y, up_b) = left[i], right[j]
            rank = ranks.get(x + y)
            if rank is not None and rank < up_a and rank <= up_b:  # among equals the leftmost merge comes first
                return False
            if up_a == up_b == math.inf:
                return True
            if up_a <= up_b:
                i += 1
            else:
                j += 1

    def fit(self, pair: int) -> bool:
        """Whether two pieces (first * number of pieces + second) stay apart side by side."""
        if len(self.fits) > 4 * KNOWN_WORDS:
            self.fits.clear()
        a, b = divmod(pair, len(self.names))
        found = self.fits[pair] = self.apart(self.names[a], self.names[b])
        return found

    def counts(self, word: str, count: list[int] | None = None, last: list[int] | None = None) -> list[int]:
        """Token counts of all prefixes (from the empty one) of a word with at most one space mark. ``count`` and ``last`` may
        hold the table of a prefix (counts and last tokens): it is carried on in place."""
        sizes, fits, names = self.sizes, self.fits, len(self.names)
        count, last = ([0], [-1]) if count is None else (count, last)  # -1: no piece ends there
        at = len(count) - 1  # prefixes done
        for end, t in self.ending.iter(word):
            if end < at:
                continue  # the last token of this prefix is found
            while at < end:  # characters that no piece ends with, in bytes
                count.append(count[at] + len(word[at].encode()))
                last.append(-1)
                at += 1
            j = end + 1 - sizes[t]
            before = last[j]
            if before >= 0:
                pair = before * names + t
                apart = fits.get(pair)
                if apart is None:
                    apart = self.fit(pair)
                if not apart:
                    continue
            count.append(count[j] + 1)
            last.append(t)
            at += 1
        for c in word[at:]:
            count.append(count[-1] + len(c.encode()))
            last.append(-1)
        return count

    def learn(self, words: Iterable[str]) -> None:
        """Count the words that are not known yet, in sorted order: each carries on the table of the prefix that it shares
        with the word before it."""
        totals = self.totals
        new = sorted({w for w in words if w not in totals and w not in totals.old and len(w) <= LONG_WORD and w[1:2] != SPACE})
        before, count, last = "", [0], [-1]
        for word in new:
            k, most = 0, min(len(before), len(word))
            while k < most and before[k] == word[k]:
                k += 1
            del count[k + 1:], last[k + 1:]
            totals.keep(word, self.counts(word, count, last)[-1])
            before = word

    def total(self, word: str) -> int:
        return self.counts(word)[-1] if word[1:2] != SPACE else self.prefixes(word)[-1]

    def table(self, word: str) -> tuple[list[int], list[bool]]:
        """For each prefix of a word: its token count, and whether its encoding begins with a lone space mark."""
        sizes, fits, names = self.sizes, self.fits, len(self.names)
        count, lone, last = [0], [False], [-1]  # -1: no piece ends there

        def spelt(until: int) -> None:  # characters that no piece ends with, in bytes
            for c in word[len(last) - 1:until]:
                count.append(count[-1] + len(c.encode()))
                lone.append(lone[-1])
                last.append(-1)

        for end, t in self.ending.iter(word):
            if len(last) > end + 1:
                continue  # the last token of this prefix is found
            if len(last) <= end:
                spelt(end)
            j = end + 1 - sizes[t]
            before = last[j]
            if before >= 0:
                pair = before * names + t
                fits_here = fits.get(pair)
                if not (self.fit(pair) if fits_here is None else fits_here):
                    continue
            count.append(count[j] + 1)
            lone.append(lone[j] if j else sizes[t] == 1 and word[0] == SPACE)
            last.append(t)
        spelt(len(word))
        return count, lone

    def prefixes(self, word: str) -> tuple[int, ...]:
        """Token counts of all prefixes (from the empty one) of a run of space marks and what follows it."""
        found = self.tables.get(word)
        if found is None:
            k = len(word) - len(word.lstrip(SPACE))
            if k < 2:
                found = tuple(self.counts(word))
            else:  # the last mark goes with the word if it merges there; marks merge among themselves after all else
                count, lone = self.table(word[k - 1:])
                found = (*map(self.run, range(k + 1)), *(self.run(k) + n - 1 if x else self.run(k - 1) + n for n, x in zip(count[2:], lone[2:], strict=True)))
            if len(word) <= LONG_WORD:
                self.tables[word] = found
        return found

    def words(self, text: str) -> list[str]:
        if len(self.tables) > KNOWN_WORDS // 4:
            self.tables.clear()
        return self.word.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def all_prefixes(self, text: str) -> np.ndarray:
        """Token count of text[:i] for every i."""
        out, done = [0], 0
        for w in self.words(text):
            own = self.prefixes(w)
            out.extend(done + n for n in own[1:])
            done += own[-1]
        return np.array([0, *out[2:]] if text else [0], dtype=np.int32)  # the mark before the text is no character of it

    def total_and_fit(self, text: str, limit: int, words: list[str] | None = None) -> tuple[int, int]:
        """(token count, characters of the longest prefix with at most ``limit`` tokens). ``words``: those of the text."""
        words = self.words(text) if words is None else words
        own = [*map(self.totals.__getitem__, words)]
        total = sum(own)
        if total <= limit:
            return total, len(text)
        before, end = total, len(text) + 1
        for w, n in zip(reversed(words), reversed(own), strict=True):
            before -= n
            end -= len(w)
            if before <= limit:
                counts = self.prefixes(w)
                for i in range(len(w), -1, -1):
                    if before + counts[i] <= limit:
                        return total, max(0, end + i - 1)
        return total, 0


def kept_counter(pieces: Pieces) -> PrefixCounter:
    """The counter of a vocabulary, kept with all it has learnt for the later tasks of this Python worker. (This subpackage
    travels with each task, so its own modules are new every time.)"""
    kept = sys.modules.setdefault("_corpus_kept", types.ModuleType("_corpus_kept")).__dict__
    key = f"counter_{pieces.digest}"
    if key not in kept:
        kept[key] = PrefixCounter(pieces)
    return kept[key]


def count_tokens(df: DataFrame, pieces: Pieces, limit: int, text: str = "text", prefixes: bool = False) -> DataFrame:
    """df with n_tokens long, fit_chars long (characters that fit in ``limit`` tokens) and, if asked for, prefix_tokens
    array<int> (the count of every prefix, from the empty one). Null and empty texts: 0. New columns replace others of their names."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("fit_chars", T.LongType())]
    fields += [T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))] * prefixes

    def make():
        counter = kept_counter(pieces)

        def work(texts: list[str]) -> list[pa.Array]:
            told = [counter.words(t) for t in texts]
            counter.learn(chain.from_iterable(told))
            both = [counter.total_and_fit(t, limit, w) for t, w in zip(texts, told, strict=True)]
            made = [pa.array([n for n, _ in both], pa.int64()), pa.array([c for _, c in both], pa.int64())]
            if prefixes:
                made.append(pa.array([counter.all_prefixes(t) for t in texts], pa.list_(pa.int32())))
            return made

        return work

    return with_columns(df, text, fields, make)


LIMIT = 4096


def op6_prefix_token_counts(spark, sf_dir: str) -> DataFrame:
    """Token counts of every document and the characters that fit in the limit."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = count_tokens(docs, Pieces.load(public_tokenizers.path("piece_bpe_32k.model")), LIMIT)
    return out.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "n_tokens",
                      (F.col("n_tokens") > LIMIT).alias("over_limit"), "fit_chars")
