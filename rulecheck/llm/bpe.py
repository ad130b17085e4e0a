"""BPE encoding and decoding by batched numpy merge rounds, for the lower-case vocabulary with word ends.

The symbols of many words lie in one flat array. In each round every word merges all places of its lowest-rank pair;
pairs are looked up by binary search over the sorted pair keys. Words are distinct ones of a slice that the task has not
yet met (a bounded table of known words is kept), so the rounds work on a small part of the text.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulecheck.llm.arrow import with_columns
from rulecheck.llm.common import table

#: Fixed by the vocabulary's file format: how texts become words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
KNOWN_WORDS = 200_000
NONE = np.iinfo(np.int32).max


def byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable Latin-1, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars, spare = {}, 256
    for b in range(256):
        chars[b] = chr(b if b in plain else spare)
        spare += b not in plain
    return [chars[b] for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """``keys``: sorted left * size + right of the merge pairs, with their ``ranks`` and ``merged`` ids."""

    tokens: list[str]
    special: dict[str, int]
    keys: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        tokens = [""] * size
        for token, i in {**vocab, **special}.items():
            tokens[i] = token
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = keys.argsort(kind="stable")
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        chars = byte_chars()
        return cls(tokens, special, keys[order], order.astype(np.int32), merged[order],
                   np.array([vocab[c] for c in chars]), np.array([vocab[c + end] for c in chars]))

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ids = np.frombuffer(b"".join(raw), np.uint8)
        ends = sizes.cumsum() - 1
        symbols = self.first[ids]
        symbols[ends] = self.last[ids[ends]]
        word = np.repeat(np.arange(len(raw)), sizes)
        done_ids, done_words = [], []
        while len(symbols):
            pair = np.full(len(symbols), NONE, np.int32)
            place = np.zeros(len(symbols), np.int64)
            inside = np.flatnonzero(word[:-1] == word[1:])
            key = symbols[inside] * len(self.tokens) + symbols[inside + 1]
            at = np.minimum(self.keys.searchsorted(key), len(self.keys) - 1)
            hit = self.keys[at] == key
            pair[inside[hit]], place[inside[hit]] = self.ranks[at[hit]], at[hit]
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lowest = np.repeat(np.minimum.reduceat(pair, starts), np.diff(np.append(starts, len(word))))
            ready = lowest == NONE
            if ready.any():  # words without a pair leave
                done_ids.append(symbols[ready])
                done_words.append(word[ready])
            take = (pair == lowest) & ~ready
            chosen = np.flatnonzero(take)
            # of overlapping places (a pair of equal symbols) every second one, from the left
            run = np.concatenate([[True], np.diff(chosen) > 1]) if len(chosen) else np.zeros(0, bool)
            since = np.arange(len(chosen)) - np.maximum.accumulate(np.where(run, np.arange(len(chosen)), 0))
            chosen = chosen[since % 2 == 0]
            symbols[chosen] = self.merged[place[chosen]]
            stay = ~ready
            stay[chosen + 1] = False
            symbols, word = symbols[stay], word[stay]
        if not done_ids:
            return np.zeros(0, np.int64), sizes
        ids, words_of = np.concatenate(done_ids), np.concatenate(done_words)
        order = words_of.argsort(kind="stable")
        return ids[order], np.bincount(words_of, minlength=len(raw))


class Encoder:
    """Texts to ids, slice by slice, with a bounded table of known words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.word = regex.compile(WORD)
        self.space = regex.compile(r"\p{White_Space}+")
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in vocabulary.special) + ")") if vocabulary.special else None
        self.reset()

    def reset(self) -> None:
        self.known = {s: n for n, s in enumerate(self.v.special)}  # each special string is a word of one id
        self.ids = np.array(list(self.v.special.values()), np.int64)
        self.sizes = np.ones(len(self.ids), np.int64)

    def words(self, text: str) -> list[str]:
        """The words of a text; a special string stands for itself (no word is one: words are lower case and split at |)."""
        if self.special is None or "<|" not in text:
            return self.plain(text)
        parts = self.special.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self.plain(part))]

    def plain(self, text: str) -> list[str]:
        text = self.space.sub(" ", unicodedata.normalize("NFC", text))
        return self.word.findall(text.replace("Σ", "σ").lower())  # no final sigma: one character at a time

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each)."""
        if len(self.known) > KNOWN_WORDS:
            self.reset()
        split = [self.words(t) for t in texts]
        new = list({w for ws in split for w in ws if w not in self.known})
        if new:
            ids, sizes = self.v.merge(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        counts = np.fromiter(map(len, split), np.int64, len(split))
        place = np.fromiter((self.known[w] for ws in split for w in ws), np.int64, int(counts.sum()))
        starts, sizes = (self.sizes.cumsum() - self.sizes)[place], self.sizes[place]
        before = sizes.cumsum() - sizes
        flat = self.ids[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]
        ends = np.concatenate([[0], sizes.cumsum()])[counts.cumsum()]
        return flat, np.diff(np.concatenate([[0], ends]))

    def decode(self, flat: np.ndarray, sizes: np.ndarray) -> list[str]:
        """This vocabulary has no decoder: tokens joined by one space."""
        tokens = [self.v.tokens[i] for i in flat.tolist()]
        ends = sizes.cumsum().tolist()
        return [" ".join(tokens[e - n:e]) for e, n in zip(ends, sizes.tolist(), strict=True)]


def encode_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """df with ids array<int> and decoded string. Null and empty texts: no ids, empty; the two columns replace others of their names.

    The vocabulary is read on the driver (``path``) and sent with the task, so executors need no file.
    """
    vocabulary = Vocabulary.load(path)
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())]

    def make():
        encoder = Encoder(vocabulary)

        def work(texts: list[str]) -> list[pa.Array]:
            flat, sizes = encoder.encode(texts)
            offsets = pa.array(np.concatenate([[0], sizes.cumsum()]).astype(np.int32))
            return [pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32))), pa.array(encoder.decode(flat, sizes), pa.string())]

        return work

    return with_columns(df, text, fields, make)


def op2_batched_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
