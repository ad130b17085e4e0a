"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by stochastic gradient
descent in numpy, with calibrated rejection.

A text's subwords are the pairs and triples of neighbouring characters (lower case; everything that is no letter is one
boundary mark) that hold a letter. Each is hashed to one of BUCKETS embeddings; a text is the mean of its own, and a
linear softmax gives the language. Since all of this is linear before the softmax, prediction sums the class scores of
the buckets (embedding times weights), which is the same mean. The class scores of a text of n subwords are shrunk by
n / (n + SHRINK): a few subwords are little evidence.

Bounds of the fit, whatever the corpus: SAMPLE labelled documents of each of at most LANGUAGES languages (the smallest
hashes of doc_id; one row of each doc_id and language, so a repeated id counts once), each as its distinct buckets. More
languages than that are an error, not left out. A fifth of the sample calibrates: a temperature that makes the score a
probability, and the rejection threshold, the REJECT quantile of the scores of its correctly named documents (never above
one half), so that about that share of good documents is lost.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulecheck.llm.arrow import with_columns
from rulecheck.llm.common import table

BUCKETS, WIDTH = 8192, 16
SAMPLE, LANGUAGES = 1500, 1000
EPOCHS, RATE, BATCH, SEED = 12, 2.0, 32, 7
REJECT = 0.001
SHRINK = 16
WINDOW = 500_000  # characters worked on at once
UND = "und"


_TABLES: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    if "letters" in _TABLES:
        return _TABLES["letters"]
    out = _TABLES["letters"] = np.zeros(0x110000, np.uint32)
    for start, end in ((0x41, 0xD800), (0xF900, 0x20000)):
        for i in range(start, end):
            if unicodedata.category(c := chr(i))[0] == "L":
                low = c.lower()
                out[i] = ord(low) if len(low) == 1 else i
    out[0x20000:0x323B0] = np.arange(0x20000, 0x323B0)  # ideographs
    return out


def subwords(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of pairs and triples, the place of each) over letters and boundary marks (0)."""
    a, b = codes[:-1], codes[1:]
    two = ((a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77)) >> np.uint32(15)) % np.uint32(BUCKETS)
    three = ((a[:-1] * np.uint32(0xC2B2AE3D) + b[:-1] * np.uint32(0x27D4EB2F) + b[1:] * np.uint32(0x165667B1)) >> np.uint32(13)) % np.uint32(BUCKETS)
    some2 = np.flatnonzero((a | b) != 0)
    some3 = np.flatnonzero(b[:-1] != 0)  # a triple is centred on a letter
    return np.concatenate([two[some2], three[some3]]), np.concatenate([some2, some3])


def letters(text: str) -> np.ndarray:
    return letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct buckets, their shares) of each text, for training."""
    out = []
    for text in texts:
        counts = np.zeros(BUCKETS)
        codes = np.concatenate([[0], letters(text), [0]]).astype(np.uint32)
        for i in range(0, max(1, len(codes) - 2), WINDOW):
            got, at = subwords(codes[i:i + WINDOW + 2])
            counts += np.bincount(got[at < WINDOW], minlength=BUCKETS)
        found = np.flatnonzero(counts)
        out.append((found.astype(np.int32), (counts[found] / max(1.0, counts.sum())).astype(np.float32)))
    return out


@dataclass(frozen=True)
class Model:
    """``scores``: class scores of each bucket (embedding times weights); ``reject``: least score of an accepted text."""

    languages: list[str]
    scores: np.ndarray
    temperature: float
    reject: float

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(mean class scores, number of letters) of each text."""
        sums, counts, some = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        parts = [np.zeros(1, np.uint32)]
        for text in texts:
            parts += [letters(text), np.zeros(1, np.uint32)]
        codes = np.concatenate(parts)
        sizes = np.fromiter((len(p) for p in parts[1::2]), np.int64, len(texts))
        ends = (sizes + 1).cumsum()  # the boundary mark after each text; a pair or triple belongs to the text it begins in or before
        for i in range(0, len(codes) - 1, WINDOW):
            got, at = subwords(codes[i:i + WINDOW + 2])
            got, at = got[at < WINDOW], at[at < WINDOW] + i
            owner = np.minimum(ends.searchsorted(at, side="right"), len(texts) - 1)
            counts += np.bincount(owner, minlength=len(texts))
            for k in range(len(self.languages)):
                sums[:, k] += np.bincount(owner, weights=self.scores[got, k], minlength=len(texts))
        for n, p in enumerate(parts[1::2]):
            some[n] = np.count_nonzero(p)
        return sums / (counts + SHRINK)[:, None], some

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        logits, some = self.logits(texts)
        p = softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        return [self.languages[b] if n else UND for b, n in zip(best, some, strict=True)], np.where(some > 0, p.max(axis=1), 0.0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(samples: list[tuple[int, np.ndarray, np.ndarray]], languages: list[str]) -> Model:
    """samples: (place of the language, distinct buckets, their shares), in a fixed order. Stochastic gradient descent."""
    rng = np.random.default_rng(SEED)
    k = len(languages)
    embed = rng.normal(0, 0.3, (BUCKETS, WIDTH)).astype(np.float32)
    weight = rng.normal(0, 0.3, (WIDTH, k)).astype(np.float32)

    def dense(rows: list[int]) -> np.ndarray:
        x = np.zeros((len(rows), BUCKETS), np.float32)
        for r, n in enumerate(rows):
            x[r, samples[n][1]] = samples[n][2]
        return x

    held = [n for n in range(len(samples)) if n % 5 == 4]
    fit = [n for n in range(len(samples)) if n % 5 != 4] or [*range(len(samples))]
    for epoch in range(EPOCHS):
        order = rng.permutation(fit)
        rate = RATE * (1 - epoch / EPOCHS)
        for i in range(0, len(order), BATCH):
            rows = order[i:i + BATCH]
            x, y = dense(rows), np.array([samples[n][0] for n in rows])
            h = x @ embed
            d = softmax(h @ weight)
            d[np.arange(len(rows)), y] -= 1
            d /= len(rows)
            back = d @ weight.T
            weight -= rate * (h.T @ d)
            embed -= (rate * 20) * (x.T @ back)  # shares are small numbers
    scores = (embed @ weight).astype(np.float64)
    held = held or fit
    logits = np.concatenate([dense(held[i:i + 256]) @ scores for i in range(0, len(held), 256)]) if held else np.zeros((0, k))
    y = np.array([samples[n][0] for n in held], dtype=np.int64)

    sure = (len(y) + 1) / (len(y) + 2)  # smoothed targets: a sample without errors does not mean certainty

    def loss(t: float) -> float:
        p = softmax(logits / t)[np.arange(len(y)), y].clip(1e-12, 1 - 1e-12)
        return float(-(sure * np.log(p) + (1 - sure) * np.log(1 - p)).mean()) if len(y) else 0.0

    temperature = min(np.geomspace(0.02, 50, 120), key=loss)
    p = softmax(logits / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == y]) if len(y) else np.zeros(0)
    reject = min(0.5, float(right[int(REJECT * len(right))])) if len(right) else 0.0
    return Model(languages, scores, float(temperature), reject)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", usable: Column | None = None) -> Model:
    """Learn from the labelled documents where ``usable`` holds (default: doc_id not held out). Without any: no languages."""
    told = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col("doc_id").isNotNull() & (~held_out() if usable is None else usable))
    frequent = sorted(r[lang] for r in told.select(lang).distinct().limit(LANGUAGES + 1).collect())
    if len(frequent) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not frequent:
        return Model([UND], np.zeros((BUCKETS, 1)), 1.0, 0.0)
    # one row of each (doc_id, lang), that of the least text hash: a partial aggregate, so copies are gone before the shuffle
    single = told.groupBy("doc_id", lang).agg(F.min(F.xxhash64(text)).alias("h"))
    first = Window.partitionBy(lang).orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = single.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= SAMPLE)
    # at most SAMPLE * LANGUAGES ids, so the broadcast has a proven bound
    hashed = told.select("doc_id", lang, text, F.xxhash64(text).alias("h"))
    chosen = hashed.join(F.broadcast(ids.select("doc_id", lang, "h")), ["doc_id", lang, "h"], "left_semi")
    chosen = chosen.groupBy("doc_id", lang).agg(F.min(text).alias(text))  # equal texts of an id become one row
    fields = [T.StructField("_buckets", T.ArrayType(T.IntegerType())), T.StructField("_shares", T.ArrayType(T.FloatType()))]

    def make():
        def work(texts: list[str]) -> list[pa.Array]:
            got = bags(texts)
            return [pa.array([b for b, _ in got], pa.list_(pa.int32())), pa.array([s for _, s in got], pa.list_(pa.float32()))]

        return work

    bagged = with_columns(chosen, text, fields, make).drop(text).orderBy(F.xxhash64("doc_id"), "doc_id", lang)
    rows = [(frequent.index(r[lang]), np.array(r["_buckets"], np.int32), np.array(r["_shares"], np.float32)) for r in bagged.toLocalIterator()]
    return train(rows, frequent)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred, lang_score (0 to 1) and lang_rejected.

    A null text, or one without a letter, is ``und`` with score 0 and rejected. The new columns replace others of their names.
    """
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()), T.StructField("lang_rejected", T.BooleanType())]

    def make():
        def work(texts: list[str]) -> list[pa.Array]:
            names, scores = model.predict(texts)
            return [pa.array(names, pa.string()), pa.array(scores), pa.array([n == UND or s < model.reject for n, s in zip(names, scores, strict=True)])]

        return work

    return with_columns(docs, text, fields, make)


def op5_subword_langid(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = predict(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))
