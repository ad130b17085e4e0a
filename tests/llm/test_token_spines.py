"""Borders of pieces along their merge spines, and words learnt in sorted order, against plain merging and the library."""

import random
from itertools import chain

import pytest

from rulecheck.llm import token_counts as tc

P = pytest.importorskip("public_tokenizers")
MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return tc.Pieces.load(MODEL)


def test_pieces_stay_apart_as_plain_merging_says(pieces):
    counter, rng = tc.PrefixCounter(pieces), random.Random(4)
    met = {True: 0, False: 0}
    for k in range(12_000):
        a, b = rng.choice(counter.names), rng.choice(counter.names)
        if k % 2:
            word = rng.choice(counter.names)
            cut = rng.randrange(1, max(2, len(word)))
            a, b = word[:cut], word[cut:]
            if a not in pieces.whole or b not in pieces.whole:
                continue
        want = tc.merged(a + b, pieces.ranks) == [a, b]
        met[want] += 1
        assert counter.apart(a, b) == want, (a, b)
    assert min(met.values()) > 500


def test_small_vocabulary_with_ties_and_odd_trees():
    """Ranks that fall towards the whole, equal neighbours and overlapping pieces."""
    rng = random.Random(9)
    for _ in range(60):
        words = {"".join(rng.choice("ab") for _ in range(n)) for n in (2, 2, 3, 3, 4, 5)}
        ranks = {c: 99.0 for c in "ab"} | {w: float(r) for r, w in enumerate(rng.sample(sorted(words), len(words)))}
        whole = {p: parts for p in ranks if (parts := tc.last_merge(p, ranks)) or len(p) == 1}
        assert set(whole) == {p for p in ranks if tc.merged(p, ranks) == [p]}
        counter = tc.PrefixCounter(tc.Pieces(ranks, whole, max(map(len, whole))))
        for a in whole:
            for b in whole:
                assert counter.apart(a, b) == (tc.merged(a + b, ranks) == [a, b]), (ranks, a, b)


def test_sorted_learning_against_the_library(pieces, monkeypatch):
    import sentencepiece

    model, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(2)
    texts = ["", " ", "  ", "a  b", "\n\n x", "日本語 テスト", "🙂🙂a🙂", "a\tb\r\n", "</s> <s>", "   " * 30, "x" * 300, "ab" * 200, "\u0000z", "é ﬁ ＡＢ", "▁▁ x▁"]
    texts += ["".join(rng.choice("abco e\n▁éß日🙂<>/s ") for _ in range(rng.randrange(60))) for _ in range(1_500)]
    monkeypatch.setattr(tc, "KNOWN_WORDS", 300)  # so that words are forgotten on the way
    counter = tc.PrefixCounter(pieces)
    for k in range(0, len(texts), 100):
        part = texts[k:k + 100]
        told = [counter.words(t) for t in part]
        counter.learn(chain.from_iterable(told))
        for t, w in zip(part, told, strict=True):
            total, fit = counter.total_and_fit(t, 7, w)
            assert total == len(model.encode(t)), t
            assert total <= 7 and fit == len(t) or total > 7 and counter.all_prefixes(t)[fit] <= 7
    assert len(counter.totals) <= 300 and counter.totals.old


def test_prefix_counts_are_made_only_where_asked_for(pieces, monkeypatch):
    texts, made, own = ["ab cd", "", "x" * 90], [], tc.PrefixCounter.all_prefixes
    monkeypatch.setattr(tc, "with_columns", lambda df, text, fields, make: make())
    monkeypatch.setattr(tc, "kept_counter", tc.PrefixCounter)
    monkeypatch.setattr(tc.PrefixCounter, "all_prefixes", lambda self, text: made.append(text) or own(self, text))
    plain = tc.count_tokens(None, pieces, 7)(texts)
    assert len(plain) == 2 and not made
    more = tc.count_tokens(None, pieces, 7, prefixes=True)(texts)
    assert made == texts and more[:2] == plain and [p[-1] for p in more[2].to_pylist()] == plain[0].to_pylist()
