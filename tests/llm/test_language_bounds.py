"""Operator 5: the training sample holds each (doc_id, lang) once, and no language is left out."""

import pytest

from rulecheck.llm import langid


def test_repeated_id_counts_once(spark, monkeypatch):
    rows = [(i, f"alpha beta gamma {i}", "en") for i in range(20)] + [(99, f"uno dos tres {i % 7}", "es") for i in range(400)]
    seen = []
    monkeypatch.setattr(langid, "train", lambda samples, languages: seen.extend(samples))
    langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), usable=langid.F.lit(True))
    assert len(seen) == 21


def test_every_language_is_learnt(spark, monkeypatch):
    df = spark.createDataFrame([(i, chr(0x4E00 + i) * 30, f"l{i}") for i in range(80)], "doc_id long, text string, lang string")
    assert len(langid.fit(df, usable=langid.F.lit(True)).languages) == 80
    monkeypatch.setattr(langid, "LANGUAGES", 79)
    with pytest.raises(ValueError):
        langid.fit(df, usable=langid.F.lit(True))
