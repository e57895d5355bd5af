"""Language identification: filters, correction, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import langid
from riskloom.llm.langid import LanguageFilters, _grams, fit, identify
from riskloom.llm.queries import op13_language_id

SF = "/root/testdata/sf0.01"


def brute_grams(text):
    """n-grams of one text as _words makes it."""
    return [text[i:i + n] for n in langid.SIZES for i in range(len(text) - n + 1) if " " not in text[i + 1:i + n - 1]]


def test_grams_are_those_of_the_text(monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 7)
    texts = [" the cat ", " ñu ", " a ", " " + "wörter " * 30]
    got = {i: 0 for i in range(len(texts))}
    seen = {}
    for doc, hashes in _grams(texts):
        for d, h in zip(doc.tolist(), hashes.tolist()):
            got[d] += 1
            seen.setdefault(d, set()).add(h)
    for i, t in enumerate(texts):
        assert got[i] == len(brute_grams(t))
        assert len(seen[i]) == len(set(brute_grams(t)))


def test_filters_return_all_languages_of_a_gram():
    rng = np.random.default_rng(1)
    grams = [rng.integers(0, 2**63, 500, dtype=np.uint64) for _ in range(70)]  # more than one word of bits
    grams[69] = np.concatenate([grams[69], grams[0]])
    f = LanguageFilters([f"l{i}" for i in range(70)], grams)
    for i, g in enumerate(grams):
        assert f._bit(f.masks(g)[i // 64], i).all()
    assert f._bit(f.masks(grams[0])[1], 69).all()
    other = rng.integers(0, 2**63, 20000, dtype=np.uint64)
    share = f._bit(f.masks(other)[0], 3).mean()
    assert abs(share - f.false_share[3]) < 0.01


def test_held_out_accuracy(spark):
    found = op13_language_id(spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.97


def corpus(spark):
    rng = random.Random(5)
    words = {"aa": ["water", "which", "other", "there"], "bb": ["wasser", "welche", "andere", "dort"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=12)) + " shared name", lang) for i, lang in enumerate(["aa", "bb", "aa"] * 40)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_edges(spark):
    filters = fit(corpus(spark), F.lit(True))
    assert filters.languages == ["aa", "bb"]  # by number of texts
    rows = [(1, None), (1, None), (2, ""), (3, "123 !? €"), (4, "WELCHE andere"), (5, "zzzzzz"), (None, "there"),
            (6, "Wasser! " * 200000)]
    docs = spark.createDataFrame([(*r, "x", 1.5) for r in rows], "doc_id long, text string, language string, score double")
    got = identify(docs, filters)
    assert got.columns == ["doc_id", "text", "language", "score", "_language"]
    out = [(r.doc_id, r._language.lang_pred, r._language.score) for r in got.collect()]
    assert [x[:2] for x in out] == [(1, "und"), (1, "und"), (2, "und"), (3, "und"), (4, "bb"), (5, "aa"), (None, "aa"), (6, "bb")]
    assert [x[2] for x in out][:4] == [0.0] * 4 and out[5][2] == 0.0 and out[4][2] > 0.6
    assert identify(docs.where("doc_id = 99"), filters).count() == 0


@pytest.mark.parametrize("condition", ["false", "lang = 'none'"])
def test_nothing_to_learn_from(spark, condition):
    docs = corpus(spark)
    filters = fit(docs.where(condition), F.lit(True))
    assert {r.language.lang_pred for r in identify(docs, filters).collect()} == {"und"}


def test_rows_without_language_or_id_teach_nothing(spark):
    docs = corpus(spark)
    more = docs.selectExpr("doc_id", "'noise words only' as text", "cast(null as string) as lang").unionByName(
        docs.selectExpr("cast(null as long) as doc_id", "text", "'cc' as lang"))
    assert fit(docs.unionByName(more), F.lit(True)).languages == ["aa", "bb"]
