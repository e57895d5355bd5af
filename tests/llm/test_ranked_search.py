"""Ranked lexical search against a brute-force score of every pair."""

import math
import random
import re

import pytest

from riskloom.llm import ranked_search
from riskloom.llm.ranked_search import Sizes, rank

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    vectors = [(i, terms(t)) for i, t in docs]
    vectors = [(i, w) for i, w in vectors if w]
    n_docs, n_words = len(vectors), sum(len(w) for _, w in vectors)
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(terms(text))
    out = []
    for item, words in queries.items():
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in w for _, w in vectors) + 1)))
                  for t in words}
        scores = []
        for i, w in vectors:
            m = 50 + 50 * len(w) * n_docs // n_words
            s = sum(weight[t] * (1000000000 * w.count(t) // (1000 * w.count(t) + 20 * m)) for t in words)
            if s > 0:
                scores.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return out


def run(spark, docs, items, k, partitions=3, sizes=Sizes()):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions)
    q = spark.createDataFrame(items, "item_id long, text string")
    return [tuple(r) for r in rank(d, q, k, sizes=sizes).collect()]


def texts(n, seed, words=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(words)] + ["Éa", "ÑO", "x1"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    return [" ".join(rng.choices(vocab, weights, k=rng.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, small):
    # Small: many blocks of documents, many levels, cut pieces.
    sizes = Sizes(table_cells=1, least_docs=40, fan=2, piece=50) if small else Sizes()
    docs = list(enumerate(texts(400, 1)))
    items = list(enumerate(texts(30, 2)))
    assert sorted(run(spark, docs, items, 7, sizes=sizes)) == sorted(brute(docs, items, 7))


def test_seed_part_and_item_blocks_change_nothing(spark):
    docs = list(enumerate(texts(300, 3)))
    items = list(enumerate(texts(25, 4)))
    assert sorted(run(spark, docs, items, 5, sizes=Sizes(seed_docs=50, item_block_bytes=500))) == sorted(brute(docs, items, 5))


def test_ties_repeated_rows_nulls_and_empty(spark):
    docs = [(i % 40, "alpha beta") for i in range(200)] + [(None, "alpha beta"), (7, None), (8, ""), (9, "... !"),
                                                          (10, "gamma"), (11, "long " * 3000 + "alpha")]
    items = [(1, "Alpha"), (1, "GAMMA"), (2, None), (3, ""), (4, "nowhere"), (None, "beta")]
    got = run(spark, docs, items, 50)
    assert sorted(got, key=repr) == sorted(brute(docs, items, 50), key=repr)
    assert {r[0] for r in got} == {1, None}


def test_empty_tables_and_clashing_names(spark):
    one = spark.createDataFrame([(1, "a b", "x", 3)], "doc_id long, text string, rank string, score int")
    none = one.where("doc_id is null")
    items = spark.createDataFrame([(1, "a", 2)], "item_id long, text string, document int")
    assert rank(none, items, 3).count() == 0
    assert rank(one, items.where("item_id is null"), 3).count() == 0
    assert [tuple(r)[:3] for r in rank(one, items, 3).collect()] == [(1, 1, 1)]
    assert rank(one, items, 3).columns == ["item", "rank", "document", "score"]


def test_words_that_share_a_hash_are_told_apart():
    import numpy as np
    v = ranked_search.Vocabulary(["aa", "bb", "cc"])
    v.hashes, v.order = np.array([5, 5, 5], np.uint64), np.array([0, 1, 2])
    data = np.frombuffer(b"CC bb dd aa", np.uint8)
    found = v.find(data, np.full(4, 5, np.uint64), np.array([0, 3, 6, 9]), np.full(4, 2))
    assert found.tolist() == [2, 1, -1, 0]
