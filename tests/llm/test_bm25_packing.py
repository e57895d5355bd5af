"""Packing: every id once, gapless sequences, BM25 scores, neighbours."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

from riskloom.llm.bm25_packing import B, K1, Shard, best_first, fill, pack
from riskloom.llm.queries import op8_bm25_packing, vocabulary

SF = "/root/testdata/sf0.001"


def _check(rows, docs, window=2048):
    """docs: (doc_id, ids). Every id in one piece, sequences gapless, little padding."""
    want, seen, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for i, ids in docs:
        want[i].append(ids)
    for r in rows:
        seen[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(seen) == set(want)
    for i, pieces in seen.items():
        at = defaultdict(list)
        for r in pieces:
            at[r.doc_tokens].append(r)
        for ids in want[i]:
            n = len(want[i])
            if n == 1:
                end = 0
                for r in sorted(pieces, key=lambda r: r.start):
                    assert r.start == end and r.doc_tokens == len(ids)
                    assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
                    end += r.length
                assert end == len(ids)
        assert sum(r.length for r in pieces) == sum(map(len, want[i]))
    short = 0
    for s in sequences.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end and length > 0
            end += length
        assert end <= window
        short += end < window
    return short, len(sequences)


def _ids(text):
    return _TOK.encode(text or "", add_special_tokens=False).ids + [1]


_TOK = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


def test_whole_table(spark):
    docs = [(r.doc_id, _ids(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    short, n = _check(op8_bm25_packing(spark, SF).collect(), docs)
    assert short <= 1 and n == math.ceil(sum(len(x) for _, x in docs) / 2048)


def test_edges_and_many_shards(spark):
    texts = [(1, None), (2, ""), (None, "null id"), (3, "word " * 10_000), (4, "same"), (4, "same")] + \
        [(10 + k, f"topic{k % 5} " * (k % 40)) for k in range(200)]
    df = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, Offset int")
    rows = pack(df, vocabulary("word_bpe_49k.json"), shard_tokens=3000).collect()
    shards = len({r.sequence_id >> 32 for r in rows})
    assert _check(rows, [(i, _ids(t)) for i, t in texts])[0] <= shards and shards > 1
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    assert pack(df.limit(0), vocabulary("word_bpe_49k.json")).count() == 0


def test_scores_are_bm25_and_neighbours_come_first():
    rng = np.random.default_rng(2)
    texts = [rng.integers(10 * (k % 4), 10 * (k % 4) + 12, rng.integers(5, 60)).astype(np.uint16) for k in range(40)]
    df = Counter(t for x in texts for t in set(x.tolist()))
    idf = np.array([math.log(1 + (40 - df[t] + .5) / (df[t] + .5)) for t in range(60)])
    mean = sum(map(len, texts)) / 40
    shard = Shard(texts, idf, mean)
    for k in (0, 7, 39):
        query = set(shard.terms[shard.queries[k]].tolist())
        assert query <= set(texts[k].tolist())
        for j, x in enumerate(texts):
            tf = Counter(x.tolist())
            want = sum(idf[t] * tf[t] * (K1 + 1) / (tf[t] + K1 * (1 - B + B * len(x) / mean)) for t in query if t in tf)
            assert abs(shard.scores(k)[j] - want) < 1e-9
    first = next(s for s in fill(np.array([len(t) for t in texts]), shard.scores, 64) if len(s) > 1)
    seed, second = first[0][0], first[1][0]
    others = shard.scores(seed).copy()
    others[seed] = -1
    assert second == int(np.argmax(others))


def test_best_first_is_a_stable_sort():
    rng = np.random.default_rng(3)
    for n in (1, 10, 16, 17, 500):
        scores = rng.integers(-1, 6, n).astype(float)
        assert list(best_first(scores.copy())) == [k for k in np.argsort(-scores, kind="stable").tolist() if scores[k] > 0]
    few = np.ones(100)
    assert next(best_first(few)) == 0 and (few == 1).sum() == 100  # nothing is sorted or taken before it is asked for
