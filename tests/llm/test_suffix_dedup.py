"""Repeat removal against brute force over all strings, and the merge's parts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from riskloom.llm.queries import op7_suffix_dedup
from riskloom.llm.suffix_dedup import (GRAM, LENGTH, LoserTree, anchors, common, decode_run, dedup, encode_run, gram_hashes,
                                       reaches, remove_repeats, removed)

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    """Per text: (bytes, removed, spans, sha256 of the rest)."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        spans = [(i, i + length) for i in range(len(r) - length + 1) if seen[r[i:i + length]] > 1]
        flags = np.zeros(len(r), bool)
        for lo, hi in spans:
            flags[lo:hi] = True
        edge = np.diff(np.concatenate([[0], flags.astype(int)]))
        rest = bytes(b for b, f in zip(r, flags) if not f)
        out.append((len(r), int(flags.sum()), int((edge == 1).sum()), hashlib.sha256(rest).hexdigest()))
    return out


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = dict(zip([d[0] for d in docs], brute([d[1] for d in docs], LENGTH)))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op7_suffix_dedup(spark, SF).collect()}
    assert got == want


def _corpus(seed, n, alphabet="ab é\n"):
    rng = random.Random(seed)
    pool = ["".join(rng.choices(alphabet, k=rng.randint(30, 160))) for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(pool)
            i, j = sorted((rng.randrange(len(p)), rng.randrange(len(p))))
            parts.append(rng.choice([p, p[i:j], p[j:], "".join(rng.choices(alphabet, k=rng.randint(0, 50))), "xy" * 40]))
        texts.append("".join(parts))
    return texts + texts[:3] + [None, "", "q" * 500, "ab" * 30]


@pytest.mark.parametrize("seed,limit,run_bytes", [(1, 20_000, 1 << 20), (2, 20_000, 4_000), (3, 3, 4_000), (4, 9, 4_000)])
def test_small_alphabets_many_overlaps(spark, seed, limit, run_bytes):
    texts = _corpus(seed, 60)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, Key string")
    got = dedup(df.repartition(5), length=64, span=40, cluster_limit=limit, run_bytes=run_bytes).collect()
    found = {r.doc_id: (r.dedup.n_bytes, r.dedup.n_removed, r.dedup.n_spans, r.dedup.kept_sha256) for r in got}
    assert found == dict(enumerate(brute(texts, 64)))


def test_removal_keeps_columns_and_clean_texts(spark):
    passage = " ".join(f"word{k}" for k in range(90))
    docs = spark.createDataFrame([(1, "head one " + passage + " tail one", 5), (2, "other start " + passage, 5), (3, "clean é", 7),
                                  (4, None, None), (5, "", 0), (6, "z" * 100_000, 1)], "doc_id long, text string, n_chars int")
    kept = {r.doc_id: (r.text, r.n_chars) for r in remove_repeats(docs).collect()}
    assert kept[3] == ("clean é", 7) and kept[4] == (None, 0) and kept[5] == ("", 0) and 6 not in kept
    assert kept[1][0].startswith("head one") and kept[1][0].endswith("tail one") and "word50" not in kept[1][0] + kept[2][0]
    assert remove_repeats(docs).columns == docs.columns and remove_repeats(docs.limit(0)).count() == 0


def test_front_coding_and_loser_tree():
    rng = random.Random(4)
    for runs in (1, 2, 3, 7):
        items = [[(bytes(rng.choices(b"ab", k=rng.randint(0, 9))), (b"k" * 16, r, 0, b"left"))
                  for _ in range(rng.randint(0, 30))] for r in range(runs)]
        blobs = [encode_run(sorted(x, key=lambda y: y[0])) for x in items]
        last, out = b"", []
        for n, s, payload in LoserTree([decode_run(b) for b in blobs]):
            assert n == common(last, s) and s >= last and payload[3] == b"left"
            out.append(s)
            last = s
        assert out == sorted(s for x in items for s, _ in x)


def test_reaches_equal_all_pairs():
    rng = random.Random(6)
    for _ in range(200):
        n = rng.randint(2, 14)
        both = sorted((bytes(rng.choices(b"ab", k=10)), bytes(rng.choices(b"ab", k=rng.randint(0, 8)))) for _ in range(n))
        rights, lefts = [b[0] for b in both], [b[1] for b in both]
        got = reaches([0] + [common(a, b) for a, b in zip(rights, rights[1:])], lefts, 12)
        for i in range(n):
            pairs = [(common(lefts[i], lefts[j]), common(rights[i], rights[j])) for j in range(n) if j != i]
            good = [p for p in pairs if sum(p) >= 12]
            assert got[i] == ((max(p[0] for p in good), max(p[1] for p in good)) if good else None)


def test_anchors_do_not_depend_on_the_place():
    rng = random.Random(7)
    core = "".join(rng.choices("abc ", k=LENGTH)).encode()
    sets = []
    for head in (b"", b"x" * 17, bytes(rng.choices(b"abc ", k=1000))):
        raw = head + core + b"tail" * 30
        at = anchors(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        sets.append({a - len(head) for a in at.tolist()})
    assert any(0 <= a <= LENGTH - 101 for a in set.intersection(*sets))
    h = gram_hashes(np.frombuffer(core + core, np.uint8))
    assert len(h) == 2 * LENGTH - GRAM + 1 and (h[:LENGTH - GRAM + 1] == h[LENGTH:]).all()
    assert removed(b"abcdef", [(1, 3), (2, 4), (5, 6)]) == (4, 2, b"ae")


def test_a_run_is_sent_bucket_by_bucket():
    """While a full run is sent, its strings are not held a second time."""
    import tracemalloc
    from riskloom.llm.suffix_dedup import SPAN, Run
    rng = random.Random(8)
    run = Run(64, LENGTH, SPAN)
    for k in range(2000):
        raw = rng.randbytes(LENGTH + SPAN)
        assert run.add(k.to_bytes(16, "little"), raw, SPAN) is None
    assert run.add(b"again" * 4, raw, SPAN) == (b"again" * 4, 1, SPAN + LENGTH)
    tracemalloc.start()
    found, known, high = 0, [], 0
    for _, blob, again in run.take():
        items = list(decode_run(blob))
        assert [x[1] for x in items] == sorted(x[1] for x in items)
        found, high = found + len(items), max(high, tracemalloc.get_traced_memory()[1])
        known += again
        del blob, items
    tracemalloc.stop()
    assert found == 2000 and known == [((1999).to_bytes(16, "little"), 1, SPAN + LENGTH)] and not run.seen and not run.size
    assert high < 2000 * (LENGTH + SPAN) / 2
