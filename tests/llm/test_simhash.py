"""SimHash against brute force over all pairs."""

import random
import re

import xxhash

from riskloom.llm.components import components
from riskloom.llm.queries import op6_simhash
from riskloom.llm.simhash import deduplicate, near_duplicates, near_links

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(docs):
    """doc_id -> (fingerprint, component)."""
    prints = {i: brute_print(t) for i, t in docs}
    comp = {i: i for i in prints}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    ids = sorted(prints)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                comp[b] = a
    return {i: (f"{prints[i]:016x}", root(i)) for i in ids}


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in op6_simhash(spark, SF).collect()} == brute(docs)


def test_links_with_and_without_hot_buckets(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = {0, (1 << 64) - 1}
    for b in base:
        for _ in range(12):
            x = b
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    half = base[0] & 0xFFFFFFFF  # many that share one half and differ in the other
    prints |= {half | rng.getrandbits(32) << 32 for _ in range(300)} | {base[1] ^ (1 << k) for k in range(64)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "fp long")
    u = [s[0] for s in signed]
    want = {(min(a, b), max(a, b)) for k, a in enumerate(u) for b in u[k + 1:]
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3}
    for limit in (2000, 5):
        got = [(r.a, r.b) for r in near_links(df, 3, limit).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_edge_rows(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(5, None, "a"), (3, "", "b"), (9, "one", "c"), (4, "One", "d"), (8, text, "e"), (7, text, "f"),
            (7, text, "f"), (None, text, "g"), (2, "x " * 100_000, "h")]
    df = spark.createDataFrame(docs, "doc_id long, text string, fp string")
    got = {(r.doc_id, r.component_id) for r in near_duplicates(df).collect()}
    assert got == {(5, 3), (3, 3), (9, 4), (4, 4), (8, 7), (7, 7), (None, 7), (2, 2)}
    kept = deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 7]
    nameless = spark.createDataFrame([(None, text), (None, text), (1, "other")], "doc_id long, text string")
    assert deduplicate(nameless).count() == 3
    assert near_duplicates(df.limit(0)).count() == 0


def test_components_with_one_id(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    other = "some wholly unrelated words about rivers and the boats that sail on them"
    docs = [(7, text, 1), (7, text.upper(), 2), (7, other, 3), (7, other, 4), (8, text, 5), (7, "third text here", 6),
            (9, "fourth", 7)]
    df = spark.createDataFrame(docs, "doc_id long, text string, n int")
    kept = deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text.lower()) for r in kept.collect()) == [
        (7, text), (7, other), (7, "third text here"), (9, "fourth")]


def test_components_of_long_paths(spark):
    links = [(k, k + 1) for k in range(300)] + [(1000, 1001), (1001, 1000), (2000 + 7, 2000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(301)} | {1000: 1000, 1001: 1000, 2007: 2000, 2000: 2000}
