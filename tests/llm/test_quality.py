"""Quality rules against a plain per-text version."""

import os
import re
from collections import Counter

import pytest
import zstandard

from riskloom.llm.quality import Bands, assess, keep, verdict
from riskloom.llm.queries import op4_quality_rules

SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    c, hit = Counter(wins), set()
    for i, w in enumerate(wins):
        if c[w] > 1:
            hit.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": dup, "n_repeat_words": len(hit),
            "base_failed": len(words) < 10 or 100 * len(hit) > 20 * len(words)}


def check(row, text):
    want = brute(text)
    assert {k: row[k] for k in want} == want
    reason = verdict((text or "").encode(), Bands(), zstandard.ZstdCompressor(level=3))[3]
    assert row["kept"] == (not want["base_failed"] and not reason)


def test_whole_table_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op4_quality_rules(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        check(r, texts[r.doc_id])


def test_edge_texts_and_clashing_columns(spark):
    texts = [None, "", " \n\t", "a b c d e a b c d e a b", "x " * 200_000, "été\n\n \nété\né\x0bü <|>", "w" * 3_000_000,
             "same same", "same same"]
    docs = spark.createDataFrame([(i, t, 1, "q") for i, t in enumerate(texts)],
                                 "doc_id long, text string, kept int, Quality_Rules string")
    rows = assess(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        check(r["_quality_rules"], texts[r.doc_id])
        assert r.kept == 1
    assert keep(docs).columns == docs.columns
    assert assess(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text,reason", [
    (os.urandom(20_000).hex(), ""), ("spam ham " * 900, "repetitive"),
    ("".join(chr(33 + b % 90) for b in os.urandom(9_000)), "incompressible")])
def test_bands(text, reason):
    assert verdict(text.encode(), Bands(), zstandard.ZstdCompressor(level=3))[3] in (reason, "chunks" if reason else "")


def test_plain_prose_passes():
    rng = __import__("random").Random(3)
    syll = "ka lo mi tu re san vel tor din pra sho ne wi ga".split()
    for size in (30, 200, 2_000, 20_000):
        words = ["".join(rng.choices(syll, k=rng.randint(1, 4))) for _ in range(size)]
        assert verdict(" ".join(words).encode(), Bands(), zstandard.ZstdCompressor(level=3))[3] == ""


def test_bad_part_only_in_the_tail():
    rng, zip_ = __import__("random").Random(4), zstandard.ZstdCompressor(level=3)
    syll = "ka lo mi tu re san vel tor din pra sho ne wi ga".split()
    plain = " ".join("".join(rng.choices(syll, k=rng.randint(1, 4))) for _ in range(2_000)).encode()
    noise = bytes(33 + rng.randrange(90) for _ in range(1_952))
    raw = plain[:2_048] + noise
    low, high = Bands().of(len(raw))
    assert low <= len(raw) / len(zip_.compress(raw)) <= high  # as a whole it passes
    assert verdict(raw, Bands(), zip_)[1:] == (2, 1, "chunks")
    assert verdict(plain[:4_096], Bands(), zip_)[1:] == (2, 0, "")
    assert verdict(plain[:4_097], Bands(), zip_)[1:] == (3, 0, "")
    assert verdict(plain[:2_047], Bands(), zip_)[1:] == (0, 0, "")
