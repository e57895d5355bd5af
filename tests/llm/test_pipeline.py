"""The pipeline's stages against brute force on a whole small corpus, and on edge rows."""

import hashlib
import re

import corpus_pipeline
from riskloom.llm import toxicity
from riskloom.llm.frames import table
from tests.llm.test_bm25_packing import _check, _ids
from tests.llm.test_simhash import brute as simhash_brute
from tests.llm.test_suffix_dedup import brute as suffix_brute

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _cut_benchmark(text, windows):
    words = [(m.start(), m.end(), m.group()) for m in WORD.finditer((text or "").translate(LOWER))]
    hit = [False] * len(words)
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if tuple(w[2] for w in words[i:i + size]) in windows:
                hit[i:i + size] = [True] * size
    if words and all(hit):
        return None
    out, last = [], 0
    for i, (lo, hi, _) in enumerate(words):
        if hit[i] and (i == 0 or not hit[i - 1]):
            out.append(text[last:lo])
        if hit[i]:
            last = hi
    return "".join(out) + (text or "")[last:] if any(hit) else text


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    want = {r.doc_id: r.text for r in docs.collect() if model.score(model.features(r.text)) < model.threshold}
    held = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert held.columns == columns and {r.doc_id: r.text for r in held.collect()} == want

    of = simhash_brute(list(want.items()))
    want = {i: t for i, t in want.items() if of[i][1] == i}
    held = corpus_pipeline.drop_near_copies(spark, corpus_pipeline.written(held, "t"), SF)
    assert held.columns == columns and {r.doc_id: r.text for r in held.collect()} == want

    shas = dict(zip(want, suffix_brute(list(want.values()), 400)))
    held = corpus_pipeline.written(corpus_pipeline.cut_repeats(spark, corpus_pipeline.written(held, "t"), SF), "t")
    got = {r.doc_id: r.text for r in held.collect()}
    assert held.columns == columns
    assert {i for i, (n, gone, *_) in shas.items() if n == 0 or gone < n} == set(got)
    for i, t in got.items():
        if shas[i][1] == 0 or t.isascii():
            assert hashlib.sha256(t.encode()).hexdigest() == shas[i][3]
    assert all(r.n_chars == len(r.text) for r in held.collect())

    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = WORD.findall((r.text or "").translate(LOWER))
        windows |= {tuple(w[i:i + min(10, len(w))]) for i in range(max(1, len(w) - 9)) if w}
    want = {i: c for i, t in got.items() if (c := _cut_benchmark(t, windows)) is not None}
    held = corpus_pipeline.cut_benchmark(spark, held, SF)
    assert held.columns == columns and {r.doc_id: r.text for r in held.collect()} == want

    rows = corpus_pipeline.run(spark, SF).collect()
    _check(rows, [(i, _ids(t)) for i, t in want.items()])


def test_edge_rows_go_through_every_stage(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id at all", "en", None, 12), (3, "x " * 50_000, "en", "s", 1),
         (4, "twice the same row", "en", "s", 18), (4, "twice the same row", "en", "s", 18)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, SF), "edge")
        assert out.count() > 0 and (name == "packing" or out.columns == docs.columns)
        assert stage(spark, docs.limit(0), SF).count() == 0
        docs = out if name != "packing" else docs
