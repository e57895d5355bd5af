"""Decontamination: oracle SQL, blocks of a large benchmark, removal, edges."""

import pytest

from riskloom.llm.decontaminate import decontaminate, find_hits

ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def _bench(spark, extra=()):
    return spark.createDataFrame([("7", ITEM, 1), ("8", "tiny item", 1), ("9", None, 1), (None, "no id here", 1), ("10", "...", 1),
                                  *extra], "item_id string, text string, hits int")


def _docs(spark):
    return spark.createDataFrame([
        (1, f"Before, {ITEM.upper()} after.", "a"), (2, "alpha beta gamma delta epsilon zeta eta theta iota KAPPA!", "a"),
        (3, "a TINY... item here", "a"), (4, "clean text", "a"), (5, None, "a"), (6, "", "a"), (7, ITEM, "a"), (7, ITEM, "a"),
        (8, "é " + ITEM + " é", "a"), (9, "w " * 600_000 + "tiny item", "a")], "doc_id long, text string, Hits string")


@pytest.mark.parametrize("block_bytes", [1 << 24, 40])
def test_hits(spark, block_bytes):
    found = find_hits(_docs(spark), _bench(spark), block_bytes=block_bytes)
    assert found.columns == ["doc_id", "text", "Hits", "_hits"]
    got = {r.doc_id: (r._hits.n_words, sum(x.words for x in r._hits.runs), r._hits["items"]) for r in found.collect()}
    assert got == {1: (14, 12, ["7"]), 2: (10, 10, ["7"]), 3: (4, 2, ["8"]), 4: (2, 0, []), 5: (0, 0, []), 6: (0, 0, []),
                   7: (12, 12, ["7"]), 8: (14, 12, ["7"]), 9: (600_002, 2, ["8"])}


def test_removal(spark):
    docs, bench = _docs(spark), _bench(spark)
    got = {r.doc_id: r.text for r in decontaminate(docs, bench).collect()}
    assert {k: v for k, v in got.items() if k != 9} == {
        1: "Before,  after.", 3: "a  here", 4: "clean text", 5: None, 6: "", 8: "é  é"}
    assert decontaminate(docs, bench).columns == docs.columns
    assert sorted(r.doc_id for r in decontaminate(docs, bench, mode="documents").collect()) == [4, 5, 6]
    assert decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate(docs, bench.limit(0)).count() == docs.count()
