"""Toxicity: the composed grammar against the single machines, held-out accuracy, edge rows."""

import random
import zlib

from riskloom.llm import grammar as G
from riskloom.llm.queries import op10_toxicity
from riskloom.llm.toxicity import Model, drop_toxic, fit, score

SF = "/root/testdata/sf0.1"


def test_composed_machine_equals_its_parts():
    parts = [G.insult(), G.threat(4.0), G.target(), G.negation(), G.reported()]
    start, table = G.compose(parts)
    rng = random.Random(1)
    for _ in range(300):
        kinds = rng.choices(G.CLASSES, k=rng.randint(0, 12))
        states, want = [p.start for p in parts], 0.0
        for k in kinds:
            steps = [p.step(s, k) for p, s in zip(parts, states)]
            states = [s[0] for s in steps]
            factor = 1.0
            for s in steps:
                factor *= s[1]
            want += 2.0 * (k == G.INSULT) * factor
            for j, s in enumerate(steps):
                amount = s[2]
                for i, other in enumerate(steps):
                    amount *= other[1] if amount and i != j and other[1] else 1.0
                want += amount
        got = G.score_clause(kinds, [2.0 * (k == G.INSULT) for k in kinds], start, table)
        assert abs(got - want) < 1e-9


def test_clauses_not_words():
    m = Model()
    f = lambda t: m.features(t)[0]
    assert f("you are an idiot") > f("an idiot") > f("you are not an idiot") > 0
    assert f("he said an idiot came") < f("an idiot came")
    assert f("I will kill you") > 0 and f("they kill weeds") > 0 and f("to kill time") == 0 and f("kill. you") == 0
    assert f("plain words") == f("") == f(None) == 0


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op10_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    seen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hit = sum(p and y for p, y in seen)
    assert hit / sum(p for p, _ in seen) > 0.93 and hit / sum(y for _, y in seen) > 0.85


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "you idiot, you moron", "x"), (3, "fine", None),
                                  (3, "fine", None), (4, "ok " * 200_000, "x")], "doc_id long, text string, Toxicity string")
    labels = spark.createDataFrame([(1, 1, None), (2, None, 0), (None, 1, 1), (9, 1, 1), (3, 0, 1)],
                                   "doc_id long, toxic int, quality int")
    found = score(docs, fit(docs, labels))
    assert found.columns[:3] == docs.columns and found.count() == 6
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [1, 2, 3, 3, 4]
    assert drop_toxic(docs.limit(0), labels).count() == 0
    assert drop_toxic(docs, labels.limit(0)).count() == 5


def test_a_small_sample_keeps_the_rate_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    whole, few = ({r.doc_id: r.toxicity.predicted for r in score(docs, fit(docs, labels, sample_rows=n)).collect()}
                  for n in (6000, 300))
    n = sum(whole.values())
    # A smaller lexicon finds less; a curve of the sample's own rate would call many clean texts toxic.
    assert sum(few[i] > whole[i] for i in whole) < 0.03 * n
    assert sum(few[i] != whole[i] for i in whole) < 0.15 * n


def test_model_does_not_depend_on_row_order(spark):
    from riskloom.llm import toxicity
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    one = toxicity.fit(docs, labels)
    two = toxicity.fit(docs.repartition(13), labels.repartition(5))
    assert one.words == two.words and one.stems == two.stems and one.curve == two.curve
