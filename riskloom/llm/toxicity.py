"""Toxicity by a weighted finite-state grammar with a learned lexicon.

``fit``: from labelled training rows, the words and word stems that mark
toxic texts get log-odds weights (the insult class of the grammar). A
logistic curve over a text's clause scores is calibrated on one training
fold with a lexicon of the others; the final lexicon is of all. The rows are a bounded sample: at most
``sample_rows`` per label, taken by a hash of the id; near copies (equal
least hash over 5-word shingles) count once, so one copied text cannot make
its words look toxic. Each calibration row weighs as many training rows of
its label as it stands for, so the curve holds the table's rate of toxic
texts whatever the sample's is. The model is small: at most ``max_entries``
words and stems.

``score``: one narrow pass over all texts. Words of a text are looked up;
clauses with an insult or a threat verb go through the composed grammar
(see ``grammar``); the text's score comes from its clause scores.

Inputs of a score: the text alone. Defined results: a null or empty text has
no clauses and gets the score of a text without matches; null labels, null
ids and labels without a document are left out of training; without labelled
rows of both kinds the built-in lexicon and curve hold; repeated rows stay.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import grammar as G
from riskloom.llm.frames import fresh, tidied, written

TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
STEMS = (4, 5, 6, 7)
FOLDS, HELD_OUT = 4, 2
CALIBRATION_FOLD = 3
BUILT_IN_WEIGHT = 4.0
PRIOR = 4.0


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=lambda: {w: BUILT_IN_WEIGHT for w in G.WORDS[G.INSULT]})
    stems: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, ...] = (-4.0, 2.0, 1.0, 0.0)
    threshold: float = 0.3

    def __post_init__(self):
        self.lengths = sorted({len(s) for s in self.stems})
        self.kinds = {w: k for k in (G.THREAT, G.REPORT, G.NEGATION, G.TARGET) for w in G.WORDS[k]}
        self.threats = set(G.WORDS[G.THREAT])
        self.start, self.table = G.machine()

    def weight(self, word: str) -> float:
        """The word's own weight, or that of its heaviest stem."""
        w = self.words.get(word, 0.0)
        for n in self.lengths:
            if len(word) > n:
                w = max(w, self.stems.get(word[:n], 0.0))
        return w

    def features(self, text: str | None) -> tuple[float, float, float, int]:
        """(all clauses, heaviest clause, per 100 words, matched clauses)."""
        tokens = TOKEN.findall((text or "").lower())
        distinct = set(tokens)
        insults = {w: self.words[w] for w in self.words.keys() & distinct}
        if self.stems:
            for n in self.lengths:
                for w in distinct:
                    if w[:n] in self.stems and len(w) > n:
                        insults[w] = self.weight(w)
        if not insults and self.threats.isdisjoint(distinct):
            return 0.0, 0.0, 0.0, 0
        total = top = 0.0
        matched = words = 0
        clause: list[str] = []
        for token in [*tokens, "."]:
            if token[0] not in ".!?;:\n":
                clause.append(token)
                continue
            words += len(clause)
            if any(w in insults or w in self.threats for w in clause):
                kinds = [G.INSULT if w in insults else self.kinds.get(w, G.OTHER) for w in clause]
                s = G.score_clause(kinds, [insults.get(w, 0.0) for w in clause], self.start, self.table)
                total, top, matched = total + s, max(top, s), matched + (s > 0)
            clause = []
        return total, top, 100 * total / max(words, 20), matched

    def score(self, f: tuple[float, float, float, int]) -> float:
        z = float(np.dot(self.curve, _terms(f)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _terms(f) -> list[float]:
    return [1.0, math.log1p(f[0]), math.log1p(f[1]), math.log1p(f[2])]


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS


def _distinct_key(text: str) -> int:
    words = text.lower().split()
    n = max(1, len(words) - 4)
    return min(xxhash.xxh64_intdigest(" ".join(words[k:k + 5])) for k in range(n)) >> 1


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """(text, toxic, calibrate, weight): a bounded sample of training rows of either label, near copies once.

    The weight is the number of training rows of the label over the number sampled.
    """
    known = (labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic"))
             .where("__id is not null and toxic in (0, 1)").where(fold("__id") != HELD_OUT)
             .groupBy("__id").agg(F.max("toxic").alias("toxic")))
    mixed = F.xxhash64("__id")
    totals = dict(known.groupBy("toxic").count().collect())  # two numbers
    picked = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(mixed, "__id").limit(rows)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    weight = [F.lit(max(1.0, totals.get(label, 0) / rows)) for label in (0, 1)]
    joined = texts.join(picked, F.col("doc_id") == F.col("__id")).select(
        "text", "__id", "toxic", (fold("__id") == CALIBRATION_FOLD).alias("calibrate"),
        F.when(F.col("toxic") == 0, weight[0]).otherwise(weight[1]).alias("weight"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([_distinct_key(t) for t in batch.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "key"])
    id_type = picked.schema["__id"].dataType.simpleString()
    rows = joined.mapInArrow(tidied(keyed), f"text string, `__id` {id_type}, toxic int, calibrate boolean, weight double, key long")
    # Of near copies the one with the smallest id (then text) stays, whatever order the rows come in.
    first = F.min_by(F.struct("text", "calibrate", "weight"), F.struct("__id", "text")).alias("first")
    return written(rows.groupBy("key", "toxic").agg(first).select("first.text", "toxic", "first.calibrate", "first.weight", "key"),
                   "toxicity-sample")


def _counted(sample: DataFrame) -> DataFrame:
    """(feature, toxic texts, clean texts); words start with '=', stems with '^'."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(TOKEN.findall(text.lower()))
                counts[toxic].update({"=" + w for w in words} | {"^" + w[:n] for w in words for n in STEMS if len(w) > n})
                counts[toxic]["#"] += 1
        names = list(counts[0].keys() | counts[1].keys())
        for lo in range(0, len(names), 50_000):
            part = names[lo:lo + 50_000]
            yield pa.RecordBatch.from_pydict({"f": part, "p": [counts[1][x] for x in part], "n": [counts[0][x] for x in part]})
    rows = sample.select("text", "toxic").mapInArrow(tidied(run), "f string, p long, n long")
    return rows.groupBy("f").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 6000,
        max_entries: int = 4000, min_share: float = 0.005, least_odds: float = 2.3) -> Model:
    """Learn the lexicon and the curve; see the module docstring for the bounds."""
    sample = _sample(docs, labels, id_col, text_col, sample_rows)
    bounds = (max_entries, min_share, least_odds)
    curve = _calibrated(_lexicon(sample.where("not calibrate"), *bounds), sample.where("calibrate")).curve
    model = _lexicon(sample, *bounds)
    return Model(model.words, model.stems, curve, model.threshold)


def _lexicon(sample: DataFrame, max_entries: int, min_share: float, least_odds: float) -> Model:
    counted = written(_counted(sample), "toxicity-counts")
    totals = counted.where("f = '#'").first()
    if not totals or not totals.p or not totals.n:
        return Model()
    least, rate = max(3, math.ceil(min_share * totals.p)), totals.p / (totals.p + totals.n)
    # Odds of a toxic text given the entry, against the odds of any text; drawn to those by PRIOR texts.
    odds = F.log((F.col("p") + PRIOR * rate) / (F.col("n") + PRIOR * (1 - rate)) * ((1 - rate) / rate))
    entries = (counted.where((F.col("p") >= least) & (F.col("f") != "#")).withColumn("w", odds)
               .where(F.col("w") >= least_odds).orderBy(F.col("p").desc(), "f").limit(max_entries).collect())
    model = Model()
    return Model(words=model.words | {e.f[1:]: e.w for e in entries if e.f[0] == "=" and e.f[1:].isalpha()},
                 stems={e.f[1:]: e.w for e in entries if e.f[0] == "^"})


def _calibrated(model: Model, rows: DataFrame) -> Model:
    """Logistic curve over the weighted clause scores of the sample's calibration rows (numbers only reach the driver)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_terms(shared.value.features(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"x": found, "y": batch.column(1).to_pylist(), "w": batch.column(2).to_pylist()})
    # Sorted, so that sums of floating-point numbers don't depend on the order of rows either.
    data = sorted(rows.select("text", "toxic", "weight").mapInArrow(tidied(run), "x array<double>, y long, w double").collect(),
                  key=lambda r: (r.x, r.y, r.w))
    y, w = np.array([r.y for r in data], dtype=float), np.array([r.w for r in data])
    if not len(y) or y.min() == y.max():
        return model
    x, beta = np.array([r.x for r in data]), np.zeros(4)
    penalty = np.diag([1e-6, 0.1, 0.1, 0.1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (w * (y - p)) - penalty @ beta)
        beta += np.clip(step, -2, 2)
    return Model(model.words, model.stems, tuple(beta), model.threshold)


_models: dict[str, Model] = {}


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """docs plus a struct: score, predicted, clause_score (heaviest), n_clauses (matched)."""
    out, token = fresh(docs, out_col), uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.stems, model.curve, model.threshold))
    kind = pa.struct([pa.field("score", pa.float64(), False), pa.field("predicted", pa.int32(), False),
                      pa.field("clause_score", pa.float64(), False), pa.field("n_clauses", pa.int64(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if token not in _models:
            _models.clear()
            _models[token] = Model(*shared.value)
        m = _models[token]
        for batch in batches:
            at = [x.lower() for x in batch.schema.names].index(text_col.lower())
            for lo in range(0, batch.num_rows, 512):
                part, rows = batch.slice(lo, 512), []
                for text in part.column(at).to_pylist():
                    f = m.features(text)
                    s = m.score(f)
                    rows.append({"score": s, "predicted": int(s >= m.threshold), "clause_score": f[1], "n_clauses": f[3]})
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, type=kind)], names=[*part.schema.names, out])
    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, T.StructField(out, T.StructType([
        T.StructField("score", T.DoubleType(), False), T.StructField("predicted", T.IntegerType(), False),
        T.StructField("clause_score", T.DoubleType(), False), T.StructField("n_clauses", T.LongType(), False)]), False)]))


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents not predicted toxic, with the columns of docs."""
    found = score(docs, fit(docs, labels, text_col=text_col, **options), text_col)
    return found.where(F.col(f"`{found.columns[-1]}`.predicted") == 0).select([f"`{c}`" for c in docs.columns])
