"""Lexical retrieval packing: documents that share rare words fill a window together.

Texts are encoded once and written with a 16-bit lexical signature each
(signs of a random projection of the distinct ids). Document frequencies of
the ids are summed over all texts; there are as many as the vocabulary has
entries. A range partition by signature makes shards of about
``shard_tokens`` ids, lexically alike texts near each other; rows with equal
signatures may fall into several shards, so no shard grows with the corpus.

A shard is one task: it builds a BM25 inverted index (global document
frequencies and mean length, postings of its own texts), takes the longest
unused rest as seed, and fills the window with the best-scored unused texts.
A text that doesn't fit is cut at the window's end and what is left of it
goes on being unused. Texts longer than a window first give whole windows.
Only the last window of a shard is padded.

Defined results: a null or empty text is its end id alone; repeated rows are
packed each; an empty table gives no rows; null ids stay null.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import tokens
from riskloom.llm.frames import tidied, written

WINDOW = 2048
SHARD_TOKENS = 2_000_000
QUERY_TERMS = 24
K1, B = 1.2, 0.75
_BITS = 16

_ENCODED = "kind int, rid long, doc_id long, n long, signature int, ids binary"
_ENCODED_ARROW = pa.schema([("kind", pa.int32()), ("rid", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()),
                            ("signature", pa.int32()), ("ids", pa.binary())])
PIECE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType(), False),
    T.StructField("length", T.LongType(), False), T.StructField("ids_crc32", T.LongType(), False),
    T.StructField("doc_tokens", T.LongType(), False), T.StructField("sequence_id", T.LongType(), False),
    T.StructField("offset", T.LongType(), False), T.StructField("ids", T.BinaryType())])


def _encode(docs: DataFrame, vocabulary: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Rows of kind 0: a text's ids; kind 1: document frequencies of the ids over a task's texts."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary)
        size = encoder.tokenizer.get_vocab_size()
        signs = np.random.default_rng(11).choice(np.array([-1, 1], dtype=np.int16), (size, _BITS))
        weights = 1 << np.arange(_BITS - 1, -1, -1)
        frequency, rid = np.zeros(size, dtype=np.int64), TaskContext.get().partitionId() << 33
        held = np.zeros(size, dtype=bool)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part, found = batch.slice(lo, 512), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.append(encoder.ids(text or ""), encoder.dtype.type(end_id))
                    held[ids] = True  # the distinct ids in order, without a sort
                    distinct = np.flatnonzero(held)
                    held[distinct] = False
                    frequency[distinct] += 1
                    found.append({"kind": 0, "rid": rid, "doc_id": doc_id, "n": len(ids), "ids": ids.tobytes(),
                                  "signature": int(((signs[distinct].sum(0, dtype=np.int64) > 0) * weights).sum())})
                    rid += 1
                yield pa.RecordBatch.from_pylist(found, schema=_ENCODED_ARROW)
        if frequency.any():
            yield pa.RecordBatch.from_pylist([{"kind": 1, "ids": frequency.astype("<i8").tobytes()}], schema=_ENCODED_ARROW)
    return written(rows.mapInArrow(tidied(run), _ENCODED), "encoded")


def _frequencies(encoded: DataFrame, size: int) -> np.ndarray:
    """Document frequency of each id over all texts (as many numbers as the vocabulary has entries)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total += np.frombuffer(raw, dtype="<i8")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": at, "df": total[at]})
    rows = encoded.where("kind = 1").select("ids").mapInArrow(tidied(run), "id long, df long").groupBy("id").agg(F.sum("df").alias("df"))
    out = np.zeros(size, dtype=np.int64)
    for r in rows.collect():
        out[r.id] = r.df
    return out


class Shard:
    """BM25 index over the texts of one shard."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean_length: float):
        lengths = np.array([len(t) for t in texts])
        owner = np.repeat(np.arange(len(texts)), lengths)
        key, tf = np.unique(np.concatenate(texts).astype(np.int64) * len(texts) + owner, return_counts=True)
        self.term, self.text = np.divmod(key, len(texts))
        norm = K1 * (1 - B + B * lengths[self.text] / mean_length)
        self.impact = idf[self.term] * tf * (K1 + 1) / (tf + norm)
        self.terms, self.first = np.unique(self.term, return_index=True)
        self.ends = np.append(self.first[1:], len(key))
        self.idf, self.n = idf, len(texts)
        order = np.argsort(self.text, kind="stable")
        bounds = np.searchsorted(self.text[order], np.arange(len(texts) + 1))
        slot = np.searchsorted(self.terms, self.term)
        shared = (self.ends - self.first)[slot] > 1
        # The rarest words (over the corpus) that a text shares with others of the shard.
        self.queries = []
        for k in range(len(texts)):
            own = order[bounds[k]:bounds[k + 1]]
            own = own[shared[own]]
            rare = own[np.argsort(-idf[self.term[own]], kind="stable")[:QUERY_TERMS]]
            self.queries.append(slot[rare])

    def scores(self, k: int) -> np.ndarray:
        """BM25 of every text of the shard for text k's query."""
        spans = [slice(self.first[s], self.ends[s]) for s in self.queries[k]]
        if not spans:
            return np.zeros(self.n)
        return np.bincount(np.concatenate([self.text[s] for s in spans]),
                           np.concatenate([self.impact[s] for s in spans]), minlength=self.n)


def best_first(scores: np.ndarray, singly: int = 16) -> Iterator[int]:
    """Places of the scores above 0, highest first, equal ones in order; few windows take more than ``singly``."""
    for _ in range(singly):
        at = int(scores.argmax())
        if scores[at] <= 0:
            return
        yield at
        scores[at] = -1.0
    yield from np.argsort(-scores, kind="stable")[:int((scores > 0).sum())].tolist()


def fill(lengths: np.ndarray, scores, window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (text, start, length); ``scores(k)`` ranks the texts for text k."""
    for k, n in enumerate(lengths):
        for at in range(0, n - window + 1, window):
            yield [(k, at, window)]
    start = lengths // window * window
    rest = lengths - start
    seeds = list(np.argsort(-rest, kind="stable"))
    unused, spare = int((rest > 0).sum()), 0
    while unused:
        while not rest[seeds[spare]]:
            spare += 1
        seed, room, sequence = int(seeds[spare]), window, []
        ranked: Iterator[int] = iter(())
        at, nearest = seed, None
        while room and unused:
            take = int(min(room, rest[at]))
            sequence.append((at, int(start[at]), take))
            start[at] += take
            rest[at] -= take
            room -= take
            unused -= rest[at] == 0
            if not room or not unused:
                break
            if nearest is None:
                nearest = np.where(rest > 0, scores(seed), -1.0)
                ranked = best_first(nearest)
            at = next(ranked, None)
            if at is None:
                while not rest[seeds[spare]]:
                    spare += 1
                at = int(seeds[spare])
        yield sequence


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, shard_tokens: int = SHARD_TOKENS, with_ids: bool = True) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and (or null) ids."""
    encoded = _encode(docs, vocabulary, end_id, id_col, text_col)
    size = tokens.encoder(vocabulary).tokenizer.get_vocab_size()
    dtype = tokens.encoder(vocabulary).dtype
    texts = encoded.where("kind = 0")
    total = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("ids")).first()
    df = _frequencies(encoded, size)
    idf = np.log(1 + (total.n - df + 0.5) / (df + 0.5))
    stats = docs.sparkSession.sparkContext.broadcast((idf, total.ids / max(1, total.n)))
    shards = max(1, math.ceil(total.ids / shard_tokens))
    rows = (texts.select("signature", "rid", "doc_id", "ids").repartitionByRange(shards, "signature", "rid")
            .sortWithinPartitions("signature", "rid").select("doc_id", "ids"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = [], []
        for batch in batches:
            names += batch.column(0).to_pylist()
            held += [np.frombuffer(x, dtype=dtype) for x in batch.column(1).to_pylist()]
        if not held:
            return
        idf, mean_length = stats.value
        shard = Shard(held, idf, mean_length)
        number, out = TaskContext.get().partitionId() << 32, []
        for sequence in fill(np.array([len(t) for t in held]), shard.scores, window):
            offset = 0
            for k, start, length in sequence:
                ids = held[k][start:start + length].astype("<u4").tobytes()
                out.append({"doc_id": names[k], "start": start, "length": length, "ids_crc32": zlib.crc32(ids),
                            "doc_tokens": len(held[k]), "sequence_id": number, "offset": offset,
                            "ids": ids if with_ids else None})
                offset += length
            number += 1
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    return rows.mapInArrow(tidied(run), PIECE)
