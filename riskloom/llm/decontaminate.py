"""Benchmark decontamination: broadcast n-gram hashes, scan, verify, remove.

The windows of all benchmark items (``n`` consecutive normalised words; a
shorter item is one window of all its words) form a hash set that every
task holds. Tasks slide over the words of their documents, look the window
hashes up, and compare the words of every hash hit with the item's words,
so a hash collision never counts.

Size: the items are measured first. They are broadcast in blocks of at
most ``block_bytes`` of text; each block is one narrow pass over the
documents (no shuffle), whose hits add to those of the passes before.
One block is the usual case; documents are never shuffled.

Defined results: a null or empty text has no words and no hits; items
without words have no window; repeated item ids count once; repeated
document rows give a row each. Input columns of any name are kept.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import text as X
from riskloom.llm.frames import fresh, text_bytes, tidied, written

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
FILTER_BITS = 22
BLOCK_BYTES = 16 << 20

HITS = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("runs", T.ArrayType(T.StructType([
        T.StructField("word", T.LongType(), False), T.StructField("words", T.LongType(), False),
        T.StructField("byte", T.LongType(), False), T.StructField("bytes", T.LongType(), False)]), False), False),
    T.StructField("items", T.ArrayType(T.StringType(), False), False)])
_ARROW_HITS = pa.struct([
    pa.field("n_words", pa.int64(), False),
    pa.field("runs", pa.list_(pa.field("element", pa.struct([
        pa.field("word", pa.int64(), False), pa.field("words", pa.int64(), False),
        pa.field("byte", pa.int64(), False), pa.field("bytes", pa.int64(), False)]), False)), False),
    pa.field("items", pa.list_(pa.field("element", pa.string(), False)), False)])


class Windows:
    """Hash set of item windows: hash -> the words of each window and the items that hold it."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        by_words: dict[bytes, set[str]] = {}
        for item_id, item in items:
            words = WORD.findall((item or "").encode().translate(X.LOWER))
            size = min(n, len(words))
            for k in range(len(words) - size + 1 if size else 0):
                by_words.setdefault(b" ".join(words[k:k + size]), set()).add(item_id)
        self.by_hash: dict[int, list[tuple[bytes, set[str]]]] = {}
        self.lengths: dict[int, np.ndarray] = {}
        hashes: dict[int, list[int]] = {}
        for words, ids in by_words.items():
            size = words.count(b" ") + 1
            data = np.frombuffer(words, dtype=np.uint8)
            h = int(X.windows(X.hash_words(data, np.zeros(0, np.int64), X.ALNUM, True)[0], size)[0])
            self.by_hash.setdefault(h, []).append((words, ids))
            hashes.setdefault(size, []).append(h)
        for size, found in hashes.items():
            keys = np.unique(np.array(found, dtype=np.uint64))
            seen = np.zeros(1 << FILTER_BITS, dtype=bool)
            seen[keys >> np.uint64(64 - FILTER_BITS)] = True
            self.lengths[size] = (keys, seen)

    def scan(self, data: np.ndarray, bounds: np.ndarray) -> list[dict]:
        """Hits of each text; ``bounds``: where the texts begin in data, and its end."""
        hashes, starts, lens = X.hash_words(data, bounds[:-1], X.ALNUM, True)
        ends = starts + lens
        first_word = np.searchsorted(starts, bounds)
        texts = len(bounds) - 1
        found: list[list] = [[] for _ in range(texts)]
        for size, (keys, seen) in self.lengths.items():
            at = X.windows(hashes, size)
            maybe = np.flatnonzero(seen[at >> np.uint64(64 - FILTER_BITS)])
            if not len(maybe):
                continue
            slot = np.searchsorted(keys, at[maybe])
            maybe = maybe[keys[np.minimum(slot, len(keys) - 1)] == at[maybe]]
            owner = np.searchsorted(first_word, maybe, side="right") - 1
            whole = maybe + size <= first_word[owner + 1]
            for i, t in zip(maybe[whole].tolist(), owner[whole].tolist()):
                words = b" ".join(WORD.findall(data[starts[i]:ends[i + size - 1]].tobytes().translate(X.LOWER)))
                for known, ids in self.by_hash[int(at[i])]:
                    if known == words:
                        found[t].append((i, i + size, ids))
        out = []
        for t in range(texts):
            base, runs, ids = int(first_word[t]), [], set()
            for lo, hi, who in sorted(found[t], key=lambda x: x[:2]):
                ids |= who
                if runs and lo <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], hi)
                else:
                    runs.append([lo, hi])
            out.append({"n_words": int(first_word[t + 1]) - base, "items": sorted(ids), "runs": [
                {"word": lo - base, "words": hi - lo, "byte": int(starts[lo] - bounds[t]),
                 "bytes": int(ends[hi - 1] - starts[lo])} for lo, hi in runs]})
        return out


def _merged(old: list[dict], new: list[dict]) -> list[dict]:
    runs: list[dict] = []
    for r in sorted([*old, *new], key=lambda r: (r["word"], r["words"])):
        if runs and r["word"] <= runs[-1]["word"] + runs[-1]["words"]:
            last = runs[-1]
            last["words"] = max(last["words"], r["word"] + r["words"] - last["word"])
            last["bytes"] = max(last["bytes"], r["byte"] + r["bytes"] - last["byte"])
        else:
            runs.append(dict(r))
    return runs


_built: dict[str, Windows] = {}


def _windows(token: str, block, n: int) -> Windows:
    """The block's windows, built once per Python worker; ``token`` names the block."""
    if token not in _built:
        _built.clear()
        _built[token] = Windows(block.value, n)
    return _built[token]


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text",
              item_col: str = "item_id", item_text: str = "text", hits_col: str = "hits",
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs plus ``hits_col``: word count, merged hit runs (words and bytes), item ids as strings."""
    spark = docs.sparkSession
    hits = fresh(docs, hits_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(hits, HITS, False)])
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("id"), F.col(f"`{item_text}`").alias("t")
                             ).where("id is not null and t is not null")
    blocks = max(1, -(-text_bytes(items, "t") // block_bytes))
    out, passes = docs, 0
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("id", "t"), F.lit(blocks)) == b) if blocks > 1 else items
        block = spark.sparkContext.broadcast([tuple(r) for r in part.distinct().collect()])
        out = out.mapInArrow(tidied(_scanner(block, n, text_col, hits, b > 0)), schema)
        if b + 1 < blocks:
            out = written(out, "decontaminate-pass")
    return out


def _scanner(block, n: int, text_col: str, hits: str, again: bool):
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _windows(token, block, n)
        for batch in batches:
            where = [f.lower() for f in batch.schema.names].index(text_col.lower())
            offsets, data = X.column_bytes(batch.column(where))
            for lo, hi in X.slices(offsets):
                rows = known.scan(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                part = batch.slice(lo, hi - lo)
                if again:
                    at = part.schema.names.index(hits)
                    for row, old in zip(rows, part.column(at).to_pylist()):
                        row["runs"] = _merged(old["runs"], row["runs"])
                        row["items"] = sorted({*old["items"], *row["items"]})
                    part = part.drop_columns([hits])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(rows, type=_ARROW_HITS)], names=[*part.schema.names, hits])
    return run


def _without(batches: Iterator[pa.RecordBatch], text_col: str, hits: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        at, found = [x.lower() for x in names].index(text_col.lower()), batch.column(names.index(hits)).to_pylist()
        texts = batch.column(at).to_pylist()
        for k, h in enumerate(found):
            if h["runs"]:
                raw, kept, last = texts[k].encode(), [], 0
                for r in h["runs"]:
                    kept.append(raw[last:r["byte"]])
                    last = r["byte"] + r["bytes"]
                texts[k] = b"".join([*kept, raw[last:]]).decode()
        columns = list(batch.columns)
        columns[at] = pa.array(texts, type=batch.schema.field(at).type)
        yield pa.RecordBatch.from_arrays(columns, names=names)


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "spans", n: int = 10,
                  text_col: str = "text", **names) -> DataFrame:
    """Remove hit spans (``spans``) or hit documents (``documents``); columns as in docs.

    In span mode the bytes from the first to the last word of each hit run go;
    a document whose words are all hit goes whole. A column ``n_chars`` (any
    case) follows the new text. Clean documents are returned unchanged.
    """
    if mode not in ("spans", "documents"):
        raise ValueError(f"unknown mode {mode}")
    found = find_hits(docs, benchmark, n, text_col, **names)
    hits = found.columns[-1]
    runs = F.col(f"`{hits}`.runs")
    if mode == "documents":
        return found.where(F.size(runs) == 0).drop(hits)
    left = found.where((F.size(runs) == 0) | (F.col(f"`{hits}`.n_words") > F.aggregate(
        F.transform(runs, lambda r: r["words"]), F.lit(0).cast("long"), lambda a, b: a + b)))
    cut = left.mapInArrow(tidied(lambda it: _without(it, text_col, hits)), left.schema)
    return recount(cut.select(docs.columns), text_col)


def recount(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Set ``n_chars``, where docs has it, to the length of the text."""
    for f in docs.schema.fields:
        if f.name.lower() == "n_chars":
            docs = docs.withColumn(f.name, F.char_length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast(f.dataType))
    return docs
