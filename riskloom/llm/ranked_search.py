"""Ranked lexical search: the k best documents of every item, by dual-tree search.

A document and an item are vectors over the terms of the items. A term's
coordinate in a document is its length-normalised frequency, so a score is
the sum of weight * coordinate over the item's terms. Every task puts its
documents into blocks, orders a block by the rarest terms of its documents
and builds a hierarchy over it; a node holds the coordinate maxima of its
documents. A second hierarchy is over the items; a node holds the union of
its items' terms and their weakest k-th score. A pair of nodes goes only as
far as its bound, the sum of weight * maximum, reaches that score: below it
no document of the one node can enter the list of any item of the other.
At the leaves the bound is the score itself, so the search is exact.

Steps: (1) the terms of the items, (2) one scan of the texts to document
vectors, written to the shared folder, (3) their statistics: documents,
words, documents of each term, (4) the dual-tree search in every task,
(5) the k best of each item out of the lists of the tasks.

Start of the k-th scores: a table of over ``2 * seed_docs`` documents is
first searched in a part of about ``seed_docs`` documents. The k-th score
there is a lower bound of the k-th score of all, so every task starts to
prune at once and returns few rows. All documents are searched after that;
the part decides nothing but speed.

Sizes: items are handled in blocks of about ``item_block_bytes`` of text
(each a pass over the documents), so what a worker holds of them is bounded,
whatever the number of items; one item's distinct terms must fit a worker.
A task holds one block of documents, at most ``table_cells`` coordinates or
``least_docs`` documents, and k rows an item.

Defined cases: a null text has no terms; an item without terms, or whose
terms occur nowhere, has no rows; rows of items with the same id (null is an
id as well) are one item with the terms of all; every row of documents is a
document of its own, so repeated rows take a rank each; equal scores go by
ascending id, nulls first. Empty tables give no rows. Extra columns are not
read and can't clash: the result has its own column names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.frames import text_bytes, written
from riskloom.llm.text import ALNUM, LOWER, column_bytes, hash_words, slices

UPPER_CASE, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SALTS = 64


class Sizes(NamedTuple):
    """What is held at once; no size changes a result."""

    item_block_bytes: int = 2 << 20
    seed_docs: int = 20_000
    table_cells: int = 1 << 22
    least_docs: int = 64
    fan: int = 8  # children of a node in either hierarchy
    piece: int = 500_000  # coordinates looked up at once


_FOLD = np.frombuffer(LOWER, dtype=np.uint8)


class Vocabulary:
    """Terms of a block of items, found by hash and compared byte by byte."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        data = np.frombuffer(b" ".join(raw), dtype=np.uint8)
        hashes = hash_words(data, np.zeros(0, np.int64), ALNUM, fold_case=True)[0]
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.lens = np.array([len(r) for r in raw], dtype=np.int64)
        self.at = np.cumsum(self.lens + 1) - self.lens - 1
        self.data = data

    def __len__(self) -> int:
        return len(self.lens)

    def _same(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray, terms: np.ndarray) -> np.ndarray:
        same = self.lens[terms] == lens
        for n in np.unique(lens[same]):
            rows = np.flatnonzero(same & (lens == n))
            span = np.arange(n)
            got = _FOLD[data[starts[rows, None] + span]]
            same[rows] = (got == self.data[self.at[terms[rows], None] + span]).all(axis=1)
        return same

    def find(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Term number of every word of a text, -1 for a word that is no term."""
        found = np.full(len(hashes), -1, dtype=np.int64)
        pos = np.searchsorted(self.hashes, hashes)
        words = np.flatnonzero(pos < len(self.hashes))
        while len(words):  # a second round only where two terms share a hash
            words = words[self.hashes[pos[words]] == hashes[words]]
            terms = self.order[pos[words]]
            same = self._same(data, starts[words], lens[words], terms)
            found[words[same]] = terms[same]
            words = words[~same]
            pos[words] += 1
            words = words[pos[words] < len(self.hashes)]
        return found


def item_terms(items: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """(item, terms): the distinct terms of every item that has any."""
    text = F.translate(F.coalesce(F.col(f"`{text_column}`"), F.lit("")), UPPER_CASE, LOWER_CASE)
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))
    return (items.select(F.col(f"`{item_column}`").alias("item"), F.explode(words).alias("term"))
            .groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms")))


def document_vectors(docs: DataFrame, vocabulary: Vocabulary, id_column: str, text_column: str) -> DataFrame:
    """(document, n_words, terms, counts) of every document with a word; terms are numbers in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    id_type = docs.schema[id_column].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            off, data = column_bytes(batch.column(1))
            for lo, hi in slices(off):
                part, cuts = data[off[lo]:off[hi]], off[lo:hi] - off[lo]
                hashes, starts, lens = hash_words(part, cuts, ALNUM, fold_case=True)
                doc = np.searchsorted(cuts, starts, side="right") - 1
                n_words = np.bincount(doc, minlength=hi - lo)
                terms = vocab.find(part, hashes, starts, lens)
                hit = terms >= 0
                keys, counts = np.unique(doc[hit] * len(vocab) + terms[hit], return_counts=True)
                bounds = np.searchsorted(keys, np.arange(hi - lo + 1) * len(vocab)).astype(np.int32)
                full = pa.array(n_words > 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n_words),
                     pa.ListArray.from_arrays(bounds, pa.array((keys % len(vocab)).astype(np.int32))),
                     pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int64)))],
                    names=["document", "n_words", "terms", "counts"]).filter(full)

    return docs.select(F.col(f"`{id_column}`").alias("document"), F.col(f"`{text_column}`").alias("text")).mapInArrow(
        scan, f"document {id_type}, n_words bigint, terms array<int>, counts array<bigint>")


class ItemTree:
    """Hierarchy over the items of a block: levels of (node starts, terms), leaves first."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, fan: int):
        # Terms are numbered by falling weight, so an item's first term is its rarest.
        self.order = np.array(sorted(range(len(items)), key=lambda i: tuple(items[i][:3])), dtype=np.int64)
        self.weights, self.fan = weights, fan
        level = [items[i] for i in self.order]
        self.starts, self.terms = [], []
        while True:
            self.starts.append(np.cumsum([0] + [len(t) for t in level]))
            self.terms.append(np.concatenate(level))
            if len(level) == 1:
                break
            level = [np.unique(np.concatenate(level[i:i + fan])) for i in range(0, len(level), fan)]

    def weakest(self, kth: np.ndarray) -> list[np.ndarray]:
        """For every level the smallest k-th score below each node."""
        out = [kth]
        while len(out[-1]) > 1:
            out.append(np.minimum.reduceat(out[-1], np.arange(0, len(out[-1]), self.fan)))
        return out


def _document_tables(rows: np.ndarray, terms: np.ndarray, values: np.ndarray, n: int, width: int,
                     fan: int) -> list[np.ndarray]:
    """Coordinate maxima of the hierarchy over n documents, a table a level, leaves first."""
    table = np.zeros((n, width), dtype=np.int32)
    table[rows, terms] = values
    tables = [table]
    while len(table) > 1:
        table = np.maximum.reduceat(table, np.arange(0, len(table), fan), axis=0)
        tables.append(table)
    return tables


def _expanded(nodes: np.ndarray, n_below: int, fan: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of its parent, child) of all children of the nodes."""
    sizes = np.minimum(n_below, (nodes + 1) * fan) - nodes * fan
    parent = np.repeat(np.arange(len(nodes)), sizes)
    child = np.arange(len(parent)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + nodes[parent] * fan
    return parent, child


class DualTree:
    """The k best scores of every item, kept over the blocks of documents of one task."""

    def __init__(self, tree: ItemTree, k: int, kth: np.ndarray, piece: int):
        self.tree, self.k, self.piece = tree, k, piece
        self.seed = kth[tree.order]
        self.best_item = np.zeros(0, np.int64)
        self.best = np.zeros(0, np.int64)
        self._raise(self.best_item, self.best)

    def _raise(self, item: np.ndarray, score: np.ndarray) -> None:
        """Takes scores in; sets every item's k-th score and the weakest one below each node."""
        item, score = np.concatenate([self.best_item, item]), np.concatenate([self.best, score])
        order = np.lexsort((-score, item))
        item, score = item[order], score[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        self.best_item, self.best = item[place < self.k], score[place < self.k]
        kth = self.seed.copy()
        last = place == self.k - 1
        kth[item[last]] = np.maximum(kth[item[last]], score[last])
        self.weakest = self.tree.weakest(kth)

    def _bounds(self, table: np.ndarray, level: int, d: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Sum of weight * maximum over the terms of every pair's item node."""
        starts = self.tree.starts[level]
        sizes = starts[q + 1] - starts[q]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(starts[q] - ends + sizes, sizes)
        terms = self.tree.terms[level][at]
        parts = table[np.repeat(d, sizes), terms] * self.tree.weights[terms]
        return np.add.reduceat(parts, ends - sizes)

    def _pieces(self, level: int, d: np.ndarray, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        starts = self.tree.starts[level]
        piece = (np.cumsum(starts[q + 1] - starts[q]) - 1) // self.piece
        cuts = np.flatnonzero(np.diff(piece)) + 1
        return list(zip(np.split(d, cuts), np.split(q, cuts)))

    def search(self, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, document, score) of every pair that may be among the k best of its item."""
        found = [(np.zeros(0, np.int64),) * 3]
        root = np.zeros(1, np.int64)
        stack = [(len(tables) - 1, len(self.tree.starts) - 1, root, root)]
        while stack:
            dl, ql, d, q = stack.pop()
            bound = self._bounds(tables[dl], ql, d, q)
            keep = (bound > 0) & (bound >= self.weakest[ql][q])
            d, q, bound = d[keep], q[keep], bound[keep]
            if not len(d):
                continue
            if dl == ql == 0:
                found.append((q, d, bound))
                self._raise(q, bound)
                continue
            order = np.argsort(-bound, kind="stable")  # the most promising first: k-th scores rise early
            d, q = d[order], q[order]
            if dl:
                parent, d = _expanded(d, len(tables[dl - 1]), self.tree.fan)
                q, dl = q[parent], dl - 1
            if ql:
                parent, q = _expanded(q, len(self.tree.starts[ql - 1]) - 1, self.tree.fan)
                d, ql = d[parent], ql - 1
            stack.extend((dl, ql, *piece) for piece in reversed(self._pieces(ql, d, q)))
        return tuple(np.concatenate(x) for x in zip(*found))


def _best_rows(rows: pa.Table, k: int) -> pa.Table:
    """The k rows of every item with the highest scores, equal scores by ascending id, nulls first."""
    order = pc.sort_indices(rows, sort_keys=[("pos", "ascending"), ("score", "descending"),
                                             ("document", "ascending")], null_placement="at_start")
    rows = rows.take(order)
    pos = rows.column("pos").to_numpy()
    return rows.filter(pa.array(np.arange(len(pos)) - np.searchsorted(pos, pos) < k))


def _search(vectors: DataFrame, model: dict, k: int, kth: np.ndarray, sizes: Sizes) -> DataFrame:
    """(pos, document, score): the k best documents of each item among those of each task."""
    id_type = vectors.schema["document"].dataType.simpleString()
    shared = vectors.sparkSession.sparkContext.broadcast(model | {"kth": kth})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        width = len(m["weights"])
        dual = DualTree(m["tree"], k, m["kth"], sizes.piece)
        best = None
        most = max(sizes.least_docs, sizes.table_cells // max(width, 1))
        for batch in batches:
            for lo in range(0, len(batch), most):
                part = batch.slice(lo, most)
                lists, counts = part.column(2), part.column(3)
                lens = lists.value_lengths().to_numpy()
                rows = np.repeat(np.arange(len(part)), lens)
                terms = m["number"][lists.flatten().to_numpy()]
                tf = counts.flatten().to_numpy()
                norm = 50 + (50 * part.column(1).to_numpy() * m["n_docs"]) // m["n_words"]
                values = (1_000_000_000 * tf) // (1000 * tf + 20 * norm[rows])
                order = np.lexsort((terms, rows))
                rows, terms, values = rows[order], terms[order], values[order]
                # Neighbours in the hierarchy share their rarest terms.
                begins = np.cumsum(lens) - lens
                first, second = np.full(len(part), width), np.full(len(part), width)
                first[lens > 0] = terms[begins[lens > 0]]
                second[lens > 1] = terms[begins[lens > 1] + 1]
                docs = np.lexsort((second, first))
                place = np.empty(len(docs), np.int64)
                place[docs] = np.arange(len(docs))
                tables = _document_tables(place[rows], terms, values, len(docs), width, sizes.fan)
                item, doc, score = dual.search(tables)
                if len(item):
                    new = pa.table({"pos": m["tree"].order[item], "document": part.column(0).take(docs[doc]),
                                    "score": score})
                    best = _best_rows(new if best is None else pa.concat_tables([best, new]), k)
        if best is not None:
            yield from best.combine_chunks().to_batches()

    return vectors.mapInArrow(search, f"pos bigint, document {id_type}, score bigint")


def _top(rows: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item with their rank; first within salts, so that no task holds an item's whole list."""
    order = [F.col("score").desc(), F.col("document").asc_nulls_first()]
    salt = F.pmod(F.xxhash64("document"), F.lit(SALTS))
    some = (rows.withColumn("salt", salt)
            .withColumn("rank", F.row_number().over(Window.partitionBy("pos", "salt").orderBy(*order)))
            .where(F.col("rank") <= k).drop("salt", "rank"))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("pos").orderBy(*order)))
            .where(F.col("rank") <= k))


def _statistics(vectors: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """(documents with a word, words, documents of each term); one number a term comes to the driver."""
    n_docs, n_words = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    df = np.zeros(n_terms, dtype=np.int64)
    for term, n in held.collect():
        df[term] = n
    return n_docs, n_words, df


def _rank_block(docs: DataFrame, block: pa.Table, k: int, id_column: str, text_column: str,
                sizes: Sizes) -> DataFrame | None:
    """(pos, document, score, rank) for one block of items; pos is the item's row in the block."""
    lists = block.column("terms").to_pylist()
    names = sorted({t for terms in lists for t in terms})
    vectors = written(document_vectors(docs, Vocabulary(names), id_column, text_column), "search-vectors")
    n_docs, n_words, df = _statistics(vectors, len(names))
    if not n_docs:
        return None
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], dtype=np.int64)
    by_weight = np.argsort(-weight, kind="stable")
    number = np.empty(len(names), np.int64)
    number[by_weight] = np.arange(len(names))
    of = {t: i for i, t in enumerate(names)}
    items = [np.sort(number[[of[t] for t in terms]]) for terms in lists]
    model = {"tree": ItemTree(items, weight[by_weight], sizes.fan), "weights": weight[by_weight], "number": number,
             "n_docs": n_docs, "n_words": n_words}
    kth = np.zeros(len(items), dtype=np.int64)
    share = n_docs // sizes.seed_docs
    if share >= 2:
        part = vectors.where(F.pmod(F.xxhash64("document", "n_words"), F.lit(share)) == 0)
        lowest = _top(_search(part, model, k, kth, sizes), k).where(F.col("rank") == k).select("pos", "score")
        for pos, score in lowest.collect():  # one row an item at most
            kth[pos] = score
    return _top(_search(vectors, model, k, kth, sizes), k)


def rank(docs: DataFrame, items: DataFrame, k: int = 50, id_column: str = "doc_id", item_column: str = "item_id",
         text_column: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """(item, rank, document, score): the k documents with the highest scores above 0 for each item."""
    spark = docs.sparkSession
    terms = written(item_terms(items, item_column, text_column), "search-items")
    blocks = max(1, -(-text_bytes(items, text_column) // sizes.item_block_bytes))
    parts = []
    for b in range(blocks):
        block = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow() if blocks > 1 else terms.toArrow()
        ranked = _rank_block(docs, block, k, id_column, text_column, sizes) if block.num_rows else None
        if ranked is not None:
            names = pa.table({"pos": pa.array(range(block.num_rows), pa.int64()), "item": block.column("item")})
            schema = f"pos bigint, item {terms.schema['item'].dataType.simpleString()}"
            ids = spark.createDataFrame(names.to_pylist(), schema)
            parts.append(ranked.join(ids, "pos").select("item", F.col("rank").cast("int").alias("rank"), "document", "score"))
    if not parts:
        kinds = (terms.schema["item"].dataType.simpleString(), docs.schema[id_column].dataType.simpleString())
        return spark.createDataFrame([], f"item {kinds[0]}, rank int, document {kinds[1]}, score bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
