"""Suffix-array dedup: repeated byte strings, found by a common-prefix-aware distributed merge sort.

A byte goes if it lies in a ``length``-byte string that starts anywhere else
in the corpus too. Sorting a suffix for each byte of the corpus is not
needed: in any ``length``-byte string the least hash of the ``GRAM``-byte
strings that start in its first ``SPAN`` bytes picks an anchor, and equal
strings pick the same one. So only suffixes at anchors are sorted (a sparse
suffix array), each with the ``SPAN - 1`` bytes to its left.

1. Equal texts are one text with a count (by MD5); a text of ``length``
   bytes or more that occurs twice is removed as a whole, and stands once
   for its copies against the other texts.
2. Screen: an anchor whose next ``length - SPAN + 1`` bytes (64-bit hash)
   occur once can't be in a repeat. Only counts by hash are aggregated.
3. Runs: each task sorts the suffixes of the anchors left, drops repeated
   contexts of the run (their result is known), front-codes the rest
   (common prefix with the one before, then the tail) and sends the run's
   parts to buckets.
4. Merge: a bucket's runs go through a loser tree that keeps each run's
   common prefix with the last winner; unequal prefixes decide at once, equal
   ones are compared from there on, so known prefixes are never read again.
5. Neighbours in the merged order that share the screened prefix are a
   cluster. For a suffix with a common right part R and left part L with some
   other one, the bytes [-L, R) around the anchor go if L + R >= length. Levels
   of R from high to low, with the left parts in sorted order, give the
   widest reach of each suffix without forming pairs.
6. A cluster of more than ``cluster_limit`` different contexts is compared
   in pieces of that many; what a piece shows is known at once. Against the
   other pieces its strings are counted by 128-bit hash in two steps: blocks of
   ``BLOCK`` consecutive strings by the bytes they all share, then the single
   strings of blocks that occur twice. A block that the piece has decided goes
   in once for all contexts with the same strings.

The different texts are shuffled once, into a table bucketed by key in the
shared folder, and the anchors are computed once; later steps join to the
stored texts by key without moving them. Defined results: a null or empty text has nothing to remove; texts shorter than
``length`` stay whole; repeated rows have equal results; bytes of a character
that is partly removed are decoded without the incomplete rest.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm import text as X
from riskloom.llm.frames import fresh, tidied, written
from riskloom.session import shared_dir

LENGTH = 400
SPAN = 300
GRAM = 24
CLUSTER_LIMIT = 20_000
SMALL = 6
BLOCK = 16
RUN_BYTES = 48 << 20
BUCKETS_PER_PARTITION = 8
HOT_SHARE = 1000
_TABLE32 = np.random.default_rng(5).integers(1, 2**32, 256, dtype=np.uint32) | np.uint32(1)
_BASE32 = np.uint32(0x9E3779B1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """32-bit hash of the GRAM bytes from each position (the last GRAM - 1 positions are left out)."""
    pieces, h, size, base = [], _TABLE32[data], 1, _BASE32
    done, out, left = 0, None, GRAM
    while left:
        if left & size:
            pieces.append((size, h, base))
            left -= size
        if left:
            h = h[:-size] * base + h[size:] if len(h) > size else h[:0]
            base = np.uint32(int(base) ** 2 & 0xFFFFFFFF)
            size *= 2
    n = max(0, len(data) - GRAM + 1)
    for size, h, base in reversed(pieces):
        part = h[done:done + n]
        out = part if out is None else out * base + part
        done += size
    return (out ^ (out >> np.uint32(15))) * np.uint32(0x85EBCA6B)


def anchors(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, span: int = SPAN) -> np.ndarray:
    """Anchor positions of the texts between consecutive bounds."""
    h = gram_hashes(data)
    if len(h) < span:
        return np.zeros(0, np.int64)
    low = (h.astype(np.uint64) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    own = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    step = np.zeros(len(data) + 1, dtype=np.int32)  # starts of whole strings: text start .. text end - length
    long = np.flatnonzero(np.diff(bounds) >= length)
    step[bounds[long]] += 1
    step[bounds[long + 1] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(step[:len(own)]) > 0)
    return np.unique(own[starts])


def prefix_hashes(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of ``size`` bytes from each position."""
    weights = X.powers(size)[::-1]
    out = np.empty(len(at), dtype=np.uint64)
    for lo in range(0, len(at), 4096):
        rows = at[lo:lo + 4096, None] + np.arange(size)
        out[lo:lo + 4096] = (X._TABLE[data[rows]] * weights).sum(1, dtype=np.uint64)
    return X.mix(out)


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    lo, step = known, 16
    while a[lo:lo + step] == b[lo:lo + step]:
        lo += step
        step *= 2
    while step > 1:
        step //= 2
        if a[lo:lo + step] == b[lo:lo + step]:
            lo += step
    return lo


class LoserTree:
    """Merges sorted runs of (common prefix with the one before, string, payload)."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes, tuple]]]):
        self.runs, n = runs, 1
        while n < len(runs):
            n *= 2
        self.n = n
        self.head: list = [next(r, None) for r in runs] + [None] * (n - len(runs))
        self.known = [0] * n  # common prefix of each head with the last winner
        self.losers = [0] * n
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.n:
            return node - self.n
        a, b = self._build(2 * node), self._build(2 * node + 1)
        won, lost = self._play(a, b)
        self.losers[node] = lost
        return won

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes that with the winner."""
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if self.known[a] != self.known[b]:
            return (a, b) if self.known[a] > self.known[b] else (b, a)
        n = common(x[1], y[1], self.known[a])
        won, lost = (a, b) if x[1][n:n + 1] <= y[1][n:n + 1] else (b, a)
        self.known[lost] = n
        return won, lost

    def __iter__(self) -> Iterator[tuple[int, bytes, tuple]]:
        """(common prefix with the one before, string, payload) in order."""
        while self.head[self.winner] is not None:
            at = self.winner
            _, s, payload = self.head[at]
            yield self.known[at], s, payload
            self.head[at] = next(self.runs[at], None)
            # The next string's common prefix with the last winner is the one it was front-coded with.
            self.known[at] = self.head[at][0] if self.head[at] else 0
            node = (at + self.n) // 2
            while node:
                at, self.losers[node] = self._play(at, self.losers[node])
                node //= 2
            self.winner = at


_ITEM = struct.Struct("<HHIHB16s")
_WHOLE, _KNOWN = 1, 2


def encode_run(items: list[tuple[bytes, tuple]]) -> bytes:
    """Front-coded run; items: (string, (key, position, flags, left part of strings cut short)) in order."""
    out, last = [], b""
    for s, (key, at, flags, left) in items:
        n = common(last, s)
        out += [_ITEM.pack(n, len(s) - n, at, len(left), flags, key), s[n:], left]
        last = s
    return b"".join(out)


def decode_run(blob: bytes) -> Iterator[tuple[int, bytes, tuple]]:
    at, last = 0, b""
    while at < len(blob):
        n, tail, place, left, flags, key = _ITEM.unpack_from(blob, at)
        at += _ITEM.size
        last = last[:n] + blob[at:at + tail]
        at += tail
        yield n, last, (key, place, flags, blob[at:at + left])
        at += left


class Run:
    """Suffixes of one task, sorted and front-coded by bucket when the run is full."""

    def __init__(self, buckets: int, length: int, span: int):
        self.buckets, self.length, self.span = buckets, length, span
        self.seen: dict[tuple[bytes, bytes], list] = {}
        self.size = 0

    def add(self, key: bytes, raw: bytes, at: int) -> tuple[bytes, int, int] | None:
        """Take in the suffix at a position; the removed part, if its context came before."""
        right, left = raw[at:at + self.length], raw[max(0, at - self.span + 1):at][::-1]
        held = self.seen.get((right, left))
        if held is None:
            self.seen[right, left] = [key, at, 0]
            self.size += len(right) + len(left) + 250
            return None
        held[2] |= _KNOWN
        return (key, at - len(left), at + len(right)) if len(left) + len(right) >= self.length else None

    def take(self) -> Iterator[tuple[int, bytes, list[tuple[bytes, int, int]]]]:
        """(bucket, front-coded part of the run, removed parts of its first suffixes with repeats) of each bucket.

        The run is emptied bucket by bucket, so its strings are never held twice.
        """
        members: dict[int, list[tuple[bytes, bytes]]] = {}
        size = self.length - self.span + 1
        for context in self.seen:
            bucket = int.from_bytes(hashlib.blake2b(context[0][:size], digest_size=8).digest(), "little") % self.buckets
            members.setdefault(bucket, []).append(context)
        self.size = 0
        while members:
            bucket, contexts = members.popitem()
            items, known = [], []
            while contexts:
                context = contexts.pop()
                right, left = context
                key, at, flags = self.seen.pop(context)
                if flags and len(left) + len(right) >= self.length:
                    known.append((key, at - len(left), at + len(right)))
                whole = len(right) == self.length
                items.append((right + left, (key, at, flags | _WHOLE, b"")) if whole else (right, (key, at, flags, left)))
            items.sort(key=lambda x: x[0])
            yield bucket, encode_run(items), known
        self.seen = {}


def reaches(common_right: list[int], lefts: list[bytes], length: int) -> list[tuple[int, int] | None]:
    """(bytes to the left, bytes to the right) that go around each suffix of a cluster, or None.

    ``common_right``: common prefix of each suffix's right part with the one
    before; ``lefts``: left parts, nearest byte first. Exact for the widest
    reach: at each level r the suffixes that share r bytes are neighbours, and
    the longest common left part of one of them is with a neighbour in the
    order of the left parts.
    """
    n = len(lefts)
    if n <= SMALL:
        return _small_reaches(common_right, lefts, length)
    order = sorted(range(n), key=lefts.__getitem__)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    between = np.array([0] + [common(lefts[a], lefts[b]) for a, b in zip(order, order[1:])])
    right = np.array(common_right)
    right[0] = 0
    far_left, far_right = np.full(n, -1), np.full(n, -1)
    longest = max(map(len, lefts))
    for r in sorted({int(x) for x in right[1:] if x + longest >= length}, reverse=True):
        begins = np.flatnonzero(right < r)
        ends = np.append(begins[1:], n)
        touched = np.unique(np.searchsorted(begins, np.flatnonzero(right == r), side="right") - 1)
        for b, e in zip(begins[touched].tolist(), ends[touched].tolist()):
            members = b + np.argsort(rank[b:e])
            at = rank[members]
            near = np.minimum.reduceat(between[:at[-1] + 1], at[:-1] + 1)
            left = np.maximum(np.append(near, -1), np.append(-1, near))
            good = left + r >= length
            who = members[good]
            far_left[who] = np.maximum(far_left[who], left[good])
            far_right[who] = np.maximum(far_right[who], r)
    return [(int(a), int(b)) if a >= 0 else None for a, b in zip(far_left, far_right)]


def _small_reaches(common_right: list[int], lefts: list[bytes], length: int) -> list[tuple[int, int] | None]:
    """The same for a handful of suffixes, compared directly."""
    far: list[tuple[int, int] | None] = [None] * len(lefts)
    for i in range(len(lefts)):
        r = length
        for j in range(i + 1, len(lefts)):
            r = min(r, common_right[j])
            left = common(lefts[i], lefts[j])
            if left + r >= length:
                for k in (i, j):
                    far[k] = (max(far[k][0], left), max(far[k][1], r)) if far[k] else (left, r)
    return far


class Clusters:
    """Turns the merged order of a bucket into removed parts, and blocks of strings to count for large clusters."""

    def __init__(self, length: int, span: int, limit: int):
        self.length, self.span, self.limit = length, span, limit
        self.strings: list[bytes] = []
        self.clear()

    def clear(self) -> None:
        self.right, self.lefts, self.who, self.known = [], [], [], []
        self.large = False

    def rows(self, merged) -> Iterator[tuple[bytes, int, int, bytes | None]]:
        """(key, from, to, None) for a removed part; (key, from, to, hash) for a block of strings to count."""
        shared, last = self.length - self.span + 1, None
        for n, s, (key, at, flags, left) in merged:
            if n < shared:
                yield from self.done()
            if flags & _WHOLE:
                right, left = s[:self.length], s[self.length:]
            else:
                right = s
            n = min(n, len(right), self.length)
            same = bool(self.who) and (right, left) == last
            last = (right, left)
            if same:  # a context that another run had too
                self.known[-1] = True
                if len(left) + len(right) >= self.length:
                    yield key, at - len(left), at + len(right), None
                continue
            self.right.append(n)
            self.lefts.append(left)
            self.who.append((key, at, right))
            self.known.append(bool(flags & _KNOWN))
            if len(self.who) >= self.limit:
                self.large = True
                yield from self.count_strings()
        yield from self.done()

    def count_strings(self):
        """The removed parts found within this piece of a large cluster, and its blocks to count against the others."""
        offered: set[bytes] = set()
        for reach, left, (key, at, right), known in zip(
                reaches(self.right, self.lefts, self.length), self.lefts, self.who, self.known):
            low, high = max(0, self.length - len(right)), len(left)
            if low > high:
                continue
            if known:
                reach = len(left), len(right)
            if reach:
                yield key, at - reach[0], at + reach[1], None
            for s in range(low - low % BLOCK, high + 1, BLOCK):
                first, last = max(low, s), min(high, s + BLOCK - 1)
                whole = _digest(left[:last], right[:self.length - first], s, first, last)
                if reach and last <= reach[0] and self.length - first <= reach[1]:
                    if whole in offered:
                        continue
                    offered.add(whole)
                shared = max(0, self.length - s - BLOCK + 1)
                yield key, at - last, at - first + self.length, _digest(left[:s], right[:shared], s)
        self.right, self.lefts, self.who, self.known = [], [], [], []

    def done(self):
        if self.large:
            yield from self.count_strings()
        elif self.who:
            for (key, at, right), left, known in zip(self.who, self.lefts, self.known):
                if known and len(left) + len(right) >= self.length:
                    yield key, at - len(left), at + len(right), None
            if len(self.who) > 1:
                for reach, (key, at, _) in zip(reaches(self.right, self.lefts, self.length), self.who):
                    if reach:
                        yield key, at - reach[0], at + reach[1], None
        self.clear()


def _digest(left: bytes, right: bytes, *place: int) -> bytes:
    return hashlib.blake2b(left + right, digest_size=16, salt=struct.pack(f"<{len(place)}I", *place)).digest()


_PARTS = pa.schema([("bucket", pa.int32()), ("key", pa.binary()), ("lo", pa.int64()), ("hi", pa.int64()),
                    ("blob", pa.binary())])


def _batches(rows: Iterator[dict], schema: pa.Schema, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row.get("blob") or b"")
        if size > limit:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    """(key, text, copies): the different texts of docs."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.unhex(F.md5(text)).alias("key"), text.alias("text")).groupBy("key").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))


def _stored_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """The different texts as a table bucketed by key: joins on the key read it without moving a text again."""
    spark = docs.sparkSession
    name = f"suffix_texts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (_texts(docs, text_col).write.format("parquet").bucketBy(buckets, "key")
     .option("path", shared_dir(spark, "suffix-texts")).saveAsTable(name))
    return spark.table(name)


def _repeated(rows: DataFrame) -> DataFrame:
    """The anchors whose hash occurs twice.

    A hash that more than one in ``HOT_SHARE`` anchors has needs no join by
    hash: there are fewer than ``HOT_SHARE`` of them, so they are broadcast,
    and a passage that very many texts share never meets in one task here.
    """
    counts = written(rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "anchor-counts")
    total = rows.count()
    hot = F.broadcast(counts.where(F.col("n") > total / HOT_SHARE).select("hash"))
    rest = counts.where(F.col("n") <= total / HOT_SHARE).select("hash")
    return rows.join(hot, "hash", "left_semi").unionByName(
        rows.join(hot, "hash", "left_anti").join(rest, "hash", "left_semi"))


def _anchor_rows(texts: DataFrame, length: int, span: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            offsets, data = X.column_bytes(batch.column(1))
            for lo, hi in X.slices(offsets):
                bounds = offsets[lo:hi + 1] - offsets[lo]
                part = data[offsets[lo]:offsets[hi]]
                at = anchors(part, bounds, length, span)
                owner = np.searchsorted(bounds, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefix_hashes(part, at, length - span + 1).view(np.int64)),
                     keys.take(pa.array(lo + owner)), pa.array((at - bounds[owner]).astype(np.int32))],
                    names=["hash", "key", "at"])
    return texts.select("key", "text").mapInArrow(tidied(run), "hash long, key binary, at int")


def repeats(texts: DataFrame, length: int = LENGTH, span: int = SPAN, cluster_limit: int = CLUSTER_LIMIT,
            run_bytes: int = RUN_BYTES) -> DataFrame:
    """texts (key, text; different) -> (key, lo, hi): byte ranges that are in repeats; they may overlap."""
    if not GRAM <= length - span + 1:
        raise ValueError("span is too long for this length")
    rows = written(_anchor_rows(texts, length, span), "anchors")
    found = _repeated(rows).groupBy("key").agg(F.collect_list("at").alias("at"))  # a text's own anchors
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS_PER_PARTITION * partitions

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of() -> Iterator[dict]:
            run = Run(buckets, length, span)

            def flush():
                for bucket, blob, known in run.take():
                    yield {"bucket": bucket, "blob": blob}
                    for key, lo, hi in known:
                        yield {"bucket": int.from_bytes(key[:2], "little") % buckets, "key": key, "lo": lo, "hi": hi}
            for batch in batches:
                for k in range(batch.num_rows):
                    key, raw = batch.column(0)[k].as_py(), batch.column(1)[k].as_py().encode()
                    for at in np.sort(batch.column(2)[k].values.to_numpy()).tolist():
                        part = run.add(key, raw, at)
                        if part:
                            yield {"bucket": int.from_bytes(key[:2], "little") % buckets, "key": key, "lo": part[1], "hi": part[2]}
                    if run.size > run_bytes:
                        yield from flush()
            yield from flush()
        yield from _batches(rows_of(), _PARTS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of() -> Iterator[dict]:
            clusters, bucket, held = Clusters(length, span, cluster_limit), None, []

            def merged():
                for key, lo, hi, h in clusters.rows(LoserTree([decode_run(b) for b in held])) if held else ():
                    yield {"key": key, "lo": lo, "hi": hi, "blob": h}
            for batch in batches:
                for row in batch.to_pylist():
                    if row["blob"] is None:
                        yield {"key": row["key"], "lo": row["lo"], "hi": row["hi"]}
                        continue
                    if row["bucket"] != bucket:
                        yield from merged()
                        bucket, held = row["bucket"], []
                    held.append(row["blob"])
            yield from merged()
        yield from _batches(rows_of(), _PARTS)

    schema = "bucket int, key binary, lo long, hi long, blob binary"
    parts = texts.join(found.hint("shuffle_hash"), "key").select("key", "text", "at").mapInArrow(tidied(runs), schema)
    out = parts.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(tidied(merge), schema)
    return out


def _strings(texts: DataFrame, blocks: DataFrame, length: int) -> DataFrame:
    """(key, lo, hi) of the strings in the blocks that occur twice."""
    again = blocks.groupBy("blob").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("blob")
    asked = blocks.join(again, "blob", "left_semi").groupBy("key").agg(
        F.collect_list(F.struct("lo", "hi")).alias("blocks"))  # a text's own blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of() -> Iterator[dict]:
            for batch in batches:
                for k in range(batch.num_rows):
                    key, raw = batch.column(0)[k].as_py(), batch.column(1)[k].as_py().encode()
                    starts = {at for x in batch.column(2)[k].as_py() for at in range(x["lo"], x["hi"] - length + 1)}
                    for at in sorted(starts):
                        h = hashlib.blake2b(raw[at:at + length], digest_size=16).digest()
                        yield {"key": key, "lo": at, "hi": at + length, "blob": h}
        yield from _batches(rows_of(), pa.schema([_PARTS.field(n) for n in ("key", "lo", "hi", "blob")]))
    counted = written(texts.join(asked.hint("shuffle_hash"), "key").select("key", "text", "blocks").mapInArrow(tidied(run), "key binary, lo long, hi long, blob binary"), "repeat-strings")
    twice = counted.groupBy("blob").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("blob")
    return counted.join(twice, "blob", "left_semi").select("key", "lo", "hi")


def _ranges(found: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """(key, spans) of each text with repeats; blocks of large clusters are counted here."""
    out = written(found, "repeats")
    both = out.where("blob is null").select("key", "lo", "hi")
    blocks = out.where("blob is not null").select("blob", "key", "lo", "hi").distinct()
    if not blocks.isEmpty():
        both = both.unionByName(_strings(texts, blocks, length))
    return both.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))  # a text's own ranges


_DONE = T.StructType([
    T.StructField("key", T.BinaryType(), False), T.StructField("n_bytes", T.LongType(), False),
    T.StructField("n_removed", T.LongType(), False), T.StructField("n_spans", T.LongType(), False),
    T.StructField("kept_sha256", T.StringType(), False), T.StructField("kept_text", T.StringType())])


def removed(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what is left)."""
    kept, gone, runs, end = [], 0, 0, 0
    for lo, hi in sorted(spans):
        if hi <= end:
            continue
        if lo > end or not runs:
            kept.append(raw[end:lo])
            runs += 1
            end = lo
        gone += hi - end
        end = hi
    return gone, runs, b"".join([*kept, raw[end:]])


def dedup(docs: DataFrame, text_col: str = "text", out_col: str = "dedup", length: int = LENGTH, span: int = SPAN,
          with_text: bool = True, **options) -> DataFrame:
    """The columns of docs but the text, plus a struct: n_bytes, n_removed, n_spans, kept_sha256, kept_text."""
    texts = _stored_texts(docs, text_col)
    spans = _ranges(repeats(texts, length, span, **options), texts, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                out = []
                for row in batch.slice(lo, 256).to_pylist():
                    raw = row["text"].encode()
                    found = [(x["lo"], x["hi"]) for x in row["spans"] or ()]
                    if row["copies"] > 1 and len(raw) >= length:
                        found = [(0, len(raw))]
                    gone, runs, kept = removed(raw, found)
                    out.append({"key": row["key"], "n_bytes": len(raw), "n_removed": gone, "n_spans": runs,
                                "kept_sha256": hashlib.sha256(kept).hexdigest(),
                                "kept_text": kept.decode(errors="ignore") if with_text else None})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                    ("key", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                    ("kept_sha256", pa.string()), ("kept_text", pa.string())]))
    done = texts.join(spans.hint("shuffle_hash"), "key", "left").select("key", "text", "copies", "spans").mapInArrow(tidied(run), _DONE)
    key, out = fresh(docs, "key"), fresh(docs, out_col)
    rows = docs.withColumn(key, F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))).drop(text_col)
    result = done.select(F.col("key").alias("__key"), F.struct(*[F.col(c) for c in done.columns[1:]]).alias(out))
    return rows.hint("shuffle_hash").join(result, F.col(key) == F.col("__key")).drop(key, "__key")


def remove_repeats(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """docs with the repeated strings cut out of the texts; columns as in docs, ``n_chars`` follows.

    Documents of which nothing is left go; null and empty texts stay as they are.
    """
    from riskloom.llm.decontaminate import recount
    kept = fresh(docs, "was_null")
    found = dedup(docs.withColumn(kept, F.col(f"`{text_col}`").isNull()), text_col, **options)
    name = found.columns[-1]
    left = found.where((F.col(f"`{name}`.n_bytes") == 0) | (F.col(f"`{name}`.n_removed") < F.col(f"`{name}`.n_bytes")))
    text = F.when(~F.col(f"`{kept}`"), F.col(f"`{name}`.kept_text")).alias(text_col)
    columns = [text if c.lower() == text_col.lower() else F.col(f"`{c}`") for c in docs.columns]
    return recount(left.select(*columns), text_col)
