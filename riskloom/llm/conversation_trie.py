"""Prefix trie of conversations: what sharing of common beginnings saves, node by node.

A node is a distinct sequence of first turns; the conversations that start
with it are its members. Conversations are sorted by their turns (digests of
role and text), so every subtree is a run of them, and the sorted run is cut
into shards of at most ``shard_nodes`` nodes (one conversation more at the
end). A shard encodes its part of the trie as balanced parentheses in depth
order:

- ``find_close`` on the range min-max tree over blocks of excess delimits a
  node's subtree;
- the rank of ``()`` pairs counts its leaves;
- cumulative arrays over conversations and nodes give its members and what
  it saves.

Only nodes on the first or the last path of a shard can continue in another
one. These shared spines are put out as parts and merged by node, where a
node's own bytes and childlessness are known only after the merge; they are
then added to all its ancestors. Everything else is whole within its shard.

Equal conversations are first collapsed: ids sorted over the cluster (a key
with any number of copies is split among tasks), joined to chunks of text,
and only these chunks of one node come together, to be hashed in order.

Sizes: the turns of one conversation must fit a task (48 bytes a turn; texts
never move), a shard holds ``shard_nodes`` nodes, and a task one shard and
one chunk. Spine rows are at most twice a shard's depth.

Defined cases: null roles and texts count as empty, rows without a
conversation id are left out, turns go by number, nulls first, equal numbers
by digest (repeated rows count each time). A conversation without turns is a
member of the root. An empty table has no nodes. Other columns are not read;
the result has its own column names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import written

DIGEST = 32  # hex characters of a turn's digest
CHUNK = 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """Balanced parentheses with a range min-max tree over blocks of excess."""

    BLOCK = 64

    def __init__(self, opens: np.ndarray):
        b = self.BLOCK
        n_blocks = max(1, -(-len(opens) // b))
        self.opens = opens
        steps = np.zeros(n_blocks * b, np.int32)
        steps[:len(opens)] = np.where(opens, 1, -1)
        self.steps = steps.reshape(n_blocks, b)
        inner = np.cumsum(self.steps, axis=1, dtype=np.int32)
        self.base = np.concatenate([[0], np.cumsum(inner[:, -1])[:-1]])  # excess before each block
        self.leaves = 1 << (n_blocks - 1).bit_length()
        far = np.iinfo(np.int32).max
        self.least = np.full(2 * self.leaves, far, np.int64)
        self.most = np.full(2 * self.leaves, -far, np.int64)
        self.least[self.leaves:self.leaves + n_blocks] = self.base + inner.min(axis=1)
        self.most[self.leaves:self.leaves + n_blocks] = self.base + inner.max(axis=1)
        lo = self.leaves
        while lo > 1:
            for tree, pick in ((self.least, np.minimum), (self.most, np.maximum)):
                tree[lo // 2:lo] = pick(tree[lo:2 * lo:2], tree[lo + 1:2 * lo:2])
            lo //= 2
        # Rank directories: open parentheses, and "()" pairs, before each position.
        self.n_open = np.concatenate([[0], np.cumsum(opens)])
        pair = opens.copy()
        pair[:-1] &= ~opens[1:]
        self.n_pair = np.concatenate([[0], np.cumsum(pair)])

    def _holds(self, node: np.ndarray, target: np.ndarray) -> np.ndarray:
        return (self.least[node] <= target) & (target <= self.most[node])

    def _in_block(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First position of the block beyond ``after`` whose excess is the target, -1 if none."""
        out = np.full(len(block), -1, np.int64)
        for lo in range(0, len(block), 1 << 14):
            rows = slice(lo, lo + (1 << 14))
            excess = np.cumsum(self.steps[block[rows]], axis=1) + self.base[block[rows], None]
            place = block[rows, None] * self.BLOCK + np.arange(self.BLOCK)
            hit = (excess == target[rows, None]) & (place > after[rows, None]) & (place < len(self.opens))
            first = np.argmax(hit, axis=1)
            out[rows] = np.where(hit.any(axis=1), place[np.arange(len(first)), first], -1)
        return out

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Position of the parenthesis that closes each of these open ones."""
        block = at // self.BLOCK
        target = 2 * self.n_open[at] - at  # the excess before the open one
        out = self._in_block(block, at, target)
        rest = np.flatnonzero(out < 0)
        node, goal = block[rest] + self.leaves, target[rest]
        up = np.ones(len(rest), bool)
        while up.any():  # to the first subtree on the right that reaches the target
            right = (node % 2 == 0) & self._holds(np.minimum(node + 1, len(self.least) - 1), goal)
            turn = up & right
            node = np.where(turn, node + 1, np.where(up, node // 2, node))
            up &= ~turn
        while (low := node < self.leaves).any():  # down to its first block
            left = np.where(low, 2 * node, node)
            node = np.where(low, np.where(self._holds(left, goal), left, left + 1), node)
        out[rest] = self._in_block(node - self.leaves, at[rest], goal)
        return out


def sequences(turns: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
              text_column: str = "text") -> DataFrame:
    """(conv_id, turns): the digests and bytes of every conversation's turns in order."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_column, text_column))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGEST)
    turn = F.struct(F.col(f"`{turn_column}`").alias("turn"), digest.alias("digest"),
                    F.octet_length(text).cast("long").alias("bytes"))
    return (turns.where(F.col(f"`{conv_column}`").isNotNull())
            .groupBy(F.col(f"`{conv_column}`").cast("long").alias("conv_id"))
            .agg(F.sort_array(F.collect_list(turn)).alias("turns")))


def with_shared_heads(convs: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of the first of its group, c - c % group.

    h is crc32(c as text) % heads. Only the first ``heads - 1`` turns of a
    group's first conversation are joined, to at most ``group`` others.
    """
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % heads).cast("int")
    stored = written(convs, "trie-sequences")
    first = stored.where(c % group == 0).select(c.alias("first_id"), F.slice("turns", 1, heads - 1).alias("head"))
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    head = F.slice("head", F.lit(1), h)
    return (stored.join(first, c - c % group == F.col("first_id"), "left")
            .select("conv_id", F.when(F.col("head").isNull(), own).otherwise(F.concat(head, own)).alias("turns")))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, sizes, conv_id) to (key, sizes, n, first_id, ids): neighbours with one key, in chunks."""
    rows: list[tuple] = []
    key, sizes, ids, length = None, None, [], 0

    def close() -> None:
        if ids:
            rows.append((key, sizes, len(ids), ids[0], ",".join(map(str, ids))))

    def out() -> pa.RecordBatch:
        cols = list(zip(*rows))
        rows.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.list_(pa.int64())), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string())], names=["key", "sizes", "n", "first_id", "ids"])

    held = 0
    for batch in batches:
        for k, s, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if k != key or length > CHUNK:
                close()
                held += length + len(key or "")
                key, sizes, ids, length = k, s, [], 0
            ids.append(i)
            length += len(str(i)) + 1
            if held > 1 << 22:
                yield out()
                held = 0
    close()
    if rows:
        yield out()


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Smallest value of each range lo..hi, from runs of doubling length."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    level = np.frexp(hi - lo + 1)[1] - 1
    out = np.empty(len(lo), values.dtype)
    for n, row in enumerate(levels):
        at = np.flatnonzero(level == n)
        out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << n) + 1])
    return out


NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string, bytes bigint, spine boolean, node string, parent string, "
        "ancestors array<string>")


class _Shard:
    """Sorted distinct conversations and the nodes of their part of the trie."""

    def __init__(self):
        self.keys, self.counts, self.firsts, self.ends = [], [], [], []
        self.shared, self.sizes, self.n_nodes = [], [], 1

    def add(self, key: str, sizes: list[int], count: int, first: int, ends: str) -> None:
        shared, before = 0, self.keys[-1] if self.keys else ""
        most = min(len(before), len(key))
        while shared < most and before[shared:shared + DIGEST] == key[shared:shared + DIGEST]:
            shared += DIGEST
        shared //= DIGEST
        for column, value in ((self.keys, key), (self.counts, count), (self.firsts, first), (self.ends, ends),
                              (self.shared, shared)):
            column.append(value)
        self.sizes.extend(sizes[shared:])
        self.n_nodes += len(sizes) - shared

    def nodes(self) -> pa.RecordBatch:
        shared = np.array(self.shared)
        depths = np.array([len(k) // DIGEST for k in self.keys])
        new = depths - shared  # nodes that each conversation opens
        # Parentheses: the root, then for every conversation what it closes and what it opens.
        closed = np.concatenate([[0], depths[:-1]]) - shared
        runs = np.concatenate([[1], np.stack([closed, new], axis=1).ravel(), [depths[-1] + 1]])
        kinds = np.concatenate([[True], np.tile([False, True], len(new)), [False]])
        tree = Parentheses(np.repeat(kinds, runs))

        at = np.flatnonzero(tree.opens)
        close = tree.find_close(at)
        last = tree.n_open[close] - 1  # the last node of each subtree
        begin = 1 + np.cumsum(new) - new  # the first node that each conversation opens
        path = np.concatenate([[0], np.repeat(np.arange(len(new)), new)])
        depth = np.concatenate([[0], np.arange(len(at) - 1) - np.repeat(begin - 1, new) + np.repeat(shared + 1, new)])
        n_before = np.concatenate([[0], np.cumsum(self.counts)])
        # A subtree is a run of conversations: from the one that opened its top to the one that opened its last node.
        n_convs = n_before[path[last] + 1] - n_before[path]
        conv_id = _least(np.array(self.firsts, np.int64), path, path[last])
        text_bytes = np.concatenate([[0], np.array(self.sizes, np.int64)])

        parent, on_path = np.arange(-1, len(at) - 1), [0]
        for i, (s, n, b) in enumerate(zip(self.shared, new.tolist(), begin.tolist())):
            if n:
                parent[b] = on_path[s]
                on_path[s + 1:] = range(b, b + n)
        spine = np.zeros(len(at), bool)
        spine[:depths[0] + 1] = True
        spine[on_path[:depths[-1] + 1]] = True

        whole = ~spine
        saved = np.concatenate([[0], np.cumsum(np.where(whole, (n_convs - 1) * text_bytes, 0))])
        n_leaves = tree.n_pair[close] - tree.n_pair[at]
        spine_leaf = np.concatenate([[0], np.cumsum(spine & (last == np.arange(len(at))))])
        n_leaves = n_leaves - (spine_leaf[last + 1] - spine_leaf[:-1])  # what a spine's end is, the merge will say
        n_children = np.bincount(parent[1:][whole[1:]], minlength=len(at))
        ends = np.full(len(at), NO_ENDS, dtype=object)
        ends[np.where(new > 0, begin + new - 1, 0)] = self.ends

        names: dict[int, str] = {}
        lines = {}
        for v in np.flatnonzero(spine).tolist():
            names[v] = hashlib.sha256(self.keys[path[v]][:depth[v] * DIGEST].encode()).hexdigest()
            lines[v] = [*lines[parent[v]], names[v]] if v else [names[v]]
        under_spine = np.zeros(len(at), bool)
        under_spine[1:] = spine[parent[1:]]
        own = [names.get(v) for v in range(len(at))]
        above = [names[p] if u else None for p, u in zip(parent.tolist(), under_spine.tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(conv_id), pa.array(depth), pa.array(conv_id[parent], mask=under_spine | (parent < 0)),
             pa.array(n_convs), pa.array(n_children), pa.array(n_leaves), pa.array(saved[last + 1] - saved[:-1]),
             pa.array(ends, pa.string()), pa.array(text_bytes), pa.array(spine), pa.array(own, pa.string()),
             pa.array(above, pa.string()), pa.array([lines.get(v) for v in range(len(at))], pa.list_(pa.string()))],
            names=[c.split()[0] for c in NODE.split(", ")])


def _shards(shard_nodes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, key, held = _Shard(), None, None
        for batch in batches:
            for k, sizes, n, first, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if k == key:  # a further chunk of the same conversation's copies
                    held[1] += n
                    held[3].update(b"," + ids.encode())
                    continue
                if key is not None:
                    shard.add(key, held[0], held[1], held[2], held[3].hexdigest())
                    if shard.n_nodes >= shard_nodes:
                        yield shard.nodes()
                        shard = _Shard()
                key, held = k, [sizes, n, first, hashlib.sha256(ids.encode())]
        if key is not None:
            shard.add(key, held[0], held[1], held[2], held[3].hexdigest())
            yield shard.nodes()
    return run


def _merged_spines(rows: DataFrame) -> DataFrame:
    """One row for every node on a spine, from its parts in all shards."""
    parts = rows.where("spine").groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("ancestors").alias("ancestors"), F.max("depth").alias("depth"),
        F.max("bytes").alias("bytes"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))).alias("ends"))
    parts = written(parts, "trie-spines")
    below = parts.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_spines"))
    parts = parts.join(below, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("n_spines", F.lit(0)))
    # A spine node's own part, added to itself and all above it.
    own = parts.select(F.explode("ancestors").alias("node"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("own_saved"),
                       (F.col("n_children") == 0).cast("long").alias("own_leaf")).groupBy("node").agg(
        F.sum("own_saved").alias("own_saved"), F.sum("own_leaf").alias("own_leaf"))
    return parts.join(own, "node").select(
        "node", "parent", "conv_id", "depth", "n_convs", "n_children", (F.col("n_leaves") + F.col("own_leaf")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("own_saved")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def prefix_trie(convs: DataFrame, shard_nodes: int = 1 << 17) -> DataFrame:
    """A row per node of the trie of (conv_id, turns); turns as ``sequences`` gives them.

    conv_id: smallest member; depth; parent_conv_id: the parent's (null for
    the root); n_convs: members; n_children; n_leaves: childless nodes in the
    subtree; saved_tokens: over the subtree, bytes of a node's last text
    times its members but one; ends_sha256: of the members that end here.
    """
    keyed = written(convs.select(
        F.array_join(F.transform("turns", lambda t: t["digest"]), "").alias("key"),
        F.transform("turns", lambda t: t["bytes"]).alias("sizes"), "conv_id"), "trie-conversations")
    chunks = written(keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        _collapse, "key string, sizes array<bigint>, n bigint, first_id bigint, ids string"), "trie-chunks")
    rows = written(chunks.repartitionByRange("key").sortWithinPartitions("key", "first_id").mapInArrow(
        _shards(shard_nodes), NODE), "trie-nodes")
    spines = written(_merged_spines(rows), "trie-merged")

    columns: list[Column] = [F.col(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                                "saved_tokens", "ends_sha256")]
    above = spines.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    inner = rows.where(~F.col("spine") & F.col("parent").isNull()).select(*columns)
    under = rows.where(~F.col("spine") & F.col("parent").isNotNull()).drop("parent_conv_id").join(
        above, "parent").select(*columns)
    shared = spines.where("parent is not null").join(above, "parent").select(*columns)
    root = spines.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns)
    return inner.unionByName(under).unionByName(shared).unionByName(root)
