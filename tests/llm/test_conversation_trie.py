"""The prefix trie against a brute-force trie of every prefix."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from riskloom.llm.conversation_trie import Parentheses, prefix_trie, sequences, with_shared_heads

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(paths):
    """paths: conv_id -> [(role, text)]."""
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[:len(node)] == node]
        kids = [x for x in members if len(x) == len(node) + 1 and x[:len(node)] == node]
        leaves = [x for x in below if not any(y[:len(x)] == x and len(y) == len(x) + 1 for y in members)]
        saved = sum((len(members[x]) - 1) * len((x[-1][1] or "").encode()) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuilt(paths):
    out = {}
    for c, turns in paths.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = paths.get(c - c % 5, [])[:h] + turns[h:]
    return out


def conversations(n, seed):
    rng = random.Random(seed)
    return {c: [(rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "", "long text"]))
                for _ in range(rng.choice([1, 2, 3, 5, 8, 12]))] for c in rng.sample(range(3 * n), n)}


def frame(spark, paths):
    rows = [(c, k, role, text) for c, turns in paths.items() for k, (role, text) in enumerate(turns)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("shard_nodes", [5, 40, 1 << 17])
def test_equals_brute_force(spark, shard_nodes):
    paths = conversations(150, shard_nodes)
    trie = prefix_trie(with_shared_heads(sequences(frame(spark, paths))), shard_nodes)
    assert found(trie) == brute(rebuilt(paths))


def test_copies_shared_heads_and_a_long_one(spark):
    paths = {c: [("user", "same")] * 3 for c in range(1000, 1060, 5)}
    paths |= {c: [("user", "same")] * 2 for c in range(2000, 2020, 5)}
    paths |= {3000: [("user", "same"), ("user", "x")] + [("tool", str(k)) for k in range(200)], 4000: [("user", "other")]}
    assert found(prefix_trie(sequences(frame(spark, paths)), 4)) == brute(paths)


def test_nulls_ties_turnless_and_empty(spark):
    rows = [(5, None, "user", "first"), (5, 1, None, None), (5, 1, "", ""), (None, 0, "user", "lost"),
            (6, 3, "user", "only"), (11, 0, "user", "gone")]
    turns = spark.createDataFrame([r + (1,) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    convs = {5: [("user", "first"), ("", ""), ("", "")], 6: [("user", "only")], 11: [("user", "gone")]}
    want = rebuilt(convs)
    assert want[11] == []  # no first conversation, all own turns replaced
    assert found(prefix_trie(with_shared_heads(sequences(turns)), 2)) == brute(want)
    assert found(prefix_trie(with_shared_heads(sequences(turns.where("conv_id = 0"))))) == []


def test_find_close_over_many_blocks():
    rng = random.Random(3)
    for _ in range(20):
        bits, depth = [], 0
        for _ in range(rng.choice([1, 30, 2000])):
            up = depth == 0 or rng.random() < rng.choice([0.5, 0.8, 0.2])
            bits.append(up)
            depth += 1 if up else -1
        bits += [False] * depth
        want, stack = {}, []
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        at = np.flatnonzero(bits)
        assert Parentheses(np.array(bits)).find_close(at).tolist() == [want[i] for i in at.tolist()]
