"""The trie against a dictionary of prefixes, for small segments and shards; the double array by itself."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from stratum.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, depth string, H1 int"


def rebuilt(rows, group=100, most=5):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        p = c - int(np.fmod(c, group))
        out[c] = own.get(p, [])[:h] + turns[h:]
    return out


def brute(rows, **k):
    convs = rebuilt(rows, **k)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
    for node, m in members.items():
        worth = (len(m) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            a = node[:d]
            leaves[a] = leaves.get(a, 0) + (node not in kids)
            saved[a] = saved.get(a, 0) + worth
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids.get(node, 0), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, **k):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    got = P.conversation_trie(df, **k)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = sorted(map(tuple, got.collect()), key=repr)
    assert got == brute(rows)
    return got


def random_rows(seed, n_convs, longest, words):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(words)) for c in rng.sample(range(400), n_convs)
            for t in range(rng.randint(1, longest))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment,shard", [(256, 1 << 18), (2, 7), (1, 3)])
def test_against_dictionary(spark, segment, shard):
    check(spark, random_rows(segment, 60, 7, ["a", "b", "é", "", None, "long text"]), segment=segment, shard=shard)


def test_copies_and_one_long_conversation(spark):
    """A third of all conversations are alike and meet in many shards; one conversation has most turns."""
    rows = [(c, t, "user", f"same {t}") for c in range(0, 9000, 100) for t in range(4)]
    rows += [(7, t, "user", "x") for t in range(300)] + [(c, 0, "user", f"same 0 {c}") for c in range(1, 60, 3)]
    got = check(spark, rows, segment=8, shard=20)
    assert max(r[1] for r in got) >= 295 and max(r[3] for r in got) > 90


def test_nulls_ties_repeats_and_empty_table(spark):
    rows = [(None, 0, "user", "nobody's"), (100, None, None, None), (100, None, None, None), (100, 3, "user", "late"), (101, 1, "user", "t"),
            (-205, 0, "a", "b"), (-200, 0, "a", "b"), (103, 0, "ab", "c"), (104, 0, "a", "bc"), (105, 0, "user", "z" * 300_000)]
    check(spark, rows)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    assert P.conversation_trie(df.limit(0)).count() == 0
    turnless = P.conversation_trie(spark.createDataFrame([(1, 0, "u", "t", "", 1)], SCHEMA))
    h = zlib.crc32(b"1") % 6
    assert turnless.count() == (1 if h else 2)


def test_double_array():
    """Every stored child is found in its slot, nothing else is, and no slot is used twice."""
    rng = np.random.default_rng(1)
    trie = P.DoubleArray(4)
    (root,) = trie.roots(1)
    edges, todo = {}, [root]
    for _ in range(400):
        s = todo.pop(int(rng.integers(len(todo))))
        codes = np.unique(rng.integers(0, 90, rng.integers(1, 12)))
        if len(codes) == 1:
            trie.single_children(np.array([s]), codes)
        else:
            trie.children(s, codes, tries=int(rng.integers(1, 50)))
        to = trie.step(np.full(len(codes), s), codes)
        edges.update({(s, c): t for c, t in zip(codes, to)})
        todo += list(to)
    assert len(set(edges.values()) | {root}) == len(edges) + 1
    states = np.array([root, *edges.values()])
    for c in range(95):
        for s, t in zip(states, trie.step(states, np.full(len(states), c))):
            assert t == edges.get((s, c), -1)
    assert (trie.check != P.FREE).sum() == len(states)
