"""Byte-exact removal of repeats against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest

from stratum.llm import suffix_dedup as S


def brute(rows, length):
    seen = {}
    for _, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            seen[b[p:p + length]] = seen.get(b[p:p + length], 0) + 1
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for x, y in zip(b"\0" + bytes(gone), gone) if y and not x)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(rng, n, letters="abcdefé ", longest=90):
    text = lambda k: "".join(rng.choices(letters, k=k))
    shared = [text(rng.randint(5, longest)) for _ in range(12)]
    rows = [None, "", "a" * 150, "ab" * 90, text(3)]
    for _ in range(n):
        rows.append("".join(rng.choice(shared) if rng.random() < .4 else text(rng.randint(1, 40)) for _ in range(rng.randint(1, 8))))
    rows += rng.sample(rows, 5)
    rng.shuffle(rows)
    return list(enumerate(rows))


def got(df, **o):
    return sorted(map(tuple, S.digests(S.remove_repeats(df, **o)).collect()), key=repr)


@pytest.mark.parametrize("letters", ["ab", "abcd ", "abcdefghijklmnopqrstuvwxyz é\x00"])
def test_suffix_order_sorts(letters):
    rng = random.Random(1)
    for n in (1, 2, 7, 300, 3000):
        data = np.frombuffer("".join(rng.choices(letters, k=n)).encode(), np.uint8)
        for wanted in (np.ones(len(data), bool), np.random.default_rng(n).random(len(data)) < .3):
            order = [i for i in S.suffix_order(data, wanted, 40).tolist() if wanted[i]]
            raw = data.tobytes()
            assert sorted(order) == np.flatnonzero(wanted).tolist()
            keys = [raw[i:i + 40] for i in order]
            assert all(a <= b for a, b in zip(keys, keys[1:])) or b"\0" in raw
            lcp = S.common_prefixes(data, np.array(order, np.int64), 40)
            for (a, b), k in zip(zip(order, order[1:]), lcp):
                same = 0
                while same < 40 and max(a, b) + same < len(raw) and raw[a + same] == raw[b + same]:
                    same += 1
                assert same == k


def test_every_window_has_one_anchor_fixed_by_its_bytes():
    rng = np.random.default_rng(3)
    S_slab, S.SLAB = S.SLAB, 500
    try:
        data = rng.integers(97, 99, 1700).astype(np.uint8)
        data[900:1300] = data[100:500]
        at, first, count, hashes = S.anchors(data, 40, 8)
    finally:
        S.SLAB = S_slab
    assert first[0] == 0 and (np.diff(first) == count[:-1]).all() and first[-1] + count[-1] == len(data) - 39
    own = {}
    for a, f, c, h in zip(at, first, count, hashes):
        for p in range(f, f + c):
            assert p <= a <= p + 32
            key = data[p:p + 40].tobytes()
            assert own.setdefault(key, (a - p, h)) == (a - p, h)


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"batch_bytes": 300}), (3, {"crowded": 2}), (4, {"crowded": 1, "batch_bytes": 1})])
def test_matches_brute_force(spark, seed, options):
    rows = corpus(random.Random(seed), 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, length=40, gram=8, **options) == brute(rows, 40)


def test_full_length_passages(spark):
    rng = random.Random(7)
    words = lambda n: " ".join("".join(rng.choices("abcdeé", k=rng.randint(2, 8))) for _ in range(n))
    passage = words(60)
    rows = list(enumerate([words(80) + " " + passage + " " + words(80) for _ in range(25)] + [words(300) for _ in range(5)]
                          + [passage[:-3], passage * 3, words(2000)]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows, 200)
    assert got(df, crowded=5) == brute(rows, 200)


def test_nulls_repeats_empty_table_and_other_columns(spark):
    long = "xyz" * 100
    rows = [(1, long, 5), (1, long, 5), (None, "q" * 199, 6), (None, None, None), (2, "é" * 99, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sid long")
    empty = hashlib.sha256(b"").hexdigest()
    assert got(df) == sorted([(1, 300, 300, 1, empty), (1, 300, 300, 1, empty), (None, 0, 0, 0, empty),
                              (None, 199, 0, 0, hashlib.sha256(b"q" * 199).hexdigest()),
                              (2, 198, 0, 0, hashlib.sha256(("é" * 99).encode()).hexdigest())], key=repr)
    assert S.remove_repeats(df.limit(0)).count() == 0
