"""The n-gram Jaccard join against all pairs by brute force."""

import random
import time

import numpy as np
import pandas as pd
import pytest

from stratum.llm import ngram_join as N
from stratum.llm.common import ASCII_LOWER, WORDS


def brute(rows, k, num, den):
    """doc -> (set size, smallest linked doc), from the definition."""
    sets = {}
    for i, t in rows:
        w = WORDS.findall((t or "").translate(ASCII_LOWER))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    comp = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1:]
             if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            if comp[a] != m or comp[b] != m:
                comp[a] = comp[b] = m
                changed = True
    return {i: (len(sets[i]), comp[i]) for i in ids}


def family(rng, n, base_words, rate):
    base = [f"w{rng.randrange(4000)}" for _ in range(base_words)]
    return [" ".join(f"x{rng.randrange(10**6)}" if rng.random() < rate else w for w in base) for _ in range(n)]


@pytest.mark.parametrize("k,num,den,seed", [(3, 90, 100, 1), (5, 80, 100, 2), (2, 60, 100, 3)])
def test_matches_brute_force(spark, k, num, den, seed):
    rng = random.Random(seed)
    texts = [None, "", " \t ", "one", "One", "one two", "one two", "Kelvin one two"]
    for size in (4, 9, 12, 15, 25, 60, 200, 700):
        for rate in (0.005, 0.03, 0.08):
            texts += family(rng, 6, size, rate)
    texts += family(rng, 60, 120, 0.012)
    texts += ["the same text again and again here"] * 40
    rng.shuffle(texts)
    rows = list(enumerate(texts, 100))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           N.join_components(df, N.Rule(k, num, den), block_sets=16).collect()}
    assert got == brute(rows, k, num, den)


def test_every_link_shares_a_signature():
    rule, rng = N.Rule(3, 90, 100), np.random.default_rng(5)
    for size in (9, 10, 13, 18, 19, 40, 300):
        edges = N.band_edges(1000)
        for _ in range(200):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            b = a.copy()
            for _ in range(rng.integers(0, rule.difference(size, 1000) + 1)):
                b = np.delete(b, rng.integers(len(b))) if rng.random() < .5 else np.append(b, rng.integers(2**63, dtype=np.uint64))
            b = np.unique(b)
            common = len(np.intersect1d(a, b))
            if not rule.linked(common, len(a), len(b)) or np.array_equal(a, b):
                continue
            band = int(np.searchsorted(edges, max(len(a), len(b)), "right")) - 1
            for sets in (10, 10_000, 10**9):
                scheme = (edges[band + 1] - 1, *N.allocate(rule, edges[band], edges[band + 1] - 1, sets))
                x, y = (N.sign(rule, e, band, scheme, 0) for e in (a, b))
                assert x is None or y is None or len(np.intersect1d(x, y))


def test_uncovered_sets_are_signed_again(spark, monkeypatch):
    monkeypatch.setattr(N, "allocate", lambda rule, low, top, sets, repeat=0.3: (rule.difference(top, top) + 1, 0))
    rng = random.Random(9)
    rows = list(enumerate(t for s in (9, 10, 11, 12) for _ in range(60) for t in family(rng, 3, s + 2, 0.02)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.join_components(df, N.Rule()).collect()}
    assert got == brute(rows, 3, 90, 100)


def test_nulls_repeats_empty_tables_and_other_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(3, text, "a"), (3, text, "a"), (None, text, "b"), (None, None, None), (7, text + " tail", "c"), (8, None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1, r["n_links"])
                 for r in N.join_components(df).collect())
    assert got == [(-1, 0, -1, 0), (-1, 28, 3, 1), (3, 28, 3, 1), (3, 28, 3, 1), (7, 29, 3, 1), (8, 0, 8, 0)]
    kept = N.keep_one_per_component(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 3, 3, 8]
    assert N.join_components(df.limit(0)).count() == 0


def test_streamed_buckets_keep_every_shared_signature():
    rng = random.Random(4)
    rows = sorted((rng.randrange(12), rng.randrange(4)) for _ in range(60)) + [(50, 1), (50, 1), (51, 2), (52, 3), (52, 4)]
    docs = {}
    for s, d in rows:
        docs.setdefault(s, set()).add(d)
    want = {(s, d) for s, d in rows if len(docs[s]) > 1}
    for size in (1, 2, 3, 7, 100):
        batches = [pd.DataFrame(rows[i:i + size], columns=["sig", "doc_id"]) for i in range(0, len(rows), size)]
        got = {(int(s), int(d)) for out in N._buckets(iter([*batches, batches[0].iloc[:0]])) for s, d in zip(out["sig"], out["doc_id"])}
        assert got == want


def test_sketches_never_differ_more_than_their_sets():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < .9], rng.integers(0, 2**63, 20, dtype=np.uint64) * np.uint64(2)]))
        bits = np.bitwise_count(np.frombuffer(N.sketch(a), np.uint8) ^ np.frombuffer(N.sketch(b), np.uint8)).sum()
        assert bits <= len(np.setxor1d(a, b))


def test_buckets_of_repeated_rows_stay_apart(spark):
    groups = {3: [1, 5, 9], 4: [1, 6, 9], 5: [1, 5, 9], 6: [1, 2], 7: [4]}
    members = spark.createDataFrame([(sig, d) for sig, docs in groups.items() for d in docs * 2], "sig long, doc_id long")
    assert sorted((r["bucket"], r["n"]) for r in N._different(members).collect()) == [(3, 6), (4, 6), (6, 4)]


def test_repeated_rows_leave_the_components_as_they_are(spark):
    rng, rows = random.Random(21), []
    for g in range(40):
        body = [f"g{g}w{rng.randrange(10 ** 6)}" for _ in range(30)]
        for k in range(5):
            copy = body if k < 2 else [w if rng.random() > 0.02 else f"x{rng.randrange(10 ** 6)}" for w in body]
            rows.append((10 * g + k, " ".join(copy)))
    one, two = (spark.createDataFrame(x, "doc_id long, text string") for x in (rows, rows * 2))
    rule = N.Rule(3, 70, 100)
    got = [{(r["doc_id"], r["component_id"], r["n_links"]) for r in N.join_components(d, rule).collect()} for d in (one, two)]
    assert got[0] == got[1]


def test_sketches_tell_large_sets_apart():
    rng, rule = np.random.default_rng(8), N.Rule(5, 80, 100)
    sets = [np.unique(N.mix64(rng.integers(0, 2**63, n, dtype=np.uint64))) for n in (2400, 2500, 2900, 900, 5000)]
    sets += [np.append(sets[4][100:], sets[0][:50]), np.append(sets[0], sets[1][:300])]
    words, levels = N.sketch_levels([N.sketch(e, rule.difference(len(e), len(e))) for e in sets])
    assert len(levels) > 2
    for x, a in enumerate(sets):
        apart = N.sketches_apart(words, levels, x, np.arange(len(sets)))
        for y, b in enumerate(sets):
            differ = len(np.setxor1d(a, b))
            assert apart[y] <= differ
            small, large = sorted((len(a), len(b)))
            if small * rule.den >= large * rule.num and not rule.linked(len(np.intersect1d(a, b)), small, large) and differ > small:
                assert apart[y] * (rule.den + rule.num) > (small + large) * (rule.den - rule.num)


def test_large_unrelated_sets_form_no_cluster():
    rng, rule = np.random.default_rng(12), N.Rule(5, 80, 100)
    bits = [N.sketch(e, rule.difference(len(e), len(e))) for e in N.mix64(rng.integers(0, 2**63, (20, 4700), dtype=np.uint64))]
    g = pd.DataFrame({"bucket": 1, "i": 0, "j": 0, "block": 0, "node": range(20), "n_shingles": 4700, "sketch": bits})
    assert not list(N._meet(iter([g]), rule))


def test_rounds_take_every_pair_of_blocks_once_and_bounded(spark):
    blocks = {1: 1, 2: 2, 3: 3, 4: 4, 5: 9, 6: 16}
    rows = [(key, b, node) for key, b in blocks.items() for node in range(12 * b)]
    df = spark.createDataFrame(rows, "key long, blocks int, node long")
    sizes = {b: 12 * b for b in blocks.values()}
    rounds = N._rounds(sizes)
    assert len(rounds) > 2 and [d for low, high in rounds for d in range(low, high)] == list(range(9))
    met = []
    for low, high in rounds:
        dealt = N._in_blocks(df, "key", low, high).select("key", "i", "j", "block", "node").collect()
        assert len(dealt) <= 2 * len(rows)
        met += {(r["key"], r["i"], r["j"]) for r in dealt}
        assert all(r["block"] in (r["i"], r["j"]) for r in dealt)
    want = {(key, i, j) for key, b in blocks.items() for i in range(b) for j in range(i, b)}
    assert len(met) == len(set(met)) and set(met) <= want
    assert N._rounds({}) == [(0, 1)] and N._rounds({1: 50}) == [(0, 1)]


def test_a_group_in_many_rounds_matches_brute_force(spark):
    rng = random.Random(17)
    rows = list(enumerate(family(rng, 45, 60, 0.02) + family(rng, 5, 60, 0.02)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 3, 70, 100)
    found = N.join_components(df, N.Rule(3, 70, 100), block_sets=8, block_elements=600)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == want


def test_stored_rows_leave_no_shuffle_files(spark):
    from stratum.llm.common import stored

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().startswith("shuffle_")}
    before = files()
    kept = stored(spark.range(2000).repartition(7, "id"), "test")
    for _ in range(100):                     # Spark deletes them in the background
        left = files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and kept.count() == 2000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
