"""Benchmark decontamination against an alignment of every diagonal."""

import random

import numpy as np

from stratum.llm import decontaminate as D


def words(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.randrange(30)}" for _ in range(n)]


def brute(texts, items, min_overlap=12):
    """Every diagonal of every pair, scored without seeds."""
    out = {}
    for i, t in texts:
        w, found = np.array(D.tokens(t), object), []
        for item, body in items:
            v = np.array(D.tokens(body), object)
            if len(v) < 8:
                continue
            best = max((D.best_overlap(v, w, s)[0] for s in range(-len(v) + 1, len(w))), default=0)
            if best >= min(min_overlap, len(v)):
                found.append(item)
        out[i] = sorted(set(found))
    return out


def planted(rng):
    items = [(k, " ".join(words(rng, n))) for k, n in enumerate([8, 9, 11, 12, 13, 20, 40, 60, 3])] + [(50, None), (51, ""), (6, "x y z")]
    texts = [(0, None), (1, ""), (2, "short")]
    for i in range(3, 60):
        body = words(rng, rng.randint(20, 120))
        if i % 3:
            _, item = items[rng.randrange(8)]
            v = D.tokens(item)
            if len(v) > 20 and i % 2:
                v = v[rng.randrange(len(v) - 15):]
            at = rng.randrange(len(body))
            body[at:at] = v
        texts.append((i, " ".join(body).title()))
    return items, texts


def test_finds_what_alignment_finds(spark):
    items, texts = planted(random.Random(6))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts, [x for x in items if x[1]])
    got = D.find_overlaps(docs, tests).collect()
    assert {r["doc_id"]: r["item_ids"] for r in got} == want and any(want.values())
    assert all(r["contaminated"] == bool(r["item_ids"]) for r in got)
    blocks = D.find_overlaps(docs, tests, block_tokens=200).collect()
    assert sorted((r["doc_id"], r["item_ids"], r["n_matched"], r["spans"]) for r in blocks) == \
        sorted((r["doc_id"], r["item_ids"], r["n_matched"], r["spans"]) for r in got)
    for limit in (1_000_000, 200):
        clean = D.drop_contaminated(docs, tests, block_tokens=limit)
        assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, f in want.items() if not f)


def test_substitutions_are_tolerated():
    rng = random.Random(1)
    missed = 0
    for _ in range(200):
        item = words(rng, 40)
        copy = list(item)
        for p in rng.sample(range(40), 3):
            copy[p] = "zzz"
        index = D.Index([(7, " ".join(item))], 8)
        h = D.WordHashes()
        found = D.overlaps(index, h.array(words(rng, 30) + copy + words(rng, 30)), 12)
        missed += not found
        assert all(f[0] == 7 for f in found)
        assert D.overlaps(index, h.array(words(rng, 200)), 12) == []
    assert missed <= 10


def test_nulls_repeats_empty_tables_and_other_columns(spark):
    item = " ".join(f"w{i}" for i in range(20))
    rows = [(1, f"a {item} b", 0), (1, f"a {item} b", 0), (None, item, 0), (2, None, 0), (3, "w1 w2 w3", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_ids long")
    tests = spark.createDataFrame([(None, item), (4, item)], "item_id long, text string")
    got = sorted(((r["doc_id"] or 0), r["item_ids"], r["n_matched"]) for r in D.find_overlaps(docs, tests).collect())
    assert got == [(0, [-1, 4], 40), (1, [-1, 4], 40), (1, [-1, 4], 40), (2, [], 0), (3, [], 0)]
    clean = D.drop_contaminated(docs, tests)
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == [2, 3]
    assert D.find_overlaps(docs.limit(0), tests).count() == 0
    assert D.drop_contaminated(docs, tests.limit(0)).count() == 5


def find(item, text):
    h = D.WordHashes()
    return [(f[0], f[1]) for f in D.overlaps(D.Index([(7, item)], 1), h.array(D.tokens(text)), 12)]


def test_short_items_are_searched_whole():
    rng = random.Random(3)
    around = " ".join(words(rng, 30))
    for n in range(1, 16):
        item = words(rng, n)
        assert find(" ".join(item), f"{around} {' '.join(item)} {around}") == [(7, n)], n
        for p in range(n):
            copy = [*item[:p], "zzz", *item[p + 1:]]
            found = find(" ".join(item), f"{around} {' '.join(copy)} {around}")
            assert found == ([(7, n - 1)] if n >= 5 else []), (n, p)
        assert find(" ".join(item), around) == []


def test_two_and_three_substitutions_in_short_items():
    rng = random.Random(5)
    for n in range(10, 16):
        item = words(rng, n)
        for a in range(n):
            for b in range(a):
                copy = ["zzz" if k in (a, b) else x for k, x in enumerate(item)]
                assert find(" ".join(item), "u " + " ".join(copy) + " v") == [(7, n - 2)], (n, a, b)


def test_scripts_without_spaces_are_read_by_character():
    for item in ("下列哪一个城市是中华人民共和国的首都并且位于华北平原", "にほんのしゅとはどこですか", "เมืองหลวงของประเทศไทยคือเมืองใด"):
        assert len(D.tokens(item)) >= 12
        assert find(item, f"abc {item} def") and not find(item, item[:4])
        assert find(item, item[:6] + "ㄅ" + item[7:])
    assert D.tokens("GPT4是a_b模型 Été") == ["gpt4", "是", "a_b", "模", "型", "été"]


def test_every_short_item_is_found_by_default(spark):
    docs = spark.createDataFrame([(1, "so it is forty two indeed"), (2, "nothing here")], "doc_id long, text string")
    tests = spark.createDataFrame([(9, "Forty two")], "item_id long, text string")
    assert sorted((r["doc_id"], r["item_ids"]) for r in D.find_overlaps(docs, tests).collect()) == [(1, [9]), (2, [])]
