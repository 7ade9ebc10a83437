"""Exact duplicates against a plain dictionary, with hot digests, nulls and ties."""

import hashlib
import random
import re

import pytest

from stratum.llm import exact_dedup as X


def brute(rows):
    groups = {}
    for i, (doc, text) in enumerate(rows):
        t = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), doc is None, doc or 0, i))
    out = []
    for norm, g in groups.items():
        g.sort()
        for k, (_, _, _, i) in enumerate(g):
            out.append((rows[i][0], rows[g[0][3]][0], len(g), k == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture()
def rows():
    rng = random.Random(2)
    base = ["", " \n", None, "a b", "ab", "a\tb\x0b", "é😀", "é 😀", "x" * 5000, "x " * 5000] + [f"text {i}" for i in range(30)]
    out = [(i, rng.choice(base)) for i in range(200)] + [(1000 + i, "hot " + " " * (i % 3)) for i in range(150)]
    out += [(5, "twice"), (5, "twice"), (None, "twice "), (None, None), (None, "only null id"), (None, "only null id")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("support", [0.001, 0.2, 0.9])
def test_matches_brute_force(spark, rows, support):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = X.copy_decisions(df, support=support).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


@pytest.mark.parametrize("support", [0.001, 0.2])
def test_drop_keeps_one_row_per_text(spark, rows, support):
    df = spark.createDataFrame([(*r, f"e{i % 3}", "k") for i, r in enumerate(rows)], "doc_id long, text string, digest string, _digest string")
    kept = X.drop_copies(df, support=support)
    assert kept.columns == df.columns
    got = kept.collect()
    norm = [re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "") for r in got]
    assert len(norm) == len(set(norm)) == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows})
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((d is None, d or 0) for d, _, _, k, _ in brute(rows) if k)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert X.copy_decisions(df).count() == 0 and X.drop_copies(df).count() == 0
