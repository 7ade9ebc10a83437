"""Trees, proofs and tampering against a plain Python tree."""

import hashlib
import zlib

import pytest

from stratum.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, root string, _PART int"
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes, fan):
    """(root, siblings with own place of every node, level by level)."""
    level, at, ways = list(nodes), list(range(len(nodes))), [[] for _ in nodes]
    while len(level) > 1:
        runs = [level[i:i + fan] for i in range(0, len(level), fan)]
        for k, i in enumerate(at):
            run = runs[i // fan]
            ways[k].append((i % fan, run[:i % fan] + run[i % fan + 1:]))
            at[k] = i // fan
        level = [sha(*r) for r in runs]
    return level[0], ways


def audited(rows, fan=8):
    """The contract, by brute force, as a sorted list."""
    groups = {}
    for doc_id, source, lang, n_chars, text in rows:
        leaf = leaf_of([doc_id, source, lang, n_chars, text])
        bad = leaf
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            bad = leaf_of([doc_id, source, lang, n_chars, text.translate(LOWER)])
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, bad, doc_id))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g])], fan) for g in order}
    root, tops = plain_tree([trees[g][0] for g in order], fan)
    out = []
    for g, top in zip(order, tops):
        for (_, _, leaf, bad, doc_id), way in zip(sorted(groups[g]), trees[g][1]):
            h = bad
            for place, others in way + top:
                h = sha(*others[:place], h, *others[place:])
            out.append((doc_id, leaf, trees[g][0], root, sha(*[s for _, o in way + top for s in o]), h, h == root))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def check(spark, rows):
    got = sorted(map(tuple, merkle.audited(frame(spark, rows)).collect()), key=repr)
    assert got == audited(rows)
    return got


def make(sizes, start=0):
    rows, i = [], start
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((i, f"s{i % 3}", lang, i * 7, f"Text Number {i} é" if i % 5 else "all small"))
            i += 1
    return rows


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8}, {"en": 9}, {"en": 600, None: 1, "de": 65, "": 2, "fr": 64}, {f"l{i:02}": i % 3 + 1 for i in range(20)}])
def test_against_plain_tree(spark, sizes):
    rows = make(sizes)
    got = check(spark, rows[::-1])
    touched = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] != r[4].translate(LOWER)]
    assert sum(not r[-1] for r in got) == len(touched)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(None, None, None, None, None), (None, "s", None, 1, "A"), (3, "s", "en", 1, "Same"), (3, "s", "en", 1, "Same"), (3, "t", "en", 1, ""),
            (3, None, "en", None, None), (5, "s", "en", 9, "Word " * 400_000), (-9, "s", "en", 0, "x")]
    assert len(check(spark, rows)) == 8


def test_empty_table(spark):
    out = merkle.audited(frame(spark, make({"en": 2})).limit(0))
    assert out.count() == 0 and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_other_fan_and_proofs(spark):
    """A binary tree over other columns: every proof folds to the root, and a foreign leaf to another one."""
    rows = make({"en": 37, "de": 5, "fr": 1})
    df = frame(spark, rows).select("doc_id", "lang", "text")
    digest = merkle.hashed(*[merkle.field(df[c]) for c in df.columns])
    leaves = df.select("lang", "doc_id", digest.alias("leaf"))
    from pyspark.sql import functions as F
    from stratum.llm.common import stored
    out = merkle.proofs(merkle.build(stored(leaves, "t"), "lang", ["doc_id"], "leaf", fan=2))
    out = out.withColumn("back", merkle.folded(F.col("leaf"), F.col("proof"))).collect()
    assert len(out) == 43 and len({r["root"] for r in out}) == 1 and all(r["back"] == r["root"] for r in out)
    assert max(len(r["proof"]) for r in out) == 6 + 2
