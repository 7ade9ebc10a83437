"""The pipeline: every stage on its own input, against brute force on a small table."""

import random

import corpus_pipeline as P
from stratum.llm import decontaminate as D
from test_exact_dedup import brute as exact_brute
from test_ngram_join import brute as near_brute


def small(spark, tmp):
    rng = random.Random(11)
    syll = {"en": ["the", "ing", "er", "and", "on"], "fr": ["eau", "ou", "les", "que", "ment"]}
    word = lambda g: "".join(rng.choices(syll[g], k=rng.randint(1, 3)))
    items = [(k, " ".join(word("en") + str(k) for _ in range(25))) for k in range(4)]
    rows = []
    for i in range(150):
        g = rng.choice(["en", "en", "fr"])
        rows.append((i, " ".join(word(g) for _ in range(rng.randint(20, 120))), g, f"src{i % 4}", 0))
    for i in range(150, 180):
        near = rows[rng.randrange(100)][1].split()
        near[rng.randrange(len(near))] = "changed"
        rows.append((i, " ".join(near), "en", "src0", 0))
    rows += [(i, rows[i - 180][1] + " ", "en", "src1", 0) for i in range(180, 200)]
    rows += [(i, f"{rows[i - 100][1]} {items[i % 4][1]}", "en", "src2", 0) for i in range(200, 210)]
    rows += [(210, None, None, None, None), (211, "", "en", "src1", 0), (212, "12 34", "en", "src1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    return rows, items


def test_stages(spark, tmp_path):
    rows, items = small(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    texts = {r[0]: r[1] for r in rows}
    ids, seen = set(texts), []
    for name, stage in P.STAGES:
        out = stage(spark, docs, str(tmp_path))
        got = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert out.count() == len(got) and got <= ids
        if name == "language":
            assert got == {i for i in ids if texts[i] and any(c.isalpha() for c in texts[i])}
        if name == "exact_copies":
            assert got == {d for d, k, _, kept, _ in exact_brute([(i, texts[i]) for i in ids]) if kept}
        if name == "near_copies":
            assert got == {i for i, (_, c) in near_brute([(i, texts[i]) for i in sorted(ids)], 5, 80, 100).items() if i == c}
        if name == "benchmark_passages":
            index, h = D.Index(items, 8), D.WordHashes()
            assert got == {i for i in ids if not D.overlaps(index, h.array(D.tokens(texts[i])), 12)} and len(got) < len(ids)
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs, ids = spark.read.parquet(f"{tmp_path}/{name}"), got
        seen.append(len(got))
    assert seen == sorted(seen, reverse=True) and 0 < seen[-1] < seen[-2]
    assert {r["doc_id"] for r in P.run(spark, str(tmp_path)).collect()} == ids


def test_stages_take_an_empty_table(spark, tmp_path):
    small(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0
