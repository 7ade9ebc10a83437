"""Language identification: held-out accuracy, odd texts, and the back-off by hand."""

import zlib

import numpy as np
import pytest

from stratum.llm import language_id as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    got = {r["doc_id"]: r for r in L.identified(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert all(got[r["doc_id"]]["held_out"] == (r in held) for r in rows)
    right = [got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held if len(L.LETTERS.findall(r["text"] or "")) >= 5]
    assert np.mean(right) >= 0.97 and all(0 <= g["score"] <= 1 for g in got.values())


@pytest.fixture()
def model():
    floor = -6.0
    row = lambda *x: np.array(x, np.float32)
    return {"langs": ["aa", "bb"], "max_n": 3, "floor": floor,
            "units": {(0, "the"): row(-1, floor), (0, "le"): row(floor, -1), (3, "ing"): row(-2, -5), (2, "ou"): row(-4, -3)}}


def test_back_off(model):
    s = L.Scorer(model)
    assert s.word("the").tolist() == [-1, -6]
    assert s.word("singing").tolist() == [-2, -5]            # known trigrams only
    assert s.word("out").tolist() == [-4, -3]                # no trigram, a bigram
    assert s.word("zzz").tolist() == [-6, -6]
    assert L.predict_one(s, model["langs"], "The the") [0] == "aa"
    assert L.predict_one(s, model["langs"], "zzz")[0] == "aa"     # a tie goes to the first
    for text in (None, "", "123 !?", "\n"):
        assert L.predict_one(s, model["langs"], text) == ("und", 0.0)
    assert L.predict_one(s, [], "text") == ("und", 0.0)


def test_words_beyond_the_memory_score_alike(model):
    small, large = L.Scorer(model, limit=2), L.Scorer(model)
    words = ["the", "singing", "out", "zzz", "le"] * 3
    for k in range(1, 15):
        assert small.mean(words[:k]).tolist() == large.mean(words[:k]).tolist()


def test_nulls_repeats_empty_table_and_other_columns(spark):
    rows = [(i, t, g, "x") for i, (t, g) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr")] * 20)]
    rows += [(1, rows[1][1], "fr", "x"), (None, "the cat", None, "x"), (99, None, "en", None), (100, "7 8", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = L.identified(df).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["lang_pred"]) for r in got if r["doc_id"] in (None, 99, 100)} == {(None, "en"), (99, "und"), (100, "und")}
    kept = L.drop_unidentified(df)
    assert kept.columns == df.columns and kept.count() == len(rows) - 2
    assert L.identified(df.limit(0)).count() == 0 and L.drop_unidentified(df.limit(0)).count() == 0
    assert {r["lang_pred"] for r in L.identified(df.withColumn("lang", L.F.lit(None).cast("string"))).collect()} == {"und"}
