"""Language identification by word-first back-off."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import fresh, hash_fraction, held_out, stored

#: Runs of letters; digits, marks and underscores separate.
LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def _grams(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def _count(batches, max_n: int):
    """(lang, n, unit, count) of one partition's texts; n = 0 for whole words."""
    words: dict[str, Counter] = {}
    for b in batches:
        for lang, text in zip(b["lang"], b["text"]):
            words.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
    for lang, seen in words.items():
        out = {0: seen}
        for n in range(1, max_n + 1):
            out[n] = Counter()
            for w, c in seen.items():
                for g in _grams(w, n):
                    out[n][g] += c
        for n, counts in out.items():
            yield pd.DataFrame({"lang": lang, "n": n, "unit": list(counts), "count": list(counts.values())})


def fit(docs: DataFrame, max_n: int = 4, docs_per_lang: int = 6_000, max_words: int = 20_000,
        max_grams: int = 5_000) -> dict:
    """Word and character n-gram log frequencies per language, as a plain model.

    The classifier is fitted on a bounded sample: about ``docs_per_lang``
    labelled documents of each language, picked by a hash of the id; of these
    the ``max_words`` commonest words and ``max_grams`` commonest n-grams of
    each length stay.  So the model has at most languages x (max_words + max_n
    x max_grams) entries and can be broadcast at any size of the corpus.
    Rows with a null language or text, and held-out ids, are never read.
    """
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()
                          & F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = {r["lang"]: min(1.0, docs_per_lang / r["n"])
             for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(share)
    if not langs:
        return {"langs": [], "units": {}, "max_n": max_n, "floor": 0.0}
    rate = F.lit(0.0)
    for lang, s in share.items():
        rate = F.when(F.col("lang") == lang, F.lit(s)).otherwise(rate)
    sample = labelled.where(hash_fraction(F.col("doc_id"), F.lit("langid")) < rate).select("lang", "text")
    counts = (sample.mapInPandas(lambda it: _count(it, max_n), "lang string, n int, unit string, count long")
              .groupBy("lang", "n", "unit").agg(F.sum("count").alias("c")))
    best = Window.partitionBy("lang", "n").orderBy(F.desc("c"), "unit")
    counts = stored(counts.withColumn("total", F.sum("c").over(Window.partitionBy("lang", "n")))
                    .withColumn("r", F.row_number().over(best))
                    .where(F.col("r") <= F.when(F.col("n") == 0, max_words).otherwise(max_grams))
                    .select("lang", "n", "unit", F.log10(F.col("c") / F.col("total")).alias("logp")), "langid")
    got = counts.toPandas()
    floor = float(got["logp"].min()) - 1.0 if len(got) else -7.0
    at = {lang: i for i, lang in enumerate(langs)}
    units: dict[tuple[int, str], np.ndarray] = {}
    for lang, n, unit, logp in got.itertuples(index=False):
        row = units.setdefault((n, unit), np.full(len(langs), floor, np.float32))
        row[at[lang]] = logp
    return {"langs": langs, "units": units, "max_n": max_n, "floor": floor}


class Scorer(dict):
    """word -> rows of the model's matrix that score it, remembered up to ``limit`` words."""

    def __init__(self, model: dict, limit: int = 200_000):
        super().__init__()
        self.max_n, self.limit = model["max_n"], limit
        self.at: list[dict[str, int]] = [{} for _ in range(self.max_n + 1)]
        rows = []
        for (n, unit), row in model["units"].items():
            self.at[n][unit] = len(rows)
            rows.append(row)
        rows.append(np.full(len(model["langs"]), model["floor"], np.float32))
        self.rows = np.array(rows, np.float64)

    def __missing__(self, w: str) -> tuple[int, ...]:
        """Known words by their own frequency, else the longest n-grams of which any is known, else the floor."""
        known = self.at[0].get(w)
        hits: list[int] = [] if known is None else [known]
        n = min(self.max_n, len(w) + 2)
        while not hits and n:
            at = self.at[n]
            hits = [at[g] for g in _grams(w, n) if g in at]
            n -= 1
        if len(self) >= self.limit:
            self.clear()
        out = self[w] = tuple(hits) or (len(self.rows) - 1,)
        return out

    def word(self, w: str) -> np.ndarray:
        return self.rows[list(self[w])].mean(axis=0)

    def mean(self, words: list[str]) -> np.ndarray:
        """The mean over words of their score, each word's being the mean of its rows."""
        at, weight = [], []
        for w, times in Counter(words).items():
            hits = self[w]
            at.extend(hits)
            weight.extend([times / len(hits)] * len(hits))
        return np.array(weight) @ self.rows[at] / len(words)


def predict_one(scorer: Scorer, langs: list[str], text: str | None, evidence: int = 30) -> tuple[str, float]:
    """(language, score): softmax of the mean log frequencies, sharpened by up to ``evidence`` words.

    Ties go to the first language in alphabetical order; no letter, or a model
    without languages, gives ``und`` and 0.
    """
    words = LETTERS.findall(text.lower()) if text else []
    if not words or not langs:
        return UNKNOWN, 0.0
    m = scorer.mean(words) * min(len(words), evidence) * np.log(10.0)
    p = np.exp(m - m.max())
    best = int(np.argmax(p))
    return langs[best], float(p[best] / p.sum())


def predict(docs: DataFrame, model: dict, text_col: str = "text", lang_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """``docs`` without its text, plus the predicted language and a score in [0, 1].

    The whole text is scored.  Null or letterless text gives ``und`` with score
    0; rows are never dropped, repeated rows stay repeated, and only the text
    is an input.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*[F.col(c) for c in docs.columns if c != text_col]).schema
    schema = schema.add(lang_col, "string").add(score_col, "double")

    def score(batches):
        scorer, langs = Scorer(shared.value), shared.value["langs"]
        for b in batches:
            got = [predict_one(scorer, langs, t) for t in b[text_col]]
            out = b.drop(columns=[text_col])
            out[lang_col], out[score_col] = [g[0] for g in got], [g[1] for g in got]
            yield out

    return docs.mapInPandas(score, schema)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of documents (doc_id, text, lang)."""
    model = fit(docs.select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def drop_unidentified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text is recognisably in one of the learned languages, same columns.

    Rejected: no letter at all (also null and empty text), or no language with
    at least ``min_score``.  Every other row stays, repeated ones included.
    """
    model = fit(docs.select("doc_id", "text", "lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = fresh(docs.columns, "_speaks")

    @F.pandas_udf("boolean")
    def speaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer, langs = Scorer(shared.value), shared.value["langs"]
        for texts in batches:
            got = (predict_one(scorer, langs, t) for t in texts)
            yield pd.Series([lang != UNKNOWN and s >= min_score for lang, s in got], dtype=bool)

    return docs.withColumn(keep, speaks(F.col("text"))).where(F.col(keep)).select(*docs.columns)
