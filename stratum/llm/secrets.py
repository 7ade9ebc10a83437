"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary words; SQL functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import hash_fraction

#: The base patterns, in the order in which spans at one position are listed.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""(?i)^(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
#: A candidate of the models is a run of these characters; what is scored is long enough to be a key.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Ordinary words and identifiers, as training samples.
PLAIN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z_-]{3,}(?![A-Za-z0-9+/_=-])"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
WIDTH = 128


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """Array of (start, kind number, end, match) of the leftmost non-overlapping matches, in code points.

    The pieces between matches and the matches themselves alternate, so
    running sums of their lengths give the positions.
    """
    # most texts match nothing: one search decides before anything is cut
    found = F.when(text.rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array())
    pieces = F.when(F.size(found) > 0, F.slice(F.split(text, pattern, -1), 1, F.size(found)))
    steps = F.arrays_zip(pieces.alias("before"), found.alias("match"))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,match:string>>")

    def step(acc, x):
        at = acc["at"] + F.length(x["before"])
        end = at + F.length(x["match"])
        one = F.struct(at.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    return F.coalesce(F.aggregate(steps, start, step, lambda acc: acc["out"]), empty)


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of every base pattern; assignments keep those whose value has 12 characters or more."""
    assign = F.filter(_spans(text, ASSIGN, "assign"),
                      lambda s: F.length(F.regexp_extract(s["match"], ASSIGN_VALUE, 1)) >= 12)
    return {"assign": assign, "access": _spans(text, ACCESS, "access"), "hex": _spans(text, HEX, "hex")}


def listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _class(ch: Column) -> Column:
    return F.least(F.ascii(ch), F.lit(WIDTH - 1))


def _bigrams(samples: DataFrame) -> DataFrame:
    """(label, a, b, n): counts of neighbouring characters of every sample (label, s), with a start mark 0."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("s")), lambda i: F.struct(
        F.when(i == 1, 0).otherwise(_class(F.substring(F.col("s"), i - 1, F.lit(1)))).alias("a"),
        _class(F.substring(F.col("s"), i, F.lit(1))).alias("b")))
    return (samples.where(F.length("s") > 0).select("label", F.explode(pairs).alias("p"))
            .groupBy("label", "p.a", "p.b").agg(F.count("*").alias("n")))


def train(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", sample_docs: int = 20_000,
          sample_chars: int = 20_000, weight: float = 5.0) -> list[float]:
    """Log-likelihood ratios of character pairs, random strings against ordinary words: WIDTH x WIDTH values.

    The samples label themselves: the values of base matches are random
    strings, the remaining words and identifiers ordinary ones.  Ordinary words
    are so many that the fit takes a bounded sample: those in the first
    ``sample_chars`` characters of about ``sample_docs`` documents, picked by a hash of id and text
    length; base matches are taken from the same documents' whole texts.  The table
    has a fixed size whatever the corpus.  Pair probabilities are smoothed
    towards those of single characters, which count as ``weight`` observations,
    and these by a half; without samples of both kinds every ratio is 0.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    n = rows.count()
    part = rows.where(hash_fraction(F.col("id"), F.length("t")) < min(1.0, sample_docs / max(1, n))).select("t")
    kinds = base_spans(F.col("t"))
    values = F.concat(F.transform(kinds["assign"], lambda s: F.regexp_extract(s["match"], ASSIGN_VALUE, 1)),
                      F.transform(kinds["access"], lambda s: s["match"]), F.transform(kinds["hex"], lambda s: s["match"]))
    random = part.select(F.lit(1).alias("label"), F.explode(values).alias("s"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.substring("t", 1, sample_chars), ASSIGN, " "), ACCESS, " "), HEX, " ")
    plain = part.select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all(rest, F.lit(PLAIN), F.lit(0))).alias("s"))
    counts = _bigrams(random.unionByName(plain.where("length(s) <= 64"))).collect()   # at most 2 x WIDTH x WIDTH rows
    got = [[[0.0] * WIDTH for _ in range(WIDTH)] for _ in range(2)]
    for r in counts:
        got[r["label"]][r["a"]][r["b"]] += r["n"]
    ratio = [0.0] * (WIDTH * WIDTH)
    if not any(r["label"] == 1 for r in counts) or not any(r["label"] == 0 for r in counts):
        return ratio
    size = len(ALPHABET)
    logs = []
    for label in (0, 1):
        rows = got[label]
        each = [sum(rows[a][b] for a in range(WIDTH)) for b in range(WIDTH)]
        one = [(each[b] + 0.5) / (sum(each) + size / 2) for b in range(WIDTH)]
        logs.append([math.log((rows[a][b] + weight * one[b]) / (sum(rows[a]) + weight)) for a in range(WIDTH) for b in range(WIDTH)])
    ratio = [p1 - p0 for p0, p1 in zip(*logs)]
    return ratio


def llr(token: Column, ratio: list[float]) -> Column:
    """Mean log-likelihood ratio per character of a token."""
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in ratio)), ",").cast("array<double>")   # a constant once planned
    chars = F.sequence(F.lit(1), F.length(token))

    def add(acc, i):
        a = F.when(i == 1, 0).otherwise(_class(F.substring(token, i - 1, F.lit(1))))
        return acc + F.element_at(table, a * WIDTH + _class(F.substring(token, i, F.lit(1))) + 1)

    return F.aggregate(chars, F.lit(0.0), add) / F.length(token)


def scan(docs: DataFrame, ratio: list[float] | None = None, text_col: str = "text", id_col: str = "doc_id",
         threshold: float = 1.0) -> DataFrame:
    """One row per row of ``docs``: doc_id, base (array of spans), added (array of spans), both as (start, rank, end, match).

    Base spans are the patterns' matches over the whole text.  Added ones are
    runs of 20 or more key characters, with a digit, whose mean log-likelihood
    ratio per character passes ``threshold`` and that overlap no base span.
    Positions count code points, the end is exclusive.  Null text counts as empty, rows are
    never dropped or merged, other columns are ignored.
    """
    if ratio is None:
        ratio = train(docs, text_col, id_col)
    t = F.col("t")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    kinds = base_spans(t)
    rows = rows.select("doc_id", F.concat(kinds["assign"], kinds["access"], kinds["hex"]).alias("base"),
                       F.filter(_spans(t, TOKEN, "markov"), lambda s: s["match"].rlike("[0-9]")).alias("runs"))
    free = F.filter("runs", lambda s: ~F.exists("base", lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))
    return rows.select("doc_id", "base", F.filter(free, lambda s: llr(s["match"], ratio) > threshold).alias("added"))


def digests(found: DataFrame) -> DataFrame:
    """Counts per kind, the digest of the base spans and the list of all spans, from ``scan``."""
    def count(kind):
        return F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        listed(F.concat("base", "added")).alias("spans"))
