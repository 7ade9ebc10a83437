"""Secret scans against Python's own matcher, and the trained models' behaviour."""

import hashlib
import random
import re

from stratum.llm import secrets as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
KEYISH = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def brute(text):
    """(start, kind number, end) of the base spans, from the definition."""
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out)


def words(rng, n):
    return " ".join("".join(rng.choice(["the", "ing", "er", "on", "tion", "re", "an"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def texts(rng, n=120):
    parts = [lambda: words(rng, 8), lambda: "token = " + "".join(rng.choices(KEYISH, k=rng.randint(8, 40))),
             lambda: "api_key:'" + "".join(rng.choices(KEYISH, k=20)) + "'", lambda: "PassWord=\"abc\"",
             lambda: "AKIA" + "".join(rng.choices("ABCDEFGHIJ0123456789", k=rng.randint(10, 18))), lambda: "AKIAAKIA" * 4,
             lambda: "".join(rng.choices("0123456789abcdef", k=rng.randint(10, 40))), lambda: "token=password: " + "k9" * 10,
             lambda: "secret==" + "a1" * 8, lambda: "é😀ü", lambda: "\n", lambda: "apikey=" + "deadbeef" * 4, lambda: "tokentoken=x1y2z3x1y2z3"]
    return ["".join(rng.choice(parts)() + rng.choice(["", " ", "\n", ","]) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_base_spans_match_brute_force(spark):
    rng = random.Random(4)
    rows = list(enumerate([None, "", *texts(rng)]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in S.digests(S.scan(df, [0.0] * (S.WIDTH * S.WIDTH))).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = brute(text)
        line = ",".join(f"{S.KINDS[k]}:{a}:{z}" for a, k, z in want)
        r = got[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == j for _, k, _ in want) for j in range(3)]
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert r["spans"] == line


def test_models_add_random_strings_and_leave_identifiers(spark):
    rng = random.Random(8)
    docs = texts(rng, 200) + [words(rng, 60) + " the_re_ing on_er_tion" for _ in range(100)]
    key = "".join(rng.choices(KEYISH, k=32))
    docs += [f"see {key} here", "the_reing_on_er_2_tion_an", "retioneringtionanretioning2"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    ratio = S.train(df)
    assert len(ratio) == S.WIDTH ** 2 and any(ratio)
    got = {r["doc_id"]: r["added"] for r in S.scan(df, ratio).collect()}
    n = len(docs)
    assert [(s["start"], s["end"]) for s in got[n - 3]] == [(4, 36)]
    assert got[n - 2] == [] and got[n - 1] == []


def test_scores_equal_a_plain_loop(spark):
    rng = random.Random(2)
    ratio = [rng.uniform(-2, 2) for _ in range(S.WIDTH ** 2)]
    tokens = ["".join(rng.choices(S.ALPHABET, k=rng.randint(1, 50))) for _ in range(30)]
    got = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", S.llr(S.F.col("t"), ratio).alias("x")).collect()
    for r in got:
        codes = [0, *map(ord, r["t"])]
        want = sum(round(ratio[a * S.WIDTH + b], 5) for a, b in zip(codes, codes[1:])) / len(r["t"])
        assert abs(r["x"] - want) < 1e-9


def test_empty_table_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "secret=abcdefghijkl", "x"), (1, "secret=abcdefghijkl", "x"), (None, None, None)],
                               "doc_id long, text string, spans string")
    got = sorted((r["doc_id"] or 0, r["n_assign"], r["spans"]) for r in S.digests(S.scan(df)).collect())
    assert got == [(0, 0, ""), (1, 1, "assign:0:19"), (1, 1, "assign:0:19")]
    assert S.scan(df.limit(0)).count() == 0
