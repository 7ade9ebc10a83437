"""Role repair against exhaustive search, and rendering."""

import itertools
import random
import re

import pytest

from stratum.llm import chat as C

LEGAL = re.compile(r"(s)?(ua)+$")


def spell(roles, actions):
    """The sequence of rendered roles and the cost of a repair, from the definition of the actions."""
    out, cost = "", 0
    for r, a in zip(roles, actions):
        if a == "m":
            if not out:
                return None, None
            cost += C.MERGE_SAME if r in (C.UNKNOWN, "_sua".index(out[-1])) else C.MERGE_OTHER
            continue
        while a[0] == "+":
            out, cost, a = out + a[1], cost + C.INSERT, a[2:]
        label = "_sua"[r] if a == "k" else a[1]
        cost += 0 if a == "k" else C.RELABEL_UNKNOWN if r == C.UNKNOWN else C.RELABEL
        out += label
    return out, cost


def exhaustive(roles):
    """Least cost over all sequences of actions, with up to two empty turns before each turn and at the end."""
    best = C.INF
    fills = ["".join(f) for n in range(3) for f in itertools.product("sua", repeat=n)]
    singles = ["m"] + ["".join("+" + c for c in f) + x for f in fills for x in ("k", "rs", "ru", "ra")]

    def go(i, out, cost):
        nonlocal best
        if cost >= best:
            return
        if i == len(roles):
            for f in fills:
                if LEGAL.match(out + f):
                    best = min(best, cost + C.INSERT * len(f))
            return
        for a in singles:
            if a.endswith("k") and roles[i] == C.UNKNOWN or a[-2:] == "r" + "_sua"[roles[i]]:
                continue
            if a == "m" and not out:
                continue
            new, c = spell([roles[i]], [a]) if a != "m" else ("", C.MERGE_SAME if roles[i] in (0, "_sua".index(out[-1])) else C.MERGE_OTHER)
            whole = out + new
            if re.match(r"(s|su|s?(ua)+u?|u)?$", whole):
                go(i + 1, whole, cost + c)

    go(0, "", 0)
    return best


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["part"]):
        out.setdefault(r["conv_id"], []).append(r)
    return out


@pytest.mark.parametrize("roles", [r for n in (1, 2, 3) for r in itertools.product(range(4), repeat=n)][::3])
def test_least_cost(roles):
    m = C.span_cost(list(roles))
    last = min(range(4), key=lambda q: m[C.START, q] + C.END_COST[q])
    cost, actions = C.best_path(list(roles), C.START, last)
    out, spelled = spell(roles, actions)
    assert spelled == cost == m[C.START, last]
    assert LEGAL.match(out + "".join("_sua"[x] for x in C.ENDING[last]))
    assert cost + C.END_COST[last] == exhaustive(roles)


def test_parts_join_to_the_same_conversation(spark):
    rng = random.Random(3)
    names = ["system", "user", "assistant", "Human", "tool", None, "GPT"]
    rows = [(c, t, rng.choice(names), rng.choice(["hi", "", None, f"text {t} <|user|>"]))
            for c in range(30) for t in range(rng.choice([1, 2, 5, 40, 200]))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole, cut = collected(C.format_conversations(df)), collected(C.format_conversations(df, part_turns=7))
    assert len(whole) == 30 and max(map(len, cut.values())) > 20
    for c, parts in whole.items():
        (one,) = parts
        assert one["cost"] == one["total_cost"] == sum(r["cost"] for r in cut[c]) == cut[c][0]["total_cost"]
        assert one["n_turns"] == sum(r["n_turns"] for r in cut[c]) == sum(x[0] == c for x in rows)
        for text in (one["rendered"], "".join(r["rendered"] for r in cut[c])):
            shown = "".join({"system": "s", "user": "u", "assistant": "a"}[x] for x in re.findall(r"<\|(\w+)\|>\n", text) if x != "end")
            assert LEGAL.match(shown) and text.endswith("<|end|>\n") and text.count("<|end|>\n") == len(shown)


def test_rendering(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (2, 0, "system", "s"), (2, 1, "user", "q")]
    got = collected(C.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert got[1][0]["rendered"] == "<|user|>\na\nb<|end|>\n<|assistant|>\nc<|end|>\n" and got[1][0]["actions"] == "k m k"
    assert got[2][0]["rendered"] == "<|system|>\ns<|end|>\n<|user|>\nq<|end|>\n<|assistant|>\n<|end|>\n"


def test_nulls_repeats_empty_table_and_other_columns(spark):
    rows = [(None, None, None, None, "x"), (None, None, None, None, "x"), (5, None, "assistant", "late", "y"), (5, 1, "user", "q", None),
            (5, 1, "user", "q", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, parts string")
    got = collected(C.format_conversations(df))
    assert got[None][0]["n_turns"] == 2 and got[5][0]["rendered"] == "<|user|>\nq\nq<|end|>\n<|assistant|>\nlate<|end|>\n"
    cut = collected(C.format_conversations(df, part_turns=1))
    assert [len(cut[k]) for k in (None, 5)] == [2, 3]
    assert C.format_conversations(df.limit(0)).count() == 0
