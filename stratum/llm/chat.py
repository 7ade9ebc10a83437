"""Chat formatting with minimum-cost role repair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import stored

#: States of the automaton: the role of the turn rendered last.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: Legal successors: an optional system turn, then user and assistant in turn.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ALIASES = {"human": USER, "prompter": USER, "customer": USER, "bot": ASSISTANT, "gpt": ASSISTANT, "model": ASSISTANT,
           "ai": ASSISTANT, "chatbot": ASSISTANT, "developer": SYSTEM, **{r: i for i, r in enumerate(ROLES) if r}}
#: Costs of the repairs.  An unknown role takes any label cheaply.
MERGE_SAME, MERGE_OTHER, RELABEL, RELABEL_UNKNOWN, INSERT = 2, 6, 4, 1, 3
UNKNOWN = 0
INF = 10**9
PART_TURNS, PART_CHARS = 1024, 4_000_000


def role_class(role: str | None) -> int:
    return ALIASES.get((role or "").strip().lower(), UNKNOWN)


def _insertions(a: int, b: int) -> tuple[int, ...] | None:
    """The fewest empty turns that make b a legal successor of a."""
    todo: list[tuple[int, ...]] = [()]
    for path in todo:
        last = path[-1] if path else a
        if b in NEXT[last]:
            return path
        if len(path) < 3:
            todo += [(*path, x) for x in NEXT[last]]
    return None


def _table() -> dict[tuple[int, int], list[tuple[int, int, str]]]:
    """(state, role class) -> (cost, next state, action) of every legal repair, cheapest first; ties in the order tried."""
    out = {}
    for q in range(4):
        for role in range(4):
            moves = []
            for label in (SYSTEM, USER, ASSISTANT):
                path = _insertions(q, label)
                if path is None:
                    continue
                change = 0 if label == role else RELABEL if role else RELABEL_UNKNOWN
                moves.append((INSERT * len(path) + change, label,
                              "".join("+" + "_sua"[x] for x in path) + ("k" if not change else "r" + "_sua"[label])))
            if q != START:
                moves.append((MERGE_SAME if role in (q, UNKNOWN) else MERGE_OTHER, q, "m"))
            out[q, role] = sorted(moves, key=lambda m: (m[0], len(m[2]), m[1]))
    return out


MOVES = _table()
#: Per role class the least cost from state to state.
STEP = np.full((4, 4, 4), INF, np.int64)
for (_q, _r), _moves in MOVES.items():
    for _c, _n, _a in reversed(_moves):
        STEP[_r, _q, _n] = min(STEP[_r, _q, _n], _c)
#: A conversation ends with an assistant turn; what it costs to get there from each state.
ENDING = {q: () if q in (START, ASSISTANT) else (*(_insertions(q, ASSISTANT) or ()), ASSISTANT) for q in range(4)}
END_COST = np.array([INSERT * len(ENDING[q]) for q in range(4)], np.int64)


def span_cost(roles: list[int]) -> np.ndarray:
    """4 x 4 least costs from the state before these turns to the state after them (min-plus product)."""
    m = np.where(np.eye(4, dtype=bool), 0, INF)
    for r in roles:
        m = np.minimum((m[:, :, None] + STEP[r][None, :, :]).min(axis=1), INF)
    return m


def best_path(roles: list[int], first: int, last: int) -> tuple[int, list[str]]:
    """(cost, actions) of the cheapest legal repair of these turns from state ``first`` to state ``last``."""
    cost, back = {first: 0}, []
    for r in roles:
        new: dict[int, tuple[int, int, str]] = {}
        for q in sorted(cost):
            for c, n, action in MOVES[q, r]:
                if n not in new or cost[q] + c < new[n][0]:
                    new[n] = (cost[q] + c, q, action)
        back.append(new)
        cost = {n: v[0] for n, v in new.items()}
    actions, q = [], last
    for new in reversed(back):
        _, q, action = (new[q][0], new[q][1], new[q][2])
        actions.append(action)
    return cost.get(last, INF), actions[::-1]


def _escape(text: str | None) -> str:
    return (text or "").replace("<|", "< |")


def render(roles: list[int], texts: list[str | None], actions: list[str], first: int, closing: bool) -> tuple[str, int]:
    """(rendered text, turns opened) of repaired turns; with ``closing`` the conversation ends here."""
    out, state, opened = [], first, 0

    def open_turn(role, text):
        nonlocal state, opened
        out.append(("" if state == START else "<|end|>\n") + f"<|{ROLES[role]}|>\n" + text)
        state, opened = role, opened + 1

    for role, text, action in zip(roles, texts, actions):
        if action == "m":
            out.append("\n" + _escape(text))
            continue
        while action[0] == "+":
            open_turn("_sua".index(action[1]), "")
            action = action[2:]
        open_turn(role if action == "k" else "_sua".index(action[1]), _escape(text))
    if closing:
        for role in ENDING[state]:
            open_turn(role, "")
        if state != START:
            out.append("<|end|>\n")
    return "".join(out), opened


def _parts(batches: Iterator[pd.DataFrame], turns: int, chars: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation and turn -> parts of bounded size, numbered in the global order."""
    pid, seq, key, held, size = TaskContext.get().partitionId(), 0, None, [], 0

    def close():
        nonlocal seq, held, size
        roles = [role_class(r) for r, _ in held]
        row = {"conv_id": [key], "place": [(pid << 32) + seq], "roles": ["".join(map(str, roles))],
               "texts": [[t for _, t in held]], "cost": [span_cost(roles).ravel().tolist()]}
        seq, held, size = seq + 1, [], 0
        return pd.DataFrame(row).astype({"conv_id": "Int64"})

    for b in batches:
        for conv, role, text in zip(b["conv_id"].astype("Int64"), b["role"], b["text"]):
            conv = None if conv is pd.NA else int(conv)
            if held and (conv != key or len(held) >= turns or size >= chars):
                yield close()
            key = conv
            held.append((role, text))
            size += len(text or "")
    if held:
        yield close()


def _choose(parts: pd.DataFrame) -> pd.DataFrame:
    """One conversation's parts -> the states before and after each on the cheapest path."""
    parts = parts.sort_values("place")
    steps = [np.array(c, np.int64).reshape(4, 4) for c in parts["cost"]]
    after = [END_COST]
    for m in reversed(steps):                    # least cost from each state to the end
        after.append(np.minimum((m + after[-1][None, :]).min(axis=1), INF))
    after.reverse()
    state, first, last = START, [], []
    for m, rest in zip(steps, after[1:]):
        first.append(state)
        state = int(np.argmin(m[state] + rest))
        last.append(state)
    n = len(steps)
    return pd.DataFrame({"p": parts["place"].to_numpy(), "part": np.arange(n), "parts": n,
                         "first": first, "last": last, "total_cost": int(after[0][START])})


def _render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for conv, part, parts, first, last, total, roles, texts in zip(
                b["conv_id"].astype("Int64"), b["part"], b["parts"], b["first"], b["last"], b["total_cost"], b["roles"], b["texts"]):
            roles = [int(r) for r in roles]
            cost, actions = best_path(roles, first, last)
            closing = part == parts - 1
            text, opened = render(roles, list(texts), actions, first, closing)
            rows.append((conv, part, parts, len(roles), opened, cost + (int(END_COST[last]) if closing else 0), total,
                         " ".join(actions), text))
        yield pd.DataFrame(rows, columns=["conv_id", "part", "parts", "n_turns", "n_out", "cost", "total_cost", "actions",
                                          "rendered"]).astype({"conv_id": "Int64"})


def format_conversations(turns: DataFrame, part_turns: int = PART_TURNS, part_chars: int = PART_CHARS) -> DataFrame:
    """Repaired and rendered conversations, in parts: conv_id, part, parts, n_turns, n_out, cost, total_cost, actions, rendered.

    A dynamic programme over the automaton of legal turns picks the cheapest
    repair: a turn is kept (k), merged into the one before it (m), relabelled
    (r and the role's initial), each possibly after empty turns put in (+ and
    the initial); a conversation starts with system or user and ends with an
    assistant.  Ties prefer fewer actions.  Joining ``rendered`` by part gives the whole
    conversation; nearly all have one part.

    Turns are range-sorted by conversation and turn, so that a very long
    conversation spreads over tasks; each run of at most ``part_turns`` turns or
    about ``part_chars`` characters is one part and is reduced to a 4 x 4
    matrix of least costs.  Only these matrices, a thousandth of the rows, meet per
    conversation to fix the states between parts.

    Turns order by turn number, null ones last, then by role, text and input
    order.  Null text is empty, a null or unknown role is free to relabel;
    rows with a null conv_id form one conversation; repeated rows are turns
    like any other; an empty table gives an empty result; other columns are
    ignored.  "<|" inside a text is rendered "< |".
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), "role", "text")
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(), "role", F.xxhash64("text"), "tie"]
    parts = (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
             .mapInPandas(lambda it: _parts(it, part_turns, part_chars),
                          "conv_id long, place long, roles string, texts array<string>, cost array<long>"))
    parts = stored(parts, "chat-parts")
    shape = "p long, part long, parts long, first int, last int, total_cost long"
    n = F.count("*").over(Window.partitionBy("conv_id"))
    keyed = parts.select("conv_id", "place", "cost").withColumn("n", n)
    # a conversation in one part needs no meeting: its end is the argmin of one row
    ends = F.transform(F.array(*[F.lit(int(c)) for c in END_COST]), lambda c, i: F.element_at("cost", i + 1) + c)
    alone = keyed.where("n = 1").select(
        F.col("place").alias("p"), F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"),
        F.lit(START).alias("first"), (F.array_position(ends, F.array_min(ends)) - 1).cast("int").alias("last"),
        F.array_min(ends).alias("total_cost"))
    split = keyed.where("n > 1").drop("n").groupBy("conv_id").applyInPandas(_choose, shape)
    states = alone.unionByName(split)
    return (parts.join(states, F.col("place") == F.col("p"))       # places are unique in the table
            .select("conv_id", "part", "parts", "first", "last", "total_cost", "roles", "texts")
            .mapInPandas(_render, "conv_id long, part long, parts long, n_turns long, n_out long, cost long, "
                                  "total_cost long, actions string, rendered string"))
