"""Mixing sources to target weights by iterative proportional fitting; DataFrame functions only."""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import fresh, release, stored

AXES = ("source", "lang", "topic")
MISSING = "(none)"
#: Raking that shrinks a cell without end, under targets that no weights can meet together, stops at this share: a double that is neither 0 nor lost.
LEAST = 1e-200
#: So many cells, counted, share one partition: summing them over an axis then takes no shuffle, and the driver plans no stage for it.
FEW_CELLS = 100_000


def topic(text: Column) -> Column:
    """The kind of text, from its layout: table rows, code or markup, list-like short lines, long prose, short prose."""
    t = F.coalesce(text, F.lit(""))
    lines = F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1
    return (F.when(F.contains(t, F.lit(" | ")), "table")
            .when(F.contains(t, F.lit("{")) | F.contains(t, F.lit("<")), "markup")
            .when(F.length(t) / lines < 40, "lines")
            .when(F.length(t) >= 2000, "long prose").otherwise("short prose"))


def tokens(text: Column) -> Column:
    """Space-separated pieces of the text, at least 1 so that every document has mass to sample."""
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) - F.length(F.replace(F.replace(t, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))) + 1).cast("double")


def gathered(cells: DataFrame) -> DataFrame:
    """``cells`` in one partition if they are few, else as they are."""
    return cells.coalesce(1) if cells.count() <= FEW_CELLS else cells


def tempered_targets(cells: DataFrame, axes: Sequence[str] = AXES, power: float = 0.5) -> dict[str, DataFrame]:
    """For each axis (value, share): shares of tokens raised to ``power`` and made to sum to 1.

    A power below 1 lifts the small values of an axis at the cost of its
    largest, which is how multilingual mixtures are usually tempered.
    """
    out = {}
    for a in axes:
        m = cells.groupBy(a).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("m"))
        total = m.agg(F.sum("m")).first()[0]
        out[a] = stored(m.select(F.col(a).alias("value"), (F.col("m") / F.lit(total).cast("double")).alias("share")), "mix-target")
    return out


def _have(cells: DataFrame, axis: str, few: bool) -> DataFrame:
    """``cells`` with column ``have``, what is fitted to all cells of their value of ``axis``; null values drop out."""
    if few:
        return cells.withColumn("have", F.sum("fitted").over(Window.partitionBy(axis))).where(F.col(axis).isNotNull())
    return cells.join(cells.groupBy(axis).agg(F.sum("fitted").alias("have")), axis)


def rake(cells: DataFrame, targets: dict[str, DataFrame], max_sweeps: int = 50, tolerance: float = 1e-4) -> DataFrame:
    """Cells with column ``fitted``: their shares scaled in turn to every axis' target until none is off by ``tolerance``.

    ``targets`` maps an axis to (value, share).  Values without a target keep
    weight 0 and targets without any cell are left out, the rest of an axis
    being scaled to sum to 1.  The goals are joined to the cells once.  Each
    step is one aggregation with map-side combine and a join on the axis value,
    on the table of cells and not of documents; up to FEW_CELLS cells lie in
    one partition and are summed there by windows.  Each sweep is written, so
    a lost executor repeats one sweep, and the one before is deleted.
    Stops early when the sweep changed no cell's share of the total, which
    is where targets that no weights can meet together settle as well.
    """
    few = cells.count() <= FEW_CELLS
    placed = (lambda df: df.coalesce(1)) if few else (lambda df: df)
    cells = placed(cells)
    total = cells.agg(F.sum("tokens")).first()[0]
    cur = cells.withColumn("fitted", F.col("tokens") / F.lit(total).cast("double"))
    goals = {}
    for a, t in targets.items():
        goals[a] = fresh(cur.columns, f"goal_{a}")
        here = t.join(cells.select(F.col(a).alias("value")).distinct(), "value")
        whole = here.agg(F.sum("share")).first()[0]
        goal = here.select(F.col("value").alias(a), (F.col("share") / F.lit(whole).cast("double")).alias(goals[a]))
        cur = cur.join(F.broadcast(goal) if few else goal, a, "left")
    kept = stored(cur, "mix-start")
    cur = placed(kept)
    for _ in range(max_sweeps):
        new = cur.withColumn("before", F.col("fitted"))
        for a, goal in goals.items():
            factor = F.when(F.col("have") > 0, F.coalesce(goal, F.lit(0.0)) / F.col("have")).otherwise(0.0)
            new = _have(new, a, few).withColumn("fitted", F.when((F.col("fitted") > 0) & (factor > 0), F.greatest(
                F.col("fitted") * factor, F.lit(LEAST))).otherwise(0.0)).drop("have")
        last, kept = kept, stored(new, "mix-sweep")
        new = placed(kept)
        release(last)
        moved = new.agg(F.sum(F.abs(F.col("fitted") - F.col("before"))).alias("d")).first()["d"] or 0.0
        cur = new.drop("before")
        if moved < tolerance:
            break
    return cur.drop(*goals.values())


def sampling_rate(fitted: DataFrame, budget: float, steps: int = 64, tolerance: float = 1e-12) -> float:
    """The factor lambda for which cells sampled with min(1, lambda * fitted / tokens) are expected to give ``budget`` tokens.

    The expected tokens are a concave, piecewise linear function of lambda.
    Each round evaluates it, with its slope, at ``steps`` values that rise by
    equal factors, since lambda may span hundreds of decades, in one
    aggregation that returns a row for each.  The tangent at the largest value
    under the budget and the chord to the smallest one above it then narrow
    the interval; between two neighbouring cells both give the exact solution.
    """
    per = fitted.where("fitted > 0 AND tokens > 0")
    r = per.agg(F.max(F.col("tokens") / F.col("fitted")).alias("hi"), F.sum("tokens").alias("t"), F.sum("fitted").alias("w")).first()
    if r["t"] is None or budget <= 0:
        return 0.0
    most = min(float(r["hi"]), sys.float_info.max)
    if budget >= r["t"]:
        return most
    near = tolerance * budget
    lo, hi, over = budget / r["w"], most, 0.0          # at lo at most the budget comes out; what comes out at hi is not known yet
    while lo < hi * (1 - tolerance):
        ratio = math.log(hi) - math.log(lo)
        tries = [lo, *(min(hi, lo * math.exp(ratio * (i + 1) / steps)) for i in range(steps - 1))]
        tried = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(x).alias("x")) for i, x in enumerate(tries)])).alias("try")
        got = {r["i"]: r for r in per.select("tokens", "fitted", tried).select("tokens", "fitted", "try.i", (F.col("fitted") * F.col("try.x")).alias("m"))
               .groupBy("i").agg(F.sum(F.least("tokens", "m")).alias("sum"),
                                 F.sum(F.when(F.col("m") < F.col("tokens"), F.col("fitted")).otherwise(0.0)).alias("slope")).collect()}
        under = max((i for i in range(steps) if got[i]["sum"] <= budget + near), default=0)
        at, have, slope = tries[under], got[under]["sum"], got[under]["slope"]
        if have >= budget - near or slope <= 0:
            return at
        if under + 1 < steps:
            hi, over = tries[under + 1], got[under + 1]["sum"]
        tangent = at + (budget - have) / slope
        chord = at + (hi - at) * ((budget - have) / (over - have)) if over > have else hi
        if not lo < tangent < hi:                         # no double lies between
            return min(max(tangent, lo), hi)
        lo, hi = tangent, min(hi, chord)
    return lo


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, budget_share: float = 0.5, power: float = 0.5,
        seed: int = 42, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with topic, n_tokens, weight, probability and sampled appended.

    Tokens are counted for every cell (source, lang, topic) over all
    documents, the cells' weights are raked to the targets (``tempered_targets``
    of the corpus itself if none are given), and a document is sampled when a
    hash of its id and text falls below min(1, lambda * weight), with lambda
    such that ``budget_share`` of all tokens are expected.  ``weight`` is the fitted
    share of a cell over its natural share.  Cells whose probability reaches 1
    are taken whole and fall short of their target; text is never repeated.

    Null source or lang count as the value '(none)'; null text as empty, with one
    token.  Rows that repeat id and text are sampled alike.  An empty table
    gives an empty result.  Appended columns that clash get a trailing underscore.
    """
    taken = list(docs.columns)
    names = {}
    for base in ("topic", "n_tokens", "weight", "probability", "sampled"):
        names[base] = fresh([*taken, *names.values()], base)
    key = {a: fresh([*taken, *names.values()], f"_{a}") for a in AXES}
    told = docs.withColumns({
        key["source"]: F.coalesce(F.col("source").cast("string"), F.lit(MISSING)),
        key["lang"]: F.coalesce(F.col("lang").cast("string"), F.lit(MISSING)),
        key["topic"]: topic(F.col(text_col)), names["n_tokens"]: tokens(F.col(text_col))})
    cells = gathered(stored(told.groupBy(*[F.col(c).alias(a) for a, c in key.items()])
                            .agg(F.sum(names["n_tokens"]).alias("tokens")), "mix-cells"))
    fitted = rake(cells, targets or tempered_targets(cells, power=power))
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    rate = sampling_rate(fitted, budget_share * total)
    w, p = fresh(told.columns, "_w"), fresh(told.columns, "_p")
    rates = fitted.select(*[F.col(a).alias(f"cell_{a}") for a in AXES],
                          (F.col("fitted") * total / F.col("tokens")).alias(w),
                          F.least(F.lit(1.0), F.col("fitted") * rate / F.col("tokens")).alias(p))
    on = [told[key[a]] == rates[f"cell_{a}"] for a in AXES]
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), F.lit(1 << 40)) / float(1 << 40)
    return told.join(rates, on).select(
        *[F.col(c) for c in taken], F.col(key["topic"]).alias(names["topic"]),
        F.col(names["n_tokens"]).cast("long").alias(names["n_tokens"]), F.col(w).alias(names["weight"]),
        F.col(p).alias(names["probability"]), (u < F.col(p)).alias(names["sampled"]))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled rows of ``mix``, with their weight and probability."""
    out = mix(docs, **options)
    flag = [c for c in out.columns if c.rstrip("_") == "sampled"][-1]
    return out.where(F.col(flag)).drop(flag)
