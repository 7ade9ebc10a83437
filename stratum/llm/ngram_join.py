"""Exact n-gram Jaccard self-join by universe partition and the pigeonhole principle.

Words of a text give a set of hashed k-word shingles.  Sets are compared by the
*scheme* of the larger one's size band.  A scheme cuts the universe of shingle
hashes into segments; two sets that differ in at most H shingles agree on some
of any H + 1 segments (threshold 0), or come within one deletion of each other
on some segment of threshold 1, which counts for two.  Each set signs segments
in a fixed order until what it has signed covers its own largest possible
difference, so the set with the shorter prefix proves that the pair meets.
Empty segments say nothing and are neither signed nor counted; a set that
cannot reach its cover under one seed is signed again under the next one,
together with everything in its scheme.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import connected_components, heavy_values, mix64, release, stored, word_hashes

BAND_RATIO = 1.6
_C = np.uint64(0x9E3779B97F4A7C15)


class Rule:
    """Shingle length and threshold: sets link when den * intersection >= num * union."""

    def __init__(self, words: int = 3, num: int = 90, den: int = 100):
        if not 0 < num <= den:
            raise ValueError("the threshold must lie in (0, 1]")
        self.words, self.num, self.den = words, num, den

    def shingles(self, bodies: list[bytes]) -> list[np.ndarray]:
        """For each text its sorted distinct shingle hashes; fewer words than a shingle count as one; none without words."""
        out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(bodies)
        k = self.words
        for first, h, counts in word_hashes(bodies):
            with np.errstate(over="ignore"):
                s = np.full(max(0, len(h) - k + 1), k, np.uint64)
                for j in range(k):
                    s = s * _C + h[j:j + len(s)]
                s = mix64(s)
                ends = np.cumsum(counts)
                for i, (lo, hi) in enumerate(zip((ends - counts).tolist(), ends.tolist()), first):
                    if hi - lo >= k:
                        out[i] = np.unique(s[lo:hi - k + 1])
                    elif hi > lo:
                        one = np.full(1, hi - lo, np.uint64)
                        for x in h[lo:hi]:
                            one = one * _C + x
                        out[i] = mix64(one)
        return out

    def difference(self, size: int, top: int) -> int:
        """The most shingles in which a linked pair can differ that holds a set of this size, the larger up to ``top``."""
        return min(size * (self.den - self.num) // self.num, (size + top) * (self.den - self.num) // (self.den + self.num))

    def linked(self, common, a, b):
        return self.den * common >= self.num * (a + b - common)


def band_edges(largest: int) -> list[int]:
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * BAND_RATIO)))
    return edges


def _miss(m: int, k: int, need: int, size: int) -> float:
    """About the chance that a set of ``size`` reaches less than ``need`` on m segments, k of them of threshold 1."""
    p = 0.0
    if k:
        empty = (1 - 1 / m) ** size if m > 1 else 0.0
        p += k * (empty + (size / m * (1 - 1 / m) ** (size - 1) if m > 1 else 0.0))
    rest = need - 2 * k
    if rest > 0:
        n, few = m - k, rest - 1
        if n < rest:
            return 1.0
        if not few:
            p += math.exp(-size * n / m)
        else:
            ways = math.lgamma(n + 1) - math.lgamma(few + 1) - math.lgamma(n - few + 1)
            p += math.exp(min(0.0, ways + size * n / m * math.log(few / n)))
    return min(1.0, p)


def allocate(rule: Rule, low: int, top: int, sets: int, repeat: float = 0.3) -> tuple[int, int]:
    """(segments, how many of them have threshold 1) of least cost for a scheme of ``sets`` sets.

    The cost of an allocation is the signatures that a set writes plus the
    accidental partners they are expected to meet: ``repeat`` is the chance
    that an unrelated set has a given shingle, so long segments collide less.
    Segments are added until fewer than one set in a hundred schemes is
    expected to miss its cover.
    """
    need = rule.difference(top, top) + 1
    probes = sorted({max(1, low), (low + top) // 2, top})
    best = (math.inf, 1, 0)
    for k in sorted({0, *(min((need + 1) // 2, 1 << j) for j in range(need.bit_length() + 1)), (need + 1) // 2}):
        m = max(1, k, need - k)
        while m < 4 * need + 8 and sum(sets * _miss(m, k, rule.difference(x, top) + 1, x) for x in probes) > 0.01:
            m += 1
        q = top / m
        rows = (m - k) + k * (1 + q)
        met = sets * ((m - k) * repeat ** q + k * (1 + q) * repeat ** max(0.0, q - 1))
        if rows + met < best[0]:
            best = (rows + met, m, k)
    return best[1], best[2]


def make_schemes(rule: Rule, bands: dict[int, int], edges: list[int]) -> dict[int, tuple[int, int, int]]:
    """band -> (largest size, segments, segments of threshold 1), from the number of sets in each band."""
    out = {}
    for b in range(len(edges) - 1):
        sets = bands.get(b, 0) + bands.get(b - 1, 0)
        if bands.get(b, 0):
            low, top = max(1, edges[b] * rule.num // rule.den), edges[b + 1] - 1
            out[b] = (top, *allocate(rule, low, top, sets))
    return out


def sign(rule: Rule, elements: np.ndarray, band: int, scheme: tuple[int, int, int], seed: int) -> np.ndarray | None:
    """The signatures of one set in one scheme; None if its cover cannot be reached under this seed.

    A set that can only link with its equals needs none, and gets an empty array.
    """
    top, m, k = scheme
    need = rule.difference(len(elements), top) + 1
    if need == 1:
        return np.empty(0, np.uint64)
    base = mix64(np.array([(band << 40) | (seed << 32) | 0x5EED], np.uint64))[0]
    v = mix64(elements ^ base)
    seg = (((v >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
    sizes = np.bincount(seg, minlength=m)
    sums = np.zeros(m, np.uint64)
    np.add.at(sums, seg, v)
    # threshold-0 segments come first in the order, then those of threshold 1
    cover = np.minimum(sizes, np.where(np.arange(m) < m - k, 1, 2))
    reach = np.cumsum(cover)
    if reach[-1] < need:
        return None
    end = int(np.searchsorted(reach, need)) + 1
    mark = mix64(np.arange(end, dtype=np.uint64) + base)
    used = np.flatnonzero(sizes[:end] > 0)
    out = [mix64(sums[used] + mark[used])]
    if end > m - k:
        on = (seg >= m - k) & (seg < end) & (sizes[seg] > 1)
        out.append(mix64(sums[seg[on]] - v[on] + mark[seg[on]]))
    return np.unique(np.concatenate(out)) >> np.uint64(1)


SKETCH_BITS, MOST_SKETCH_BITS = 1 << 10, 1 << 15


def sketch(elements: np.ndarray, apart: int = 0) -> bytes:
    """Parities of the set's shingles over slots: two sketches never differ in more bits than their sets differ in shingles.

    There are over four slots for each of the ``apart`` shingles in which a
    partner may differ, SKETCH_BITS at least: unrelated sets then differ in
    about half the slots, twice what is allowed.  Sets too large for
    MOST_SKETCH_BITS pass more often and are told apart by their shingles.
    """
    bits = min(MOST_SKETCH_BITS, max(SKETCH_BITS, 1 << (4 * apart).bit_length()))
    slots = (elements & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(slots, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """The sketch that the same set has with fewer slots."""
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def sketch_levels(sketches: list[bytes]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Words of each sketch, and for each such length the sketches of that length or more folded to it (else zeros)."""
    rows = [np.frombuffer(x, np.uint64) for x in sketches]
    words = np.array([len(r) for r in rows])
    levels = {}
    for n in np.unique(words).tolist():
        levels[n] = np.zeros((len(rows), n), np.uint64)
        for k in np.flatnonzero(words >= n).tolist():
            levels[n][k] = _fold(rows[k], n) if words[k] > n else rows[k]
    return words, levels


def sketches_apart(words: np.ndarray, levels: dict[int, np.ndarray], x: int, others: np.ndarray) -> np.ndarray:
    """In how many bits sketch x differs from each of the others, at the shorter length of the two."""
    if len(levels) == 1:
        bits = levels[int(words[x])]
        return np.bitwise_count(bits[others] ^ bits[x]).sum(axis=1, dtype=np.int64)
    out, at = np.zeros(len(others), np.int64), np.minimum(words[others], words[x])
    for n, bits in levels.items():
        on = at == n
        out[on] = np.bitwise_count(bits[others[on]] ^ bits[x]).sum(axis=1, dtype=np.int64)
    return out


def _set_keys(batches, rule: Rule):
    for b in batches:
        rows = []
        for e in rule.shingles(b["body"].tolist()):
            rows.append((len(e), int(mix64(e).sum(dtype=np.uint64).astype(np.int64)),
                         int(mix64(e ^ _C).sum(dtype=np.uint64).astype(np.int64)),
                         sketch(e, rule.difference(len(e), len(e)))))
        n, k1, k2, bits = zip(*rows) if rows else ((), (), (), ())
        yield pd.DataFrame({"doc_id": b["doc_id"], "n_shingles": np.array(n, np.int64),
                            "k1": np.array(k1, np.int64), "k2": np.array(k2, np.int64), "sketch": list(bits)})


def _signatures(batches, rule, edges, schemes, only, seed, hot):
    """(sig, doc_id): signatures of every set but repeated hot ones; -1 - scheme where a set stays uncovered."""
    starts = np.array(edges)
    for b in batches:
        sigs, ids, counts = [], [], []
        for doc_id, e in zip(b["doc_id"], rule.shingles(b["body"].tolist())):
            if not len(e):
                continue
            if hot:
                key = (int(mix64(e).sum(dtype=np.uint64).astype(np.int64)), int(mix64(e ^ _C).sum(dtype=np.uint64).astype(np.int64)))
                if hot.get(key, doc_id) != doc_id:
                    continue
            band = int(np.searchsorted(starts, len(e), "right")) - 1
            while band < len(edges) - 1 and (edges[band] <= len(e) or edges[band] <= len(e) * rule.den // rule.num):
                if band in schemes and (only is None or band in only):
                    s = sign(rule, e, band, schemes[band], seed)
                    s = np.array([-1 - band], np.int64) if s is None else s.astype(np.int64)
                    sigs.append(s)
                    ids.append(doc_id)
                    counts.append(len(s))
                band += 1
        yield pd.DataFrame({"sig": np.concatenate(sigs) if sigs else np.empty(0, np.int64),
                            "doc_id": np.repeat(np.array(ids, np.int64), counts)})


def _runs(batches, keys: list[str]):
    """Consecutive rows with equal keys, across batches of rows sorted by them."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        k = b[keys].to_numpy()
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(b)]
        for lo, hi in zip(cuts, cuts[1:]):
            part = b.iloc[lo:hi]
            if held and (held[-1][keys].iloc[0].to_numpy() != k[lo]).any():
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _buckets(batches):
    """(sig, doc_id, n) of the signatures that two documents or more share, from rows sorted by signature.

    A run streams through: rows wait only until a second document shows up,
    and from then on leave with every batch.
    """
    last_sig, last_doc, met = None, None, False
    for b in batches:
        sig, doc = b["sig"].to_numpy(), b["doc_id"].to_numpy()
        if not len(sig):
            continue
        head = np.concatenate([[True], sig[1:] != sig[:-1]])
        carried = last_sig is not None and sig[0] == last_sig
        run = np.cumsum(head) - 1
        first = doc[head][run]
        if carried:
            first = np.where(run == 0, last_doc, first)
        mixed = np.zeros(run[-1] + 1, bool)
        np.logical_or.at(mixed, run, doc != first)
        keep = mixed[run]
        if carried:
            keep |= (run == 0) & met
            if mixed[0] and not met:          # the document that waited since an earlier batch
                yield pd.DataFrame({"sig": [last_sig], "doc_id": [last_doc]})
        yield pd.DataFrame({"sig": sig[keep], "doc_id": doc[keep]})
        ends_carried = carried and run[-1] == 0
        met = bool(mixed[-1]) or (ends_carried and met)
        last_sig, last_doc = sig[-1], last_doc if ends_carried else first[-1]


class _Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


def _meet(batches, rule: Rule):
    """(a, b): a forest of the pairs of one bucket, or of two blocks of it, that size and sketch allow to be linked."""
    for g in _runs(batches, ["bucket", "i", "j"]):
        g = g.drop_duplicates(["node"])
        if len(g) < 2:
            continue
        i, j = int(g["i"].iloc[0]), int(g["j"].iloc[0])
        ids, sizes = g["node"].to_numpy(), g["n_shingles"].to_numpy()
        words, levels = sketch_levels(g["sketch"].tolist())
        block = g["block"].to_numpy()
        yours = np.flatnonzero(block == j)
        forest = _Forest(len(ids))
        for x in np.flatnonzero(block == i).tolist():
            apart = sketches_apart(words, levels, x, yours)
            small, large = np.minimum(sizes[yours], sizes[x]), np.maximum(sizes[yours], sizes[x])
            ok = (apart * (rule.den + rule.num) <= (small + large) * (rule.den - rule.num)) & (small * rule.den >= large * rule.num)
            for y in yours[ok].tolist():
                if y != x:
                    forest.join(x, y)
        top = np.array([forest.find(x) for x in range(len(ids))])
        on = np.flatnonzero(top != np.arange(len(ids)))
        if len(on):
            yield pd.DataFrame({"a": ids[on], "b": ids[top[on]]})


def common_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, by blocks of a 0/1 matrix product."""
    both = left + right
    flat = np.concatenate(both)
    _, at, times = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    live = times[at] > 1
    rank = np.cumsum(times > 1) - 1
    row, col = row[live], rank[at[live]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    total = np.zeros((len(left), len(right)), np.float64)
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, z = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((len(both), width), np.float32)
        m[row[a:z], col[a:z] - lo] = 1
        total += m[:len(left)] @ m[len(left):].T
    return total.astype(np.int64)


def _verify(batches, rule):
    """(node, parent, links) for each member of a block pair: exact links, thinned to a forest."""
    for g in _runs(batches, ["cluster", "i", "j"]):
        g = g.drop_duplicates(["node", "elements"])
        i, j = int(g["i"].iloc[0]), int(g["j"].iloc[0])
        ids, sets = g["node"].to_numpy(), [np.frombuffer(x, np.uint64) for x in g["elements"]]
        mine = np.flatnonzero(g["block"].to_numpy() == i)
        yours = mine if i == j else np.flatnonzero(g["block"].to_numpy() == j)
        if not len(mine) or not len(yours):
            continue
        sizes = np.array([len(x) for x in sets], np.int64)
        common = common_counts([sets[x] for x in mine], [sets[x] for x in yours])
        ok = rule.linked(common, sizes[mine][:, None], sizes[yours][None, :]) & (ids[mine][:, None] != ids[yours][None, :])
        a, b = np.nonzero(ok)
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, mine[a], 1)
        if i != j:
            np.add.at(links, yours[b], 1)
        forest = _Forest(len(ids))
        for x, y in zip(mine[a].tolist(), yours[b].tolist()):
            forest.join(x, y)
        on = np.flatnonzero(links)
        yield pd.DataFrame({"node": ids[on], "parent": ids[[forest.find(x) for x in on.tolist()]], "links": links[on]})


def _shared(signed: DataFrame, support: float) -> DataFrame:
    """The rows (sig, doc_id) whose signature two documents or more have.

    Misra-Gries counters name the signatures that may fill over ``support`` of
    the rows; their rows stay where they are.  All others meet in one shuffle
    and stream past in order.
    """
    hot = F.broadcast(heavy_values(signed, "sig", support))
    cold = (signed.join(hot, "sig", "left_anti").repartition("sig").sortWithinPartitions("sig")
            .mapInPandas(_buckets, "sig long, doc_id long"))
    return signed.join(hot, "sig", "left_semi").unionByName(cold)


def _different(members: DataFrame) -> DataFrame:
    """(n, bucket): the rows of each bucket of (sig, doc_id) with two documents or more, one signature for equal buckets.

    Hashes of the documents are summed in two halves, which no number of rows
    overflows; documents that repeat do not cancel as in an exclusive or.
    """
    h = F.xxhash64("doc_id")
    return (members.groupBy("sig").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                       F.sum(F.shiftrightunsigned(h, 32)).alias("x"),
                                       F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("y")).where("lo < hi")
            .groupBy("n", "lo", "hi", "x", "y").agg(F.min("sig").alias("bucket")).select("n", "bucket"))


def _rounds(sizes: dict[int, int], copies: int = 2) -> list[tuple[int, int]]:
    """Ranges of distances between blocks, from ``blocks`` of a group -> rows of such groups.

    Blocks of a group stand in a ring, so each pair of them has one distance up
    to half the ring.  What the pairs of a range read is at most ``copies``
    times all rows, however many blocks a group has.
    """
    most, out, used = copies * sum(sizes.values()), [], 0
    for d in range(max(sizes, default=0) // 2 + 1):
        cost = sum(n * (1 if d == 0 or 2 * d == b else 2) for b, n in sizes.items() if 2 * d <= b)
        if out and used + cost <= most:
            out[-1], used = (out[-1][0], d + 1), used + cost
        else:
            out.append((d, d + 1))
            used = cost
    return out


def _in_blocks(rows: DataFrame, key: str, low: int, high: int) -> DataFrame:
    """Deals the members of every group (``key``, with column blocks) to the tasks of the pairs of its blocks at
    distances from ``low`` to below ``high``."""
    half = (F.col("blocks") / 2).cast("int")
    return (rows.where(half >= low).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("apart", F.explode(F.sequence(F.lit(low), F.least(F.lit(high - 1), half))))
            .withColumn("other", F.explode(F.array_distinct(F.array(F.expr("pmod(block + apart, blocks)"), F.expr("pmod(block - apart, blocks)")))))
            .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("blocks", "apart", "other")
            .repartition(key, "i", "j").sortWithinPartitions(key, "i", "j"))


def _dealt(rows: DataFrame, groups: DataFrame, key: str) -> list[DataFrame]:
    """``rows`` dealt to all pairs of blocks, in rounds to be stored one after the other; ``groups`` has (blocks, n) of each group."""
    sizes = {r["blocks"]: int(r["n"]) for r in groups.groupBy("blocks").agg(F.sum("n").alias("n")).collect()}
    return [_in_blocks(rows, key, low, high) for low, high in _rounds(sizes)]


def join_components(docs: DataFrame, rule: Rule | None = None, doc_col: str = "doc_id", text_col: str = "text",
                    support: float = 0.001, block_sets: int = 512, block_elements: int = 400_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_links.

    Equal sets collapse to one node, named by their smallest doc_id, so copies
    cost one narrow row each (heavy-hitter sets leave map-side).  Nodes that
    share a signature, and that their sizes and parity sketches allow to be
    linked, form clusters; a cluster's sets are compared exactly.  Buckets and
    clusters are dealt out in blocks of bounded size, and only a forest of
    their links leaves a task, so neither the pairs of a group nor the group
    itself ever meet in one place.
    ``n_links`` counts the other distinct sets that a row's set links with.

    Null, empty and wordless texts have no shingles, link with nothing and are
    components of their own.  Rows that share a doc_id belong to one component.
    A row with a null doc_id cannot name a class: its component_id is that of
    its equals if they have one, else null.  An empty table gives an empty
    result; other columns are ignored.
    """
    rule = rule or Rule()
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    keyed = stored(rows.mapInPandas(lambda it: _set_keys(it, rule), "doc_id long, n_shingles long, k1 long, k2 long, sketch binary"), "join-sets")
    named = keyed.where("n_shingles > 0")
    nodes = named.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))

    largest = named.agg(F.max("n_shingles")).first()[0] or 0
    edges = band_edges(int(largest))
    starts = F.array(*[F.lit(e) for e in edges[1:]])
    bands = {r["b"]: r["n"] for r in
             named.groupBy(F.size(F.filter(starts, lambda e: e <= F.col("n_shingles"))).alias("b"))
             .agg(F.countDistinct("k1", "k2").alias("n")).collect()}
    schemes = make_schemes(rule, bands, edges)
    heavy = heavy_values(named, "k1", support)
    hot = {(r["k1"], r["k2"]): r["node"] for r in
           named.join(F.broadcast(heavy), "k1", "left_semi").groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))
           .where("node IS NOT NULL").limit(int(2 / support)).collect()}

    members, only, seed, waiting, spent = None, None, 0, None, []
    texts = rows.where("doc_id IS NOT NULL")
    while True:
        signed = stored(texts.mapInPandas(
            lambda it, only=only, seed=seed: _signatures(it, rule, edges, schemes, only, seed, hot),
            "sig long, doc_id long"), "join-signatures")
        spent.append(signed)
        found = _shared(signed.where("sig >= 0"), support)
        members = found if members is None else members.unionByName(found)
        left = signed.where("sig < 0")
        waiting = stored(left if waiting is None else waiting.join(left, ["sig", "doc_id"], "left_semi"), "join-waiting")
        spent.append(waiting)
        only = {-1 - r["sig"] for r in waiting.select("sig").distinct().collect()}
        if not only:
            break
        seed += 1
        if seed > 99:
            raise RuntimeError("some sets found no cover under 100 seeds")

    # buckets with the same documents are one: each is kept under one signature
    members = stored(members, "join-members")
    del signed, found, left, waiting
    release(*spent)
    spent.clear()
    buckets = stored(_different(members).select("bucket", "n", F.ceil(F.col("n") / block_sets).cast("int").alias("blocks")), "join-buckets")
    by_doc = (named.where("doc_id IS NOT NULL").join(nodes, ["k1", "k2"])
              .select("doc_id", "node", "n_shingles", "sketch").dropDuplicates(["doc_id", "node"]))
    placed = members.join(buckets, members["sig"] == buckets["bucket"]).join(by_doc, "doc_id")
    near = [stored(dealt.mapInPandas(lambda it: _meet(it, rule), "a long, b long").distinct(), "join-near")
            for dealt in _dealt(placed.select("bucket", "blocks", "node", "n_shingles", "sketch"), buckets, "bucket")]
    del placed
    release(members, buckets)
    clusters = stored(connected_components(reduce(DataFrame.unionByName, near), "join-clusters")
                      .select(F.col("node"), F.col("component").alias("cluster")), "join-clusters")
    release(*near)

    def elements(batches):
        for b in batches:
            b = b.drop_duplicates()          # rows that repeat id and text
            sets = rule.shingles(b["body"].tolist())
            yield pd.DataFrame({"cluster": b["cluster"], "node": b["node"], "n": [len(s) for s in sets],
                                "elements": [s.tobytes() for s in sets]})

    # always by shuffle: the texts move once, whatever the number of members
    sets = stored(texts.join(clusters.hint("merge"), texts["doc_id"] == clusters["node"]).select("cluster", "node", "body")
                     .mapInPandas(elements, "cluster long, node long, n long, elements binary"), "join-elements")
    sized = sets.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / block_sets), F.ceil(F.sum("n") / block_elements)).cast("int").alias("blocks"), F.sum("n").alias("n"))
    forest = reduce(DataFrame.unionByName, [
        stored(dealt.mapInPandas(lambda it: _verify(it, rule), "node long, parent long, links long"), "join-forest")
        for dealt in _dealt(sets.drop("n").join(sized, "cluster").select("cluster", "blocks", "node", "elements"), sized, "cluster")])
    del sized
    release(sets)
    linked = connected_components(forest.select(F.col("node").alias("a"), F.col("parent").alias("b")), "join-linked")
    degree = forest.groupBy("node").agg(F.sum("links").alias("n_links"))

    all_nodes = nodes.join(linked, "node", "left").join(degree, "node", "left").select(
        "k1", "k2", F.coalesce("component", "node").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    placed = named.join(all_nodes, ["k1", "k2"]).select("doc_id", "n_shingles", "component_id", "n_links")
    alone = keyed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"),
                                                 F.lit(0).cast("long").alias("n_links"))
    return placed.unionByName(alone)


def keep_one_per_component(docs: DataFrame, rule: Rule | None = None, text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with one row of each component, the one with its smallest doc_id, same columns.

    Rows with a null doc_id are kept: they cannot be told apart by a class.
    Rows that share the surviving doc_id are all kept.
    """
    found = stored(join_components(docs, rule, "doc_id", text_col, **limits), "join-result")
    dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias("x")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["x"], "left_anti").select(*docs.columns)
