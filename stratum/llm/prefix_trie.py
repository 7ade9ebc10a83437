"""Conversation prefix trie: double arrays per shard, shared upper nodes merged globally."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import heavy_join, mix64, ranked, stored

#: Turns of a conversation that one row holds, and turns that one double array is packed from.
SEGMENT, SHARD = 256, 1 << 18
#: A turn as packed bytes: digest of role and text, code points of the text.
TURN = np.dtype([("d1", ">u8"), ("d2", ">u8"), ("chars", ">i8")])
KEY = ["depth", "h1", "h2"]
FREE, ROOT = -1, -2


def turn_key(role: Column, text: Column) -> Column:
    """A turn's 24 bytes; null role or text counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return F.unhex(F.concat(digest, F.lpad(F.hex(F.length(text).cast("long")), 16, "0")))


def _packed(turns: Column) -> Column:
    """Sorted (place, key) structs as one binary."""
    return F.unhex(F.array_join(F.transform(turns, lambda t: F.hex(t["key"])), ""))


def sequences(turns: DataFrame, head: Column, lender: Column, most: int, segment: int = SEGMENT) -> DataFrame:
    """Rebuilt conversations in rows of bounded size: conv_id, seg, start, last, keys.

    A conversation's first ``head`` turns (0 to ``most``) are replaced by those of
    conversation ``lender``; both are expressions over ``conv_id``.  A lender
    lends at most ``most`` turns as one narrow row.  ``keys`` packs the turns
    from depth ``start`` on; a long conversation has several rows.  Turns are
    numbered by a range sort, so one conversation may hold most of the table.
    """
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                                                     turn_key(F.col("role"), F.col("text")).alias("key"))
    placed = ranked(stored(rows, "trie-turns"), ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("key")], "trie-placed", "j")
    placed = placed.withColumn("head", head.cast("long"))
    convs = placed.where("j = 0").select("conv_id", "head", lender.cast("long").alias("lender"), "n")
    lent = (placed.where(F.col("j") < most).join(convs.select(F.col("lender").alias("conv_id")).distinct(), "conv_id", "left_semi")
            .groupBy(F.col("conv_id").alias("lender")).agg(F.sort_array(F.collect_list(F.struct("j", "key"))).alias("first")))
    convs = convs.join(lent, "lender", "left")
    front = F.coalesce(_packed(F.slice("first", F.lit(1), F.col("head").cast("int"))), F.lit(b""))
    convs = convs.select(F.struct("conv_id").alias("c"), front.alias("front"),
                         F.greatest(F.ceil((F.col("n") - F.col("head")) / segment) - 1, F.lit(0)).alias("end"))
    own = (placed.where("j >= head").groupBy("conv_id", F.floor((F.col("j") - F.col("head")) / segment).alias("seg"))
           .agg(_packed(F.sort_array(F.collect_list(F.struct("j", "key")))).alias("keys")))
    both = convs.join(own, F.col("c.conv_id") == F.col("conv_id"), "left")
    seg, keys = F.coalesce("seg", F.lit(0)), F.coalesce("keys", F.lit(b""))
    start = F.when(seg > 0, F.length("front") / TURN.itemsize + seg * segment).otherwise(0).cast("long")
    return both.select(F.col("c.conv_id").alias("conv_id"), seg.alias("seg"), start.alias("start"), (seg == F.col("end")).alias("last"),
                       F.when(seg == 0, F.concat("front", keys)).otherwise(keys).alias("keys"), (F.col("end") > 0).alias("long"))


def step_hashes(turns: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each turn at its depth; a prefix's hash is their exclusive or."""
    with np.errstate(over="ignore"):
        salt = mix64((depth.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        return (mix64(turns["d1"].astype(np.uint64) + salt), mix64(turns["d2"].astype(np.uint64) ^ mix64(salt)))


def _segment_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        sums = []
        for start, keys in zip(b["start"], b["keys"]):
            t = np.frombuffer(keys, TURN)
            sums.append([int(np.bitwise_xor.reduce(x).view(np.int64)) for x in step_hashes(t, start + np.arange(len(t)))])
        yield b[["conv_id", "seg"]].assign(x1=[s[0] for s in sums], x2=[s[1] for s in sums])


def with_start_hashes(rows: DataFrame) -> DataFrame:
    """``sequences`` with g1, g2: the hash of the prefix that comes before each row."""
    short = rows.where("NOT long").withColumns({"g1": F.lit(0).cast("long"), "g2": F.lit(0).cast("long")})
    long = rows.where("long")
    w = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)   # one narrow row per segment
    sums = (long.select("conv_id", "seg", "start", "keys").mapInPandas(_segment_hashes, "conv_id long, seg long, x1 long, x2 long")
            .select("conv_id", "seg", *[F.coalesce(F.expr(f"bit_xor(x{i})").over(w), F.lit(0)).alias(f"g{i}") for i in (1, 2)]))
    return short.unionByName(long.join(sums, ["conv_id", "seg"])).drop("seg", "long")


class DoubleArray:
    """A trie in two arrays: the child of state s by code c is slot BASE[s] + c, if CHECK of that slot is s."""

    def __init__(self, size: int):
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, FREE, np.int64)
        self.low = 0                                   # no slot before it is free
        self.end = 0                                   # no slot from it on is taken

    def _reserve(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, FREE, np.int64)])

    def _free(self, m: int) -> np.ndarray:
        """The first ``m`` free slots."""
        self._reserve(self.end + m)
        holes = self.low + np.flatnonzero(self.check[self.low:self.end] == FREE)
        return np.concatenate([holes[:m], self.end + np.arange(max(0, m - len(holes)))])

    def _take(self, slots: np.ndarray, owner) -> None:
        self.check[slots] = owner
        self.end = max(self.end, int(slots.max()) + 1)
        holes = np.flatnonzero(self.check[self.low:self.end] == FREE)
        self.low = self.low + int(holes[0]) if len(holes) else self.end

    def roots(self, m: int) -> np.ndarray:
        slots = self._free(m)
        self._take(slots, ROOT)
        return slots

    def single_children(self, states: np.ndarray, codes: np.ndarray) -> None:
        """Packs states that have one child each into the first free slots."""
        slots = self._free(len(states))
        self.base[states] = slots - codes
        self._take(slots, states)

    def children(self, state: int, codes: np.ndarray, tries: int = 4096) -> None:
        """First fit for a state's ascending codes; after ``tries`` holes they go behind everything."""
        span = codes - codes[0]
        self._reserve(self.end + int(span[-1]) + 1)
        holes = self.low + np.flatnonzero(self.check[self.low:self.end] == FREE)[:tries]
        width = max(1, (1 << 18) // len(codes))
        place = self.end
        for i in range(0, len(holes), width):
            some = holes[i:i + width]
            fits = (self.check[some[:, None] + span[None, :]] == FREE).all(axis=1)
            if fits.any():
                place = int(some[np.argmax(fits)])
                break
        self.base[state] = place - codes[0]
        self._take(place + span, state)

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states reached by ``codes``, -1 where there is no such child."""
        to = self.base[states] + codes
        inside = (to >= 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == states), to, -1)


def dense_ids(turns: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Consecutive ids of distinct turns, numbered as they first appear in ``order``, so that new siblings lie side by side."""
    pair = np.empty(len(turns), np.dtype([("a", np.uint64), ("b", np.uint64)]))
    pair["a"], pair["b"] = turns["d1"], turns["d2"]
    _, first, inverse = np.unique(pair[order], return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    ids = np.empty(len(turns), np.int64)
    ids[order] = rank[inverse]
    return ids


def shard_nodes(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one shard's trie with what its rows say about them (columns of NODES)."""
    rows = rows.assign(size=[len(k) // TURN.itemsize for k in rows["keys"]])
    rows = rows.sort_values("size", ascending=False, kind="stable")         # rows still active at a depth come first
    size, conv, start = (rows[c].to_numpy(np.int64) for c in ("size", "conv_id", "start"))
    turns = np.frombuffer(b"".join(rows["keys"]), TURN)
    offset = np.concatenate([[0], np.cumsum(size)])[:-1]
    row = np.repeat(np.arange(len(rows)), size)
    local = np.arange(len(turns)) - offset[row]
    codes = dense_ids(turns, np.lexsort((row, local)))
    g = rows[["g1", "g2"]].to_numpy(np.int64).view(np.uint64)
    hashes = []
    for j, x in enumerate(step_hashes(turns, start[row] + local)):
        if len(turns):
            run = np.bitwise_xor.accumulate(x)
            before = np.where(offset > 0, run[offset - 1], np.uint64(0))
            x = run ^ before[row] ^ g[row, j]
        hashes.append(x)
    active = [int(np.searchsorted(-size, -k, side="left")) for k in range(int(size.max(initial=0)) + 1)]   # rows longer than k

    # pack: depth by depth the children of every state
    origin = pd.MultiIndex.from_arrays([start, g[:, 0], g[:, 1]]).factorize()[0]
    trie = DoubleArray(2 * (len(turns) + len(rows)) + 16)
    root_slots = trie.roots(int(origin.max()) + 1)
    width = int(codes.max(initial=0)) + 1
    state = root_slots[origin]
    for k, m in enumerate(active[:-1]):
        at = codes[offset[:m] + k]
        s, c = np.divmod(np.unique(state[:m] * width + at), width)
        first = np.flatnonzero(np.diff(s, prepend=-1))
        count = np.diff(first, append=len(s))
        for i in np.flatnonzero(count > 1):
            trie.children(int(s[first[i]]), c[first[i]:first[i] + count[i]])
        one = first[count == 1]
        if len(one):
            trie.single_children(s[one], c[one])
        state[:m] = trie.step(state[:m], at)

    # traverse: every row walks down and leaves its marks
    slots = len(trie.check)
    n, low = np.zeros(slots, np.int64), np.full(slots, np.iinfo(np.int64).max)
    parent, depth, chars = np.full(slots, -1), np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    h = np.zeros((2, slots), np.uint64)
    state, levels = root_slots[origin], [np.unique(root_slots)]
    depth[state], h[0, state], h[1, state] = start, g[:, 0], g[:, 1]
    whole = start == 0                                   # members of a later segment's first node are counted where it ends
    np.add.at(n, state[whole], 1)
    np.minimum.at(low, state[whole], conv[whole])
    for k, m in enumerate(active[:-1]):
        at = offset[:m] + k
        to = trie.step(state[:m], codes[at])
        parent[to], depth[to], chars[to] = state[:m], start[:m] + k + 1, turns["chars"][at]
        h[0, to], h[1, to] = hashes[0][at], hashes[1][at]
        np.add.at(n, to, 1)
        np.minimum.at(low, to, conv[:m])
        state[:m] = to
        levels.append(np.unique(to))

    # sum up: deepest nodes first
    last = rows["last"].to_numpy(bool)
    opened = np.zeros(slots, bool)
    opened[state[~last]] = True
    opened[root_slots[origin[start > 0]]] = True
    inner = np.zeros(slots, bool)
    inner[parent[parent >= 0]] = True
    leaves, saved = (~inner).astype(np.int64), (n - 1) * chars
    for nodes in reversed(levels[1:]):
        np.add.at(leaves, parent[nodes], leaves[nodes])
        np.add.at(saved, parent[nodes], saved[nodes])
        opened[parent[nodes[opened[nodes]]]] = True

    nodes = np.concatenate(levels)
    up, known = parent[nodes], parent[nodes] >= 0
    signed = h.view(np.int64)
    out = pd.DataFrame({"depth": depth[nodes], "h1": signed[0, nodes], "h2": signed[1, nodes],
                        "p1": pd.array(np.where(known, signed[0, up], 0), "Int64"), "p2": pd.array(np.where(known, signed[1, up], 0), "Int64"),
                        "conv_id": pd.array(low[nodes], "Int64"), "n_convs": n[nodes], "chars": chars[nodes], "open": opened[nodes],
                        "n_leaves": leaves[nodes], "saved": saved[nodes]}, index=nodes)
    out.loc[~known, ["p1", "p2"]] = pd.NA
    out.loc[n[nodes] == 0, "conv_id"] = pd.NA
    ended = pd.Series(conv[last], index=state[last]).sort_values(kind="stable")
    ended = {s: x.to_numpy(np.int64) for s, x in ended.groupby(level=0)}
    out["ends"] = [ended[s].tobytes() if s in ended else None for s in nodes]
    out["ends_sha256"] = [hashlib.sha256(listed(ended[s])).hexdigest() if s in ended else None for s in nodes]
    return out


NODES = ("depth long, h1 long, h2 long, p1 long, p2 long, conv_id long, n_convs long, chars long, open boolean, n_leaves long, "
         "saved long, ends binary, ends_sha256 string")


def listed(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def shards(rows: DataFrame, shard: int = SHARD) -> DataFrame:
    """The nodes of every shard: rows sorted by their first turns, cut after each ``shard`` turns (see NODES)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            weight = 1 + b["keys"].map(len).to_numpy() // TURN.itemsize
            for cut in np.split(np.arange(len(b)), np.flatnonzero(np.diff((size + np.cumsum(weight)) // shard)) + 1):
                part = b.iloc[cut]
                if held and size + weight[cut].sum() > shard:
                    yield shard_nodes(pd.concat(held))
                    held, size = [], 0
                held.append(part)
                size += int(weight[cut].sum())
        if held:
            yield shard_nodes(pd.concat(held))

    order = ["start", "g1", "g2", F.substring("keys", 1, 4 * TURN.itemsize), "conv_id"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(run, NODES)


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for k, ends in zip(b[KEY].itertuples(index=False), b["ends"]):
            yield pd.DataFrame({**k._asdict(), "id": np.frombuffer(ends, np.int64)})


def _texts(batches: Iterator[pd.DataFrame], size: int = 50_000) -> Iterator[pd.DataFrame]:
    """Rows sorted by node and id -> the listed ids in pieces, numbered in the global order."""
    seq = TaskContext.get().partitionId() << 32
    for b in batches:
        new = (b[KEY] != b[KEY].shift()).any(axis=1).to_numpy() | (np.arange(len(b)) % size == 0)
        rows = []
        for at in np.split(np.arange(len(b)), np.flatnonzero(new)[1:]):
            if len(at):
                rows.append((*b[KEY].iloc[at[0]], seq, listed(b["id"].to_numpy()[at])))
                seq += 1
        yield pd.DataFrame(rows, columns=[*KEY, "seq", "piece"])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces sorted by node and number -> one digest a node, with one hash state held at a time."""
    key, state = None, None
    for b in batches:
        done = []
        for *k, piece in b[[*KEY, "piece"]].itertuples(index=False):
            if k != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = k, hashlib.sha256(piece)
            else:
                state.update(b"," + piece)
        yield pd.DataFrame(done, columns=[*KEY, "sha"])
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=[*KEY, "sha"])


def spread_ends(parts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, sha): the digest of ids of nodes at which conversations of several shards end.

    Ids are range-sorted and written out in pieces over all tasks.  SHA-256
    itself runs through a list from its first to its last byte, so the pieces of
    one node pass through one task, which holds a single piece and the hash state.
    """
    many = nodes.where("ends_parts > 1").select(*KEY)
    ids = (parts.where("ends IS NOT NULL").join(many, KEY, "left_semi").select(*KEY, "ends")
           .mapInPandas(_unpacked, "depth long, h1 long, h2 long, id long"))
    ids = stored(ids, "trie-ends")
    pieces = (ids.repartitionByRange(*KEY, "id").sortWithinPartitions(*KEY, "id")
              .mapInPandas(_texts, "depth long, h1 long, h2 long, seq long, piece binary"))
    return (stored(pieces, "trie-pieces").repartition(*KEY).sortWithinPartitions(*KEY, "seq")
            .mapInPandas(_digests, "depth long, h1 long, h2 long, sha string"))


def subtree_sums(rows: DataFrame, values: list[str]) -> DataFrame:
    """``rows`` (KEY, a1, a2: the parent's hashes, null at the root) with ``values`` summed over subtrees, by pointer doubling.

    After k rounds a row holds the sum over descendants closer than 2^k and
    points 2^k levels up, so the rounds are the logarithm of the depth.
    """
    far = rows.withColumn("up", F.when(F.col("a1").isNotNull(), F.col("depth") - 1))
    up = ["up", "a1", "a2"]
    while True:
        far = stored(far, "trie-sums")
        moving = far.where("up IS NOT NULL")
        sums = stored(moving.groupBy(*up).agg(F.count("*").alias("c"), *[F.sum(v).alias(f"s_{v}") for v in values]), "trie-lifted")
        if sums.isEmpty():
            return far.select(*KEY, *values)
        lifted = sums.select(F.col("up").alias("depth"), F.col("a1").alias("h1"), F.col("a2").alias("h2"), *[f"s_{v}" for v in values])
        added = far.join(lifted, KEY, "left").select(*KEY, *up, *[(F.col(v) + F.coalesce(f"s_{v}", F.lit(0))).alias(v) for v in values])
        to = far.select(F.col("depth").alias("up"), F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.struct(*up).alias("next"))
        moved = heavy_join(added.where("up IS NOT NULL"), to, up, sums.select(*up, "c"))
        far = (added.where("up IS NULL").unionByName(
            moved.select(*KEY, *[F.col(f"next.{c}").alias(c) for c in up], *values)))


def trie(rows: DataFrame, shard: int = SHARD) -> DataFrame:
    """The global prefix trie of ``with_start_hashes`` rows: one row per node.

    Each shard packs its own double array.  A node that only one shard has is
    done there, with its whole subtree.  Nodes that several shards have, or below
    which a conversation goes on in another shard, form the upper tree: their
    counts are merged, and what hangs below them is summed by pointer doubling
    over that small tree alone.
    """
    parts = stored(shards(rows, shard), "trie-shards")
    nodes = parts.groupBy(*KEY).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.max("chars").alias("chars"), (F.max("open") | (F.count("*") > 1)).alias("shared"), F.max("n_leaves").alias("n_leaves"),
        F.max("saved").alias("saved"), F.count("ends_sha256").alias("ends_parts"), F.max("ends_sha256").alias("ends_sha256"))
    nodes = stored(nodes, "trie-nodes")
    below = F.when(~F.col("shared"), F.col("n_leaves")), F.when(~F.col("shared"), F.col("saved"))
    kids = (nodes.where("p1 IS NOT NULL").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2"))
            .agg(F.count("*").alias("n_children"), *[F.coalesce(F.sum(x), F.lit(0)).alias(n) for x, n in zip(below, ("l", "s"))]))
    nodes = nodes.join(kids, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes, "trie-counted")
    own = (F.col("n_convs") - 1) * F.col("chars")
    upper = nodes.where("shared").select(*KEY, F.col("p1").alias("a1"), F.col("p2").alias("a2"),
                                         (F.coalesce("l", F.lit(0)) + (F.col("n_children") == 0).cast("long")).alias("leaves_up"),
                                         (F.coalesce("s", F.lit(0)) + own).alias("saved_up"))
    sums = stored(subtree_sums(upper, ["leaves_up", "saved_up"]), "trie-upper")
    to = nodes.select(F.col("depth").alias("up"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    counts = nodes.where("n_children > 0").select(F.col("depth").alias("up"), F.col("h1").alias("p1"), F.col("h2").alias("p2"),
                                                   F.col("n_children").alias("c"))
    nodes = heavy_join(nodes.withColumn("up", F.col("depth") - 1), to, ["up", "p1", "p2"], counts)
    done = nodes.join(sums, KEY, "left").join(spread_ends(parts, nodes), KEY, "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return done.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("leaves_up", "n_leaves").alias("n_leaves"),
                       F.coalesce("saved_up", "saved").alias("saved_tokens"), F.coalesce("sha", "ends_sha256", empty).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, group: int = 100, most: int = 5, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """One node per distinct prefix of the rebuilt conversations (conv_id, turn, role, text).

    Conversation c takes its first h = crc32(c) % (most + 1) turns from
    conversation c - c % ``group`` and keeps its own after its first h.  Turns
    order by turn (null first), ties by a digest of role and text.  Null role or
    text is empty.  Rows with a null conv_id belong to no conversation and
    are left out; repeated rows are turns like any other; an empty table gives an
    empty result, not even a root; other columns are ignored.

    Result: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.  Turns and prefixes are
    compared by 128-bit digests.
    """
    c = F.col("conv_id")
    rows = sequences(turns, F.crc32(c.cast("string").cast("binary")) % (most + 1), c - c % group, most, segment)
    return trie(stored(with_start_hashes(stored(rows, "trie-rows")), "trie-sequences"), shard)
