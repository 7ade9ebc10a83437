"""Byte-exact removal of repeated substrings with two-stage suffix sorting.

A window is a string of ``length`` bytes.  Its *anchor* is the smallest hash
among its grams of ``gram`` bytes, so equal windows have equal anchors at equal
offsets, wherever they stand.  The windows of one anchor form a *context*, a
little over ``length`` bytes.  Only contexts whose anchor occurs elsewhere can
repeat; these meet by anchor, and a suffix array over the contexts of each
batch of anchors tells which windows have a twin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.common import mix64, stored

LENGTH, GRAM = 200, 32
SLAB = 1 << 23
_POS = np.uint64((1 << 24) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` bytes (a power of two), by doubling."""
    h, base, step = _BYTES[b], _BASE, 1
    while step < gram:
        h = h[:-step] * base + h[step:]
        base = base * base
        step *= 2
    return mix64(h)


def anchors(b: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(anchor position, first window, windows, anchor hash) arrays; every window belongs to exactly one anchor.

    Ties go to the leftmost gram.  Texts are cut into slabs that overlap by a
    window, so memory stays bounded for a text of any length.
    """
    at, first, count, hashes = [], [], [], []
    with np.errstate(over="ignore"):
        for lo in range(0, max(0, len(b) - length + 1), SLAB):
            part = b[lo:lo + SLAB + length - 1]
            g = _gram_hashes(part, gram)
            m = (g & ~_POS) | np.arange(len(g), dtype=np.uint64)
            width, step = length - gram + 1, 1
            while step * 2 <= width:
                m = np.minimum(m[:-step], m[step:])
                step *= 2
            rest = width - step
            m = np.minimum(m[:len(m) - rest], m[rest:]) if rest else m
            a = (m & _POS).astype(np.int64)
            start = np.concatenate([[0], np.flatnonzero(np.diff(a)) + 1])
            at.append(a[start] + lo)
            first.append(start + lo)
            count.append(np.diff(np.append(start, len(a))))
            hashes.append(g[a[start]])
    if not at:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    return tuple(np.concatenate(x) for x in (at, first, count, hashes))


def _anchor_rows(batches: Iterator[pd.DataFrame], length: int, gram: int) -> Iterator[pd.DataFrame]:
    """(anchor, context, sid, first, windows, offset) of every anchor of every text."""
    for b in batches:
        out = []
        for sid, body in zip(b["sid"], b["body"]):
            at, first, count, hashes = anchors(np.frombuffer(body, np.uint8), length, gram)
            ends = first + count + length - 1
            ctx = np.fromiter((xxhash.xxh3_64_intdigest(body[i:j]) for i, j in zip(first.tolist(), ends.tolist())), np.uint64, len(first))
            out.append((hashes.view(np.int64), ctx.view(np.int64), np.full(len(first), sid), first, count, at - first))
        cols = ("anchor", "context", "sid", "first", "windows", "offset")
        yield pd.DataFrame({c: np.concatenate([o[i] for o in out]) if out else [] for i, c in enumerate(cols)})


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as a big-endian number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i:i + len(data)]
    return out


def _direct_sort(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``at`` in the order of their first ``depth`` bytes, eight at a time and only while tied."""
    def word(p):
        return np.where(p < len(words), words[np.minimum(p, len(words) - 1)], np.uint64(0))

    key = word(at)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    for skip in range(8, depth, 8):
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(at)))
        tied = np.flatnonzero(np.repeat(size > 1, size))
        if not len(tied):
            break
        group = np.cumsum(new)[tied]
        key = word(at[tied] + skip)
        if depth - skip < 8:
            key = key >> np.uint64(8 * (8 - (depth - skip)))
        order = np.lexsort((key, group))
        at[tied] = at[tied][order]
        key = key[order]
        new[tied[1:]] |= (key[1:] != key[:-1]) & (group[1:] == group[:-1])
    return at


def suffix_order(data: np.ndarray, wanted: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The suffixes of ``data`` marked in ``wanted`` and those their order hangs on, sorted by their first ``depth`` bytes.

    Two stages.  A suffix smaller than its successor (type B) is sorted
    directly.  One larger than its successor (type A) follows from it: a scan
    of the buckets in order of their first byte appends to the front part of
    bucket c, for each sorted suffix in turn, its predecessor if that is of
    type A and begins with c.  Suffixes are taken to end with a sentinel
    smaller than any byte; ties beyond ``depth`` bytes are in no defined order.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    rise = np.concatenate([np.sign(np.diff(data.astype(np.int16))), [-1]]).astype(np.int8)
    known = np.flatnonzero(rise)                     # equal neighbours take the type of what follows them
    larger = rise[known[np.searchsorted(known, np.arange(n))]] < 0
    # the successors of a wanted type A suffix, up to the next type B one, decide its place
    b_at = np.flatnonzero(~larger)
    need = wanted.copy()
    last = np.flatnonzero(wanted & larger)
    if len(last):
        k = np.searchsorted(b_at, last)
        upto = np.where(k < len(b_at), b_at[np.minimum(k, max(0, len(b_at) - 1))] if len(b_at) else n - 1, n - 1)
        mark = np.zeros(n + 1, np.int64)
        np.add.at(mark, last, 1)
        np.add.at(mark, upto + 1, -1)
        need |= np.cumsum(mark[:-1]) > 0
    direct = _direct_sort(np.flatnonzero(need & ~larger), _words(data), depth)
    cut = np.searchsorted(data[direct], np.arange(257))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced = need & larger
    if induced[n - 1]:
        pending[data[n - 1]].append(np.array([n - 1]))      # the successor of the last suffix is the sentinel

    def hand_on(done, stop=None):
        """Predecessors of type A go to their buckets in order; those of bucket ``stop`` are returned."""
        p = done[done > 0] - 1
        p = p[induced[p]]
        first = data[p]
        if stop is not None:
            again = p[first == stop]
            p, first = p[first != stop], first[first != stop]
        order = np.argsort(first, kind="stable")
        p, first = p[order], first[order]
        ends = np.searchsorted(first, np.arange(257))
        for c in np.unique(first).tolist():
            pending[c].append(p[ends[c]:ends[c + 1]])
        return again if stop is not None else None

    out = []
    for c in range(256):
        front = np.concatenate(pending[c]) if pending[c] else np.empty(0, np.int64)
        while len(front):
            out.append(front)
            front = hand_on(front, c)
        back = direct[cut[c]:cut[c + 1]]
        if len(back):
            out.append(back)
            hand_on(back)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Length of the common prefix of each suffix in ``order`` with the next, up to ``depth`` bytes."""
    out = np.zeros(max(0, len(order) - 1), np.int64)
    alive = np.arange(len(out))
    padded = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    words = _words(padded)
    for skip in range(0, depth, 8):
        a, b = words[order[alive] + skip], words[order[alive + 1] + skip]
        diff = a ^ b
        same = diff == 0
        gone = alive[~same]
        lead = np.array([(64 - int(x).bit_length()) // 8 for x in diff[~same].tolist()], np.int64)
        out[gone] = np.minimum(skip + lead, depth)
        alive = alive[same]
    out[alive] = depth
    return np.minimum(out, len(data) - np.maximum(order[:-1], order[1:])) if len(out) else out


def repeated_windows(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For every context a mask of its windows: True where the same string starts anywhere else in ``contexts``."""
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    windows = np.maximum(sizes - length + 1, 0)
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + windows, -1)
    wanted = np.cumsum(edge[:-1]) > 0
    order = suffix_order(data, wanted, length)
    order = order[wanted[order]]
    twin = np.zeros(len(data), bool)
    equal = np.flatnonzero(common_prefixes(data, order, length) >= length)
    twin[order[equal]] = twin[order[equal + 1]] = True
    return [twin[s:s + w] for s, w in zip(starts.tolist(), windows.tolist())]


def _ranges(mask: np.ndarray) -> list[int]:
    """first, past-the-end, first, ... of the runs of True."""
    return np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))).tolist()


def _mark(batches: Iterator[pd.DataFrame], length: int, batch_bytes: int) -> Iterator[pd.DataFrame]:
    """(anchor, context, marks): repeated windows as ranges, for contexts sorted by key; keys are never split."""
    held: list[tuple] = []
    size, key, last = 0, None, None

    def close():
        found = repeated_windows([h[3] for h in held], length)
        keep = [(h[0], h[1], [x + h[2] for x in _ranges(m)]) for h, m in zip(held, found) if m.any()]
        return pd.DataFrame(keep, columns=["anchor", "context", "marks"])

    for b in batches:
        for k, anchor, context, off, ctx in zip(b["key"], b["anchor"], b["context"], b["off"], b["bytes"]):
            if k != key and size >= batch_bytes:
                yield close()
                held, size = [], 0
            key = k
            if (k, anchor, context, off) == last:        # a context fetched from rows that repeat
                continue
            last = (k, anchor, context, off)
            held.append((anchor, context, off, ctx))
            size += len(ctx)
    if held:
        yield close()


def _refine(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """Splits contexts of crowded keys in two, by how far windows reach left of the anchor; the new key holds the
    bytes that all windows of the half have in common, so equal windows stay together."""
    for b in batches:
        rows = []
        for r in b.itertuples(index=False):
            mid = (r.low + r.high) // 2
            for low, high in ((r.low, mid), (mid, r.high)):
                # windows p of this context with low <= offset - p < high, both in context coordinates
                first, past = max(0, r.offset - high + 1), min(len(r.bytes) - length + 1, r.offset - low + 1)
                if first >= past:
                    continue
                shared = r.bytes[r.offset - low:r.offset - high + 1 + length]
                key = xxhash.xxh3_64_intdigest(shared, seed=low * 1024 + high) ^ (r.key & (2**64 - 1))
                rows.append((key - 2**64 if key >= 2**63 else key, r.anchor, r.context, r.off + first, r.offset - first, low, high,
                             r.bytes[first:past + length - 1]))
        yield pd.DataFrame(rows, columns=["key", "anchor", "context", "off", "offset", "low", "high", "bytes"])


def _cut(batches: Iterator[pd.DataFrame], length: int, gram: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(q["anchor"], q["anchor"], q["context"], 0, q["offset"], 0, length - gram + 1,
                 body[q["first"]:q["first"] + q["windows"] + length - 1])
                for body, asked in zip(b["body"], b["asked"]) for q in asked]
        yield pd.DataFrame(rows, columns=["key", "anchor", "context", "off", "offset", "low", "high", "bytes"])


def _strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes that stay of each text, given the byte ranges that repeated windows cover."""
    for b in batches:
        rows = []
        for body, covered, copy in zip(b["body"], b["covered"], b["copy"]):
            gone = np.zeros(len(body), bool)
            if copy is True:
                gone[:] = True
            elif covered is not None:
                cover = np.zeros(len(body) + 1, np.int32)
                pairs = np.concatenate(list(covered)).astype(np.int64).reshape(-1, 2)
                np.add.at(cover, pairs[:, 0], 1)
                np.add.at(cover, pairs[:, 1], -1)
                gone = np.cumsum(cover[:-1]) > 0
            kept = body if not gone.any() else np.frombuffer(body, np.uint8)[~gone].tobytes()
            rows.append((len(body), int(gone.sum()), _ranges(gone), kept))
        out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "spans", "kept"])
        out.insert(0, "doc_id", b["doc_id"].to_numpy())
        yield out


def remove_repeats(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, batch_bytes: int = 2_000_000, crowded: int = 8_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, spans, kept (binary: the bytes that stay).

    A byte goes when a string of ``length`` bytes that covers it starts
    anywhere else in the table, the same text included; ``spans`` are the
    removed runs as start, end, start, end, ...; everything is judged on the
    input.  Matches never cross documents.

    Anchors are counted with map-side combine; contexts that occur twice, byte
    for byte, are settled by that count, and what remains is compared in
    suffix arrays of about ``batch_bytes``.  A key with over ``crowded``
    different contexts (the edges of a passage that very many documents share)
    is split by longer and longer common bytes, down to single windows, so no
    group has to fit a task.

    Null text counts as empty; texts under ``length`` bytes lose nothing; equal
    texts of ``length`` bytes or more lose everything.  Rows are keyed by a hash
    and the length of their text, so null and repeated ids do no harm.  An empty table
    gives an empty result; other columns are ignored.
    """
    if gram & (gram - 1) or not 0 < gram <= length:
        raise ValueError("gram must be a power of two and at most length")
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_col).alias("doc_id"), body.alias("body"), F.xxhash64(body).alias("sid"))
    long = rows.where(F.octet_length("body") >= length)
    found = stored(long.select("sid", "body").mapInPandas(
        lambda it: _anchor_rows(it, length, gram),
        "anchor long, context long, sid long, first int, windows smallint, offset smallint"), "suffix-anchors")
    again = (found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi"))
             .where("n > 1").select("anchor", (F.col("lo") < F.col("hi")).alias("varied")))
    shared = stored(found.join(again, "anchor"), "suffix-shared")

    kinds = (shared.where("varied").groupBy("anchor", "context")
             .agg(F.count("*").alias("n"), F.min(F.struct("sid", "first", "windows", "offset")).alias("q")))
    kinds = stored(kinds, "suffix-kinds")
    names = long.groupBy("sid").agg(F.min("doc_id").alias("id"))
    asked = (kinds.groupBy("q.sid").agg(F.collect_list(F.struct(
        "anchor", "context", F.col("q.first").alias("first"), F.col("q.windows").alias("windows"),
        F.col("q.offset").alias("offset"))).alias("asked")).join(names, "sid")
        .select(F.col("sid").alias("s"), "id", "asked"))
    shape = "key long, anchor long, context long, off int, offset int, low int, high int, bytes binary"
    level = stored(long.join(asked, (F.col("sid") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("id")))
                   .select("body", "asked").mapInPandas(lambda it: _cut(it, length, gram), shape), "suffix-contexts")
    marks = None
    while True:
        full = stored(level.groupBy("key").agg(F.count("*").alias("n"), F.max(F.col("high") - F.col("low")).alias("width"))
                      .where(F.col("n") > crowded).select(F.col("key").alias("k"), "width"), "suffix-crowded")
        some = not full.isEmpty()
        calm = level.join(full, level["key"] == full["k"], "left_anti") if some else level
        part = (calm.repartition("key").sortWithinPartitions("key", "anchor", "context", "off")
                .mapInPandas(lambda it: _mark(it, length, batch_bytes), "anchor long, context long, marks array<int>"))
        if some:
            # of single windows every one with a crowded key is repeated
            single = (level.join(full.where("width = 1"), level["key"] == full["k"], "left_semi")
                      .select("anchor", "context", F.array("off", F.col("off") + 1).alias("marks")))
            part = part.unionByName(single)
        part = stored(part, "suffix-marks")
        marks = part if marks is None else marks.unionByName(part)
        wide = full.where("width > 1")
        if not some or wide.isEmpty():
            break
        level = stored(level.join(wide, level["key"] == wide["k"], "left_semi")
                       .mapInPandas(lambda it: _refine(it, length), shape), "suffix-contexts")

    # byte ranges: whole contexts that occur twice, and the marked windows of the others
    whole = F.array(F.col("first"), F.col("first") + F.col("windows") - 1 + length)
    plain = shared.where("NOT varied").select("sid", whole.alias("c"))
    some = (kinds.where("n > 1").select("anchor", "context", F.lit(None).cast("array<int>").alias("marks"))
            .unionByName(kinds.where("n = 1").select("anchor", "context").join(marks, ["anchor", "context"])))
    ends = F.transform("marks", lambda x, i: F.col("first") + x + F.when(i % 2 == 1, length - 1).otherwise(0))
    varied = (shared.where("varied").join(some, ["anchor", "context"])
              .select("sid", F.when(F.col("marks").isNull(), whole).otherwise(ends).alias("c")))
    copies = (rows.where(F.octet_length("body") >= length).groupBy("sid").agg(F.count("*").alias("n"))
              .where("n > 1").select("sid", F.lit(True).alias("copy")))
    covered = (plain.unionByName(varied).join(copies, "sid", "left_anti")      # equal texts go whole
               .groupBy("sid").agg(F.collect_list("c").alias("covered")))
    known = (covered.select(F.col("sid").alias("s"), "covered", F.lit(False).alias("copy"))
             .unionByName(copies.select(F.col("sid").alias("s"), F.lit(None).cast("array<array<int>>").alias("covered"), "copy")))
    shape = (rows.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long")
             .add("spans", T.ArrayType(T.IntegerType())).add("kept", "binary"))
    return (rows.join(known, F.col("sid") == F.col("s"), "left").select("doc_id", "body", "covered", "copy")
            .mapInPandas(_strip, shape))


def digests(stripped: DataFrame) -> DataFrame:
    """Counts and the digest of the remaining bytes, from ``remove_repeats``."""
    return stripped.select("doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"),
                           F.sha2("kept", 256).alias("kept_sha256"))
