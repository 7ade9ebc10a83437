"""Benchmark decontamination with spaced seeds."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import WordHashes, fresh, mix64, stored

TOKENS = re.compile(r"\w+")
#: Scripts written without spaces between words (Thai to Khmer, Tai, Balinese, Javanese, kana, Chinese characters): each character is a token.
UNSPACED = ("\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ece\u1000-\u103f\u1050-\u108f\u1780-\u17d3\u1950-\u19cf\u1a20-\u1a7c\u1b00-\u1b4b"
            "\u3005-\u3007\u3041-\u3096\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
            "\ua980-\ua9c0\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff")
ANY_UNSPACED = re.compile(f"[{UNSPACED}]")
MIXED = re.compile(f"[{UNSPACED}]|[^\\W{UNSPACED}]+")
#: Spaced seeds: positions with 0 are ignored, so a substituted token there does not hide the window.
MASKS = ("111011001011", "110110111001", "101100111101", "111100010111")
#: Items under this many tokens are also searched whole: a substitution in them may leave no run of ``min_overlap`` tokens.
SHORT = 16


def tokens(text: str | None) -> list[str]:
    """Runs of word characters in lower case; where a script has no spaces, its characters."""
    if not text:
        return []
    plain = text.isascii() or not ANY_UNSPACED.search(text)
    return (TOKENS if plain else MIXED).findall(text.lower())


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """One 64-bit hash per window of the mask's length, over the kept positions only."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, np.uint64(int(mask, 2) + (len(mask) << 32)), np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
    return mix64(h)


def tolerated(n: int) -> int:
    """Substituted tokens that a whole item of ``n`` tokens may hold: one in five, as 12 equal tokens may pay for 3."""
    return n // 5


def parts_of(n: int) -> list[tuple[int, int]]:
    """(start, length) of the parts of a short item; the tolerated substitutions leave at least one of them whole."""
    cuts = [n * k // (tolerated(n) + 1) for k in range(tolerated(n) + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


class _Seeds:
    """Sorted seed hashes with (item, position), and a bit table in front."""

    def __init__(self, seeds: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]], bits: int):
        self.masks = sorted({x[0] for x in seeds})
        h, item, pos = (np.concatenate([x[k] for x in seeds]) if seeds else np.empty(0, t)
                        for k, t in ((1, np.uint64), (2, np.int64), (3, np.int64)))
        order = np.argsort(h, kind="stable")
        self.keys, self.item, self.pos = h[order], item[order], pos[order]
        self.shift = np.uint64(64 - bits)
        self.front = np.zeros(1 << bits, bool)
        self.front[(self.keys >> self.shift).astype(np.int64)] = True

    def hits(self, words: np.ndarray, at_once: int = 1 << 16):
        """Arrays (item, item position, text position) of the seeds shared with ``words``, about ``at_once`` at a time."""
        for mask in self.masks:
            h = seed_hashes(words, mask)
            at = np.flatnonzero(self.front[(h >> self.shift).astype(np.int64)])
            lo, hi = np.searchsorted(self.keys, h[at], "left"), np.searchsorted(self.keys, h[at], "right")
            at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            group = np.cumsum(n) // at_once
            for g in np.unique(group):
                a, b = np.searchsorted(group, g, "left"), np.searchsorted(group, g, "right")
                each = n[a:b]
                row = np.repeat(lo[a:b] - (np.cumsum(each) - each), each) + np.arange(each.sum())
                yield self.item[row], self.pos[row], np.repeat(at[a:b], each)


class Index:
    """Seeds of a block of test items: sorted hashes with (item, position), and a bit table in front.

    Items of as many tokens as the masks have get the spaced seeds of every
    window.  Items under ``SHORT`` tokens, also those, are searched whole,
    seeded by ``parts_of``.
    """

    def __init__(self, items: list[tuple[int, str]], min_tokens: int, bits: int = 20):
        hashes, self.items = WordHashes(), []
        spaced, whole = [], []
        for item_id, text in items:
            w = hashes.array(tokens(text))
            k, n = len(self.items), len(w)
            self.items.append((item_id, w))
            if n < max(1, min_tokens):
                continue
            if n >= len(MASKS[0]):
                for mask in MASKS:
                    h = seed_hashes(w, mask)
                    spaced.append((mask, h, np.full(len(h), k), np.arange(len(h))))
            if n < SHORT:
                for at, size in parts_of(n):
                    whole.append(("1" * size, seed_hashes(w[at:at + size], "1" * size), np.array([k]), np.array([at])))
        self.spaced, self.whole = _Seeds(spaced, bits), _Seeds(whole, bits)
        self.sizes = np.array([len(w) for _, w in self.items], np.int64)
        self.padded = np.zeros((len(self.items), SHORT), np.uint64)      # short items only
        for k, (_, w) in enumerate(self.items):
            if len(w) < SHORT:
                self.padded[k, :len(w)] = w

    def hits(self, words: np.ndarray):
        """(item, item position, text position) of every spaced seed shared with ``words``."""
        for item, pos, p in self.spaced.hits(words):
            yield from zip(item.tolist(), pos.tolist(), p.tolist())

    def whole_copies(self, words: np.ndarray):
        """(item, equal tokens, first text position) of copies of whole short items, with their tolerated substitutions."""
        for item, pos, p in self.whole.hits(words):
            start, size = p - pos, self.sizes[item]
            on = (start >= 0) & (start + size <= len(words))
            if not on.any():
                continue
            item, start = np.unique(np.stack([item[on], start[on]]), axis=1)
            size = self.sizes[item]
            equal = np.zeros(len(item), np.int64)
            for j in range(int(size.max())):
                equal += (j < size) & (words[np.minimum(start + j, len(words) - 1)] == self.padded[item, j])
            ok = equal >= size - tolerated(size)
            yield from zip(item[ok].tolist(), equal[ok].tolist(), start[ok].tolist())


def best_overlap(item: np.ndarray, words: np.ndarray, shift: int, penalty: int = 3) -> tuple[int, int, int]:
    """The best-scoring run of aligned tokens: (matching tokens, first text position, one past the last).

    ``words[i + shift]`` lines up with ``item[i]``; a match adds 1, a
    substitution costs ``penalty``.
    """
    a, b = max(0, -shift), min(len(item), len(words) - shift)
    same = item[a:b] == words[a + shift:b + shift]
    run = np.concatenate([[0], np.cumsum(np.where(same, 1, -penalty))])
    low = np.minimum.accumulate(run)
    end = int(np.argmax(run - low))
    start = int(np.flatnonzero(run[:end + 1] == low[end])[-1])
    return int(same[start:end].sum()), a + shift + start, a + shift + end


def overlaps(index: Index, words: np.ndarray, min_overlap: int) -> list[tuple[int, int, int, int]]:
    """Verified overlaps (item id, matching tokens, start, end), the best of each item."""
    best: dict[int, tuple[int, int, int, int]] = {}
    seen = set()
    for item, pos, p in index.hits(words):
        if (item, p - pos) in seen:
            continue
        seen.add((item, p - pos))
        item_id, w = index.items[item]
        n, start, end = best_overlap(w, words, p - pos)
        old = best.get(item_id, (item_id, 0, 0, 0))
        if n >= min(min_overlap, len(w)) and (n, -start) > (old[1], -old[2]):
            best[item_id] = (item_id, n, start, end)
    for k, n, start in index.whole_copies(words):
        item_id, w = index.items[k]
        old = best.get(item_id, (item_id, 0, 0, 0))
        if (n, -start) > (old[1], -old[2]):
            best[item_id] = (item_id, n, start, start + len(w))
    return sorted(best.values())


FOUND = "struct<item_ids: array<bigint>, n_matched: bigint, spans: array<string>>"


def _blocks(items: DataFrame, item_col: str, item_text: str, block_tokens: int):
    """Broadcast blocks of distinct items, each of at most about ``block_tokens`` tokens."""
    spark = items.sparkSession
    tests = items.select(F.coalesce(F.col(item_col).cast("long"), F.lit(-1)).alias("item"),
                         F.col(item_text).alias("body")).where("body IS NOT NULL").distinct()
    # every token takes a character and a separator, so half the characters bound the tokens from above
    chars = tests.agg(F.sum(F.length("body") + 1)).first()[0] or 0
    n = max(1, -(-int(chars) // (2 * block_tokens)))
    for k in range(n):
        mine = tests.where(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == k).collect()
        yield spark.sparkContext.broadcast(sorted((r["item"], r["body"]) for r in mine))


def _finder(shared, min_overlap: int, min_tokens: int):
    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index, hashes = Index(shared.value, min_tokens), WordHashes()
        for texts in batches:
            found = [overlaps(index, hashes.array(tokens(t)), min_overlap) for t in texts]
            yield pd.DataFrame({"item_ids": [[f[0] for f in x] for x in found],
                                "n_matched": [sum(f[1] for f in x) for x in found],
                                "spans": [[f"{f[0]}:{f[2]}:{f[3]}" for f in x] for x in found]})
    return find


def find_overlaps(docs: DataFrame, items: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", min_overlap: int = 12, min_tokens: int = 1,
                  block_tokens: int = 1_000_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, item_ids, n_matched, spans.

    Every window of every whole text is hashed under each spaced seed and
    looked up among the windows of the test items; each shared seed is
    extended along its diagonal, and counts when a run of at least
    ``min_overlap`` equal tokens (the whole item, if shorter) comes out, where a
    substituted token costs three equal ones.  ``spans`` are token ranges
    item:start:end of the best run of each item.

    The items go to the tasks in blocks of about ``block_tokens`` tokens, each
    a broadcast of fixed bound with a pass of its own, all treated alike.
    Items under 16 tokens are also searched whole and count when at most one
    token in five is substituted, so those under 5 tokens only word for word.
    Short items that ordinary prose holds by chance are reported like all others;
    a caller who wants them left out sets ``min_tokens``.  Tokens are words, and
    characters in scripts without spaces.  Null or empty texts match nothing;
    null items and items without any token are not searched.  Items with a null id are reported as -1.  No row is dropped,
    repeated rows stay repeated, and other columns are ignored.
    """
    rows = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("body"))
    finders = [_finder(b, min_overlap, min_tokens) for b in _blocks(items, item_col, item_text, block_tokens)]
    if len(finders) == 1:
        out = rows.select("doc_id", finders[0](F.col("body")).alias("f"))
        out = out.select("doc_id", F.col("f.item_ids").alias("item_ids"), F.col("f.n_matched").alias("n_matched"),
                         F.col("f.spans").alias("spans"))
    else:
        key = F.xxhash64("body").alias("key")
        hits = None
        for find in finders:
            part = (rows.select("doc_id", key, find(F.col("body")).alias("f")).where(F.size("f.item_ids") > 0)
                    .select("doc_id", "key", "f.*").dropDuplicates(["doc_id", "key"]))
            hits = part if hits is None else hits.unionByName(part)
        hits = hits.groupBy(F.col("doc_id").alias("id"), F.col("key").alias("h")).agg(
            F.flatten(F.collect_list("item_ids")).alias("item_ids"), F.sum("n_matched").alias("n_matched"),
            F.flatten(F.collect_list("spans")).alias("spans"))
        none = F.array().cast("array<string>")
        out = (rows.select("doc_id", key).join(hits, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("h")), "left")
               .select("doc_id", F.coalesce("item_ids", none.cast("array<bigint>")).alias("item_ids"),
                       F.coalesce("n_matched", F.lit(0)).alias("n_matched"), F.coalesce("spans", none).alias("spans")))
    return out.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"),
                      F.array_sort(F.array_distinct("item_ids")).alias("item_ids"),
                      "n_matched", F.array_sort("spans").alias("spans"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", min_overlap: int = 12,
                      min_tokens: int = 1, block_tokens: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows that hold a passage of a test item, same columns.

    The rule of ``find_overlaps`` as a filter: map-side only, no row moves.
    Between blocks of items the kept rows are written, so that a task never
    holds more than one block.
    """
    out, found = docs, fresh(docs.columns, "_found")
    for k, block in enumerate(_blocks(items, "item_id", "text", block_tokens)):
        if k:
            out = stored(out, "decontaminated")
        find = _finder(block, min_overlap, min_tokens)
        out = (out.withColumn(found, find(F.col(text_col))).where(F.size(F.col(found)["item_ids"]) == 0)
               .select(*docs.columns))
    return out
