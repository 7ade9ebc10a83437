"""Helpers shared by the text operators: narrow reads, stored intermediates, stable hashes, components."""

from __future__ import annotations

import gc
import re
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.session import scratch_path


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift), elementwise."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a driver table (pruned at the scan)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with files that every executor sees, so a lost executor
    costs one task and not the whole history.  The shuffles of the write go with
    it (a setting of Spark 4.1; earlier versions wait for their garbage collector).
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{label}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Deletes what ``stored`` wrote for ``frames``; call it once everything computed from them is stored itself.

    Later steps then start from those files, so no lost executor needs the
    deleted ones.  The collections let Spark see that the shuffles behind them
    have no reader left, and remove their files too.
    """
    for df in frames:
        spark, path = df.sparkSession, df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if frames:
        gc.collect()
        spark.range(1).count()              # the plan of the query run last is held until the next one
        spark._jvm.System.gc()


def fresh(taken, base: str) -> str:
    """A column name that no column in ``taken`` has (names compare without case)."""
    used = {c.lower() for c in taken}
    name = base
    while name.lower() in used:
        name += "_"
    return name


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """True where crc32 of the id's text falls on the held-out remainder; null ids are not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def hash_fraction(*cols: Column) -> Column:
    """A stable pseudo-random number in [0, 1) from the given columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)


class WordHashes(dict):
    """word -> stable 64-bit hash, remembered up to ``limit`` words per task."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def array(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}

_BASE = 0x9E3779B97F4A7C15
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_VALUES[65:91] = _VALUES[97:123]                       # A-Z count as a-z
_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, *range(9, 14)]] = False
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n, kept between calls."""
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base), np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def _pieces(body: bytes, size: int):
    """``body`` in pieces of about ``size`` bytes, cut before white space only."""
    while len(body) > size:
        m = _SPACE.search(body, size)
        if m is None:
            break
        yield body[:m.start()]
        body = body[m.start():]
    yield body


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_hashes(bodies: list[bytes], slab: int = 1 << 20):
    """Yields (number of the first body, word hashes, words of each body) for runs of ``bodies``.

    Words are maximal runs of bytes other than [\\x20\\x09-\\x0D], with A-Z read as
    a-z.  A word's hash is a difference of running polynomial sums, so a run of
    about ``slab`` bytes takes a handful of array operations; longer texts are
    hashed piece by piece and come alone.
    """
    def hashed(parts: list[bytes]):
        data = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
        up, down = _power_tables(len(data) + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[data] * up[:len(data)])])
            on = np.diff(np.concatenate([[False], _IS_WORD[data], [False]]).astype(np.int8))
            start, end = np.flatnonzero(on == 1), np.flatnonzero(on == -1)
            h = mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
        bounds = np.cumsum([0, *(len(p) + 1 for p in parts)])
        return h, np.diff(np.searchsorted(start, bounds))

    first, size, run = 0, 0, []
    for i, body in enumerate(bodies):
        if run and size + len(body) > slab:
            yield first, *hashed(run)
            run, size = [], 0
        if not run:
            first = i
        if len(body) > slab:
            h = np.concatenate([hashed([p])[0] for p in _pieces(body, slab)])
            yield i, h, np.array([len(h)])
            continue
        run.append(body)
        size += len(body) + 1
    if run:
        yield first, *hashed(run)


def heavy_values(df: DataFrame, col: str, support: float) -> DataFrame:
    """Candidates for the values of ``col`` that fill over ``support`` of the rows.

    ``freqItems`` keeps Misra-Gries counters, so at most 1/support values come
    out and no value above the threshold is missed; nulls are left out.
    """
    found = df.select(F.col(col).alias("v")).where("v IS NOT NULL").freqItems(["v"], support)
    return found.select(F.explode("v_freqItems").alias(col)).where(F.col(col).isNotNull()).distinct()


def ranked(df: DataFrame, group: list[str], order: list[Column], label: str, index: str = "idx", size: str = "n") -> DataFrame:
    """``df`` stored, with each row's 0-based place (``index``) in its ``group`` by ``order`` and the group's row count (``size``).

    Rows are sorted over range partitions, so a group that holds most of the
    table spreads over tasks.  Only the counts per (partition, group) are
    summed up: as many rows as there are partitions and groups.  Nulls in
    ``group`` form one group.
    """
    keys = [*[F.col(g).asc_nulls_first() for g in group], *order]
    rows = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), label)
    rows = rows.withColumn("_key", F.struct(F.shiftright("_at", 33).alias("pid"), F.struct(F.lit(0), *group).alias("g")))
    counts = rows.groupBy("_key").agg(F.min("_at").alias("first"), F.count("*").alias("c"))
    whole = Window.partitionBy("_key.g")
    before = F.sum("c").over(whole.orderBy("_key.pid").rowsBetween(Window.unboundedPreceding, -1))
    base = stored(counts.select("_key", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("_base"),
                                F.sum("c").over(whole).alias(size)), f"{label}-places")
    if base.count() <= 100_000:                          # a row a partition and group: small enough for every task
        base = F.broadcast(base)
    return rows.join(base, "_key").withColumn(index, F.col("_at") + F.col("_base")).drop("_key", "_at", "_base")


def heavy_join(rows: DataFrame, to: DataFrame, keys: list[str], counts: DataFrame, hot: int = 256) -> DataFrame:
    """``rows`` left-joined with ``to``, whose ``keys`` are unique; ``counts`` says how many rows (c) have each key.

    Keys that more than 1/``hot`` of the rows have, fewer than ``hot`` of them,
    are broadcast, so their rows stay where they are; the others are joined by
    shuffle, where no key weighs more than that.
    """
    total = counts.agg(F.sum("c")).first()[0] or 0
    often = counts.where(F.col("c") * hot > total).select(*keys)
    few = to.join(F.broadcast(often), keys, "left_semi").withColumn("_often", F.lit(True))
    split = rows.join(F.broadcast(few), keys, "left")
    new = [c for c in to.columns if c not in keys]
    rest = split.where("_often IS NULL").drop("_often", *new).join(to, keys, "left")
    return split.where("_often").drop("_often").unionByName(rest)


def connected_components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node each node of ``edges`` (a, b) is connected to.

    Alternating large-star and small-star rounds; every step is a partial
    ``min`` and a join, so a node with very many neighbours splits.  Stops when
    a round changes nothing; raises if that never happens.
    """
    def oriented(df):
        return (df.where("a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def state(df):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    cur = stored(oriented(edges), label)
    before = state(cur)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = oriented(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                         .unionByName(low.select("a", F.col("m").alias("b"))))
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low2.select("a", F.col("m").alias("b"))))
        last, cur = cur, stored(oriented(small), label)
        release(last)
        after = state(cur)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    star = cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return star.unionByName(star.select(F.col("component").alias("node"), "component").distinct())
