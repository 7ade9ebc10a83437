"""Merkle manifest of a table: a tree of SHA-256 digests per partition, and every row's proof by pointer jumping."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import heavy_join, ranked, stored

FAN = 8
#: The number of the tree over the partitions' roots.
TOP = -1
STEP = "struct<place:int,before:string,after:string>"


def field(value: Column) -> Column:
    """A value's unambiguous text: its UTF-8 byte count, a colon and itself; - for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def hashed(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _joined(digests: Column) -> Column:
    return F.lower(F.array_join(F.transform(digests, F.hex), ""))


@dataclass
class Tree:
    """``leaves``: one row per run of leaves (t, level 0, run, n, leaves, digest); ``runs``: all runs with their members.

    A run is up to ``fan`` consecutive nodes of one level of one tree; it is
    itself a node of the next level.  ``t`` numbers the partitions in order.
    """
    leaves: DataFrame
    runs: DataFrame
    fan: int


def build(rows: DataFrame, part: str, order: list[str], leaf: str, fan: int = FAN) -> Tree:
    """The runs of a tree per value of ``part`` (null first) over rows ordered by ``order`` and ``leaf`` (hex), and of a tree over their roots.

    Rows are numbered by a range sort, so one partition may hold nearly all of
    them.  A level is one grouping of an eighth of the level below; digests
    move as 32 bytes.  Levels are as many as the largest partition needs.
    """
    others = [c for c in rows.columns if c not in (part, leaf)]
    raw = rows.select(part, *others, F.unhex(leaf).alias(leaf))
    placed = ranked(raw, [part], [*[F.col(c).asc_nulls_first() for c in order], F.col(leaf)], "merkle-leaves")
    parts = ranked(placed.groupBy(part).agg(F.max("n").alias("n_rows")), [], [F.col(part).asc_nulls_first()], "merkle-parts", "t", "n_parts")
    parts = stored(parts, "merkle-trees")
    size = parts.agg(F.max("n_rows").alias("rows"), F.max("n_parts").alias("parts")).first()
    keyed = placed.join(parts.select(F.struct(part).alias("_k"), "t"), F.struct(part) == F.col("_k"))
    at = (F.col("idx") % fan).cast("int").alias("place")
    grouped = (keyed.groupBy("t", F.floor(F.col("idx") / fan).alias("run"))
               .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct(at, F.col(leaf).alias("leaf"), *others))).alias("leaves")))
    members = F.transform("leaves", lambda x: x["leaf"])
    digest = F.when(F.col("n") == 1, members[0]).otherwise(F.unhex(hashed(_joined(members))))
    leaves = stored(grouped.select("t", F.lit(0).alias("level"), "run", "n", "leaves", digest.alias("digest")), "merkle-runs")

    def above(nodes: DataFrame, level: int) -> DataFrame:
        """The runs over ``nodes`` (t, idx, n, digest) of the trees that have more than one."""
        runs = (nodes.where("n > 1").groupBy("t", F.floor(F.col("idx") / fan).alias("run"))
                .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct((F.col("idx") % fan).alias("p"), "digest"))).alias("m")))
        runs = runs.withColumn("members", F.transform("m", lambda x: x["digest"])).withColumn("digest", F.unhex(hashed(_joined(F.col("members")))))
        return stored(runs.select("t", F.lit(level).alias("level"), "run", "n", "members", "digest"), "merkle-runs")

    def next_level(runs: DataFrame) -> DataFrame:
        return runs.select("t", F.col("run").alias("idx"), F.ceil(F.col("n") / fan).alias("n"), "digest")

    pending = leaves.select("t", "level", "run", "n", F.lit(None).cast("array<binary>").alias("members"), "digest")
    levels, n, level = [pending], -(-(size["rows"] or 0) // fan), 0
    while n > 1:
        level += 1
        levels.append(above(next_level(levels[-1]), level))
        n = -(-n // fan)
    roots = levels[0]
    for df in levels[1:]:
        roots = roots.unionByName(df)
    nodes = roots.where(F.col("n") <= fan).select(F.lit(TOP).cast("long").alias("t"), F.col("t").alias("idx"),
                                                   F.lit(size["parts"]).cast("long").alias("n"), "digest")
    n, level = size["parts"] or 0, -1
    while n > 1:
        level += 1
        levels.append(above(nodes, level))
        nodes, n = next_level(levels[-1]), -(-n // fan)

    tree, parts_n = F.col("t"), size["parts"] or 0
    inner = F.col("n") > fan                              # the run is one of several nodes of the next level of its tree
    hangs = inner | ((tree >= 0) & F.lit(parts_n > 1))
    runs = levels[0]
    for df in levels[1:]:
        runs = runs.unionByName(df)
    number = F.when(inner, F.col("run")).otherwise(tree)  # its number among its siblings' runs
    runs = runs.select(
        "t", "level", "run", "members",
        F.when(hangs, F.when(inner, tree).otherwise(F.lit(TOP))).alias("up_t"),
        F.when(hangs, F.when(inner, F.col("level") + 1).otherwise(F.lit(0))).alias("up_level"),
        F.when(hangs, F.floor(number / fan)).alias("up_run"), F.when(hangs, (number % fan).cast("int")).alias("place"),
        F.when((tree >= 0) & ~inner, F.col("digest")).alias("subroot"), F.when(~hangs, F.col("digest")).alias("root"))
    return Tree(leaves, runs, fan)


def _step(members: Column, place: Column) -> Column:
    """A proof's step: the node's place in its run, and its siblings' digests before and after it."""
    return F.struct(place.cast("int").alias("place"), _joined(F.slice(members, F.lit(1), place)).alias("before"),
                    _joined(F.slice(members, place + 2, F.greatest(F.size(members) - place - 1, F.lit(0)))).alias("after"))


def _packed(members: Column, place: Column) -> Column:
    return F.struct(place.alias("place"), members.alias("members"))


def paths(tree: Tree) -> DataFrame:
    """Every run of leaves with its way to the root: t, run, path (array of (place, members)), subroot, root.

    Pointer jumping.  A run points to an ancestor and holds the segment of the
    way between them.  Joined with its ancestor's row it points to that one's
    ancestor and holds both segments, so the distance doubles each round and a
    tree of h levels takes log2(h) rounds.  Runs of leaves are nobody's
    ancestor, which leaves an eighth of the rows to look up; the few ancestors
    that very many rows point to are broadcast.  A round is written before the next.
    """
    up = ["up_t", "up_level", "up_run"]
    rows = tree.runs.withColumn("path", F.array().cast("array<struct<place:int,members:array<binary>>>"))
    while True:
        rows = stored(rows, "merkle-jumps")
        moving = rows.where("up_t IS NOT NULL")
        counts = stored(moving.groupBy(*up).agg(F.count("*").alias("c")), "merkle-targets")
        if counts.isEmpty():
            return rows.where((F.col("level") == 0) & (F.col("t") >= 0)).select("t", "run", "path", "subroot", "root")
        to = rows.where((F.col("level") > 0) | (F.col("t") == TOP))
        to = to.select(F.col("t").alias("up_t"), F.col("level").alias("up_level"), F.col("run").alias("up_run"), F.struct(
            F.col("members"), F.col("path"), F.col("subroot"), F.col("root"), F.col("place"), *up).alias("a"))
        joined = heavy_join(moving, to, up, counts)
        step = F.array(_packed(F.col("a.members"), F.col("place")))
        joined = joined.select("t", "level", "run", "members", *[F.col(f"a.{c}").alias(c) for c in up], F.col("a.place").alias("place"),
                               F.coalesce("subroot", "a.subroot").alias("subroot"), F.coalesce("root", "a.root").alias("root"),
                               F.concat("path", step, "a.path").alias("path"))
        rows = rows.where("up_t IS NULL").unionByName(joined)


def proofs(tree: Tree) -> DataFrame:
    """Per leaf its columns, leaf, subroot, root (hex) and proof: an array of steps (place, siblings before, siblings after)."""
    ways = paths(tree)
    steps = F.transform("path", lambda s: _step(s["members"], s["place"]))
    ways = ways.select("t", "run", steps.alias("steps"), *[F.lower(F.hex(c)).alias(c) for c in ("subroot", "root")])
    runs = tree.leaves.join(ways, ["t", "run"]).withColumn("all", F.transform("leaves", lambda x: x["leaf"]))
    each = runs.select("n", "all", "steps", "subroot", "root", F.explode("leaves").alias("l"))
    own = F.when(F.col("n") > 1, F.array(_step(F.col("all"), F.col("l.place")))).otherwise(F.array().cast(f"array<{STEP}>"))
    carried = [f for f in tree.leaves.schema["leaves"].dataType.elementType.names if f not in ("place", "leaf")]
    return each.select(*[F.col(f"l.{c}").alias(c) for c in carried], F.lower(F.hex("l.leaf")).alias("leaf"), "subroot", "root",
                       F.concat(own, "steps").alias("proof"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf (hex) and a proof lead to."""
    return F.aggregate(proof, leaf, lambda h, s: hashed(s["before"], h, s["after"]))


def manifest(docs: DataFrame, columns: list[str], part: str, order: list[str], suspect: tuple[str, Column] | None = None) -> DataFrame:
    """Per row of ``docs``: the ``order`` columns, leaf, subroot, root, proof, and ``suspect_leaf``.

    A leaf hashes ``columns``; leaves of one ``part`` ascend by ``order``
    (nulls first), then by leaf, so rows that repeat are neighbours.  Null
    values count as such, null ``part`` is a tree of its own and the first; an
    empty table gives an empty result; other columns are ignored.  ``suspect``
    is (column, expression): where the expression is not null, ``suspect_leaf``
    is the leaf with that column replaced by it, else null.

    Texts are read once and never move: only digests and keys do.
    """
    leaf = hashed(*[field(F.col(c)) for c in columns])
    changed = F.lit(None).cast("string")
    if suspect:
        name, value = suspect
        changed = F.when(value.isNotNull(), hashed(*[field(value if c == name else F.col(c)) for c in columns]))
    keep = [c for c in order if c != part]
    rows = docs.select(F.col(part).alias("_part"), *keep, leaf.alias("_leaf"), F.unhex(changed).alias("suspect_leaf"))
    tree = build(stored(rows, "merkle-digests"), "_part", keep, "_leaf")
    return proofs(tree).withColumn("suspect_leaf", F.lower(F.hex("suspect_leaf")))


def audited(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` with its proofs checked after tampering with every third document by hash.

    Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.
    Tampering lower-cases A-Z of the text where 3 divides crc32 of the id; rows
    with a null id or a null text stay as they are.
    """
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = manifest(docs, columns, "lang", ["doc_id"], ("text", F.when(chosen, lower)))
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["before"], s["after"])), "")
    back = folded(F.coalesce("suspect_leaf", "leaf"), F.col("proof"))
    out = rows.select("doc_id", "leaf", "subroot", "root", hashed(siblings).alias("proof_sha256"), back.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
