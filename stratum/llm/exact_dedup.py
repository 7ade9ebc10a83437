"""Exact duplicates with a heavy-hitter split; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import fresh, heavy_values, stored

#: White space that does not count when texts are compared.
SPACES = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """``text`` without the characters of SPACES; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for ch in SPACES:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def digest(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def code_points(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def _winner(id_col: str = "doc_id") -> Column:
    # most code points, then smallest id; a null id comes after every other
    return F.min(F.struct((-F.col("n_chars")).alias("n"), F.col(id_col).isNull().alias("z"), F.col(id_col).alias("id")))


def copy_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   support: float = 0.001) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_chars.

    Only narrow rows (id, digest, length) move.  Misra-Gries counters name the
    digests that may fill over ``support`` of the rows, at most 1/support of
    them whatever the table's size; their exact sizes and winners are
    aggregated with map-side combine, broadcast, and settle every row of a hot
    digest without a shuffle.  The other digests are grouped by an ordinary
    shuffle, in which no group can exceed ``support`` of the rows.

    Null text counts as empty.  A row with a null id loses every tie.  Rows
    that repeat both id and text are numbered, and one of them is kept.  An
    empty table gives an empty result; other columns are ignored.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("digest"),
                         code_points(F.col(text_col)).alias("n_chars"))
    rows = stored(narrow.groupBy("doc_id", "digest", "n_chars").agg(F.count("*").alias("copies")), "exact-rows")

    hot = heavy_values(rows, "digest", support)
    size = F.sum("copies").alias("group_size")
    won = (rows.join(F.broadcast(hot), "digest", "left_semi").groupBy("digest").agg(_winner().alias("w"), size)
           .select("digest", "w", "group_size", F.lit(True).alias("hot")))
    won = stored(won, "exact-hot")                      # at most 1/support rows: broadcast is bounded
    split = rows.join(F.broadcast(won), "digest", "left")
    of_hot = split.where("hot").drop("hot")
    cold = split.where("hot IS NULL").select("doc_id", "digest", "n_chars", "copies")
    groups = cold.groupBy("digest").agg(_winner().alias("w"), size)
    of_cold = cold.join(groups, "digest").select(*of_hot.columns)
    both = of_hot.unionByName(of_cold)
    each = both.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select("doc_id", F.col("w.id").alias("keep_id"), "group_size",
                       (F.col("doc_id").eqNullSafe(F.col("w.id")) & (F.col("n_chars") == -F.col("w.n"))
                        & (F.col("copy") == 1)).alias("kept"),
                       F.col("digest").alias("text_sha256"), "n_chars")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = 0.001) -> DataFrame:
    """``docs`` with one row per group of equal texts (the winner of ``copy_decisions``), same columns.

    Rows of a hot digest are settled map-side against its broadcast winner;
    only what is left is joined by id and digest.
    """
    spark = docs.sparkSession
    decided = stored(copy_decisions(docs, id_col, text_col, support), "exact-decided")
    taken = list(docs.columns)
    d, n = (fresh(taken, x) for x in ("_digest", "_n_chars"))
    keyed = docs.withColumns({d: digest(F.col(text_col)), n: code_points(F.col(text_col))})
    kept = decided.where("kept").select(F.col("doc_id").alias("w_id"), F.col("text_sha256").alias("w_digest"),
                                        F.col("n_chars").alias("w_n"))
    bound = int(1 / support) + 1
    hot = (decided.where("kept").orderBy(F.desc("group_size"), "text_sha256").limit(bound).where("group_size > 1")
           .select(F.col("text_sha256").alias("h_digest"), F.col("doc_id").alias("h_id")))
    keyed = (keyed.join(F.broadcast(hot), F.col(d) == F.col("h_digest"), "left")
             .where(F.col("h_digest").isNull() | F.col(id_col).eqNullSafe(F.col("h_id")))
             .select(*taken, d, n))
    same = (F.col(d) == F.col("w_digest")) & F.col(id_col).eqNullSafe(F.col("w_id")) & (F.col(n) == F.col("w_n"))
    # rows that repeat id and text of a winner: settle them apart, only if there are any
    repeated = (decided.groupBy("doc_id", "text_sha256", "n_chars").agg(F.count("*").alias("copies"),
                                                                      F.max("kept").alias("kept"))
                .where("kept AND copies > 1")
                .select(F.col("doc_id").alias("w_id"), F.col("text_sha256").alias("w_digest"),
                        F.col("n_chars").alias("w_n")))
    repeated = stored(repeated, "exact-repeated")
    if repeated.isEmpty():
        return keyed.join(kept, same, "left_semi").select(*taken)
    single = kept.join(repeated, kept["w_digest"] == repeated["w_digest"], "left_anti")
    out = keyed.join(single, same, "left_semi")
    again = keyed.join(repeated, same, "left_semi").dropDuplicates([d, n, id_col])
    return out.select(*taken).unionByName(again.select(*taken))
