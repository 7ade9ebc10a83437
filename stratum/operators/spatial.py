"""Exact k-nearest-neighbour joins over a count-balanced tile tree, and the imputers built on them.

No all-pairs join and no fixed grid.  Reference points are cut by rank, not by
distance: slabs of equal row count along u, tiles of ``cap`` points along v in
each slab (both by a range scan).  Only occupied tiles exist, a dense spot has
many small ones, and a far point only stretches the one that holds it.  Sixteen
consecutive tiles form a node of the next level, down to one root group.
Queries are tiled the same way, and the join descends the tree level by level
with pairs (query tile, node): of a query tile's nodes those survive whose
least distance is at most a bound within which ``k`` eligible references are
sure to lie.  The surviving leaves hold every neighbour, so the result is exact
whatever the layout, and the pairs per query tile stay about constant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.quantiles import grouped_medians
from stratum.operators.scan import BROADCAST_ROWS, range_scan
from stratum.session import cut_lineage

FAN = 16
QUERY_TILE = 64


def _tiles(df: DataFrame, group: Sequence[str], u: str, v: str, cap: int, out: str) -> DataFrame:
    """Numbers tiles of up to ``cap`` rows per group: equal slabs along u, equal runs along v inside a slab."""
    tiles = F.ceil(F.col("_nu") / cap)
    column = F.ceil(tiles / F.ceil(F.sqrt(tiles)))                       # tiles a slab
    a = range_scan(df, group, [F.col(u).asc(), F.col(v).asc()], "_iu", "_nu").withColumn("_column", column)
    a = a.withColumn("_slab", F.floor(F.col("_iu") / (F.col("_column") * cap))).drop("_iu", "_nu")
    b = range_scan(a, [*group, "_slab"], [F.col(v).asc(), F.col(u).asc()], "_iv")
    return b.withColumn(out, F.col("_slab") * F.col("_column") + F.floor(F.col("_iv") / cap)).drop("_slab", "_column", "_iv")


def _valid(u: str, v: str) -> Column:
    return F.col(u).isNotNull() & F.col(v).isNotNull() & ~F.isnan(u) & ~F.isnan(v)


def _few_per_spot(r: DataFrame, k: int, grouped: bool) -> DataFrame:
    """References at one and the same spot that can be among k neighbours: the smallest ids.

    They tie in distance, so of a group only its first k count, and of a spot,
    since one group may be excluded, only the first 2k of what is left.
    """
    if grouped:
        w = Window.partitionBy("_ru", "_rv", "_rgrp").orderBy("_rid")
        r = r.withColumn("_t", F.row_number().over(w)).filter(F.col("_t") <= k).drop("_t")
    w = Window.partitionBy("_ru", "_rv").orderBy("_rid")
    return r.withColumn("_t", F.row_number().over(w)).filter(F.col("_t") <= (2 * k if grouped else k)).drop("_t")


def _levels(r: DataFrame, fan: int) -> list[DataFrame]:
    """Node tables from the tiles up: _node, box, _cnt, _top and _topgrp (the largest group's rows and name)."""
    box = [F.min("_u0").alias("_u0"), F.max("_u1").alias("_u1"), F.min("_v0").alias("_v0"), F.max("_v1").alias("_v1")]
    cells = (r.select("_rb", "_rgrp", F.col("_ru").alias("_u0"), F.col("_ru").alias("_u1"), F.col("_rv").alias("_v0"), F.col("_rv").alias("_v1"))
             .groupBy(F.col("_rb").alias("_node"), "_rgrp").agg(F.count(F.lit(1)).alias("_c"), *box))
    out = []
    while True:
        cells = cut_lineage(cells)
        most = F.max(F.struct(F.col("_c"), F.col("_rgrp")))
        nodes = cells.groupBy("_node").agg(F.sum("_c").alias("_cnt"), most.alias("_m"), *box)
        out.append(cut_lineage(nodes.select("_node", "_cnt", F.col("_m._c").alias("_top"), F.col("_m._rgrp").alias("_topgrp"),
                                            "_u0", "_u1", "_v0", "_v1")))
        if (out[-1].agg(F.max("_node")).first()[0] or 0) < fan:
            return out
        cells = cells.groupBy(F.floor(F.col("_node") / fan).alias("_node"), "_rgrp").agg(F.sum("_c").alias("_c"), *box)


def _survivors(pairs: DataFrame, need: int) -> DataFrame:
    """Pairs of query tiles (or queries) and nodes that can hold a neighbour, with the tile's ``_bound``."""
    def gap(axis):
        return F.greatest(F.col(f"_q{axis}0") - F.col(f"_{axis}1"), F.col(f"_{axis}0") - F.col(f"_q{axis}1"), F.lit(0.0))

    def reach(axis):
        return F.greatest(F.col(f"_q{axis}1") - F.col(f"_{axis}0"), F.col(f"_{axis}1") - F.col(f"_q{axis}0"))

    own = F.coalesce(F.col("_topgrp") == F.col("_qgrp"), F.lit(False))
    # rows of the query's own group in a node: known for its largest group, else at most the rest or the largest
    barred = F.when(F.col("_qgrp").isNull(), F.lit(0)).when(own, F.col("_top")).otherwise(F.least("_top", F.col("_cnt") - F.col("_top")))
    p = pairs.withColumns({"_least": F.sqrt(gap("u") * gap("u") + gap("v") * gap("v")),
                           "_most": F.sqrt(reach("u") * reach("u") + reach("v") * reach("v")),
                           "_sure": F.col("_cnt") - barred})
    p = p.filter(~(own & (F.col("_top") == F.col("_cnt"))))
    w = Window.partitionBy("_qk")
    upto = F.sum("_sure").over(w.orderBy("_most", "_node").rowsBetween(Window.unboundedPreceding, 0))
    p = p.withColumn("_upto", upto)
    p = p.withColumn("_bound", F.coalesce(F.min(F.when(F.col("_upto") >= need, F.col("_most"))).over(w), F.lit(float("inf"))))
    return p.filter(F.col("_least") <= F.col("_bound"))


def knn_candidates(queries: DataFrame, refs: DataFrame, k: int, qid: str, rid: str, qu: str, qv: str, ru: str, rv: str,
                   qgrp: str | None = None, rgrp: str | None = None, exclude_self_id: bool = False, cap: int | None = None,
                   carry: Sequence[str] = ()) -> DataFrame:
    """(_qid, _rid, dist, *carry): few pairs per query, among them its k nearest references."""
    grouped, need = bool(qgrp and rgrp), k + (1 if exclude_self_id else 0)
    cap = cap or max(2 * need, 16)
    r = refs.select(F.col(rid).alias("_rid"), F.col(ru).cast("double").alias("_ru"), F.col(rv).cast("double").alias("_rv"),
                    (F.col(rgrp) if grouped else F.lit(None).cast("int")).alias("_rgrp"), *carry).filter(_valid("_ru", "_rv"))
    r = _tiles(_few_per_spot(r, need, grouped), [], "_ru", "_rv", cap, "_rb")
    q = queries.select(F.col(qid).alias("_qid"), F.col(qu).cast("double").alias("_qu"), F.col(qv).cast("double").alias("_qv"),
                       (F.col(qgrp) if grouped else F.lit(None).cast("int")).alias("_qgrp")).filter(_valid("_qu", "_qv"))
    # a tile of queries has one group: what is barred for one of its rows is barred for all
    q = _tiles(q, ["_qgrp"] if grouped else [], "_qu", "_qv", QUERY_TILE, "_qt").withColumn("_qk", F.struct("_qgrp", "_qt")).drop("_qt")
    tiles = q.groupBy("_qk").agg(F.min("_qu").alias("_qu0"), F.max("_qu").alias("_qu1"), F.min("_qv").alias("_qv0"), F.max("_qv").alias("_qv1"))
    tiles = tiles.withColumn("_qgrp", F.col("_qk._qgrp"))
    levels = _levels(r, FAN)
    keep = ["_qk", "_qgrp", "_qu0", "_qu1", "_qv0", "_qv1"]
    pairs = tiles.crossJoin(F.broadcast(levels[-1]))                     # at most FAN nodes
    for i in range(len(levels) - 1, 0, -1):
        up = cut_lineage(_survivors(pairs, need).select(*keep, F.col("_node").alias("_up")))
        nodes = levels[i - 1].withColumn("_up", F.floor(F.col("_node") / FAN))
        pairs = up.join(F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes, "_up")
    box = ["_cnt", "_top", "_topgrp", "_u0", "_u1", "_v0", "_v1"]
    leaves = _survivors(pairs, need).select(F.col("_qk").alias("_tile"), "_node", *box)
    # the same once more for single queries, so that the width of a query tile does not count
    each = q.withColumnRenamed("_qk", "_tile").join(leaves, "_tile").withColumns(
        {"_qk": F.col("_qid"), "_qu0": F.col("_qu"), "_qu1": F.col("_qu"), "_qv0": F.col("_qv"), "_qv1": F.col("_qv")})
    near = _survivors(each, need).select("_qid", "_qu", "_qv", "_qgrp", F.col("_node").alias("_rb"), "_bound")
    du, dv = F.col("_qu") - F.col("_ru"), F.col("_qv") - F.col("_rv")
    cand = near.join(r, "_rb").withColumn("dist", F.sqrt(du * du + dv * dv)).filter(F.col("dist") <= F.col("_bound"))
    if grouped:
        cand = cand.filter(F.col("_qgrp").isNull() | ~F.col("_rgrp").eqNullSafe(F.col("_qgrp")))
    if exclude_self_id:
        cand = cand.filter(F.col("_rid") != F.col("_qid"))
    return cand.select("_qid", "_rid", "dist", *carry)


def knn_join(queries: DataFrame, refs: DataFrame, k: int, qid: str, rid: str, qu: str, qv: str, ru: str, rv: str,
             qgrp: str | None = None, rgrp: str | None = None, exclude_self_id: bool = False, cap: int | None = None,
             carry: Sequence[str] = ()) -> DataFrame:
    """k nearest reference rows per query: (qid, rid, dist, rank, *carry).

    ``qgrp``/``rgrp`` exclude references of the query's own group (a query
    without a group excludes none); ties in distance are broken by ``rid``.
    ``carry`` lists reference columns to return with each neighbour.  Rows with a
    null or NaN coordinate have and are no neighbours; query and reference ids
    are unique.  ``cap`` is the number of points a tile holds.
    """
    cand = knn_candidates(queries, refs, k, qid, rid, qu, qv, ru, rv, qgrp, rgrp, exclude_self_id, cap, carry)
    w = Window.partitionBy("_qid").orderBy("dist", "_rid")
    top = cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.select(F.col("_qid").alias(qid), F.col("_rid").alias(rid), "dist", F.col("rank").cast("long").alias("rank"), *carry)


def scale_of(df: DataFrame, x: str, y: str, min_std: float = 1e-3) -> DataFrame:
    """Per-axis std (ddof 0) used to scale distances; below ``min_std`` -> 1 (one row)."""
    return df.agg(F.stddev_pop(x).alias("_sx"), F.stddev_pop(y).alias("_sy")).select(
        F.when(F.col("_sx") < min_std, F.lit(1.0)).otherwise(F.col("_sx")).alias("_sx"),
        F.when(F.col("_sy") < min_std, F.lit(1.0)).otherwise(F.col("_sy")).alias("_sy"))


def knn_plane_impute(points: DataFrame, queries: DataFrame, entity: str, x: str, y: str, surfaces: Sequence[str],
                     qid: str, qx: str, qy: str, qgrp: str | None, k: int = 10, ridge: float = 1e-9) -> DataFrame:
    """Per query: weighted local plane a*x + b*y + c of each surface over the k nearest entity centroids.

    Centroids are per-entity medians of (x, y, surfaces); distance is scaled
    by the centroid std; own entity excluded; weights 1/(d + 1e-3); 3x3
    normal equations with a ``ridge`` on the diagonal.  No neighbour -> mean
    of the centroid surfaces.  Also returns the nearest distance.
    """
    pts = points.select(entity, x, y, *surfaces).dropna()
    cen = grouped_medians(pts, [entity], {"_cx": x, "_cy": y, **{f"_c_{s}": s for s in surfaces}})
    sc = scale_of(cen, "_cx", "_cy")
    cen = cen.crossJoin(F.broadcast(sc)).withColumn("_u", F.col("_cx") / F.col("_sx")).withColumn("_v", F.col("_cy") / F.col("_sy"))
    qs = queries.crossJoin(F.broadcast(sc)).withColumn("_u", F.col(qx) / F.col("_sx")).withColumn("_v", F.col(qy) / F.col("_sy"))
    carry = ["_cx", "_cy"] + [f"_c_{s}" for s in surfaces]
    nb = knn_join(qs, cen, k, qid, entity, "_u", "_v", "_u", "_v", qgrp, entity if qgrp else None, carry=carry)
    w = F.lit(1.0) / (F.col("dist") + F.lit(1e-3))
    xn, yn = F.col("_cx"), F.col("_cy")
    aggs = [F.sum(w * xn * xn).alias("_sxx"), F.sum(w * xn * yn).alias("_sxy"), F.sum(w * xn).alias("_sx1"),
            F.sum(w * yn * yn).alias("_syy"), F.sum(w * yn).alias("_sy1"), F.sum(w).alias("_s1"),
            F.min("dist").alias("min_dist")]
    for s in surfaces:
        f = F.col(f"_c_{s}")
        aggs += [F.sum(w * xn * f).alias(f"_rx_{s}"), F.sum(w * yn * f).alias(f"_ry_{s}"), F.sum(w * f).alias(f"_r1_{s}")]
    g = nb.groupBy(qid).agg(*aggs)
    means = cen.agg(*[F.avg(f"_c_{s}").alias(f"_m_{s}") for s in surfaces])
    res = queries.select(qid, qx, qy).join(g, qid, "left").crossJoin(F.broadcast(means))
    # centred form of the weighted plane normal equations (same solution, far better conditioned)
    s1 = F.col("_s1")
    mx, my = F.col("_sx1") / s1, F.col("_sy1") / s1
    cxx = F.col("_sxx") - F.col("_sx1") * F.col("_sx1") / s1 + ridge
    cyy = F.col("_syy") - F.col("_sy1") * F.col("_sy1") / s1 + ridge
    cxy = F.col("_sxy") - F.col("_sx1") * F.col("_sy1") / s1
    det = cxx * cyy - cxy * cxy
    cols = [qid]
    for s in surfaces:
        mf = F.col(f"_r1_{s}") / s1
        cxf = F.col(f"_rx_{s}") - F.col("_sx1") * F.col(f"_r1_{s}") / s1
        cyf = F.col(f"_ry_{s}") - F.col("_sy1") * F.col(f"_r1_{s}") / s1
        a = (cxf * cyy - cyf * cxy) / det
        b = (cyf * cxx - cxf * cxy) / det
        pred = a * (F.col(qx) - mx) + b * (F.col(qy) - my) + mf
        cols.append(F.when(s1.isNull(), F.col(f"_m_{s}")).otherwise(pred).alias(f"plane_{s}"))
    cols.append("min_dist")
    return res.select(*cols)


def knn_idw_impute(refs: DataFrame, queries: DataFrame, entity: str, rid: str, x: str, y: str, value: str,
                   qid: str, qx: str, qy: str, qgrp: str | None, k: int = 20) -> DataFrame:
    """Inverse-distance-weighted mean / weighted std of ``value`` over the k nearest reference points.

    Distances are scaled by the reference std; own entity excluded; weights
    1/(d + 1e-3); total weight < 1e-9, or no reference at all (only the own
    group has points, a null coordinate) -> the reference mean, with std 0 and
    a null distance.  One row per query.
    """
    r = refs.select(F.col(rid).alias("_ref_id"), entity, x, y, value).dropna()
    sc = scale_of(r, x, y)
    r = r.crossJoin(F.broadcast(sc)).withColumn("_u", F.col(x) / F.col("_sx")).withColumn("_v", F.col(y) / F.col("_sy"))
    qs = queries.crossJoin(F.broadcast(sc)).withColumn("_u", F.col(qx) / F.col("_sx")).withColumn("_v", F.col(qy) / F.col("_sy"))
    nb = knn_join(qs, r, k, qid, "_ref_id", "_u", "_v", "_u", "_v", qgrp, entity if qgrp else None, carry=[value])
    w = F.lit(1.0) / (F.col("dist") + F.lit(1e-3))
    g = nb.groupBy(qid).agg(F.sum(w).alias("_sw"), F.sum(w * F.col(value)).alias("_swa"), F.min("dist").alias("idw_dist"))
    mean = r.agg(F.avg(value).alias("_gm"))
    safe = F.when(F.col("_sw") < 1e-9, F.lit(1.0)).otherwise(F.col("_sw"))
    g = queries.select(qid).join(g, qid, "left").crossJoin(F.broadcast(mean))
    g = g.withColumn("idw_mean", F.when(F.coalesce(F.col("_sw"), F.lit(0.0)) < 1e-9, F.col("_gm")).otherwise(F.col("_swa") / safe)) \
         .withColumn("_safe", safe)
    var = nb.join(g.select(qid, "idw_mean", "_safe"), qid).groupBy(qid).agg(
        (F.sum(w * F.pow(F.col(value) - F.col("idw_mean"), 2)) / F.first("_safe")).alias("_var"))
    return (g.join(var, qid, "left").select(qid, "idw_mean", F.sqrt(F.greatest("_var", F.lit(0.0))).alias("idw_std"), "idw_dist"))
