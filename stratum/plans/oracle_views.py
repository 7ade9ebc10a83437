"""DuckDB definitions of the binding views, prepended to oracle statements.

These are written independently of the Spark views in ``views.py``; the
driver runs both sides over the same Parquet tables and compares results.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "seq": """
SELECT entity, event_id, i, n, pos, k, sig, sig_gap, (10 * i < 7 * n) AS known,
       CASE WHEN 10 * i < 7 * n THEN sig END AS y_in, tid, prior
FROM (SELECT user_id AS entity, event_id,
             CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS i,
             count(*) OVER (PARTITION BY user_id) AS n,
             date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) / 3.6e9 AS pos,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
             value AS sig,
             CASE WHEN event_type <> 'error' THEN value END AS sig_gap,
             'Brand#' || CAST(user_id % 25 + 1 AS VARCHAR) AS tid,
             900.0 + value / 5 AS prior
      FROM events) AS _e""",
    "tmpl": """
SELECT p_brand AS tid, p_retailprice AS x, avg(p_size) AS y, min(p_type) AS lab
FROM part GROUP BY p_brand, p_retailprice""",
    "pts": """
SELECT vec_id, CAST(label AS BIGINT) AS grp,
       CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
       CAST(embedding[3] AS DOUBLE) AS s1, CAST(embedding[4] AS DOUBLE) AS s2,
       CAST(embedding[5] AS DOUBLE) AS s3, CAST(embedding[6] AS DOUBLE) AS s4,
       CAST(embedding[7] AS DOUBLE) AS s5, CAST(embedding[8] AS DOUBLE) AS s6
FROM embeddings""",
    "docs": """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
       l.quality IS NOT NULL AS is_train
FROM documents AS d LEFT JOIN labels AS l ON d.doc_id = l.doc_id""",
    "fold_scores": """
WITH mom AS (
  SELECT entity, count(y_in) AS nk, avg(pos) AS m1, avg(k) AS m2, avg(y_in) AS my,
         var_pop(pos) AS v11, var_pop(k) AS v22, covar_pop(pos, k) AS v12,
         covar_pop(pos, y_in) AS c1, covar_pop(k, y_in) AS c2
  FROM seq WHERE known GROUP BY entity),
co AS (
  SELECT entity, m1, m2, my,
         CASE WHEN nk >= 2 AND v11 * v22 - v12 * v12 > 1e-12 * v11 * v22 AND v11 * v22 - v12 * v12 > 0
              THEN (c1 * v22 - c2 * v12) / (v11 * v22 - v12 * v12)
              WHEN nk >= 2 AND v11 > 0 THEN c1 / v11 ELSE 0.0 END AS a,
         CASE WHEN nk >= 2 AND v11 * v22 - v12 * v12 > 1e-12 * v11 * v22 AND v11 * v22 - v12 * v12 > 0
              THEN (c2 * v11 - c1 * v12) / (v11 * v22 - v12 * v12) ELSE 0.0 END AS b
  FROM mom),
pr AS (
  SELECT s.entity, s.i, s.sig, co.a * s.pos + co.b * s.k + (co.my - co.a * co.m1 - co.b * co.m2) AS pred
  FROM seq AS s LEFT JOIN co ON s.entity = co.entity WHERE NOT s.known),
lk AS (SELECT entity, arg_max(sig, i) AS last_sig, avg(sig) AS mean_sig FROM seq WHERE known GROUP BY entity),
lng AS (SELECT entity, sig, 'ols' AS model, pred AS p FROM pr
        UNION ALL SELECT pr.entity, pr.sig, 'last', lk.last_sig FROM pr JOIN lk ON pr.entity = lk.entity
        UNION ALL SELECT pr.entity, pr.sig, 'mean', lk.mean_sig FROM pr JOIN lk ON pr.entity = lk.entity),
gs AS (SELECT entity AS g, count(*) AS sz FROM seq GROUP BY entity),
gr AS (SELECT g, row_number() OVER (ORDER BY sz DESC, g) - 1 AS r FROM gs),
gf AS (SELECT g, CASE WHEN (r // 5) % 2 = 0 THEN r % 5 ELSE 4 - r % 5 END AS fold FROM gr)
SELECT model, fold, sqrt(avg((sig - p) * (sig - p))) AS rmse, count(*) AS n_rows
FROM lng JOIN gf ON lng.entity = gf.g GROUP BY model, fold""",
    "runs": """
SELECT a.model AS variant, CASE WHEN a.model = 'ols' THEN 'linear' ELSE 'naive' END AS model_family,
       'cv' AS stage, a.fold AS loop, avg(b.rmse) AS cv_mean, stddev_pop(b.rmse) AS cv_std, a.rmse AS holdout_score
FROM fold_scores AS a JOIN fold_scores AS b ON a.model = b.model AND a.fold <> b.fold
GROUP BY a.model, a.fold, a.rmse""",
}

# views that reference other views (prepended in dependency order)
DEPENDS = {"fold_scores": ["seq"], "runs": ["fold_scores", "seq"]}


def with_views(sql: str) -> str:
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql))
    needed = {v for v in VIEWS if v in words}
    for v in list(needed):
        needed.update(DEPENDS.get(v, []))
    needed = [v for v in VIEWS if v in needed]  # VIEWS order = dependency order
    if not needed:
        return sql
    ctes = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in needed)
    if re.match(r"(?is)^\s*with\s+recursive\s", sql):
        raise ValueError("recursive CTE not supported in oracle composition")
    m = re.match(r"(?is)^\s*with\s+", sql)
    if m:
        return f"WITH {ctes},\n{sql[m.end():]}"
    return f"WITH {ctes}\n{sql}"
