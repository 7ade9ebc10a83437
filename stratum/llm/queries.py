"""The dealt operators bound to the driver tables, with their DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import (bpe, chat, decontaminate, exact_dedup, html_text, language_id, merkle, mixing, ngram_join, prefix_trie,
                         secrets, suffix_dedup, toxicity)
from stratum.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return add


@query("op3_decontaminate")
def op3(spark, sf_dir):
    return decontaminate.find_overlaps(table(spark, sf_dir, "documents", "doc_id", "text"),
                                       table(spark, sf_dir, "benchmark", "item_id", "text"))


@query("op4_language_id")
def op4(spark, sf_dir):
    return language_id.identified(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query("op9_exact_dedup", r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
w AS (SELECT h, first(doc_id ORDER BY n_chars DESC, doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY h)
SELECT n.doc_id, w.keep_id, w.group_size, n.doc_id = w.keep_id AS kept, n.h AS text_sha256
FROM n JOIN w USING (h)
""")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return exact_dedup.copy_decisions(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op6_ngram_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, md5(array_to_string(s, chr(10))) AS k FROM sh),
e AS (SELECT doc_id, unnest(s) AS g FROM sh),
pr AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e AS a JOIN e AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y, ny.k AS ky, nx.k AS kx FROM pr JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y
      WHERE 100 * c >= 90 * (nx.n_shingles + ny.n_shingles - c)),
r AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id),
d AS (SELECT x, count(DISTINCT ky) AS n_links FROM l WHERE kx <> ky GROUP BY x)
SELECT n.doc_id, n.n_shingles, c.component_id, coalesce(d.n_links, 0) AS n_links
FROM n JOIN c ON c.doc_id = n.doc_id LEFT JOIN d ON d.x = n.doc_id
""")
def op6(spark, sf_dir):
    return ngram_join.join_components(table(spark, sf_dir, "documents", "doc_id", "text"), ngram_join.Rule(3, 90, 100))


@query("op7_mixing")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return mixing.mix(docs).select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled")


@query("op1_html_extraction")
def op1(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query("op8_secret_scan")
def op8(spark, sf_dir):
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents", "doc_id", "text")))


@query("op5_toxicity")
def op5(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents", "doc_id", "text"),
                           table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query("op10_chat_formatting")
def op10(spark, sf_dir):
    return chat.format_conversations(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@query("op2_suffix_dedup")
def op2(spark, sf_dir):
    return suffix_dedup.digests(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text")))


@query("op12_bpe")
def op12(spark, sf_dir):
    import public_tokenizers
    return bpe.digests(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


# unsigned crc32 of a number's decimal text
CRC32 = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda ch: ord(ch)::UBIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]),
                           lambda x, i: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)))"""


def crc32(value: str) -> str:
    return f"xor({CRC32.format(value)}, 4294967295::UBIGINT)"


@query("op13_merkle", f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, *, {crc32("doc_id")} % 3 = 0 AS chosen,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
e AS (SELECT *, {" || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))} AS head FROM d),
leaf AS (SELECT r, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                CASE WHEN chosen AND text IS NOT NULL THEN sha256(head || strlen(low) || ':' || low) END AS bad FROM e),
node AS (
  SELECT coalesce('=' || lang, '') AS t, 0 AS lvl, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h,
         count(*) OVER (PARTITION BY lang) AS n FROM leaf
  UNION ALL
  SELECT t, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8) FROM node WHERE n > 1 GROUP BY t, lvl, i // 8),
top AS (
  SELECT 0 AS lvl, row_number() OVER (ORDER BY t) - 1 AS i, t, h, count(*) OVER () AS n FROM node WHERE n = 1
  UNION ALL
  SELECT lvl + 1, i // 8, '', sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8) FROM top WHERE n > 1 GROUP BY lvl, i // 8),
walk AS (
  SELECT r, t, lvl, i, leaf AS h, coalesce(bad, leaf) AS f, '' AS proof, n, false AS up
  FROM (SELECT l.*, coalesce('=' || lang, '') AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
               0 AS lvl, count(*) OVER (PARTITION BY lang) AS n FROM leaf AS l)
  UNION ALL
  SELECT w.r, w.t, w.lvl, w.i, w.h, w.f, w.proof, w.n, w.up
  FROM (
    SELECT w.r, CASE WHEN w.n > 1 THEN w.t ELSE '' END AS t, CASE WHEN w.n > 1 THEN w.lvl + 1 ELSE 0 END AS lvl,
           CASE WHEN w.n > 1 THEN w.i // 8 ELSE any_value(x.i) END AS i, any_value(w.h) AS h,
           CASE WHEN w.n > 1 THEN sha256(string_agg(CASE WHEN s.i = w.i THEN w.f ELSE s.h END, '' ORDER BY s.i)) ELSE any_value(w.f) END AS f,
           CASE WHEN w.n > 1 THEN w.proof || coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i <> w.i), '') ELSE any_value(w.proof) END AS proof,
           CASE WHEN w.n > 1 THEN (w.n + 7) // 8 ELSE any_value(x.n) END AS n, w.up OR w.n = 1 AS up
    FROM walk AS w
    LEFT JOIN (SELECT t, lvl, i, h, false AS up FROM node UNION ALL SELECT '', lvl, i, h, true FROM top) AS s
      ON w.n > 1 AND s.up = w.up AND s.t = w.t AND s.lvl = w.lvl AND s.i // 8 = w.i // 8
    LEFT JOIN top AS x ON NOT w.up AND w.n = 1 AND x.lvl = 0 AND x.t = w.t
    WHERE NOT (w.up AND w.n = 1)
    GROUP BY w.r, w.t, w.lvl, w.i, w.n, w.proof, w.up) AS w),
done AS (SELECT * FROM walk WHERE up AND n = 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, o.h AS root, sha256(w.proof) AS proof_sha256, w.f AS folded_root, w.f = o.h AS verified
FROM done AS w JOIN leaf AS l ON l.r = w.r JOIN node AS s ON s.n = 1 AND s.t = coalesce('=' || l.lang, '')
CROSS JOIN (SELECT h FROM top WHERE n = 1) AS o
""")
def op13(spark, sf_dir):
    return merkle.audited(table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"))


@query("op11_prefix_trie", f"""
WITH t AS (SELECT conv_id, {{'r': coalesce(role, ''), 'x': coalesce(text, '')}} AS u,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '')), md5(coalesce(text, ''))) AS j
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(u ORDER BY j) AS l, {crc32("conv_id")} % 6 AS h FROM t GROUP BY conv_id),
b AS (SELECT c.conv_id, list_concat(CASE WHEN p.l IS NULL THEN [] ELSE p.l[1:c.h] END, c.l[c.h + 1:]) AS l
      FROM own AS c LEFT JOIN own AS p ON p.conv_id = c.conv_id - c.conv_id % 100),
pre AS (SELECT conv_id, d, len(l) AS n, md5(CAST(to_json(l[1:d]) AS VARCHAR)) AS k, md5(CAST(to_json(l[1:d - 1]) AS VARCHAR)) AS pk,
               CASE WHEN d > 0 THEN length(l[d].x) ELSE 0 END AS chars FROM b, unnest(range(0, len(l) + 1)) AS u(d)),
node AS (SELECT d, k, CASE WHEN d > 0 THEN any_value(pk) END AS pk, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
         FROM pre GROUP BY d, k),
kids AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
f AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (d, k)),
sums AS (SELECT p.d, p.k, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.chars) AS saved_tokens
         FROM f JOIN pre AS p ON p.conv_id = f.conv_id AND p.d <= f.d GROUP BY p.d, p.k)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN sums USING (d, k) LEFT JOIN node AS q ON q.d = f.d - 1 AND q.k = f.pk
""")
def op11(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
