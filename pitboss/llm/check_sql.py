"""DuckDB SQL of the text queries that SQL can express, written from their
meaning: edits are found by words that share a cut, trees by recursion."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# One row: the remainders of all bytes by the CRC-32 polynomial.
_CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(v ORDER BY k) AS tab FROM (
    SELECT k, list_reduce(list_prepend(k, range(8)),
      lambda a, bit: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(k)) t)"""


def _crc(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, with ``tab`` in scope."""
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    numbers = f"list_transform({pairs}, lambda h: ('0x' || h)::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {numbers}), "
            "lambda a, b: xor(tab[1 + (xor(a, b) & 255)], a >> 8)), 4294967295)")


SPELLING_VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS run FROM documents),
drawn AS (
  SELECT run, n, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
  FROM (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL) r, crc_table),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                   ELSE run END AS word FROM drawn) d
  GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5),
cuts AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words) w),
near AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cuts c JOIN words w ON w.word = c.cut
  UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.cut),
best AS (
  SELECT a, count(*) AS n_near, arg_max(b, (n, -place)) AS form, max(n) AS form_n
  FROM (SELECT near.*, w.n, row_number() OVER (ORDER BY b) AS place FROM near JOIN words w ON w.word = near.b) x GROUP BY a),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
         CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best ON a = w.word),
chains AS (
  SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL SELECT c.word, f.form, steps + 1 FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, steps) AS root FROM chains GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""


def _written(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_written(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE_MANIFEST = f"""
WITH RECURSIVE {_CRC_TABLE},
rows AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf('text')} AS leaf,
    CASE WHEN {_crc("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")}
         ELSE {_leaf('text')} END AS now
  FROM documents, crc_table),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS n, {_written('lang')} AS grp, row_number() OVER () AS id FROM rows),
-- nodes of the languages' trees: height, place and number of nodes at that height
nodes AS MATERIALIZED (
  SELECT grp, 0 AS height, place, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT grp, height + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY grp, height, place // 8, n),
langs AS MATERIALIZED (
  SELECT l.lang, l.grp, d.digest AS subroot, row_number() OVER (ORDER BY l.lang NULLS FIRST) - 1 AS place,
    count(*) OVER () AS n
  FROM (SELECT DISTINCT lang, grp FROM leaves) l JOIN nodes d ON d.grp = l.grp AND d.n = 1),
tops AS MATERIALIZED (
  SELECT 0 AS height, place, n, subroot AS digest FROM langs
  UNION ALL
  SELECT height + 1, place // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM tops WHERE n > 1 GROUP BY height, place // 8, n),
-- each leaf's way: at every step what stands left and right of its node
ways AS (
  SELECT v.id, x.height AS step, v.place // (8 ** x.height)::BIGINT AS own, x.place, x.digest
  FROM leaves v JOIN nodes x ON x.grp = v.grp AND x.n > 1
    AND x.place // 8 = (v.place // (8 ** x.height)::BIGINT) // 8
  UNION ALL
  SELECT v.id, 1000 + x.height, l.place // (8 ** x.height)::BIGINT, x.place, x.digest
  FROM leaves v JOIN langs l ON l.grp = v.grp JOIN tops x ON x.n > 1
    AND x.place // 8 = (l.place // (8 ** x.height)::BIGINT) // 8),
steps AS MATERIALIZED (
  SELECT id, row_number() OVER (PARTITION BY id ORDER BY step) AS k,
    coalesce(string_agg(digest, '' ORDER BY place) FILTER (WHERE place < own), '') AS lft,
    coalesce(string_agg(digest, '' ORDER BY place) FILTER (WHERE place > own), '') AS rgt
  FROM ways GROUP BY id, step),
folds AS (
  SELECT id, 0::BIGINT AS k, now AS node FROM leaves
  UNION ALL SELECT f.id, s.k, sha256(lft || node || rgt) FROM folds f JOIN steps s ON s.id = f.id AND s.k = f.k + 1),
folded AS (SELECT id, arg_max(node, k) AS folded_root FROM folds GROUP BY id),
proofs AS (SELECT id, sha256(string_agg(lft || rgt, '' ORDER BY k)) AS proof FROM steps GROUP BY id)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN langs USING (grp) JOIN folded USING (id) LEFT JOIN proofs USING (id),
     (SELECT digest AS root FROM tops WHERE n = 1) r
"""

JACCARD_JOIN = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reached AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT s.doc_id, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE min(s.doc_id) OVER (PARTITION BY list_sort(s.s)) END AS set_id,
  len(s.s)::BIGINT AS n_shingles, c.component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) c USING (doc_id)
"""

MTREE_TOP_K = """
WITH vectors AS MATERIALIZED (
  SELECT vec_id, list_transform(v, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM (SELECT vec_id, embedding AS v FROM embeddings) e
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

SQL: dict[str, str] = {
    "op2_jaccard_join": JACCARD_JOIN,
    "op5_mtree_top_k": MTREE_TOP_K,
    "op12_spelling_variants": SPELLING_VARIANTS,
    "op13_merkle_manifest": MERKLE_MANIFEST,
}
