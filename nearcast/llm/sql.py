"""DuckDB SQL of operator queries that need more than a few lines."""

from __future__ import annotations

#: Unsigned CRC-32 of a text, bit by bit (reflected polynomial 0xEDB88320).
CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"""


def _leaf_sql(n_chars: str) -> str:
    parts = [f"coalesce(octet_length(encode({c}))::VARCHAR || ':' || {c}, '-')" for c in ("doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text")]
    return f"sha256({' || '.join(parts)})"


MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf,
         CASE WHEN {CRC32.format('doc_id::VARCHAR')} % 7 = 0 THEN {_leaf_sql('n_chars + 1')} ELSE {_leaf_sql('n_chars')} END AS held
  FROM documents),
place AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t
  FROM d),
low(t, level, i, n, h) AS (
  SELECT t, 0, i, n, leaf FROM place
  UNION ALL
  SELECT t, level + 1, i // 2, (n + 1) // 2, sha256(h || coalesce(r, ''))
  FROM (SELECT *, lead(h) OVER (PARTITION BY t ORDER BY i) AS r FROM low WHERE n > 1) AS x WHERE i % 2 = 0),
sub AS (SELECT t, level AS height, h FROM low WHERE n = 1),
up(level, i, n, h) AS (
  SELECT 0, t, (SELECT count(*) FROM sub), h FROM sub
  UNION ALL
  SELECT level + 1, i // 2, (n + 1) // 2, sha256(h || coalesce(r, ''))
  FROM (SELECT *, lead(h) OVER (ORDER BY i) AS r FROM up WHERE n > 1) AS x WHERE i % 2 = 0),
step AS (
  SELECT p.t, p.i, l.level AS k, l.i % 2 AS side, s.h AS other
  FROM place AS p JOIN low AS l ON l.t = p.t AND l.n > 1 AND l.i = p.i >> l.level
  LEFT JOIN low AS s ON s.t = l.t AND s.level = l.level AND s.i = xor(l.i, 1)
  UNION ALL
  SELECT p.t, p.i, sub.height + u.level, u.i % 2, s.h
  FROM place AS p JOIN sub ON sub.t = p.t JOIN up AS u ON u.n > 1 AND u.i = p.t >> u.level
  LEFT JOIN up AS s ON s.level = u.level AND s.i = xor(u.i, 1)),
fold(t, i, k, h) AS (
  SELECT t, i, 0::BIGINT, held FROM place
  UNION ALL
  SELECT f.t, f.i, f.k + 1, CASE WHEN s.other IS NULL THEN sha256(f.h) WHEN s.side = 0 THEN sha256(f.h || s.other) ELSE sha256(s.other || f.h) END
  FROM fold AS f JOIN step AS s ON s.t = f.t AND s.i = f.i AND s.k = f.k),
proof AS (SELECT t, i, string_agg(other, '' ORDER BY k) AS path FROM step GROUP BY t, i),
ended AS (SELECT t, i, max_by(h, k) AS h FROM fold GROUP BY t, i),
top AS (SELECT h FROM up WHERE n = 1)
SELECT p.doc_id, p.leaf, sub.h AS subroot, top.h AS root, sha256(coalesce(proof.path, '')) AS proof_sha256,
       ended.h AS folded_root, ended.h = top.h AS verified
FROM place AS p JOIN sub ON sub.t = p.t JOIN ended ON ended.t = p.t AND ended.i = p.i CROSS JOIN top
LEFT JOIN proof ON proof.t = p.t AND proof.i = p.i"""
