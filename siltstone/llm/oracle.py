"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from siltstone.llm import licenses, line_rules

# Five-word shingle sets, pairs that share a shingle, their similarity, and components by a recursive walk.
_JACCARD = r"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT r, list_slice(w, pos + 1, pos + 5) AS g FROM (SELECT r, w, unnest(range(greatest(len(w) - 4, 1))) AS pos FROM docs WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
walk(r, s) AS (SELECT r, r FROM docs UNION SELECT walk.r, sides.b FROM walk JOIN sides ON sides.a = walk.s)
SELECT d.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(e.doc_id) AS component_id
FROM walk JOIN docs d ON d.r = walk.r JOIN docs e ON e.r = walk.s LEFT JOIN sizes ON sizes.r = walk.r GROUP BY walk.r, d.doc_id"""

ORACLE: dict[str, str] = {
    "op1_diagonal_licenses": licenses.ORACLE,
    "op6_line_frequency": line_rules.ORACLE,
    "op9_partenum_jaccard": _JACCARD,
}
