"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from silverbrook.llm.divergence import ORACLE as DIVERGENCE
from silverbrook.llm.mixing import ORACLE as MIXING
from silverbrook.llm.vector_codes import ORACLE as CODES

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda s: array_to_string(ws[s:s + 3], ' ')) END) AS g FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_have p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(other) AS component_id FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

SUBSTRINGS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 18), lambda s: struct_pack(s := s, k := array_to_string(ws[s:s + 19], ' ')))) AS x FROM w WHERE len(ws) >= 20),
again AS (SELECT doc_id, s FROM (SELECT doc_id, x.s AS s, row_number() OVER (PARTITION BY x.k ORDER BY doc_id, x.s) AS r FROM starts) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM again),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

SQL = {
    "op4_ngram_jaccard_join": JACCARD,
    "op8_substring_dedup": SUBSTRINGS,
    "op9_mix_sources": MIXING,
    "op12_vector_codes": CODES,
    "op13_source_divergence": DIVERGENCE,
}
