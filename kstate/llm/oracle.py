"""SQL that computes the same rows, where SQL can express the operator on whole tables."""

from __future__ import annotations

_P1 = """
c AS (SELECT DISTINCT candidate_no, candidate_type,
        CASE WHEN candidate_type = 'concept' THEN coalesce(name, '') || ' ' || description ELSE statement END AS said FROM candidate),
s AS (SELECT candidate_no, candidate_type, list_distinct(regexp_extract_all(lower(said), '[\\p{L}\\p{N}]+')) AS words
      FROM c WHERE said IS NOT NULL),
w AS (SELECT candidate_no, candidate_type, len(words) AS n, unnest(words) AS word FROM s),
j AS (SELECT a.candidate_type, a.candidate_no AS x, b.candidate_no AS y, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS m
      FROM w a JOIN w b ON a.word = b.word AND a.candidate_type = b.candidate_type AND a.candidate_no < b.candidate_no GROUP BY ALL),
p AS (SELECT candidate_type, x, y, na, nb, m FROM j WHERE 10 * m >= 6 * (na + nb - m))
"""

P1_FOUND = f"WITH {_P1} SELECT x AS candidate_no_a, y AS candidate_no_b FROM p"

P1_GROUPS = f"""WITH RECURSIVE {_P1},
cls AS (SELECT candidate_no, candidate_type, min(candidate_no) OVER (PARTITION BY candidate_type, list_sort(words)) AS class_id FROM s WHERE len(words) > 0),
e AS (SELECT x AS a, y AS b FROM p UNION SELECT y, x FROM p),
reach AS (SELECT candidate_no AS a, candidate_no AS b FROM cls UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
g AS (SELECT a AS candidate_no, min(b) AS group_id FROM reach GROUP BY a),
l AS (SELECT ca.class_id, count(DISTINCT cb.class_id) AS links FROM e JOIN cls ca ON ca.candidate_no = e.a JOIN cls cb ON cb.candidate_no = e.b
      WHERE ca.class_id <> cb.class_id GROUP BY 1)
SELECT cls.candidate_type, cls.candidate_no, cls.class_id, g.group_id, coalesce(l.links, 0) AS links
FROM cls JOIN g USING (candidate_no) LEFT JOIN l USING (class_id)
"""

P2_FOUND = """
WITH RECURSIVE r AS (
  SELECT DISTINCT object_type, internal_id, lower(trim(internal_id)) AS k, nullif(lower(trim(merged_into)), '') AS t FROM (
    SELECT 'concept' AS object_type, internal_id, merged_into FROM concept
    UNION ALL SELECT 'claim', internal_id, merged_into FROM claim)),
e AS (SELECT DISTINCT object_type, k AS a, t AS b FROM r WHERE t IS NOT NULL AND t <> k
      UNION SELECT object_type, t, k FROM r WHERE t IS NOT NULL AND t <> k),
reach AS (SELECT object_type, a AS root, a AS node FROM e
          UNION SELECT reach.object_type, reach.root, e.b FROM reach JOIN e ON e.object_type = reach.object_type AND e.a = reach.node),
comp AS (SELECT object_type, node, min(root) AS c FROM reach GROUP BY ALL),
have AS (SELECT r.object_type, r.k, min(r.internal_id) AS internal_id, any_value(comp.c) AS c
         FROM r JOIN comp ON comp.object_type = r.object_type AND comp.node = r.k GROUP BY ALL),
g AS (SELECT object_type, c, min(internal_id) AS group_id FROM have GROUP BY ALL HAVING count(*) > 1)
SELECT have.object_type, have.internal_id, g.group_id FROM have JOIN g USING (object_type, c)
"""


P5_FOUND = """
SELECT DISTINCT m.run_id, u.unit_no FROM synthesis_manifest m
JOIN normalized_unit u ON u.source_version_uri = 'kst-source:' || m.source_id || '@' || m.snapshot_id
WHERE length(u.text) > m.max_input_chars
"""

P5_PLACED = """
SELECT m.run_id, count(*) AS units, CAST(coalesce(sum(length(u.text)), 0) AS BIGINT) AS chars, true AS limits_kept
FROM (SELECT DISTINCT run_id, source_id, snapshot_id FROM synthesis_manifest) m
JOIN (SELECT DISTINCT unit_no, source_version_uri, text FROM normalized_unit) u ON u.source_version_uri = 'kst-source:' || m.source_id || '@' || m.snapshot_id GROUP BY m.run_id
"""

P8_COVERED = r"""
SELECT doc_id, md5(b) AS signs_md5 FROM (SELECT DISTINCT doc_id, regexp_replace(text, '[\s\p{Z}\x{1C}-\x{1F}\x{85}]+', '', 'g') AS b FROM documents) WHERE b <> ''
"""

_P6 = """
i AS (SELECT DISTINCT item_id, suite, lower(nfc_normalize(text)) AS t, substr(lower(lang), 1, 2) IN ('zh', 'ja') AS by_sign FROM eval_item),
d AS (SELECT DISTINCT doc_id, lower(nfc_normalize(text)) AS t FROM documents WHERE text IS NOT NULL),
iw AS (SELECT item_id, by_sign, CASE WHEN by_sign THEN 20 ELSE 12 END AS n,
         CASE WHEN by_sign THEN regexp_extract_all(t, '[\\p{L}\\p{N}]') ELSE regexp_extract_all(t, '[\\p{L}\\p{N}]+') END AS w FROM i),
ik AS (SELECT DISTINCT item_id, by_sign, array_to_string(list_slice(w, k, k + n - 1), ' ') AS win
       FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM iw WHERE len(w) >= n)),
dw AS (SELECT doc_id, false AS by_sign, 12 AS n, regexp_extract_all(t, '[\\p{L}\\p{N}]+') AS w FROM d
       UNION ALL SELECT doc_id, true, 20, regexp_extract_all(t, '[\\p{L}\\p{N}]') FROM d WHERE regexp_matches(t, '[\\p{Han}\\p{Hiragana}\\p{Katakana}]')),
dk AS (SELECT doc_id, by_sign, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS win
       FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS k FROM dw WHERE len(w) >= n)),
f AS (SELECT doc_id, item_id, count(*) AS windows FROM dk JOIN ik USING (by_sign, win) GROUP BY ALL)
"""

P6_FOUND = f"WITH {_P6} SELECT doc_id, item_id FROM f"

P6_ITEMS = f"""WITH {_P6}
SELECT i.item_id, i.suite, count(f.doc_id) AS documents, CAST(coalesce(sum(f.windows), 0) AS BIGINT) AS windows FROM i LEFT JOIN f USING (item_id) GROUP BY ALL
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_FOUND, "p1_groups": P1_GROUPS, "p2_found": P2_FOUND, "p5_found": P5_FOUND, "p5_placed": P5_PLACED, "p8_covered": P8_COVERED, "p6_found": P6_FOUND, "p6_items": P6_ITEMS}
