"""SQL that computes the same rows as the queries of the same names."""

from __future__ import annotations

from kstate.plans import extraction
from kstate.sources.formats import format_rows, extension_rows

# label, token and path rules as macros written out, since each statement stands alone
def _label(x: str) -> str:
    return rf"trim(regexp_replace(replace(replace(lower(nfc_normalize({x})), 'ß', 'ss'), 'ς', 'σ'), '[\s\p{{Z}}]+', ' ', 'g'))"


def _title(x: str) -> str:
    return _label(rf"regexp_replace(regexp_replace(split_part({x}, '/', -1), '(?i)\.md$', ''), '[-_]+', ' ', 'g')")


def _normal(x: str) -> str:
    return rf"nfc_normalize(regexp_replace({x}, '\r\n?', chr(10), 'g'))"


def _esc(x: str) -> str:
    """A string as the inside of a JSON literal in ASCII."""
    u = "unicode(c)"
    short = " ".join(f"WHEN {u} = {n} THEN chr(92) || '{c}'" for n, c in ((8, "b"), (9, "t"), (10, "n"), (12, "f"), (13, "r")))
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '(?s).'), lambda c: CASE WHEN {u} IN (34, 92) THEN chr(92) || c {short} WHEN {u} BETWEEN 32 AND 126 THEN c "
        f"WHEN {u} < 65536 THEN chr(92) || printf('u%04x', {u}) ELSE chr(92) || printf('u%04x', 55296 + (({u} - 65536) >> 10)) || chr(92) || printf('u%04x', 56320 + (({u} - 65536) & 1023)) END), '')"
    )


def _literal(x: str) -> str:
    return f"""coalesce('"' || {_esc(x)} || '"', 'null')"""


def _strings(x: str) -> str:
    return f"""'[' || coalesce(array_to_string(list_transform({x}, lambda e: '"' || e || '"'), ','), '') || ']'"""


RAW = "SELECT * FROM raw_unit QUALIFY row_number() OVER (PARTITION BY unit_no) = 1"
NORMAL = "SELECT * FROM normalized_unit QUALIFY row_number() OVER (PARTITION BY unit_no) = 1"
CAND = "SELECT * FROM candidate QUALIFY row_number() OVER (PARTITION BY candidate_no) = 1"
CATALOG = "SELECT * FROM catalog_concept QUALIFY row_number() OVER (PARTITION BY internal_id) = 1"
ANCHOR = "'a-sha256-' || sha256('{\"basis\":\"kst-anchor-v1\",\"kind\":' || to_json(kind) || ',\"native_locator\":' || native_locator || ',\"source_path\":' || to_json(source_path) || '}')"


def _latest(name: str) -> str:
    return (
        f"SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY internal_id ORDER BY recorded_at DESC NULLS LAST, "
        "'{\"status\":' || coalesce(to_json(status), 'null') || ',\"merged_into\":' || coalesce(to_json(merged_into), 'null') || '}') = 1"
    )


def _values(rows) -> str:  # noqa: ANN001
    return ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows)


RUN_UNITS = f"""
m AS (SELECT DISTINCT run_id, 'kst-source:' || source_id || '@' || snapshot_id AS v, max_input_chars AS mc, max_batch_units AS mu FROM synthesis_manifest),
nu AS ({NORMAL}),
ru AS (SELECT m.run_id, nu.unit_no, nu.anchor_uri, coalesce(length(nu.text), 0) AS size, m.mc, m.mu,
         row_number() OVER (PARTITION BY m.run_id ORDER BY nu.unit_no) AS rn FROM nu JOIN m ON nu.source_version_uri = m.v),
fold AS (SELECT run_id, unit_no, rn, size, 1 AS b, size AS chars, 1 AS n FROM ru WHERE rn = 1
  UNION ALL SELECT r.run_id, r.unit_no, r.rn, r.size, CASE WHEN f.n >= r.mu OR f.chars + r.size > r.mc THEN f.b + 1 ELSE f.b END,
    CASE WHEN f.n >= r.mu OR f.chars + r.size > r.mc THEN r.size ELSE f.chars + r.size END, CASE WHEN f.n >= r.mu OR f.chars + r.size > r.mc THEN 1 ELSE f.n + 1 END
  FROM fold f JOIN ru r ON r.run_id = f.run_id AND r.rn = f.rn + 1)
"""

KEYS = f"""
cat AS ({CATALOG}),
keys AS (SELECT DISTINCT internal_id, kind, key FROM (
  SELECT internal_id, 'title' AS kind, {_label('title')} AS key FROM cat
  UNION ALL SELECT internal_id, 'alias', {_label('x')} FROM (SELECT internal_id, unnest(aliases) AS x FROM cat)
  UNION ALL SELECT internal_id, 'title_history', {_label('x')} FROM (SELECT internal_id, unnest(title_history) AS x FROM cat)
  UNION ALL SELECT internal_id, 'path', {_title('canonical_path')} FROM cat
  UNION ALL SELECT internal_id, 'path_history', {_title('x')} FROM (SELECT internal_id, unnest(path_history) AS x FROM cat)) WHERE key IS NOT NULL),
cand AS ({CAND}),
cc AS (SELECT *, {_label('name')} AS nk FROM cand WHERE candidate_type = 'concept')
"""

LADDER = f"""{KEYS},
nm AS (SELECT cc.candidate_no, keys.internal_id, list_sort(list(DISTINCT kind)) AS kinds FROM cc JOIN keys ON cc.nk = keys.key WHERE cc.nk <> '' GROUP BY ALL),
j AS (SELECT nm.*, cc.evidence_anchors AS ev, cat.source_anchors AS sa, cat.resource_uris AS ru FROM nm JOIN cc USING (candidate_no) JOIN cat USING (internal_id)),
lp AS (SELECT candidate_no, internal_id, 1 AS tier FROM j WHERE list_has_any(ev, sa)
  UNION ALL SELECT candidate_no, internal_id, 2 FROM j WHERE list_has_any(list_transform(list_filter(ev, lambda a: contains(a, '#')), lambda a: split_part(a, '#', 1)), ru)
  UNION ALL SELECT candidate_no, internal_id, 3 FROM j WHERE list_has_any(kinds, ['alias', 'title_history'])
  UNION ALL SELECT candidate_no, internal_id, 4 FROM j WHERE NOT list_has_any(kinds, ['alias', 'title_history']) AND list_has_any(kinds, ['title', 'path', 'path_history']))
"""

# -- planning ------------------------------------------------------------------------------------------

PLAN = f"""
cand AS ({CAND}),
res AS (SELECT * FROM resolution QUALIFY row_number() OVER (PARTITION BY candidate_no) = 1),
kc AS (SELECT * FROM ({_latest('claim')}) WHERE status <> 'merged'),
c0 AS (SELECT cand.candidate_no AS o, r.status, {_label("coalesce(cand.name, '')")} || chr(1) || {_label("coalesce(cand.description, '')")} AS k, cand.name, cand.description, cand.run_id, cand.batch_id,
        r.resolved_internal_id AS rid, len(r.considered_internal_ids) AS nc, coalesce(lower(trim(cand.name)) IN ('tbd', '(untitled)', 'unknown', '???', '-'), false) AS dec
      FROM cand JOIN res r USING (candidate_no) WHERE cand.candidate_type = 'concept'),
c1 AS (SELECT k, min(o) AS first FROM c0 WHERE NOT dec AND status = 'new' GROUP BY k),
co AS (SELECT c0.*, c1.first,
        CASE WHEN dec THEN 'ignore' WHEN status = 'matched' THEN 'update' WHEN status = 'ambiguous' THEN 'ignore' WHEN o = first THEN 'create' ELSE 'merge' END AS operation,
        CASE WHEN dec THEN 'placeholder' WHEN status = 'matched' THEN 'resolved-existing-concept' WHEN status = 'ambiguous' THEN 'identity-ambiguous' WHEN o = first THEN 'resolved-new-concept' ELSE 'exact-new-concept-duplicate' END AS reason,
        CASE WHEN dec THEN 0 WHEN status = 'matched' THEN 1 WHEN status = 'ambiguous' THEN nc WHEN o = first THEN 0 ELSE 1 END AS targets,
        CASE WHEN NOT dec AND status = 'new' AND o <> first THEN first END AS after
      FROM c0 LEFT JOIN c1 USING (k)),
s0 AS (SELECT o, {_label('description')} AS k FROM c0 WHERE description IS NOT NULL),
so AS (SELECT o, k, min(o) OVER (PARTITION BY k) AS first FROM s0),
q0 AS (SELECT candidate_no AS o, {_label('statement')} AS k, statement LIKE 'No %' AS dec FROM cand WHERE candidate_type = 'claim' AND statement IS NOT NULL),
kk AS (SELECT {_label('statement')} AS k, count(*) AS n FROM kc GROUP BY 1),
q1 AS (SELECT q0.*, coalesce(kk.n, 0) AS n FROM q0 LEFT JOIN kk USING (k)),
q2 AS (SELECT k, min(o) AS first FROM q1 WHERE NOT dec AND n = 0 GROUP BY k),
qo AS (SELECT q1.*, q2.first,
        CASE WHEN dec THEN 'contradict' WHEN n = 1 THEN 'update' WHEN n > 1 THEN 'ignore' WHEN o = first THEN 'create' ELSE 'merge' END AS operation,
        CASE WHEN dec THEN 'denies' WHEN n = 1 THEN 'exact-existing-claim' WHEN n > 1 THEN 'existing-claim-duplicate-ambiguous' WHEN o = first THEN 'new-claim' ELSE 'exact-new-claim-duplicate' END AS reason,
        CASE WHEN dec THEN 1 WHEN n >= 1 THEN n WHEN o = first THEN 0 ELSE 1 END AS targets, CASE WHEN NOT dec AND n = 0 AND o <> first THEN first END AS after
      FROM q1 LEFT JOIN q2 USING (k)),
r0 AS (SELECT candidate_no AS o, lag(candidate_no) OVER (PARTITION BY run_id, batch_id ORDER BY candidate_no) AS s FROM cand WHERE candidate_type = 'concept'),
en AS (SELECT o, CASE WHEN operation = 'ignore' THEN NULL WHEN status = 'matched' THEN rid ELSE CAST(first AS VARCHAR) END AS id FROM co),
r1 AS (SELECT r0.o, r0.s, a.id AS sid, b.id AS oid, a.o IS NOT NULL AS ha, b.o IS NOT NULL AS hb FROM r0 LEFT JOIN en a ON a.o = r0.s LEFT JOIN en b ON b.o = r0.o WHERE r0.s IS NOT NULL),
kr AS (SELECT DISTINCT a.resolved_internal_id AS sid, b.resolved_internal_id AS oid FROM r0 JOIN res a ON a.candidate_no = r0.s JOIN res b ON b.candidate_no = r0.o
  WHERE a.status = 'matched' AND b.status = 'matched' AND right(a.resolved_internal_id, 1) < '8'),
r2 AS (SELECT sid, oid, min(o) AS first FROM r1 WHERE sid IS NOT NULL AND oid IS NOT NULL AND (sid, oid) NOT IN (SELECT (sid, oid) FROM kr) GROUP BY ALL),
ro AS (SELECT r1.*, r2.first, CASE WHEN r1.sid IS NULL OR r1.oid IS NULL THEN 'ignore' WHEN kr.sid IS NOT NULL THEN 'update' WHEN o = first THEN 'create' ELSE 'merge' END AS operation,
        CASE WHEN r1.sid IS NULL OR r1.oid IS NULL THEN 'relation-endpoint-unresolved' WHEN kr.sid IS NOT NULL THEN 'exact-existing-relation' WHEN o = first THEN 'new-relation' ELSE 'exact-new-relation-duplicate' END AS reason
      FROM r1 LEFT JOIN r2 ON r1.sid = r2.sid AND r1.oid = r2.oid LEFT JOIN kr ON r1.sid = kr.sid AND r1.oid = kr.oid)
"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["infer_provider"] = r"""
WITH l AS (SELECT DISTINCT a || source_path || b AS locator FROM documents, (VALUES ('', ''), ('git+https://h/', ''), ('user@host:', ''), ('https://h/', '.git'), ('http://h/', ''), ('file:///', ''), ('ssh://h/', ''), ('git://h/', ''), ('https://h/', '?x=.git')) v(a, b) WHERE source_path IS NOT NULL)
SELECT locator, CASE WHEN starts_with(locator, 'git+') THEN 'git' WHEN regexp_matches(locator, '^[^/@:\s]+@[^/:\s]+:') THEN 'git'
  WHEN regexp_matches(locator, '^(?i)https?://') THEN CASE WHEN ends_with(regexp_replace(locator, '[?#].*$', ''), '.git') THEN 'git' ELSE 'http' END
  WHEN regexp_matches(locator, '^(git|ssh)://') THEN 'git' ELSE 'local' END AS provider FROM l"""
    q["source_id_valid"] = """SELECT source_id, coalesce(regexp_matches(source_id, '^[A-Za-z0-9][A-Za-z0-9._-]*$'), false) AS valid
FROM (SELECT DISTINCT unnest([source, source_path, '-' || source]) AS source_id FROM documents)"""
    q["safe_path"] = """SELECT path, coalesce(path <> '' AND NOT starts_with(path, '/') AND NOT contains(path, '\\') AND NOT list_has_any(string_split(path, '/'), ['', '.', '..']), false) AS safe
FROM (SELECT DISTINCT unnest([source_path, '/' || source_path, '../' || source_path, source_path || '/..']) AS path FROM documents)"""
    q["tree_fingerprint"] = """
WITH e AS (SELECT source, source_path || '/' || doc_id AS path, CAST(strlen(coalesce(text, '')) AS VARCHAR) AS size, sha256(coalesce(text, '')) AS h FROM documents),
l AS (SELECT source, path, sha256(coalesce(strlen(path) || ':' || path, '-') || ' 4:file ' || strlen(size) || ':' || size || ' 64:' || h || ' 5:false -') AS line FROM e),
p AS (SELECT source, sha256(path)[1:3] AS part, count(*) AS n, sha256(string_agg(line, chr(10) ORDER BY line)) AS h FROM l GROUP BY ALL)
SELECT source, CAST(sum(n) AS BIGINT) AS entries, sha256('kst-tree-v2' || chr(10) || string_agg(h, chr(10) ORDER BY part)) AS fingerprint FROM p GROUP BY source"""
    q["tree_difference"] = """
WITH a AS (SELECT unit_no, source_path FROM raw_unit), b AS (SELECT unit_no, source_path FROM normalized_unit)
SELECT *, 'left' AS side FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT *, 'right' FROM (FROM b EXCEPT ALL FROM a)"""
    ext = r"nullif(CASE WHEN regexp_matches(n, '^\.*[^.]+$') THEN '' ELSE lower(regexp_extract(n, '\.([^.]+)$', 1)) END, '')"
    q["classify_extension"] = f"""
WITH p AS (SELECT DISTINCT unnest([source_path, upper(source_path), source_path || '.tar.gz', 'a/.' || source]) AS path FROM documents), n AS (SELECT path, split_part(path, '/', -1) AS n FROM p)
SELECT path, {ext} AS extension FROM n"""
    ladder = f"""
x AS (SELECT * FROM (VALUES {_values([(r[0], r[1], r[5]) for r in extension_rows()])}) v(extension, ef, evidence)),
f AS (SELECT * FROM (VALUES {_values(format_rows())}) v(format, media_type, family, route)),
d AS (SELECT doc_id, {ext} AS extension, coalesce(text, '') AS t FROM (SELECT *, split_part(source_path, '/', -1) AS n FROM documents)),
k AS (SELECT d.doc_id, d.extension, ef, evidence, CASE WHEN evidence = 'text' THEN ef ELSE 'text' END AS format FROM d LEFT JOIN x USING (extension)),
y AS (SELECT k.doc_id, k.extension, k.format, f.media_type, f.family, f.route, CASE WHEN evidence = 'text' THEN 'extension+text' ELSE 'text-probe' END AS basis, CASE WHEN evidence = 'text' THEN 'supported' ELSE 'generic' END AS strength,
  CASE WHEN evidence <> 'text' THEN 'extension-signature-mismatch:' || ef ELSE '' END AS diagnostics FROM k JOIN f USING (format))"""
    q["classify_ladder"] = f"WITH {ladder} SELECT doc_id, extension, format, media_type, family, route, basis, strength, coalesce(diagnostics, '') AS diagnostics FROM y"
    q["classify_summary"] = f"""WITH {ladder} SELECT 'all' AS kind, NULL AS value, count(*) AS n FROM y UNION ALL SELECT 'entry_kind', 'file', count(*) FROM y
UNION ALL SELECT 'family', family, count(*) FROM y GROUP BY ALL UNION ALL SELECT 'format', format, count(*) FROM y GROUP BY ALL"""
    q["text_probe"] = """
WITH t AS (SELECT doc_id, length(source_path) % 3 AS c, coalesce(text, '') || repeat(chr(1), CAST(length(source_path) % 3 AS INT)) AS t FROM documents)
SELECT doc_id, c AS controls, CASE WHEN doc_id % 7 = 0 THEN CASE WHEN t = '' THEN 'empty' ELSE 'utf-16' END WHEN doc_id % 11 = 0 THEN 'utf-8-sig' WHEN doc_id % 13 = 0 THEN NULL
  WHEN t = '' THEN 'empty' WHEN c <= greatest(1, length(t) // 100) THEN 'utf-8' END AS encoding FROM t"""
    q["tree_rows"] = """
WITH e AS (SELECT doc_id % 3 AS k, concat_ws('/', source_path, CAST(doc_id AS VARCHAR)) AS path, source_path FROM documents WHERE doc_id % 3 > 0)
SELECT path, CASE WHEN k = 1 THEN 'directory' ELSE 'symlink' END AS kind, CASE WHEN k = 2 AND source_path IS NOT NULL THEN '{"target":' || to_json(source_path) || '}' ELSE '{}' END AS data,
  '{"path":' || to_json(path) || '}' AS native_locator, CASE WHEN k = 2 THEN 'symlink-not-dereferenced' ELSE '' END AS diagnostics FROM e"""
    q["zip_members"] = """
WITH d AS (SELECT doc_id || '.zip' AS path, text FROM documents WHERE text IS NOT NULL)
SELECT path, 'a.txt' AS member, 'archive-member' AS kind, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size FROM d
UNION ALL SELECT path, 'b.txt', 'archive-member', sha256(array_to_string(list_reverse(regexp_extract_all(text, '(?s).')), '')), CAST(strlen(text) AS BIGINT) FROM d"""
    q["text_units"] = "SELECT concat_ws('/', source_path, CAST(doc_id AS VARCHAR)) AS path, 'text-document' AS kind, sha256(text) AS sha256, length(text) AS chars FROM documents WHERE text IS NOT NULL"
    q["unit_numbers"] = f"SELECT unit_no, 'u' || lpad(CAST(row_number() OVER (PARTITION BY source_id, snapshot_id ORDER BY unit_no) AS VARCHAR), 6, '0') AS unit_id FROM ({RAW})"
    q["kind_counts"] = f"SELECT source_id, snapshot_id, kind, count(*) AS n FROM ({RAW}) GROUP BY ALL"
    q["member_guard"] = f"""
WITH u AS (SELECT unit_no, strlen(coalesce(text, '')) AS size, CAST(sum(strlen(coalesce(text, ''))) OVER w AS BIGINT) AS running, count(*) OVER w AS number FROM ({RAW})
  WINDOW w AS (PARTITION BY source_id, snapshot_id ORDER BY unit_no ROWS UNBOUNDED PRECEDING))
SELECT unit_no, running, number FROM u WHERE number > 40 OR size > 4000 OR running > 16000"""
    q["normalize_text"] = f"SELECT unit_no, md5({_normal('text')}) AS text_md5 FROM ({RAW})"
    q["normalize_parity"] = f"SELECT a.unit_no FROM ({RAW}) a JOIN ({NORMAL}) b USING (unit_no) WHERE a.unit_no % 89 = 0 AND a.text IS NOT NULL"
    q["source_uris"] = "SELECT DISTINCT source_id, snapshot_id, 'kst-source:' || source_id AS source_uri, 'kst-source:' || source_id || '@' || snapshot_id AS source_version_uri FROM raw_unit"
    q["anchor_ids"] = f"SELECT unit_no, {ANCHOR} AS anchor_id FROM ({RAW})"
    q["anchor_collisions"] = f"""
WITH r AS ({RAW}), u AS (SELECT source_id, CASE WHEN unit_no % 40 = 0 THEN 'same.md' ELSE source_path END AS source_path, CASE WHEN unit_no % 40 = 0 THEN 'text' ELSE kind END AS kind, CASE WHEN unit_no % 40 = 0 THEN '{{}}' ELSE native_locator END AS native_locator FROM r)
SELECT source_id, anchor_id, count(*) AS rows FROM (SELECT source_id, {ANCHOR} AS anchor_id FROM u) GROUP BY ALL HAVING count(*) > 1"""
    q["content_hashes"] = f"""SELECT unit_no, sha256('{{"data":' || data || ',"diagnostics":' || {_strings('diagnostics')} || ',"kind":' || {_literal('kind')} || ',"metadata":' || metadata || ',"native_locator":' || native_locator
  || ',"source_path":' || {_literal('source_path')} || ',"text":' || {_literal(_normal('text'))} || '}}') AS content_sha256 FROM ({RAW})"""
    q["unit_id_repeats"] = "SELECT source_id, snapshot_id, unit_id, count(*) AS rows FROM raw_unit GROUP BY ALL HAVING count(*) > 1"
    q["path_collisions"] = f"""
SELECT source_id, 'café/' || nfc_normalize(source_path) AS nfc_path, 1 + max(CAST(kind = 'page' AS INT)) AS spellings FROM ({RAW}) GROUP BY ALL HAVING spellings > 1"""
    q["unit_faults"] = f"SELECT unit_no, ['unit_id', 'source_path', 'kind', 'native_locator', 'diagnostics'][unit_no % 61] AS fault FROM ({RAW}) WHERE unit_no % 61 BETWEEN 1 AND 5"
    q["count_differences"] = f"""
WITH r AS (SELECT source_id, snapshot_id, sum(len(diagnostics)) AS dc FROM ({RAW}) GROUP BY ALL),
m AS (SELECT DISTINCT s.source_id, s.snapshot_id, unit_count, coalesce(dc, 0) AS dc FROM synthesis_manifest s LEFT JOIN r USING (source_id, snapshot_id)),
u AS (SELECT regexp_extract(source_version_uri, '^kst-source:([^@]*)@', 1) AS source_id, split_part(source_version_uri, '@', -1) AS snapshot_id, count(*) AS units, sum(len(diagnostics)) AS notes FROM ({NORMAL}) GROUP BY ALL),
j AS (SELECT source_id, snapshot_id, coalesce(unit_count, 0) AS unit_count, coalesce(units, 0) AS units, CAST(coalesce(dc, 0) AS BIGINT) AS diagnostic_count, CAST(coalesce(notes, 0) AS BIGINT) AS notes FROM m FULL JOIN u USING (source_id, snapshot_id))
SELECT * FROM j WHERE units <> unit_count OR notes <> diagnostic_count"""
    q["diagnostic_counts"] = f"SELECT diagnostic, count(*) AS n FROM (SELECT unnest(diagnostics) AS diagnostic FROM ({RAW})) GROUP BY ALL"
    q["unit_counts"] = f"""
SELECT source_id, count(*) AS units, count(DISTINCT snapshot_id) AS snapshots, count(DISTINCT {ANCHOR}) AS anchors, CAST(coalesce(sum(length({_normal('text')})), 0) AS BIGINT) AS chars FROM ({RAW}) GROUP BY ALL"""
    q["ordered_batches"] = f"WITH RECURSIVE {RUN_UNITS} SELECT run_id, unit_no, 'b' || lpad(CAST(b AS VARCHAR), 4, '0') AS batch_id FROM fold"
    q["batch_sizes"] = f"WITH RECURSIVE {RUN_UNITS} SELECT run_id, 'b' || lpad(CAST(b AS VARCHAR), 4, '0') AS batch_id, count(*) AS units, CAST(sum(size) AS BIGINT) AS chars FROM fold GROUP BY ALL"
    body = f"""'{{"anchor_uri":' || {_literal('anchor_uri')} || ',"content_sha256":' || {_literal('content_sha256')} || ',"data":' || data || ',"diagnostics":' || {_strings('diagnostics')} || ',"kind":' || {_literal('kind')}
  || ',"metadata":' || metadata || ',"native_locator":' || native_locator || ',"source_path":' || {_literal('source_path')} || ',"text":' || {_literal('text')} || ',"unit_id":' || {_literal('unit_id')} || '}}'"""
    q["unit_renderings"] = f"SELECT unit_no, md5(j) AS json_md5, length(j) AS chars FROM (SELECT unit_no, {body} AS j FROM ({NORMAL}))"
    q["rendered_batches"] = f"""
WITH RECURSIVE m AS (SELECT DISTINCT run_id, 'kst-source:' || source_id || '@' || snapshot_id AS v FROM synthesis_manifest),
j AS (SELECT unit_no, source_uri, source_version_uri, length({body}) AS n FROM ({NORMAL})),
u AS (SELECT run_id, unit_no, n, 3 * max(n) OVER (PARTITION BY run_id) + 200 - length('{{"source_uri":"' || source_uri || '","source_version_uri":"' || source_version_uri || '","units":[]}}') AS room, row_number() OVER (PARTITION BY run_id ORDER BY unit_no) AS rn
  FROM j JOIN m ON source_version_uri = v),
f AS (SELECT run_id, unit_no, rn, 1 AS b, n AS chars, 1 AS k FROM u WHERE rn = 1
  UNION ALL SELECT u.run_id, u.unit_no, u.rn, CASE WHEN k >= 12 OR chars + 1 + n > room THEN b + 1 ELSE b END, CASE WHEN k >= 12 OR chars + 1 + n > room THEN n ELSE chars + 1 + n END, CASE WHEN k >= 12 OR chars + 1 + n > room THEN 1 ELSE k + 1 END
  FROM f JOIN u ON u.run_id = f.run_id AND u.rn = f.rn + 1)
SELECT run_id, unit_no, 'b' || lpad(CAST(b AS VARCHAR), 4, '0') AS batch_id FROM f"""
    q["offline_concepts"] = f"""WITH RECURSIVE {RUN_UNITS}, w AS (SELECT DISTINCT f.run_id, f.b, f.unit_no, x.w FROM fold f JOIN nu USING (unit_no), LATERAL (SELECT unnest(regexp_extract_all(nu.text, '[\\p{{L}}\\p{{N}}_]+')) AS w) x
  WHERE regexp_matches(x.w, '^[A-Z]') AND length(x.w) >= 4),
c AS (SELECT run_id, b, count(*) AS n, count(DISTINCT w) AS names FROM w GROUP BY ALL), a AS (SELECT DISTINCT run_id, b FROM fold)
SELECT run_id, 'b' || lpad(CAST(b AS VARCHAR), 4, '0') AS batch_id, 'summary' AS candidate_type, 1 AS n, 0 AS names FROM a
UNION ALL SELECT run_id, 'b' || lpad(CAST(b AS VARCHAR), 4, '0'), 'concept', n, names FROM c UNION ALL SELECT run_id, 'b' || lpad(CAST(b AS VARCHAR), 4, '0'), 'relation', n - 1, 0 FROM c WHERE n > 1"""
    q["candidate_ids"] = f"""SELECT run_id, candidate_no, batch_id || '-' || CASE candidate_type WHEN 'summary' THEN 's' WHEN 'concept' THEN 'c' WHEN 'claim' THEN 'q' ELSE 'r' END
  || lpad(CAST(row_number() OVER (PARTITION BY run_id, batch_id, candidate_type ORDER BY candidate_no) AS VARCHAR), 4, '0') AS candidate_id FROM ({CAND})"""
    q["evidence_violations"] = f"""
WITH RECURSIVE {RUN_UNITS}, k AS (SELECT run_id, candidate_id, CASE WHEN candidate_no % 97 = 0 THEN [] WHEN candidate_no % 101 = 0 THEN evidence_anchors || evidence_anchors[1:1] WHEN candidate_no % 103 = 0 THEN evidence_anchors || ['kst-source:none#a'] ELSE evidence_anchors END AS e FROM ({CAND})),
c AS (SELECT run_id, candidate_id, unnest(e) AS a FROM k), n AS (SELECT run_id, candidate_id, a, count(*) AS n FROM c GROUP BY ALL),
v AS (SELECT run_id, candidate_id, 'none' AS fault FROM k WHERE len(coalesce(e, [])) = 0
  UNION ALL SELECT run_id, candidate_id, 'repeated' FROM n WHERE n > 1
  UNION ALL SELECT n.run_id, candidate_id, 'unknown' FROM n WHERE NOT EXISTS (SELECT 1 FROM ru WHERE ru.run_id = n.run_id AND ru.anchor_uri = n.a))
SELECT run_id, fault, count(DISTINCT candidate_id) AS candidates FROM v GROUP BY ALL"""
    q["candidate_counts"] = f"""
WITH c AS ({CAND}), t AS (SELECT unnest(['summary', 'concept', 'claim', 'relation']) AS candidate_type)
SELECT r.run_id, t.candidate_type, count(c.candidate_no) AS n FROM (SELECT DISTINCT run_id FROM c) r CROSS JOIN t LEFT JOIN c ON c.run_id = r.run_id AND c.candidate_type = t.candidate_type GROUP BY ALL"""
    q["relation_violations"] = f"""
WITH c AS (SELECT * FROM ({CAND}) WHERE candidate_type = 'concept'), r AS (SELECT candidate_no AS o, lag(candidate_no) OVER (PARTITION BY run_id, batch_id ORDER BY candidate_no) AS s FROM c),
e AS (SELECT DISTINCT o, unnest([s, o]) AS e FROM r WHERE s IS NOT NULL)
SELECT 'r' || o AS candidate_id, CAST(e AS VARCHAR) AS "end" FROM e WHERE e NOT IN (SELECT candidate_no FROM c WHERE trim(coalesce(name, '')) <> '')"""
    q["label_keys"] = f"SELECT candidate_no, {_label('name')} AS name_key, md5({_label('statement')}) AS statement_md5 FROM ({CAND})"
    q["path_keys"] = f"""
WITH p AS (SELECT DISTINCT unnest([canonical_path, upper(canonical_path), replace(canonical_path, '/', chr(92)), '/' || canonical_path]) AS path FROM concept)
SELECT path, CASE WHEN NOT starts_with(path, '/') THEN lower(replace(path, chr(92), '/')) END AS path_key, {_title('path')} AS title_key FROM p"""
    unlike = " OR ".join(f"len(list_distinct({x})) < len({x})" for x in ("aliases", "title_history", "path_history", "resource_uris", "source_anchors"))
    q["catalog_faults"] = f"""
WITH c AS (SELECT *, CASE WHEN NOT starts_with(replace(canonical_path, chr(92), '/'), '/') AND NOT list_has_any(string_split(replace(canonical_path, chr(92), '/'), '/'), ['', '.', '..']) THEN lower(nfc_normalize(replace(canonical_path, chr(92), '/'))) END AS pk FROM concept),
o AS (SELECT internal_id, CASE WHEN NOT coalesce(regexp_full_match(internal_id, '[^\\x00-\\x1F\\x7F]{{1,200}}'), false) THEN 'internal_id' WHEN trim(coalesce(title, '')) = '' THEN 'title' WHEN pk IS NULL THEN 'canonical_path' WHEN {unlike} THEN 'list' END AS fault FROM c)
SELECT internal_id, fault FROM o WHERE fault IS NOT NULL UNION ALL SELECT internal_id, 'repeated id' FROM c GROUP BY internal_id HAVING count(*) > 1
UNION ALL SELECT internal_id, 'shared path' FROM c WHERE pk IN (SELECT pk FROM c WHERE pk IS NOT NULL GROUP BY pk HAVING count(*) > 1)"""
    q["ambiguous_keys"] = f"""
WITH k AS (SELECT internal_id, {_label("split_part(title, ' ', 1)")} AS key FROM concept
  UNION SELECT internal_id, {_label('x')} FROM (SELECT internal_id, unnest(aliases || title_history) AS x FROM concept) UNION SELECT internal_id, {_title('x')} FROM (SELECT internal_id, unnest([canonical_path] || path_history) AS x FROM concept))
SELECT key, count(DISTINCT internal_id) AS concepts FROM k WHERE key IS NOT NULL GROUP BY key HAVING concepts > 1"""
    q["catalog_keys"] = f"WITH {KEYS} SELECT * FROM keys"
    q["name_matches"] = f"WITH {LADDER} SELECT candidate_no, internal_id, array_to_string(kinds, ',') AS kinds FROM nm"
    q["ladder_pairs"] = f"WITH {LADDER} SELECT * FROM lp"
    q["match_ladder"] = f"""WITH {LADDER}, b AS (SELECT candidate_no, min(tier) AS tier FROM lp GROUP BY ALL)
SELECT candidate_no, ['source-anchor+name', 'resource-uri+name', 'alias-history-exact', 'title-path-exact'][tier] AS method, string_agg(DISTINCT internal_id, ',' ORDER BY internal_id) AS considered
FROM lp JOIN b USING (candidate_no, tier) GROUP BY ALL"""
    q["match_signals"] = f"""WITH {KEYS},
s AS (SELECT DISTINCT candidate_no, internal_id, 0 AS s FROM (SELECT candidate_no, unnest(evidence_anchors) AS a FROM cc) JOIN (SELECT internal_id, unnest(source_anchors) AS a FROM cat) USING (a)
  UNION SELECT candidate_no, internal_id, 1 FROM (SELECT DISTINCT candidate_no, split_part(a, '#', 1) AS a FROM (SELECT candidate_no, unnest(evidence_anchors) AS a FROM cc) WHERE contains(a, '#')) JOIN (SELECT internal_id, unnest(resource_uris) AS a FROM cat) USING (a)
  UNION SELECT candidate_no, internal_id, CASE WHEN kind IN ('alias', 'title_history') THEN 2 WHEN kind = 'title' THEN 3 ELSE 4 END FROM cc JOIN keys ON nk = key WHERE nk <> '')
SELECT candidate_no, internal_id, string_agg(['source-anchor-overlap', 'resource-uri-overlap', 'alias-history-exact', 'title-exact', 'path-title-exact'][s + 1], ',' ORDER BY s) AS signals FROM s GROUP BY ALL"""
    tok = lambda x: rf"list_distinct(list_filter(regexp_extract_all({_label(x)}, '[\p{{L}}\p{{N}}]+'), lambda t: length(t) > 1))"
    q["token_overlap_top"] = f"""WITH {KEYS},
a AS (SELECT candidate_no, {tok("concat_ws(' ', name, description)")} AS t FROM cc), b AS (SELECT internal_id, {tok("concat_ws(' ', title, description, array_to_string(aliases, ' '), array_to_string(title_history, ' '))")} AS t FROM cat),
x AS (SELECT candidate_no, internal_id, count(*) AS m, any_value(na) AS na, any_value(nb) AS nb FROM (SELECT candidate_no, len(t) AS na, unnest(t) AS w FROM a) JOIN (SELECT internal_id, len(t) AS nb, unnest(t) AS w FROM b) USING (w) GROUP BY ALL),
o AS (SELECT candidate_no, internal_id, round(m / (na + nb - m), 6) AS overlap FROM x)
SELECT *, row_number() OVER (PARTITION BY candidate_no ORDER BY overlap DESC, internal_id) AS rank FROM o QUALIFY rank <= 5"""
    q["resolution_counts"] = "SELECT status, count(candidate_no) AS n FROM (SELECT unnest(['matched', 'new', 'ambiguous']) AS status) LEFT JOIN (SELECT DISTINCT candidate_no, status FROM resolution) USING (status) GROUP BY ALL"
    q["plan_concepts"] = f"WITH {PLAN} SELECT o AS ordinal, operation, reason, targets, after FROM co"
    q["plan_summaries"] = f"WITH {PLAN} SELECT o AS ordinal, CASE WHEN o = first THEN 'create' ELSE 'merge' END AS operation, CASE WHEN o = first THEN 'new-source-summary' ELSE 'exact-new-summary-duplicate' END AS reason, CAST(o <> first AS INT) AS targets, CASE WHEN o <> first THEN first END AS after FROM so"
    q["plan_claims"] = f"WITH {PLAN} SELECT o AS ordinal, operation, reason, targets, after FROM qo"
    q["plan_relations"] = f"WITH {PLAN} SELECT o AS ordinal, operation, reason, CAST(ha AS INT) + CAST(hb AS INT) + CAST(operation = 'merge' AS INT) AS after FROM ro"
    log = "lg AS (SELECT 'concept' AS object_type, 1 AS t, o, operation FROM co UNION ALL SELECT 'summary', 2, o, CASE WHEN o = first THEN 'create' ELSE 'merge' END FROM so UNION ALL SELECT 'claim', 3, o, operation FROM qo UNION ALL SELECT 'relation', 4, o, operation FROM ro)"
    q["plan_counts"] = f"""WITH {PLAN}, {log}
SELECT 'operation' AS kind, operation AS value, count(*) AS n FROM lg GROUP BY ALL UNION ALL SELECT 'object_type', object_type, count(*) FROM lg GROUP BY ALL UNION ALL SELECT 'blocked', NULL, count(*) FROM lg WHERE operation = 'ignore'"""
    q["operation_numbers"] = f"WITH {PLAN}, {log} SELECT object_type, o AS ordinal, 'op' || lpad(CAST(row_number() OVER (ORDER BY t, o) AS VARCHAR), 6, '0') AS operation_id FROM lg"
    q["operation_faults"] = f"""WITH {PLAN}, {log}, n AS (SELECT row_number() OVER (ORDER BY t, o) AS n FROM lg)
SELECT 'op' || lpad(CAST(n AS VARCHAR), 6, '0') AS operation_id, fault FROM n JOIN (VALUES (101, 'verb'), (103, 'dependency'), (107, 'candidate')) f(every, fault) ON n % every = 0"""
    q["provisional_ids"] = f"""WITH {PLAN}, p AS (SELECT qo.o, 'urn:kst:claim:sha256-' || sha256('{{"descriptor":{{"candidate_id":"' || qo.o || '","evidence_anchors":' || {_strings('cand.evidence_anchors')} || ',"statement":' || {_literal('cand.statement')} || '}},"object_type":"claim"}}') AS id
  FROM qo JOIN cand ON cand.candidate_no = qo.o WHERE operation = 'create')
SELECT o AS ordinal, id AS provisional_internal_id, 'urn:kst:identity:claim:sha256-' || sha256('{{"basis":"kst-identity-v1","object_type":"claim","provisional":"' || id || '"}}') AS final_id FROM p"""
    q["translated_ids"] = f"""WITH {PLAN}, p AS (SELECT qo.o, 'urn:kst:claim:sha256-' || sha256('{{"descriptor":{{"candidate_id":"' || qo.o || '","evidence_anchors":' || {_strings('cand.evidence_anchors')} || ',"statement":' || {_literal('cand.statement')} || '}},"object_type":"claim"}}') AS id
  FROM qo JOIN cand ON cand.candidate_no = qo.o WHERE operation IN ('create', 'contradict')),
f AS (SELECT o, 'urn:kst:identity:claim:sha256-' || sha256('{{"basis":"kst-identity-v1","object_type":"claim","provisional":"' || id || '"}}') AS id FROM p)
SELECT qo.o AS ordinal, operation, a.id AS final_id, b.id AS merged_into, b.id AS survivor FROM qo LEFT JOIN f a ON a.o = qo.o LEFT JOIN f b ON qo.operation = 'merge' AND b.o = qo.first"""
    slug = r"trim(regexp_replace(replace(lower(nfc_normalize(coalesce(co.name, ''))), 'ß', 'ss'), '[^\p{L}\p{N}]+', '-', 'g'), '-')"
    q["path_proposals"] = f"""WITH {PLAN}, n AS (SELECT co.o, {slug} AS slug, sha256('{{"descriptor":{{"candidate_id":"' || co.o || '","description":' || {_literal('co.description')} || ',"evidence_anchors":' || {_strings('cand.evidence_anchors')} || ',"name":' || {_literal('co.name')} || '}},"object_type":"concept"}}') AS h
  FROM co JOIN cand ON cand.candidate_no = co.o WHERE operation = 'create'),
b AS (SELECT o, 'concepts/' || CASE WHEN slug = '' THEN 'concept-' || h[1:12] ELSE slug END || '.md' AS base FROM n), t AS (SELECT lower(unnest([canonical_path] || path_history)) AS k FROM catalog_concept)
SELECT o AS ordinal, base, lower(base) IN (SELECT k FROM t) OR o > min(o) OVER (PARTITION BY base) AS made_unique FROM b"""
    q["decision_faults"] = f"""WITH {PLAN}, r AS (SELECT candidate_no AS o, candidate_type = 'claim' AS q, candidate_no % 50 AS k FROM cand
  WHERE NOT (candidate_type = 'concept' AND coalesce(lower(trim(name)) IN ('tbd', '(untitled)', 'unknown', '???', '-'), false)) AND NOT (candidate_type = 'claim' AND coalesce(statement LIKE 'No %', false)))
SELECT CAST(o AS VARCHAR) AS candidate_id, 'no reason' AS fault FROM co WHERE dec UNION ALL SELECT CAST(o AS VARCHAR), 'action not allowed' FROM r WHERE NOT q AND k = 1
UNION ALL SELECT CAST(o AS VARCHAR), 'ignore names targets' FROM r WHERE NOT q AND k = 2 UNION ALL SELECT CAST(o AS VARCHAR), 'merge needs two targets and a survivor among them' FROM r WHERE NOT q AND k = 3
UNION ALL SELECT 'z' || o, 'unknown candidate' FROM r WHERE k = 4 UNION ALL SELECT CAST(o AS VARCHAR), 'decided twice' FROM r WHERE k = 5
UNION ALL SELECT CAST(o AS VARCHAR), 'update needs one target' FROM r WHERE q AND k = 6 UNION ALL SELECT CAST(o AS VARCHAR), 'unknown target' FROM r WHERE q AND k = 7"""
    q["planning_faults"] = f"""WITH {PLAN}, kx AS (SELECT 'urn:kst:relation:' || md5(sid || '|' || oid) AS id FROM kr)
SELECT internal_id, 'repeated id' AS fault FROM kc WHERE length(CASE WHEN length(statement) % 17 = 0 THEN ' ' ELSE statement END) % 13 = 0
UNION ALL SELECT internal_id, 'claim' FROM kc WHERE length(statement) % 17 = 0 OR trim(coalesce(statement, '')) = '' OR evidence_anchors IS NULL UNION ALL SELECT id, 'end not in the catalog' FROM kx WHERE right(id, 1) < '8'"""
    q["path_faults"] = f"""WITH {PLAN}, {log}, n AS (SELECT *, row_number() OVER (ORDER BY t, o) AS n FROM lg), x AS (SELECT 'op' || lpad(CAST(n AS VARCHAR), 6, '0') AS operation_id FROM n WHERE n % 5 = 0 AND object_type = 'concept' AND operation = 'create')
SELECT operation_id, unnest(['path in use', 'path created twice']) AS fault FROM x"""
    q["event_log"] = f"""WITH {PLAN}, {log}, n AS (SELECT *, row_number() OVER (ORDER BY t, o) AS number FROM lg)
SELECT number, 'op' || lpad(CAST(number AS VARCHAR), 6, '0') AS operation_id, CAST(operation <> 'ignore' AS INT) AS results, operation FROM n"""
    q["verb_matrix"] = f"""WITH {PLAN}, a AS (SELECT 'concept' AS object_type, reason, operation FROM co UNION ALL SELECT 'claim', reason, operation FROM qo UNION ALL SELECT 'relation', reason, operation FROM ro
  UNION ALL SELECT 'summary', '', CASE WHEN o = first THEN 'create' ELSE 'merge' END FROM so),
v AS (SELECT object_type, CASE WHEN reason IN ('denies', 'placeholder', 'relation-endpoint-unresolved') THEN 'supersede' ELSE operation END AS operation FROM a)
SELECT object_type, operation, count(*) AS n, CASE operation WHEN 'update' THEN object_type <> 'summary' WHEN 'contradict' THEN object_type = 'claim' WHEN 'supersede' THEN object_type = 'claim' ELSE operation IN ('create', 'merge', 'ignore') END AS allowed FROM v GROUP BY ALL"""
    q["slugs"] = rf"""SELECT candidate_no, trim(regexp_replace(replace(lower(nfc_normalize(name)), 'ß', 'ss'), '[^\p{{L}}\p{{N}}]+', '-', 'g'), '-') AS slug FROM ({CAND}) WHERE candidate_type = 'concept'"""
    q["compile_counts"] = f"""WITH {PLAN}, g AS (SELECT DISTINCT status, internal_id FROM catalog_concept)
SELECT object_type, status, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT 'concept' AS object_type, status, count(*) AS n FROM g GROUP BY ALL UNION ALL SELECT 'concept', 'active', count(*) FROM co WHERE operation = 'create'
  UNION ALL SELECT 'summary', 'active', count(*) FROM so WHERE o = first UNION ALL SELECT 'claim', status, count(*) FROM kc GROUP BY ALL UNION ALL SELECT 'claim', 'active', count(*) FROM qo WHERE operation IN ('create', 'contradict')
  UNION ALL SELECT 'relation', 'active', count(*) FROM ro WHERE operation = 'create' UNION ALL SELECT 'relation', 'active', count(*) FROM kr) GROUP BY ALL HAVING sum(n) > 0"""
    q["compile_titles"] = f"""WITH {PLAN}, g AS ({CATALOG}), u AS (SELECT rid, max_by(co.name, o) AS t FROM co WHERE operation = 'update' GROUP BY rid),
e AS (SELECT rid AS id, unnest(cand.evidence_anchors) AS a FROM co JOIN cand ON cand.candidate_no = co.o WHERE operation = 'update' UNION SELECT internal_id, unnest(source_anchors) FROM g),
n AS (SELECT id, count(DISTINCT a) AS anchors FROM e GROUP BY id)
SELECT g.internal_id, coalesce(u.t, g.title) AS title, coalesce(n.anchors, 0) AS anchors FROM g LEFT JOIN u ON u.rid = g.internal_id LEFT JOIN n ON n.id = g.internal_id"""
    q["compile_links"] = f"""WITH {PLAN}, kn AS (SELECT internal_id, row_number() OVER (ORDER BY substr(md5(internal_id), 1, 3), internal_id) - 1 AS r, count(*) OVER () AS n FROM kc),
st AS (SELECT {_label('statement')} AS rest, min(internal_id) AS id FROM kc GROUP BY 1), d AS (SELECT candidate_no, {_label('substr(statement, 4)')} AS rest FROM cand WHERE candidate_type = 'claim' AND statement LIKE 'No %'),
g AS (SELECT coalesce(st.id, kn.internal_id) AS internal_id FROM d JOIN kn ON kn.r = d.candidate_no % kn.n LEFT JOIN st USING (rest))
SELECT internal_id, count(*) AS against, count(*) AS back FROM g GROUP BY ALL"""
    q["compile_faults"] = f"""SELECT 'concept' AS object_type, internal_id, CASE WHEN right(internal_id, 1) IN ('0', '1', '2') THEN 'merged' ELSE 'shared path' END AS fault
FROM ({CATALOG}) WHERE right(internal_id, 1) IN ('0', '1', '2', '3', '4')"""
    own = "CASE WHEN coalesce(internal_id, '') = '' THEN 'id' WHEN (status = 'merged') <> (merged_into IS NOT NULL) THEN 'merged' WHEN merged_into = internal_id THEN 'merged into itself' END"
    q["state_faults"] = f"""
WITH c AS ({_latest('concept')}), k AS ({_latest('claim')}), a AS (SELECT 'concept' AS object_type, internal_id, status, merged_into FROM c UNION ALL SELECT 'claim', internal_id, status, merged_into FROM k),
l AS (SELECT DISTINCT internal_id, unnest(contradicts || contradicted_by || supersedes || superseded_by) AS x FROM k), p AS (SELECT internal_id, lower(nfc_normalize(replace(canonical_path, chr(92), '/'))) AS p FROM c WHERE status <> 'merged')
SELECT object_type, internal_id, fault FROM (SELECT *, {own} AS fault FROM a) WHERE fault IS NOT NULL
UNION ALL SELECT object_type, internal_id, 'merged into unknown' FROM a WHERE merged_into IS NOT NULL AND NOT EXISTS (SELECT 1 FROM a b WHERE b.object_type = a.object_type AND b.internal_id = a.merged_into)
UNION ALL SELECT DISTINCT 'claim', internal_id, 'link to unknown' FROM l WHERE x NOT IN (SELECT internal_id FROM k)
UNION ALL SELECT 'concept', internal_id, 'shared path' FROM p WHERE p IN (SELECT p FROM p GROUP BY p HAVING count(DISTINCT internal_id) > 1)"""
    q["catalog_projection"] = f"SELECT internal_id, title, canonical_path, status FROM ({_latest('concept')}) WHERE status <> 'merged'"
    q["planning_projection"] = f"WITH {PLAN} SELECT internal_id, statement, status FROM kc UNION ALL SELECT 'urn:kst:relation:' || md5(sid || '|' || oid), sid || ' appears with ' || oid, 'active' FROM kr"
    q["identity_registry"] = f"""SELECT 'concept' AS object_type, internal_id, status, merged_into, canonical_path FROM ({_latest('concept')})
UNION ALL SELECT 'claim', internal_id, status, merged_into, NULL FROM ({_latest('claim')})"""
    q["link_faults"] = f"""WITH c AS ({_latest('claim')}), x AS (SELECT DISTINCT internal_id, unnest(contradicts || contradicted_by || supersedes || superseded_by || CASE WHEN length(statement) % 11 = 0 THEN ['urn:kst:claim:none'] ELSE [] END) AS target FROM c)
SELECT internal_id, target FROM x WHERE target NOT IN (SELECT internal_id FROM c)"""
    q["shared_paths"] = f"""WITH c AS (SELECT internal_id, lower(canonical_path[1:12]) AS p FROM ({_latest('concept')}) WHERE status <> 'merged')
SELECT internal_id FROM c WHERE p IN (SELECT p FROM c GROUP BY p HAVING count(DISTINCT internal_id) > 1)"""
    q["ordered_anchors"] = f"""
WITH e AS (SELECT run_id, candidate_no, unnest(evidence_anchors) AS a, generate_subscripts(evidence_anchors, 1) AS i FROM ({CAND})), f AS (SELECT run_id, a, min((candidate_no, i)) AS k FROM e GROUP BY ALL)
SELECT run_id, count(*) AS anchors, md5(string_agg(a, chr(10) ORDER BY k)) AS order_md5 FROM f GROUP BY run_id"""
    q["merge_lineage"] = f"""
WITH RECURSIVE c AS (SELECT internal_id, lower(trim(internal_id)) AS k, nullif(lower(trim(merged_into)), '') AS m FROM ({_latest('concept')})), ids AS (SELECT k, min(internal_id) AS id FROM c GROUP BY k),
l AS (SELECT c.internal_id AS a, ids.id AS b FROM c JOIN ids ON ids.k = c.m WHERE c.m <> c.k),
w AS (SELECT a, b FROM l UNION SELECT w.a, l.b FROM w JOIN l ON l.a = w.b)
SELECT a AS internal_id, coalesce(min(CASE WHEN b NOT IN (SELECT a FROM l) THEN b END), min(CASE WHEN (b, b) IN (SELECT (a, b) FROM w) THEN b END)) AS survivor FROM w GROUP BY a"""
    q["token_sets"] = f"SELECT candidate_no, len(t) AS tokens, md5(array_to_string(list_sort(t), ' ')) AS tokens_md5 FROM (SELECT candidate_no, {tok('description')} AS t FROM ({CAND}) WHERE candidate_type = 'concept' AND description IS NOT NULL)"
    return q | extraction.oracle_sql()
