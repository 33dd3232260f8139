"""DuckDB SQL for the registered queries, over views named like the tables."""

from __future__ import annotations

_FOUND = "SELECT doc_id, item_id, d.text AS text, b.text AS q FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE b.text <> ''"
_FOUND_SHORT = "SELECT doc_id, item_id, d.text AS text, left(b.text, 12) AS q FROM documents d JOIN benchmark b ON contains(d.text, left(b.text, 12)) WHERE b.text <> ''"


def _ground(found: str) -> str:
    """Status and span of quotes without a scope, where chunk and section are the whole text."""
    return f"""
    WITH f AS ({found}),
    g AS (SELECT doc_id, item_id, text, q, strpos(text, q) AS p FROM f),
    h AS (SELECT *, strpos(substr(text, p + 1), q) > 0 AS again FROM g)
    SELECT doc_id, item_id, CASE WHEN again THEN 'ambiguous' ELSE 'verified' END AS evidence_status,
      CASE WHEN NOT again THEN CAST(p - 1 AS INT) END AS evidence_character_start, CASE WHEN NOT again THEN CAST(p - 1 + length(q) AS INT) END AS evidence_character_end
    FROM h"""


_LINES = """
lines AS (
  SELECT doc_id AS doc, CAST(i - 1 AS INT) AS idx, l[i] AS text
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) t, unnest(range(1, len(l) + 1)) u(i)
)"""
_KEPT = """
full_lines AS (SELECT * FROM lines WHERE text <> '' AND NOT regexp_matches(text, '^[0-9]+$')),
lagged AS (SELECT *, lag(text) OVER (PARTITION BY doc ORDER BY idx) AS before FROM full_lines),
kept AS (SELECT doc, idx, text, CAST(row_number() OVER (PARTITION BY doc ORDER BY idx) - 1 AS INT) AS block FROM lagged WHERE text IS DISTINCT FROM before)"""
_PLACED = """
placed AS (
  SELECT *, CAST(coalesce(sum(length(text) + 2) OVER (PARTITION BY doc ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS s FROM kept
)"""
_FILINGS = """
raw AS (
  SELECT doc_id, source || '-' || CAST(doc_id // 100 AS VARCHAR) AS source, list_concat(
    CASE WHEN doc_id % 7 = 0 THEN [CASE WHEN doc_id % 2 = 0 THEN 'PART I' ELSE 'PART II' END] ELSE [] END,
    ['Item ' || CAST(doc_id % 9 + 1 AS VARCHAR) || '. ' || lang], string_split(text, chr(10))) AS l
  FROM documents
),
lines AS (
  SELECT source AS doc, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id, i) - 1 AS INT) AS idx, l[i] AS text FROM raw, unnest(range(1, len(l) + 1)) u(i)
)"""
_PARTS = """
parts AS (
  SELECT *, CASE WHEN length(text) <= 160 THEN upper(nullif(regexp_extract(text, '^PART\\s+([IVX]+)\\b', 1, 'i'), '')) END AS own FROM {rows}
),
filled AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY doc ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS part FROM parts)"""
_SECTIONS = (
    "WITH " + _FILINGS + "," + _KEPT + "," + _PLACED + "," + _PARTS.format(rows="placed", order="block") + """,
whole AS (SELECT doc, string_agg(text, chr(10) || chr(10) ORDER BY block) AS doc_text FROM kept GROUP BY doc),
markers AS (
  SELECT f.*, w.doc_text, upper(regexp_extract(text, '^Item\\s+(\\d+[A-Z]?)\\.\\s*(.*)$', 1, 'i')) AS item_number
  FROM filled f JOIN whole w USING (doc) WHERE own IS NULL AND length(text) <= 240 AND regexp_matches(text, '^Item\\s+(\\d+[A-Z]?)\\.\\s*(.*)$', 'i')
),
ends AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc ORDER BY block) - 1 AS INT) AS ord, lead(s, 1, CAST(length(doc_text) AS INT)) OVER (PARTITION BY doc ORDER BY block) AS e FROM markers),
bodies AS (
  SELECT *, regexp_replace(substr(doc_text, s + 1, e - s), '\\s+$', '') AS body,
    coalesce('part-' || lower(part) || '-', '') || 'item-' || lower(item_number) AS base FROM ends
),
secs AS (
  SELECT doc, base || CASE WHEN nth = 1 THEN '' ELSE '-' || CAST(nth AS VARCHAR) END AS section_id, part, item_number, text AS heading, ord, s AS character_start, CAST(s + length(body) AS INT) AS character_end, body
  FROM (SELECT *, row_number() OVER (PARTITION BY doc, base ORDER BY ord) AS nth FROM bodies) t
)"""
)
# Paragraphs of sections: blocks parted by blank lines; a block of one character takes the next one in.
_PARAGRAPHS = (
    _SECTIONS + """,
cut AS (SELECT doc || '/' || CAST(ord AS VARCHAR) AS section, string_split(body, chr(10) || chr(10)) AS l, body FROM secs),
pieces AS (
  SELECT section, i, l[i] AS t, CAST(coalesce(sum(length(l[i]) + 2) OVER (PARTITION BY section ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS a FROM cut, unnest(range(1, len(l) + 1)) u(i)
),
short AS (SELECT *, length(t) = 1 AS one, lag(length(t) = 1, 1, false) OVER (PARTITION BY section ORDER BY i) AS after_one FROM pieces),
runs AS (SELECT *, max(CASE WHEN NOT one THEN i ELSE 0 END) OVER (PARTITION BY section ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_long,
  max(CASE WHEN NOT one THEN i ELSE 0 END) OVER (PARTITION BY section ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS long_before FROM short),
-- In a run of one-character blocks every second one begins a paragraph, starting with the first.
starts AS (SELECT *, (i - coalesce(long_before, 0) - 1) % 2 = 0 AS begins FROM runs),
named AS (SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY section ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM starts),
pars AS (
  SELECT section, CAST(row_number() OVER (PARTITION BY section ORDER BY g) - 1 AS INT) AS idx, CAST(min(a) AS INT) AS s, CAST(max(a + length(t)) AS INT) AS e, string_agg(t, chr(10) || chr(10) ORDER BY i) AS raw
  FROM named GROUP BY section, g
)"""
)
_HEADING = """CASE WHEN {x} IN ('PART I', 'Item 2') THEN false WHEN contains({x}, chr(10)) OR length({x}) > 120 OR right({x}, 1) IN ('.', ':', ';') THEN false
  WHEN upper({x}) = {x} AND lower({x}) <> {x} THEN true
  ELSE len(list_filter(string_split({x}, ' '), lambda w: w <> '')) BETWEEN 1 AND 8 AND len(list_filter(string_split({x}, ' '), lambda w: w <> '' AND NOT (regexp_matches(w, '^[\\p{{Lu}}\\p{{Lt}}]') OR lower(w) IN ('and', 'of', 'the')))) = 0 END"""


def _packed(limit: str, items: str, nth: str = "") -> str:
    """Chunk numbers of paragraphs (k, n, idx, s, e) of each text k, by a recursive walk; nth tells several walks apart."""
    return f"""
walk{nth} AS (
  SELECT k, idx, s, e, 0 AS no, s AS first FROM {items} WHERE idx = 0
  UNION ALL
  SELECT i.k, i.idx, i.s, i.e, CASE WHEN i.e - w.first > {limit} THEN w.no + 1 ELSE w.no END, CASE WHEN i.e - w.first > {limit} THEN i.s ELSE w.first END
  FROM walk{nth} w JOIN {items} i ON i.k = w.k AND i.idx = w.idx + 1
),
made{nth} AS (SELECT k, no, CAST(min(s) AS INT) AS a, CAST(max(e) AS INT) AS b FROM walk{nth} GROUP BY k, no)"""


def _number(no: str) -> str:
    return f"lpad(CAST({no} + 1 AS VARCHAR), CAST(greatest(3, length(CAST({no} + 1 AS VARCHAR))) AS INT), '0')"


def _resplit(least: int, limit: str) -> str:
    """Chunks of 6,000 characters, and children of those over a length: key, parent_id, chunk_id, a and b in the section, and its text."""
    return (
        _PARAGRAPHS.replace("WITH ", "WITH RECURSIVE ", 1) + ", items AS (SELECT section AS k, idx, s, e FROM pars)," + _packed("6000", "items") + f""",
        parents AS (SELECT k || '/' || CAST(no AS VARCHAR) AS key, k AS section, no, b - a AS n FROM made WHERE b - a > {least}),
        items2 AS (SELECT key AS k, CAST(row_number() OVER (PARTITION BY key ORDER BY idx) - 1 AS INT) AS idx, s, e, {limit} AS most FROM walk JOIN parents ON section = walk.k AND parents.no = walk.no),"""
        + _packed("i.most", "items2", "2") + f""",
        many AS (SELECT k FROM made2 GROUP BY k HAVING count(*) > 1),
        children AS (SELECT section, section || '/item2-chunk-' || {_number("parents.no")} AS key, 'item2-chunk-' || {_number("parents.no")} AS parent_id, 'item2-chunk-' || {_number("parents.no")} || '.' || {_number("made2.no")} AS chunk_id, a, b,
          substr(body, a + 1, b - a) AS text FROM made2 JOIN many USING (k) JOIN parents ON key = made2.k JOIN cut USING (section))"""
    )


_TOKENS = "list_distinct(regexp_extract_all(lower(replace(replace({x}, 'ß', 'ss'), 'ẞ', 'ss')), '[a-z0-9]+'))"


def _jaccard(a: str, b: str) -> str:
    ta, tb = _TOKENS.format(x=a), _TOKENS.format(x=b)
    return f"CASE WHEN len({ta}) = 0 OR len({tb}) = 0 THEN 0.0 ELSE CAST(len(list_intersect({ta}, {tb})) AS DOUBLE) / len(list_distinct(list_concat({ta}, {tb}))) END"


_CLAIMS = """
cut AS (SELECT doc_id, lang, text, string_split(replace(text, chr(10), ' '), '. ') AS l FROM documents WHERE text <> ''),
sentences AS (SELECT doc_id, lang, text, CAST(i - 1 AS INT) AS i, l[i] AS x FROM cut, unnest(range(1, len(l) + 1)) u(i) WHERE length(l[i]) >= 12),
p AS (
  SELECT doc_id, i AS p_index, text, CASE WHEN contains(text, left(x, 12)) AND i <> 3 THEN 'verified' ELSE 'not_found' END AS status, CASE WHEN i % 3 = 0 THEN 'risk' ELSE 'business_driver' END AS kind,
    x AS statement, left(x, 12) AS quote, CASE WHEN i % 5 = 1 THEN left(text, 8) END AS scope, lang AS metric, string_split(x, ' ')[1] AS value, CASE WHEN i % 2 = 0 THEN lang END AS period FROM sentences
),
moved AS (SELECT doc_id, lang, text, i, CASE WHEN i % 2 = 0 THEN x ELSE substr(x, strpos(x, ' ') + 1) END AS y, x FROM sentences),
e AS (
  SELECT doc_id, i AS e_index, text, CASE WHEN i % 3 = 0 THEN 'risk' ELSE 'business_driver' END AS kind, y AS statement, left(y, 12) AS quote, CASE WHEN i % 5 = 1 THEN left(text, 8) END AS scope,
    lang AS metric, string_split(y, ' ')[1] AS value, CASE WHEN i % 2 = 0 THEN lang END AS period FROM moved WHERE length(y) >= 12 AND contains(text, left(y, 12)) AND i <> 1
)"""
_AT = """CASE WHEN scope IS NULL THEN nullif(strpos(text, quote), 0) WHEN strpos(text, scope) > 0 AND strpos(substr(text, strpos(text, scope) + length(scope)), quote) > 0
    THEN strpos(text, scope) + length(scope) - 1 + strpos(substr(text, strpos(text, scope) + length(scope)), quote) END"""


def _of(ta: str, tb: str) -> str:
    return f"CASE WHEN len({ta}) = 0 OR len({tb}) = 0 THEN 0.0::DOUBLE ELSE CAST(len(list_intersect({ta}, {tb})) AS DOUBLE) / len(list_distinct(list_concat({ta}, {tb}))) END"


_CANDIDATES = (
    _CLAIMS + f""",
pt AS MATERIALIZED (SELECT *, {_AT} AS ps, {_TOKENS.format(x='statement')} AS tp FROM p WHERE status = 'verified'),
et AS MATERIALIZED (SELECT *, {_AT} AS es, {_TOKENS.format(x='statement')} AS te FROM e),
pairs AS (
  SELECT doc_id, p_index, e_index, p.quote = e.quote AS exact, ps, es, {_of('tp', 'te')} AS st,
    {_jaccard('p.metric', 'e.metric')} AS f1, {_jaccard('p.value', 'e.value')} AS f2, CASE WHEN p.period IS NOT NULL AND e.period IS NOT NULL THEN {_jaccard('p.period', 'e.period')} END AS f3,
    p.kind = e.kind AS type_equal, p.kind = e.kind AND p.statement = e.statement AND p.quote = e.quote AND p.scope IS NOT DISTINCT FROM e.scope AND p.metric = e.metric AND p.value = e.value AND p.period IS NOT DISTINCT FROM e.period AS exact_claim
  FROM pt p JOIN et e USING (doc_id)
),
sims AS (
  SELECT *, coalesce(greatest(0, least(ps, es) + 12 - greatest(ps, es)) / 12.0::DOUBLE, 0.0::DOUBLE) AS ov, CASE WHEN f3 IS NULL THEN (0.0 + f1 + f2) / 2.0::DOUBLE ELSE (0.0 + f1 + f2 + f3) / 3.0::DOUBLE END AS fs
  FROM (SELECT * REPLACE (CASE WHEN es IS NOT NULL THEN ps END AS ps, CASE WHEN ps IS NOT NULL THEN es END AS es) FROM pairs) t
),
cands AS (
  SELECT *, CASE WHEN exact THEN 'exact_evidence' WHEN ov >= 0.8 THEN 'evidence_overlap' WHEN st >= 0.72 AND fs >= 0.6 THEN 'field_similarity' END AS method,
    round(least(1.0, CASE WHEN exact THEN 1.0::DOUBLE WHEN ov >= 0.8 THEN 0.85::DOUBLE * ov + 0.15::DOUBLE * st ELSE 0.7::DOUBLE * st + 0.3::DOUBLE * fs END), 9) AS score
  FROM sims WHERE exact OR ov >= 0.8 OR (st >= 0.72 AND fs >= 0.6)
)"""
)
_MATCHES = (
    "WITH RECURSIVE " + _CANDIDATES + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, p_index, e_index) AS r FROM cands),
pick AS (
  SELECT doc_id, CAST(0 AS BIGINT) AS r, CAST([] AS INT[]) AS ps_, CAST([] AS INT[]) AS es_, false AS took FROM ranked WHERE r = 1
  UNION ALL
  SELECT k.doc_id, k.r,
    CASE WHEN NOT list_contains(ps_, k.p_index) AND NOT list_contains(es_, k.e_index) THEN list_append(ps_, k.p_index) ELSE ps_ END,
    CASE WHEN NOT list_contains(ps_, k.p_index) AND NOT list_contains(es_, k.e_index) THEN list_append(es_, k.e_index) ELSE es_ END,
    NOT list_contains(ps_, k.p_index) AND NOT list_contains(es_, k.e_index)
  FROM pick JOIN ranked k ON k.doc_id = pick.doc_id AND k.r = pick.r + 1
),
m AS (SELECT ranked.* FROM ranked JOIN pick USING (doc_id, r) WHERE took)"""
)
_REVIEWS = """
rows_ AS (SELECT doc_id, source AS doc, quality, toxic, text AS statement FROM documents LEFT JOIN labels USING (doc_id)),
reviewed AS (SELECT doc, doc_id, CASE WHEN quality = 1 THEN 'accepted' WHEN toxic = 1 THEN 'rejected' ELSE 'needs_edit' END AS decision, statement FROM rows_ WHERE quality IS NOT NULL)"""
_HALF = """
WITH f AS (SELECT doc_id, item_id, d.text AS t, left(b.text, 12) AS q, left(d.text, 8) AS sc, CAST(floor(length(d.text) / 2) AS INT) AS h
  FROM documents d JOIN benchmark b ON contains(d.text, left(b.text, 12)) WHERE b.text <> ''),
g AS (SELECT *, substr(t, h + 1) AS c, left(t, h) AS before FROM f),
k AS (SELECT *, strpos(c, q) AS p, strpos(c, sc) AS sp,
  CASE WHEN strpos(before, sc) > 0 THEN length(before) - (strpos(array_to_string(list_reverse(string_split(before, '')), ''), array_to_string(list_reverse(string_split(sc, '')), '')) - 1) - length(sc) END AS back FROM g),
s AS (SELECT *, CASE WHEN sp > 0 THEN h + sp - 1 WHEN back IS NOT NULL THEN back END AS scope FROM k),
v AS (SELECT *, CASE WHEN p = 0 THEN 'not_found' WHEN strpos(substr(c, p + 1), q) > 0 THEN 'ambiguous' WHEN scope IS NULL THEN 'not_found' ELSE 'verified' END AS st FROM s)
SELECT doc_id, item_id, st AS evidence_status, CASE WHEN st = 'verified' THEN CAST(h + p - 1 AS INT) END AS evidence_character_start, CASE WHEN st = 'verified' THEN CAST(h + p - 1 + length(q) AS INT) END AS evidence_character_end,
  CASE WHEN st = 'verified' THEN CAST(scope AS INT) END AS scope_character_start, CASE WHEN st = 'verified' THEN CAST(scope + length(sc) AS INT) END AS scope_character_end FROM v"""

ORACLES: dict[str, str] = {
    "ground_quotes": _ground(_FOUND),
    "ground_short_quotes": _ground(_FOUND_SHORT),
    "ground_scoped_quotes": _HALF,
    "blocks_dedup": "WITH " + _LINES + "," + _KEPT + " SELECT doc, idx, block, text FROM kept",
    "blocks_offsets": "WITH " + _LINES + "," + _KEPT + "," + _PLACED + ' SELECT doc, block, s AS "start", CAST(s + length(text) AS INT) AS "end" FROM placed',
    "document_texts": "WITH " + _LINES + "," + _KEPT + ", w AS (SELECT doc, string_agg(text, chr(10) || chr(10) ORDER BY block) AS t FROM kept GROUP BY doc) SELECT doc, CAST(length(t) AS INT) AS n_chars, sha256(t) AS text_content_sha256 FROM w",
    "part_fill": "WITH " + _FILINGS + "," + _PARTS.format(rows="lines", order="idx") + " SELECT doc, idx, part FROM filled",
    "sections": _SECTIONS + ' SELECT doc, section_id, part, item_number, heading, ord AS "order", character_start, character_end, sha256(body) AS text_sha256 FROM secs',
    "section_unique_check": _SECTIONS + " SELECT doc, CASE count(*) FILTER (section_id = 'part-i-item-2') WHEN 1 THEN 'ok' WHEN 0 THEN 'section_missing' ELSE 'section_repeated' END AS state FROM secs GROUP BY doc",
    "section_first": _SECTIONS + """ SELECT doc, 'item-2' AS section_id, min(ord) AS "order", arg_min(character_start, ord) AS character_start FROM secs WHERE regexp_extract(section_id, '(item-[0-9]+)', 1) = 'item-2' GROUP BY doc""",
    "paragraphs": _PARAGRAPHS + """ SELECT section, idx, s AS "start", e AS "end", sha256(regexp_replace(regexp_replace(raw, '^\\s+', ''), '\\s+$', '')) AS sha256 FROM pars""",
    "headings": "WITH " + _LINES + f""", w AS (SELECT doc, idx, text, regexp_replace(array_to_string(string_split(text, ' ')[1:3], ' '), '[.,]', '', 'g') AS short FROM lines WHERE text <> '')
        SELECT doc, idx, {_HEADING.format(x='short')} AS is_heading, {_HEADING.format(x='text')} AS line_is_heading FROM w""",
    "heading_context": "WITH " + _LINES + """, w AS (
          SELECT doc, idx, idx % 5 = 4 AS period, CASE WHEN idx % 5 = 4 THEN 'Three Months Ended ' || CAST(idx AS VARCHAR) || ' Compared with ' || CAST(doc AS VARCHAR) ELSE 'Heading ' || upper(left(replace(text, 'ß', 's'), 3)) END AS h FROM lines
        ), h AS (SELECT *, CASE WHEN period THEN h WHEN right(h, 1) IN ('.', ':', ';') THEN NULL WHEN upper(h) = h AND lower(h) <> h THEN h
            WHEN len(list_filter(string_split(h, ' '), lambda x: x <> '' AND NOT (regexp_matches(x, '^[\\p{Lu}\\p{Lt}]') OR lower(x) IN ('and', 'of', 'the')))) = 0 THEN h END AS heading FROM w),
        n AS (SELECT *, count(*) FILTER (period) OVER (PARTITION BY doc ORDER BY idx) AS epoch FROM h),
        c AS (SELECT doc, idx, list(heading) FILTER (heading IS NOT NULL) OVER (PARTITION BY doc, epoch ORDER BY idx) AS l FROM n)
        SELECT doc, idx, coalesce(array_to_string(l[greatest(len(l) - 2, 1):len(l)], '|'), '') AS context FROM c""",
    "chunks": _PARAGRAPHS.replace("WITH ", "WITH RECURSIVE ", 1) + ", items AS (SELECT section AS k, idx, s, e FROM pars)," + _packed("1000", "items") + """
        SELECT k AS section, 'item2-chunk-' || lpad(CAST(no + 1 AS VARCHAR), CAST(greatest(3, length(CAST(no + 1 AS VARCHAR))) AS INT), '0') AS chunk_id, a AS character_start, b AS character_end, sha256(substr(body, a + 1, b - a)) AS text_sha256
        FROM made JOIN cut ON cut.section = made.k""",
    "chunks_resplit": _resplit(1000, "greatest(1000, n // 2)") + " SELECT key AS chunk_key, chunk_id, parent_id, a AS character_start, b AS character_end FROM children",
    "split_rounds": _resplit(2000, "1000") + """, marked AS (SELECT *, suffix(chunk_id, '3') AS gap FROM children)
        SELECT key AS parent_key, to_json(list(left(text, 20) ORDER BY chunk_id)) AS raw_response, to_json(list(left(text, 5) ORDER BY chunk_id)) AS claims, CAST(sum(length(text)) AS BIGINT) AS input_tokens, count(*) AS output_tokens, 'm' AS model,
          CASE WHEN bool_or(gap) THEN 'content_filtered' ELSE 'completed' END AS status, 'content_filter in ' || string_agg(chunk_id, ', ' ORDER BY chunk_id) FILTER (gap) AS failure_reason, CAST(NULL AS VARCHAR) AS response_id
        FROM marked GROUP BY key""",
    "record_rejects": """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'not JSON' WHEN 1 THEN '$.lang: unknown field' WHEN 2 THEN '$.sections[0].order: no int' WHEN 3 THEN '$.source_content_sha256: no hash' WHEN 4 THEN '$.sections[1].page: unknown field' END AS reason,
        CASE WHEN doc_id % 6 = 5 THEN sha256(text) END AS text_content_sha256, CASE WHEN doc_id % 6 = 5 THEN 2 END AS n_sections FROM documents""",
    "content_hashes": "SELECT 'document' AS kind, doc_id AS id, sha256(text) AS sha256 FROM documents UNION ALL SELECT 'page', page_id, sha256(html) FROM pages",
    "checkpoint_hits": "SELECT doc_id FROM documents WHERE sha256(text) IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0)",
    "checkpoint_misses": "SELECT doc_id FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0)",
    "usage_null_sum": "SELECT conv_id, CASE WHEN bool_or(role = 'system') THEN NULL ELSE CAST(sum(length(text)) AS BIGINT) END AS tokens FROM conversations GROUP BY conv_id",
    "single_model_check": "SELECT conv_id, CASE WHEN count(DISTINCT m) = 1 THEN max(m) END AS model FROM (SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN role ELSE 'm' || CAST(conv_id % 5 AS VARCHAR) END AS m FROM conversations) t GROUP BY conv_id",
    "claim_dedup": "WITH g AS (" + _ground(_FOUND_SHORT) + """), q AS (SELECT item_id, left(text, 12) AS q FROM benchmark),
        r AS (SELECT doc_id, item_id, CASE WHEN item_id % 2 = 0 THEN 'risk' ELSE 'business_driver' END AS claim_type, evidence_character_start AS s, evidence_character_end AS e, q FROM g JOIN q USING (item_id)),
        n AS (SELECT *, row_number() OVER (PARTITION BY doc_id % 16, s, e, claim_type, CASE WHEN s IS NULL THEN q END ORDER BY doc_id, item_id) AS k FROM r)
        SELECT doc_id, item_id, claim_type FROM n WHERE k = 1""",
    "token_jaccard_pairs": "WITH t AS (SELECT doc_id, list_sort(" + _TOKENS.format(x="coalesce(text, '')") + """) AS t FROM documents),
        o AS (SELECT t, min(doc_id) AS class FROM t WHERE len(t) > 0 GROUP BY t),
        k AS (SELECT x.class AS a, y.class AS b FROM o x JOIN o y ON x.class < y.class AND len(x.t) >= 0.719 * len(y.t) AND len(y.t) >= 0.719 * len(x.t)
          WHERE CAST(len(list_intersect(x.t, y.t)) AS DOUBLE) / (len(x.t) + len(y.t) - len(list_intersect(x.t, y.t))) >= 0.72::DOUBLE),
        n AS (SELECT c, count(*) AS links FROM (SELECT a AS c FROM k UNION ALL SELECT b FROM k) u GROUP BY c)
        SELECT t.doc_id, coalesce(o.class, t.doc_id) AS class_id, coalesce(links, 0) AS links FROM t LEFT JOIN o ON t.t = o.t LEFT JOIN n ON n.c = o.class""",
    "span_overlap": "WITH g AS (" + _ground(_FOUND) + """) SELECT doc_id, evidence_character_start AS s,
        round(coalesce(CAST(greatest(0, least(evidence_character_end, evidence_character_start + 140) - greatest(evidence_character_start, evidence_character_start + 40)) AS DOUBLE) / nullif(least(evidence_character_end - evidence_character_start, 100), 0), 0.0), 9) AS overlap,
        0.0::DOUBLE AS "none" FROM g""",
    "candidate_scores": "WITH " + _CANDIDATES + " SELECT doc_id, p_index, e_index, method, score, round(ov, 9) AS evidence_overlap, round(st, 9) AS statement_similarity, round(fs, 9) AS field_similarity FROM cands",
    "greedy_match": _MATCHES + " SELECT doc_id, p_index, e_index, method, score FROM m",
    "evaluation_report": _MATCHES + """,
        pc AS (SELECT doc_id, count(*) AS n, count(*) FILTER (status = 'verified') AS v FROM p GROUP BY doc_id), ec AS (SELECT doc_id, count(*) AS k FROM e GROUP BY doc_id),
        mc AS (SELECT doc_id, count(*) AS t, count(*) FILTER (method = 'exact_evidence') AS a, count(*) FILTER (method = 'evidence_overlap') AS b, count(*) FILTER (method = 'field_similarity') AS c,
          count(*) FILTER (type_equal) AS ty, count(*) FILTER (exact_claim) AS ex FROM m GROUP BY doc_id),
        j AS (SELECT d.doc_id, coalesce(n, 0) AS n, coalesce(v, 0) AS v, coalesce(k, 0) AS k, coalesce(t, 0) AS t, coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(c, 0) AS c, coalesce(ty, 0) AS ty, coalesce(ex, 0) AS ex
          FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN pc USING (doc_id) LEFT JOIN ec USING (doc_id) LEFT JOIN mc USING (doc_id)),
        r AS (SELECT *, CAST(t AS DOUBLE) / nullif(n, 0) AS pr, CAST(t AS DOUBLE) / nullif(k, 0) AS rc FROM j)
        SELECT doc_id, n AS predicted_claim_count, v AS verified_count, k AS expected_claim_count, t AS matched_claim_count, a AS exact_evidence_match_count, b AS evidence_overlap_match_count, c AS field_similarity_match_count,
          ty AS correct_claim_type_count, ex AS exact_claim_match_count, n - t AS false_positive_count, k - t AS false_negative_count, round(pr, 9) AS claim_precision, round(rc, 9) AS claim_recall,
          round(CASE WHEN pr IS NULL OR rc IS NULL THEN NULL WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END, 9) AS claim_f1, round(CAST(ty AS DOUBLE) / nullif(t, 0), 9) AS claim_type_accuracy,
          round(CAST(ex AS DOUBLE) / nullif(t, 0), 9) AS exact_claim_match_rate, round(CAST(v AS DOUBLE) / nullif(n, 0), 9) AS evidence_verification_rate, round(CAST(n - v AS DOUBLE) / nullif(n, 0), 9) AS ungrounded_claim_rate,
          round(CAST(n - t AS DOUBLE) / nullif(n, 0), 9) AS unmatched_claim_rate FROM r""",
    "percent_format": """WITH b AS (SELECT doc_id % 50 AS bucket, count(*) FILTER (toxic = 1) AS t, count(*) FILTER (quality = 0) AS q FROM labels GROUP BY ALL)
        SELECT bucket, coalesce(format('{:.1f}%', 100 * CAST(t AS DOUBLE) / nullif(q, 0)), 'n/a') AS shown FROM b""",
    "review_template": "WITH " + _CLAIMS + " SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p_index) - 1 AS INT) AS claim_index, 'pending' AS decision, statement, true AS uncorrected FROM p",
    "review_decisions": "WITH " + _REVIEWS + """, both_ AS (
          SELECT doc, 0 AS part, doc_id, CASE WHEN decision = 'accepted' THEN statement ELSE 'corrected: ' || statement END AS claim FROM reviewed WHERE decision <> 'rejected'
          UNION ALL SELECT doc, 1, doc_id, statement FROM rows_ WHERE quality IS NULL)
        SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY part, doc_id) - 1 AS INT) AS ord, sha256(claim) AS claim_sha256 FROM both_ WHERE claim IS NOT NULL""",
    "review_summary": "WITH " + _REVIEWS + """ SELECT doc, count(*) FILTER (quality = 1) AS accepted, count(*) FILTER (quality IS NOT NULL AND quality <> 1 AND toxic = 1) AS rejected,
        count(*) FILTER (quality IS NOT NULL AND quality <> 1 AND toxic <> 1) AS needs_edit, count(*) FILTER (quality IS NULL) AS missed FROM rows_ GROUP BY doc""",
    "review_violations": "WITH " + _CLAIMS + """, n AS (SELECT doc_id AS doc, count(*) AS n FROM p GROUP BY doc_id)
        SELECT doc, CASE doc % 7 WHEN 1 THEN 'count_differs' WHEN 2 THEN CASE WHEN n > 1 THEN 'duplicate_index' END WHEN 3 THEN CASE WHEN n > 1 THEN 'claim_differs' ELSE 'index_out_of_range' END
          WHEN 4 THEN 'claim_differs' WHEN 5 THEN 'fingerprint_differs' WHEN 6 THEN 'pending' END AS violation FROM n""",
    "decision_rules": """SELECT doc_id, CASE doc_id % 4
          WHEN 3 THEN 'unknown_decision'
          WHEN 0 THEN CASE WHEN quality = 0 THEN 'reason_without_rejection' WHEN toxic = 1 THEN 'correction_without_needs_edit' END
          WHEN 1 THEN CASE WHEN quality <> 0 THEN 'rejected_without_reason' WHEN toxic = 1 THEN 'correction_without_needs_edit' END
          WHEN 2 THEN CASE WHEN toxic <> 1 THEN 'needs_edit_without_correction' WHEN quality = 0 THEN 'reason_without_rejection' END END AS problem FROM labels""",
    "provenance_mismatch": """WITH d AS (SELECT doc_id, lang, source, CASE WHEN doc_id % 5 > 0 THEN n_chars END AS n FROM documents),
        s AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 'xx' ELSE lang END AS l2, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE source END AS s2, CASE WHEN doc_id % 10 > 0 THEN n END AS n2 FROM d),
        l AS (SELECT doc_id, concat_ws(', ', CASE WHEN lang IS DISTINCT FROM l2 THEN 'language' END, CASE WHEN source IS DISTINCT FROM s2 THEN 'source hash' END, CASE WHEN n IS DISTINCT FROM n2 THEN 'length' END) AS labels FROM s)
        SELECT doc_id, labels FROM l WHERE labels <> ''""",
    "gold_violations": """WITH d AS (SELECT doc_id AS doc, text AS t, [left(text, 12), substr(text, CAST(floor(length(text) / 2) AS INT), 12), left(text, 12), 'not there'] AS l FROM documents WHERE length(text) >= 40),
        r AS (SELECT doc, t, CAST(i - 1 AS INT) AS ord, l[i] AS q, CASE WHEN doc % 2 = 0 AND i = 2 THEN left(t, 5) END AS s FROM d, unnest(range(1, 5)) u(i)),
        c AS (SELECT *, row_number() OVER (PARTITION BY doc, s, q ORDER BY ord) AS nth, (length(t) - length(replace(t, s, ''))) // length(s) AS sn, CASE WHEN s IS NULL THEN t ELSE substr(t, strpos(t, s) + length(s)) END AS area FROM r)
        SELECT doc, ord, CASE WHEN nth > 1 THEN 'duplicate_evidence' WHEN s IS NOT NULL AND sn <> 1 THEN 'scope_not_unique' WHEN NOT contains(area, q) THEN 'evidence_outside_scope' END AS problem FROM c""",
    "page_decoding": """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, doc_id % 4 AS kind, regexp_full_match(coalesce(text, ''), '(?s)[\\x{00}-\\x{FF}]*') AS fits FROM documents),
    h AS (SELECT doc_id, CASE WHEN kind = 0 OR (kind > 1 AND NOT fits) THEN 'utf-8' WHEN kind = 1 THEN 'utf-16-le' ELSE 'cp1252' END AS encoding,
      CASE WHEN kind = 0 THEN '<p>é' || text WHEN kind = 1 THEN '<p>' || text WHEN NOT fits THEN '<?xml version="1.0" encoding="utf-8"?><p>é' || text
        WHEN kind = 2 THEN '<!-- <meta charset=utf-8> --><meta http-equiv=Content-Type content=''text/html; charset=ISO-8859-1''><p>é' || text ELSE '<p>é ' || text END AS html FROM t)
    SELECT doc_id, encoding, sha256(html) AS html_sha256, CAST(length(html) AS INT) AS n_chars FROM h""",
    "archive_batch_status": """
    WITH once AS (SELECT source, n_chars % 50 AS bucket, sha256(text) AS content_sha256, count(*) AS copies FROM documents GROUP BY ALL),
    claims AS (SELECT source, bucket, count(*) AS n FROM once GROUP BY ALL),
    old AS (SELECT source, n_chars % 50 AS bucket, min(sha256(text)) AS h, min(doc_id) % 3 <> 0 AS sound, 1 AS there FROM documents WHERE doc_id % 5 = 0 GROUP BY ALL)
    SELECT source, bucket, content_sha256, copies,
      CASE WHEN there IS NULL AND n > 1 THEN 'conflict' WHEN there IS NULL THEN 'stored' WHEN NOT sound THEN 'corrupt' WHEN h = content_sha256 THEN 'unchanged' ELSE 'conflict' END AS status
    FROM once JOIN claims USING (source, bucket) LEFT JOIN old USING (source, bucket)""",
    "archive_status": "SELECT page_id, CASE WHEN page_id % 2 <> 0 THEN 'stored' WHEN page_id % 10 = 0 THEN 'corrupt' WHEN page_id % 6 = 0 THEN 'conflict' ELSE 'unchanged' END AS status FROM pages",
    "archive_integrity": """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'missing_metadata' WHEN page_id % 5 = 0 THEN 'hash_mismatch' ELSE 'sound' END AS status FROM pages
        UNION ALL SELECT page_id + 1000000, 'missing_file' FROM pages WHERE page_id % 7 = 0""",
    "document_upsert_status": "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'stored' WHEN 1 THEN 'unchanged' ELSE 'regenerated' END AS status FROM documents",
    "latest_by_form": """SELECT o_custkey AS cik, o_orderstatus AS form_type, min(o_orderkey) AS pos, CAST(arg_min(o_orderdate, o_orderkey) AS DATE) AS filed_at FROM orders GROUP BY o_custkey, o_orderstatus""",
    "submissions_decode": """SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE)) - 1 AS INT) AS pos, o_orderstatus AS form_type,
          lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-22-000001' AS accession_number, 'd' || CAST(o_orderkey AS VARCHAR) || '.htm' AS primary_document, CAST(o_orderdate AS DATE) AS filed_at,
          CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END AS reporting_period,
          'https://www.sec.gov/Archives/edgar/data/' || CAST(o_custkey AS VARCHAR) || '/' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '22000001/d' || CAST(o_orderkey AS VARCHAR) || '.htm' AS source_url FROM orders""",
    "artifact_names": """SELECT event_id, regexp_replace(CASE WHEN event_id % 3 = 0 THEN event_type || ':/' || CAST(user_id AS VARCHAR) ELSE strftime(ts, '%Y%m%dT%H%M%S.%fZ') END, '[^A-Za-z0-9._-]', '-', 'g') AS name FROM events""",
    "collapsed_text": """WITH d AS (SELECT doc_id, '  ' || chr(9) || replace(text, ' ', '  ' || chr(10) || ' ') || '  ' AS t FROM documents)
        SELECT doc_id, sha256(trim(regexp_replace(t, '\\s+', ' ', 'g'))) AS sha256, CAST(length(regexp_replace(t, '\\s+$', '')) AS INT) AS n FROM d""",
    "occurrences": """WITH d AS (SELECT doc_id, text AS t, left(text, 3) AS q, left(text, CAST(floor(length(text) / 2) AS INT)) AS h FROM documents WHERE length(text) >= 3)
        SELECT doc_id, CAST(CASE WHEN strpos(substr(t, 2), q) > 0 THEN strpos(substr(t, 2), q) ELSE -1 END AS INT) AS second,
          CAST(coalesce(list_max(list_filter(range(0, length(h) - 2), lambda i: substr(h, i + 1, 3) = q)), -1) AS INT) AS last, CAST((length(t) - length(replace(t, q, ''))) // 3 AS INT) AS n FROM d""",
}
