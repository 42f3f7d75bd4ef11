"""SQL twins (DuckDB) of the operators that SQL can express."""

from __future__ import annotations

from ledgerline.llm.licenses import SLACK, TEMPLATES

URL_FILTERS = r"""
WITH rules(rhost, rpath, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parted AS (
  SELECT page_id, row_number() OVER () AS row,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), fitting AS (
  SELECT row, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM parted JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY row
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parted LEFT JOIN fitting USING (row)
"""

CHAT_FORMATTING = r"""
WITH said AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS m FROM said GROUP BY conv_id
), same AS (
  SELECT m, min(conv_id) AS conv_id, count(*) AS n_copies FROM whole GROUP BY m
), inner_part AS (
  SELECT DISTINCT m[1:k] AS m FROM (SELECT m, unnest(range(1, len(m))) AS k FROM same)
)
SELECT conv_id, CAST(len(m) AS INTEGER) AS n_turns, n_copies,
       array_to_string(list_transform(m, lambda x: '<|im_start|>' || x.r || chr(10) || x.t || '<|im_end|>' || chr(10)), '') AS text
FROM same WHERE m NOT IN (SELECT m FROM inner_part)
"""

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL
), wanted AS (
  SELECT DISTINCT id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS run
  FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents
), sizes AS (SELECT DISTINCT size FROM wanted), start AS (
  SELECT row, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size
), hit AS (
  SELECT row, i, s.size, id FROM (SELECT row, i, size, array_to_string(w[i:i + size - 1], ' ') AS run FROM start) AS s
  JOIN wanted USING (size, run)
), covered AS (
  SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT row, i, size FROM hit)) GROUP BY row
), named AS (
  SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT row, id FROM hit WHERE id IS NOT NULL) GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (row) LEFT JOIN named USING (row)
"""

_URN = "'urn:uuid:' || substr({0}, 1, 8) || '-' || substr({0}, 9, 4) || '-' || substr({0}, 13, 4) || '-' || substr({0}, 17, 4) || '-' || substr({0}, 21, 12)"


def _resolved(text: str) -> str:
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{char}')"
    return text


_BLOCKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
_VISIBLE = (
    "regexp_replace(regexp_replace(regexp_replace(html, "
    r"'(?is)<script[^<>]*>.*?(?:</script[^<>]*>|\z)|<style[^<>]*>.*?(?:</style[^<>]*>|\z)|<!--.*?(?:-->|\z)', ' ', 'g'), "
    rf"'(?i)</?(?:{_BLOCKS})(?:[ \t\r\n/][^<>]*)?>', chr(10), 'g'), "
    r"'</?[a-zA-Z!?][^<>]*>', '', 'g')"
)
_TEXT = rf"trim(regexp_replace(regexp_replace({_resolved(_VISIBLE)}, '[ \t\r\f]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10))"
_TITLE = _resolved(r"regexp_extract(html, '(?i)<title[^<>]*>([^<]*)', 1)")

WARC_DERIVATIVES = rf"""
WITH response AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS html FROM pages
), source AS (
  SELECT *, md5('response' || chr(10) || coalesce(CAST(page_id AS VARCHAR), '') || chr(10) || target_uri || chr(10) || md5(html)) AS h,
         'sha256:' || sha256(html) AS source_digest,
         'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) ||
         'Content-Length: ' || strlen(html) || chr(13) || chr(10) AS header
  FROM response
), record AS (
  SELECT page_id, target_uri, source_digest, {_URN.format('h')} AS refers_to, 'metadata' AS warc_type,
         'application/warc-fields' AS content_type,
         'title: ' || trim(regexp_replace({_TITLE}, '[ \t\r\n\f]+', ' ', 'g')) || chr(13) || chr(10) ||
         'links: ' || len(regexp_extract_all(html, '(?i)<a[ \t\r\n][^<>]*href')) || chr(13) || chr(10) ||
         'payload-digest: ' || source_digest || chr(13) || chr(10) || header AS block, header
  FROM source
  UNION ALL
  SELECT page_id, target_uri, source_digest, {_URN.format('h')}, 'conversion', 'text/plain', {_TEXT}, header FROM source
), keyed AS (
  SELECT *, md5(warc_type || chr(10) || refers_to) AS k, 'sha256:' || sha256(block) AS block_digest FROM record
), named AS (SELECT *, {_URN.format('k')} AS record_id FROM keyed)
SELECT page_id, warc_type, record_id, refers_to, target_uri, content_type, CAST(strlen(block) AS BIGINT) AS content_length,
       source_digest, block_digest,
       sha256('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: ' || warc_type || chr(13) || chr(10) ||
         'WARC-Record-ID: <' || record_id || '>' || chr(13) || chr(10) || 'WARC-Refers-To: <' || refers_to || '>' || chr(13) || chr(10) ||
         'WARC-Refers-To-Payload-Digest: ' || source_digest || chr(13) || chr(10) || 'WARC-Refers-To-HTTP-Header: ' ||
         replace(rtrim(header, chr(13) || chr(10)), chr(13) || chr(10), chr(13) || chr(10) || ' ') || chr(13) || chr(10) ||
         'WARC-Target-URI: ' || target_uri || chr(13) || chr(10) || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10) ||
         'WARC-Block-Digest: ' || block_digest || chr(13) || chr(10) || 'Content-Type: ' || content_type || chr(13) || chr(10) ||
         'Content-Length: ' || strlen(block) || chr(13) || chr(10) || chr(13) || chr(10) || block ||
         chr(13) || chr(10) || chr(13) || chr(10)) AS record_sha256
FROM named
"""

_SEARCH_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL_SEARCH = f"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, {_SEARCH_TERMS.format('text')} AS w FROM documents WHERE text IS NOT NULL
), sized AS (SELECT row, doc_id, w, len(w) AS n FROM doc WHERE len(w) > 0
), whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized
), tf AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM sized) GROUP BY ALL
), weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS wt
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole
), item AS (
  SELECT q, item_id, term, count(*) AS times
  FROM (SELECT q, item_id, unnest({_SEARCH_TERMS.format('text')}) AS term FROM (SELECT row_number() OVER () AS q, * FROM benchmark WHERE text IS NOT NULL))
  GROUP BY ALL
), scored AS (
  SELECT q, item_id, row, any_value(doc_id) AS doc_id,
         CAST(sum(times * wt * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM item JOIN weight USING (term) JOIN tf USING (term) JOIN sized USING (row), whole GROUP BY q, item_id, row
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def _literal(text: str) -> str:
    return "'" + text.replace("'", "\'\'") + "'"


_TEMPLATES = ", ".join(f"({i}, {_literal(t.label)}, {t.base}, {t.share}, {_literal(t.text)})" for i, t in enumerate(TEMPLATES))

LICENSE_SCANS = f"""
WITH template AS (
  SELECT *, len(w) AS size, CASE WHEN len(w) >= 4 THEN 4 ELSE 2 END AS k, CASE WHEN share >= 1 THEN 0 ELSE {SLACK} END AS slack
  FROM (SELECT t, label, base, share, {_WORDS.format('text')} AS w FROM (VALUES {_TEMPLATES}) AS v(t, label, base, share, text))
), template_run AS (
  SELECT t, k, j, array_to_string(w[j + 1:j + k], ' ') AS run FROM (SELECT t, k, w, unnest(range(0, size - k + 1)) AS j FROM template)
), doc AS (
  SELECT row_number() OVER () AS row, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
), run AS (
  SELECT row, k, i, array_to_string(w[i + 1:i + k], ' ') AS run
  FROM (SELECT row, k, w, unnest(range(0, len(w) - k + 1)) AS i FROM doc, (VALUES (2), (4)) AS ks(k) WHERE len(w) >= k)
), vote AS (
  SELECT DISTINCT row, t, i - j AS diagonal, j FROM run JOIN template_run USING (k, run)
), placed AS (
  SELECT row, t, diagonal, sum(apart) OVER (PARTITION BY row, t ORDER BY diagonal) AS place
  FROM (SELECT row, t, diagonal, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY row, t ORDER BY diagonal) > slack THEN 1 ELSE 0 END AS apart
        FROM (SELECT DISTINCT row, t, diagonal FROM vote) JOIN template USING (t))
), covered AS (
  SELECT row, t, place, min(diagonal + j) AS start, count(DISTINCT j + o) AS n
  FROM vote JOIN placed USING (row, t, diagonal) JOIN template USING (t), range(4) AS r(o) WHERE o < k GROUP BY ALL
), found AS (
  SELECT row, label, base, start, CAST(n AS DOUBLE) / size AS share FROM covered JOIN template USING (t) WHERE n >= ceil(template.share * size)
), said AS (
  SELECT row, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM found GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM doc LEFT JOIN said USING (row)
"""

_LETTER_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

SOURCE_DIVERGENCE = f"""
WITH doc AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LETTER_TERMS} AS w FROM documents
), held AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS n_docs FROM (SELECT row, lang, source, unnest(w) AS term FROM doc) GROUP BY ALL
), kept AS (SELECT lang, term, sum(n) AS n FROM held GROUP BY ALL HAVING sum(n_docs) >= 30
), lang AS (SELECT lang, count(*) AS V, sum(n) AS N FROM kept GROUP BY lang
), grp AS (SELECT DISTINCT lang, source FROM doc
), total AS (
  SELECT lang, source, coalesce(sum(held.n), 0) AS N FROM grp LEFT JOIN (held SEMI JOIN kept USING (lang, term)) AS held USING (lang, source) GROUP BY ALL
), dense AS (
  SELECT lang, source, term, coalesce(held.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(held.n, 0) + 5)) // (total.N + 5 * V) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (kept.n + 5)) // (lang.N + 5 * V) AS q
  FROM total JOIN lang USING (lang) JOIN kept USING (lang) LEFT JOIN held USING (lang, source, term)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM dense AS a JOIN dense AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), part AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp AS a JOIN grp AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM dense WHERE n > 0 AND p > q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM part)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLE = {
    "op1_url_filters": URL_FILTERS,
    "op2_chat_formatting": CHAT_FORMATTING,
    "op3_decontamination": DECONTAMINATION,
    "op5_warc_derivatives": WARC_DERIVATIVES,
    "op11_lexical_search": LEXICAL_SEARCH,
    "op12_license_scans": LICENSE_SCANS,
    "op13_source_divergence": SOURCE_DIVERGENCE,
}
