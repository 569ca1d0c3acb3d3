"""The same results as SQL, for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op4_decontamination"] = r"""
WITH items AS (
  SELECT item_id, words, least(len(words), 5) AS width FROM (SELECT item_id,
    list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM benchmark)
  WHERE len(words) >= 1
), held AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(words) - width + 2),
    lambda i: array_to_string(words[i:i + width - 1], ' '))) AS s
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS words FROM documents), (SELECT DISTINCT width FROM items) WHERE len(words) >= width
), wanted AS (
  SELECT DISTINCT item_id, unnest(list_transform(range(1, len(words) - width + 2),
    lambda i: array_to_string(words[i:i + width - 1], ' '))) AS s
  FROM items
), sizes AS (SELECT item_id, count(*) AS n_shingles FROM wanted GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_shingles, count(*) / n_shingles AS containment
FROM held JOIN wanted USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= 0.8 * n_shingles
"""

ORACLE["op6_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, source, unnest(list) AS line, generate_subscripts(list, 1) AS place
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS list FROM documents)
), common AS (
  SELECT line, min(doc_id) AS first_doc FROM lines
  WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''
  GROUP BY line HAVING count(DISTINCT source) >= 10
), marked AS (
  SELECT doc_id, place, l.line, coalesce(doc_id > first_doc, false) AS gone
  FROM lines l LEFT JOIN common c ON l.line = c.line
)
SELECT doc_id, cast(count(*) AS integer) AS n_lines, cast(count(*) FILTER (gone) AS integer) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE["op7_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, md5('17|' || doc_id) AS draw,
    cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS bigint) AS size
  FROM documents
), sources AS (
  SELECT source, cast(sum(size) AS bigint) AS source_size,
    [5.0::double, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, 3.0::double * source_size AS most,
    cast(sum(source_size) OVER () AS double)
      - coalesce(sum(3.0::double * source_size) OVER (ORDER BY 3.0 * source_size / weight, source
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(weight) OVER (ORDER BY 3.0 * source_size / weight DESC, source DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sharing,
    row_number() OVER (ORDER BY 3.0 * source_size / weight, source) AS place
  FROM sources
), level AS (
  SELECT remaining, sharing, place FROM filled WHERE remaining * weight / sharing <= most ORDER BY place LIMIT 1
), targets AS (
  SELECT f.source, f.source_size,
    CASE WHEN l.place IS NULL OR f.place < l.place THEN most ELSE l.remaining * weight / l.sharing END AS target
  FROM filled f LEFT JOIN level l ON true
), parts AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS whole FROM targets
), drawn AS (
  SELECT s.*, p.source_size, p.target, p.whole, round(p.target - p.whole * p.source_size) AS part,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, source, size, source_size, target,
  cast(whole * size + least(size, greatest(0, part - ahead)) AS bigint) AS taken
FROM drawn
"""

ORACLE["op8_revisits"] = r"""
WITH made AS (
  SELECT page_id, k, coalesce(html, '') AS html, page_id * 5 + k AS record_id,
    CASE WHEN k = 1 THEN url || '#again' ELSE url END AS url,
    1700000000 + (page_id * 7919) % (30 * 86400) + k * (3 * 86400 + page_id % 1000) AS time
  FROM pages, (SELECT unnest(range(5)) AS k)
), records AS (
  SELECT *, k IN (0, 2) AS entire,
    lower(regexp_extract(url, '^[A-Za-z][\w+.-]*://([^/?#]*)', 1)) AS host,
    regexp_replace(regexp_extract(url, '^[A-Za-z][\w+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> ''
      AND NOT regexp_matches(x, '^(?i:utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)(=|$)'))) AS fields,
    '"' || left(md5(html), 16) || '-' AS tag,
    CASE WHEN k IN (0, 2) THEN '"' || left(md5(html), 16) || '-' || k || '"'
      WHEN k = 1 AND page_id % 3 <> 0 THEN 'W/"' || left(md5(html), 16) || '-0"'
      WHEN k = 3 AND page_id % 4 = 0 THEN '"' || left(md5(html), 16) || '-0"'
      WHEN k = 3 THEN '"' || left(md5(html), 16) || '-2"' END AS etag,
    CASE WHEN k IN (0, 2) THEN 'day ' || (page_id % 28 + k) WHEN k = 1 THEN 'day ' || (page_id % 28)
      WHEN k = 4 AND page_id % 5 <> 0 THEN 'day ' || (page_id % 28 + 2) END AS modified,
    CASE WHEN k IN (0, 2) THEN md5(html || k) END AS digest
  FROM made
), named AS (
  SELECT *, CASE WHEN host = '' THEN url ELSE
    regexp_replace(regexp_replace(host, ':\d+$', ''), '^www\.', '') || path
      || CASE WHEN len(fields) > 0 THEN '?' || array_to_string(fields, '&') ELSE '' END END AS canonical
  FROM records
), paired AS (
  SELECT r.record_id, r.url, r.canonical, r.time, r.k, r.etag, r.modified,
    f.record_id AS response_id, f.time AS response_time, f.etag AS old_etag, f.modified AS old_modified,
    f.digest, length(f.html) AS size
  FROM (SELECT * FROM named WHERE NOT entire) r
  LEFT JOIN (SELECT * FROM named WHERE entire) f ON r.canonical = f.canonical AND f.time < r.time
  QUALIFY row_number() OVER (PARTITION BY r.record_id ORDER BY f.time DESC NULLS LAST, f.record_id DESC) = 1
), judged AS (
  SELECT *, coalesce(regexp_replace(etag, '^W/', '') = regexp_replace(old_etag, '^W/', ''),
    modified = old_modified) AS agrees FROM paired
), told AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'missing' WHEN agrees THEN 'resolved'
    WHEN agrees IS NULL THEN 'unverified' ELSE 'changed' END AS outcome FROM judged
)
SELECT record_id, url, canonical, time, response_id, response_time, outcome,
  CASE WHEN outcome = 'resolved' THEN concat_ws(chr(10),
    CASE WHEN k = 4 THEN 'cache-control: max-age=60' END, 'content-length: ' || size, 'date: ' || k,
    'etag: ' || coalesce(etag, old_etag), 'last-modified: ' || coalesce(modified, old_modified),
    'server: origin') END AS headers,
  CASE WHEN outcome = 'resolved' THEN digest END AS digest
FROM told
"""

ORACLE["op11_source_divergence"] = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), uses AS (
  SELECT lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs)
  GROUP BY lang, term HAVING count(*) >= 10
), used AS (
  SELECT lang, source, term, count(*) AS n FROM uses JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(s.n, 0) + 2 * coalesce(v, 0) AS whole
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN langs USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM used GROUP BY ALL) s
      ON g.lang = s.lang AND g.source = s.source
), shares AS (
  SELECT lang, source, k.term, coalesce(n, 0) AS n,
    1 + 1000000000::hugeint * (coalesce(n, 0) + 2) // whole AS p
  FROM groups JOIN kept k USING (lang) LEFT JOIN used USING (lang, source, term)
), overall AS (
  SELECT lang, term, 1 + 1000000000::hugeint * (sum(n) + 2) // (any_value(t) + 2 * any_value(v)) AS q
  FROM used JOIN langs USING (lang) JOIN (SELECT lang, sum(n) AS t FROM used GROUP BY lang) USING (lang)
  GROUP BY lang, term
), summed AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), valued AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN summed s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q)
  FROM shares JOIN overall USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, cast(value AS bigint) AS value,
  cast(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS integer) AS rank
FROM valued
QUALIFY part = 'pair' OR rank <= 10
"""


def _rounds(count: int) -> str:
    """The assignments and codebooks of op12, round by round."""
    steps = []
    for i in range(count + 1):
        steps.append(f"""
), far_{i} AS MATERIALIZED (
  SELECT r, part, entry, sum((c.v - e.v) * (c.v - e.v)) AS d
  FROM components c JOIN entries_{i} e USING (part, place) GROUP BY r, part, entry
), near_{i} AS MATERIALIZED (
  SELECT r, part, entry, d FROM far_{i} QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1""")
        if i < count:
            steps.append(f"""
), mean_{i} AS (
  SELECT part, entry, place, sum(v) AS s, count(*)::hugeint AS n
  FROM near_{i} JOIN components USING (r, part) GROUP BY part, entry, place
), entries_{i + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce((s - ((s % n) + n) % n) // n, v) AS v
  FROM entries_{i} LEFT JOIN mean_{i} USING (part, entry, place)""")
    return "".join(steps)


ORACLE["op12_vector_codes"] = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), components AS MATERIALIZED (
  SELECT r, (i - 1) // (len(embedding) // 8) AS part, (i - 1) % (len(embedding) // 8) AS place,
    floor(4096 * embedding[i]::double)::hugeint AS v
  FROM (SELECT r, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)
), entries_0 AS MATERIALIZED (
  SELECT part, r - 1 AS entry, place, v FROM components WHERE r <= 16{_rounds(6)}
), coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::bigint AS error
  FROM near_6 GROUP BY r
)
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error,
  (SELECT sha256(string_agg(v::varchar, ',' ORDER BY part, entry, place)) FROM entries_6) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""

ORACLE["op13_set_join"] = r"""
WITH RECURSIVE worded AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN coalesce(len(words), 0) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS s
  FROM worded
), texts AS MATERIALIZED (
  SELECT t, len(any_value(s)) AS n, min(doc_id) AS doc_id, unnest(any_value(s)) AS shingle
  FROM (SELECT doc_id, s, md5(array_to_string(list_sort(s), chr(10))) AS t FROM sets WHERE len(s) > 0) GROUP BY t
), links AS MATERIALIZED (
  SELECT a.t AS one, b.t AS two FROM texts a JOIN texts b ON a.shingle = b.shingle AND a.t <> b.t
  GROUP BY a.t, b.t, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
  SELECT DISTINCT t AS one, t AS two FROM texts
  UNION
  SELECT reached.one, links.two FROM reached JOIN links ON reached.two = links.one
), classed AS (
  SELECT one AS t, min(doc_id) AS component_id FROM reached JOIN (SELECT DISTINCT t, doc_id FROM texts) k ON two = k.t
  GROUP BY one
)
SELECT doc_id, cast(len(s) AS bigint) AS n_shingles,
  CASE WHEN len(s) = 0 THEN doc_id ELSE component_id END AS component_id
FROM sets LEFT JOIN classed ON t = md5(array_to_string(list_sort(s), chr(10)))
"""
