"""DuckDB SQL over the given tables for the operators that SQL can express."""

from __future__ import annotations

from railyard.llm.license_rules import RULES
from railyard.llm.licenses import placed_pattern
from railyard.llm.urls import FILTER_LIST

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
LOWER = "'abcdefghijklmnopqrstuvwxyz'"

OP2 = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM totals),
weighted AS (
  SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 2 * source_size AS cap,
         [1.0, 0.5, 2.0][rank % 3 + 1]::DOUBLE AS w0, [1.0, 2.0, 0.5][rank % 3 + 1]::DOUBLE AS w1
  FROM ranked),
walked AS (
  SELECT *, row_number() OVER by_ratio AS step,
         (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
           - coalesce(sum(cap) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(weight) OVER ()
           - coalesce(sum(weight) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           AS level
  FROM weighted
  WINDOW by_ratio AS (ORDER BY cap::DOUBLE / weight::DOUBLE, rank)),
free AS (SELECT min(step) AS step FROM walked WHERE level * weight <= cap),
goal AS (
  SELECT w.source, w.source_size, w.w0, w.w1,
         CASE WHEN f.step IS NULL OR w.step < f.step THEN w.cap::DOUBLE
              ELSE least((SELECT level FROM walked x WHERE x.step = f.step) * w.weight, w.cap::DOUBLE) END AS target
  FROM walked w, free f),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.w0, g.w1, CAST(floor(g.target) AS BIGINT) AS budget,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - s.size AS start
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
counted AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS passes FROM placed),
taken AS (
  SELECT *, greatest(0, least(size, budget - passes * source_size - start)) AS part FROM counted),
timed AS (
  SELECT *, CASE WHEN size = 0 OR passes * size + part = 0 THEN NULL
                 ELSE (start + (CASE WHEN passes > 0 THEN size ELSE part END)::DOUBLE / 2) / target * ((w0 + w1) / 2)
            END AS area
  FROM taken)
SELECT doc_id, size, source_size, target, CAST(passes * size + part AS BIGINT) AS taken,
       2 * area / (w0 + sqrt(w0 * w0 + 2 * (w1 - w0) * area)) AS position
FROM timed"""

OP3 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS body, {WORDS} AS w FROM documents),
windows AS (
  SELECT row_id, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS g
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs WHERE len(w) >= 3)),
repeated AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT row_id, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row_id),
split AS (SELECT row_id, unnest(string_split(body, chr(10))) AS line FROM docs),
own AS (
  SELECT row_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id),
normal AS (
  SELECT d.row_id, d.doc_id, d.source, d.body, l.line,
         len(regexp_extract_all(l.line, '[^\x20\x09-\x0D]+')) AS line_words
  FROM docs d JOIN (
    SELECT row_id, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
      'abcdefghijklmnopqrstuvwxyz000000000'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line FROM split) l
  ON d.row_id = l.row_id WHERE l.line <> ''),
per_line AS (
  SELECT source, line, count(DISTINCT md5(body)) AS n_docs, min(doc_id) AS first_doc FROM normal GROUP BY source, line),
per_host AS (SELECT source, count(DISTINCT md5(body)) AS host_docs FROM docs GROUP BY source),
frequent AS (
  SELECT l.* FROM per_line l JOIN per_host h ON l.source IS NOT DISTINCT FROM h.source
  WHERE l.n_docs >= 20 AND (l.n_docs * 100 > h.host_docs * 10 OR l.n_docs >= 10000)),
removed AS (
  SELECT n.row_id, sum(line_words) AS removed_words
  FROM normal n JOIN frequent f ON n.source IS NOT DISTINCT FROM f.source AND n.line = f.line
  WHERE n.doc_id IS DISTINCT FROM f.first_doc GROUP BY n.row_id),
measured AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words
  FROM docs d LEFT JOIN covered USING (row_id) LEFT JOIN own USING (row_id) LEFT JOIN removed USING (row_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND NOT 100 * (n_words - removed_words) < 30 * n_words AS kept
FROM measured"""

#: The lines are read and turned into expressions by the SQL itself, and every
#: rule is tried on every page.
OP6 = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parsed AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {UPPER}, {LOWER}), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         coalesce(translate(regexp_extract(rest, '^[^#]*'), {UPPER}, {LOWER}), '') AS address
  FROM cut),
rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
lines AS (SELECT DISTINCT trim(unnest(string_split('{FILTER_LIST}', chr(10)))) AS line),
bodies AS (
  SELECT line, starts_with(line, '@@') AS wanted, translate(regexp_replace(line, '^@@', ''), {UPPER}, {LOWER}) AS body
  FROM lines WHERE line <> '' AND NOT starts_with(line, '!')),
patterns AS (
  SELECT line, wanted,
    CASE WHEN starts_with(body, '||') THEN '^([^/?]*[.])?' WHEN starts_with(body, '|') THEN '^' ELSE '' END
    || replace(replace(regexp_replace(regexp_replace(body, '^[|]+|[|]$', '', 'g'), '([-.+?$(){{}}&=\[\]\\])', '\\\1', 'g'),
                       '^', '(^|[^a-z0-9]+|$)'), '*', '.*')
    || CASE WHEN body LIKE '%|' THEN '$' ELSE '' END AS pattern
  FROM bodies),
ruled AS (
  SELECT *,
    (SELECT max(struct_pack(n := length(rule_host || rule_path), r := rule_host || rule_path, v := rule_verdict))
     FROM rules WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS best,
    (SELECT min(struct_pack(last := NOT wanted, line := line)) FROM patterns
     WHERE regexp_matches(address, pattern, 's')) AS loose
  FROM parsed)
SELECT page_id, host, path, best.r AS rule,
       coalesce(best.v, CASE WHEN loose.last THEN 'block' ELSE 'allow' END) AS verdict, loose.line AS pattern
FROM ruled"""

OP9 = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000
      GROUP BY payload_digest HAVING count(*) > 1 AND max(page_id) IS NOT NULL)
SELECT p.*, CASE WHEN page_id IS DISTINCT FROM keeper AND keeper IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.payload_digest = k.payload_digest AND p.payload_bytes >= 1000"""

TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {UPPER}, {LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11 = f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, {TERMS} AS terms FROM documents),
items AS (SELECT row_number() OVER () AS item, item_id, list_distinct({TERMS}) AS terms FROM benchmark),
sizes AS (
  SELECT CAST(count(*) FILTER (WHERE len(terms) > 0) AS BIGINT) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM docs),
asked AS (SELECT item, item_id, unnest(terms) AS term FROM items),
counted AS (
  SELECT row_id, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT row_id, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * s.docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, sizes s GROUP BY term, s.docs),
scored AS (
  SELECT item, item_id, row_id, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * c.n * s.docs) // s.total)))) AS BIGINT) AS score
  FROM asked JOIN counted c USING (term) JOIN weights USING (term), sizes s GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""

OP12 = """
WITH RECURSIVE remainder(n, k, c) AS (
  SELECT n, 0, n FROM range(256) r(n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM remainder WHERE k < 8),
ids AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS digits FROM documents WHERE doc_id IS NOT NULL),
crc(doc_id, digits, i, c) AS (
  SELECT doc_id, digits, 0, 4294967295::BIGINT FROM ids
  UNION ALL
  SELECT w.doc_id, digits, i + 1, xor(t.c, w.c >> 8)
  FROM crc w JOIN remainder t ON t.k = 8 AND t.n = xor(w.c, ascii(substr(digits, i + 1, 1))) & 255
  WHERE i < length(digits)),
touched AS (SELECT doc_id FROM crc WHERE i = length(digits) AND xor(c, 4294967295) % 7 = 0),
cells AS (
  SELECT doc_id, lang, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS own,
         [CAST(doc_id AS VARCHAR), source, lang,
          CAST(n_chars + CASE WHEN doc_id IN (SELECT doc_id FROM touched) THEN 1 ELSE 0 END AS VARCHAR), text] AS claim
  FROM documents),
digests AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g,
         sha256(array_to_string([CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END FOR v IN own], '')) AS leaf,
         sha256(array_to_string([CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END FOR v IN claim], '')) AS claimed
  FROM cells),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY g) AS n
  FROM digests),
tree(g, k, p, n, h) AS (
  SELECT g, 0, p, n, leaf FROM leaves
  UNION ALL
  SELECT g, k + 1, p // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY p)) FROM tree WHERE n > 1 GROUP BY g, k, p // 2),
subroots AS (
  SELECT g, h, k AS height, row_number() OVER (ORDER BY encode(g)) - 1 AS p, count(*) OVER () AS n FROM tree WHERE n = 1),
crown(k, p, n, h) AS (
  SELECT 0, p, n, h FROM subroots
  UNION ALL
  SELECT k + 1, p // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY p)) FROM crown WHERE n > 1 GROUP BY k, p // 2),
fold(start, g, k, p, n, f, proof) AS (
  SELECT p, g, 0, p, n, claimed, '' FROM leaves
  UNION ALL
  SELECT f.start, f.g, f.k + 1, f.p // 2, (f.n + 1) // 2,
         sha256(CASE WHEN t.h IS NULL THEN f.f WHEN t.p < f.p THEN t.h || f.f ELSE f.f || t.h END), proof || coalesce(t.h, '')
  FROM fold f LEFT JOIN tree t ON t.g = f.g AND t.k = f.k AND t.p = xor(f.p, 1) WHERE f.n > 1),
rise(start, g, k, p, n, f, proof) AS (
  SELECT f.start, f.g, 0, s.p, s.n, f.f, f.proof FROM fold f JOIN subroots s ON s.g = f.g AND f.n = 1
  UNION ALL
  SELECT r.start, r.g, r.k + 1, r.p // 2, (r.n + 1) // 2,
         sha256(CASE WHEN c.h IS NULL THEN r.f WHEN c.p < r.p THEN c.h || r.f ELSE r.f || c.h END), proof || coalesce(c.h, '')
  FROM rise r LEFT JOIN crown c ON c.k = r.k AND c.p = xor(r.p, 1) WHERE r.n > 1)
SELECT l.doc_id, l.leaf, s.h AS subroot, c.h AS root, sha256(r.proof) AS proof_sha256, r.f AS folded_root, r.f = c.h AS verified
FROM leaves l JOIN rise r ON r.g = l.g AND r.start = l.p AND r.n = 1 JOIN subroots s ON s.g = l.g JOIN crown c ON c.n = 1"""

def _rule_values() -> str:
    row = lambda r: f"({r.number}, '{r.label}', {r.priority}, {r.confidence}::DOUBLE, '{placed_pattern(r.pattern)}', {r.base})"
    return ", ".join(map(row, RULES))


OP13 = rf"""
WITH rules(number, label, priority, confidence, pattern, base) AS (VALUES {_rule_values()}),
docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), {UPPER}, {LOWER}), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
placed AS (
  SELECT row_id, doc_id, CAST(len(words) AS BIGINT) AS n_words,
         array_to_string(list_transform(words, lambda w, i: ' ' || (i - 1) || '~' || w || ' '), '') AS p
  FROM docs),
spans AS (
  SELECT *, CAST(regexp_extract(m, '^ (\d+)~', 1) AS BIGINT) AS a, CAST(regexp_extract(m, '(\d+)~\S+ $', 1) AS BIGINT) AS z
  FROM (SELECT row_id, r.*, unnest(regexp_extract_all(p, pattern)) AS m FROM placed, rules r)),
stay AS (
  SELECT * FROM spans s WHERE base OR NOT EXISTS (
    SELECT 1 FROM spans o WHERE NOT o.base AND o.row_id = s.row_id AND (
      (o.a <= s.a AND o.z >= s.z AND o.priority >= s.priority
        AND (o.a < s.a OR o.z > s.z OR o.priority > s.priority OR o.number < s.number))
      OR (o.a >= s.a AND o.z <= s.z AND o.priority > s.priority)))),
per_row AS (
  SELECT row_id, count(*) FILTER (WHERE base) AS n_base, min(a) FILTER (WHERE base) AS first_word,
         max(a) FILTER (WHERE base) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(confidence) AS score,
         count(*) FILTER (WHERE NOT base) AS n_method
  FROM stay GROUP BY row_id)
SELECT doc_id, n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score, coalesce(n_method, 0)::BIGINT AS n_method
FROM placed LEFT JOIN per_row USING (row_id)"""

SQL = {"op2_mixing": OP2, "op3_line_frequency": OP3, "op6_url_filter": OP6, "op9_warc": OP9, "op11_lexical_search": OP11,
       "op12_merkle_manifest": OP12,
       "op13_license_scan": OP13}
