"""DuckDB counterparts of the queries that SQL can express."""

QUALITY_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), placed_words AS (
  SELECT rid, unnest(words) AS word, unnest(range(len(words))) AS i FROM w
), windows AS (
  SELECT rid, i, [word, lead(word, 1) OVER p, lead(word, 2) OVER p, lead(word, 3) OVER p, lead(word, 4) OVER p] AS g
  FROM placed_words WINDOW p AS (PARTITION BY rid ORDER BY i) QUALIFY lead(word, 4) OVER p IS NOT NULL
), repeated AS (
  SELECT rid, g FROM windows GROUP BY rid, g HAVING count(*) > 1
), covered AS (
  SELECT rid, count(DISTINCT place) AS n
  FROM (SELECT rid, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS place FROM windows SEMI JOIN repeated USING (rid, g))
  GROUP BY rid
), m AS (
  SELECT w.rid, doc_id, lang, source, len(words)::BIGINT AS n_words,
    coalesce(length(list_aggregate(words, 'string_agg', '')), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
  FROM w LEFT JOIN covered ON w.rid = covered.rid
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    [100 * word_chars // greatest(n_words, 1), 1000 * n_symbols // greatest(word_chars, 1),
     1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1)] AS s
  FROM m
), listed AS (
  SELECT lang, source, unnest([0, 1, 2, 3]) AS signal, unnest(s) AS v FROM f WHERE NOT base_failed
), sketch AS (
  SELECT lang, source, signal, v - v % CAST(pow(2, greatest(length(bin(v)) - 7, 0)) AS BIGINT) AS low FROM listed
), levels AS (
  SELECT 0 AS level, lang, source, signal, low, count(*) AS n FROM sketch GROUP BY ALL
  UNION ALL SELECT 1, lang, NULL, signal, low, count(*) FROM sketch GROUP BY ALL
  UNION ALL SELECT 2, NULL, NULL, signal, low, count(*) FROM sketch GROUP BY ALL
), placed AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, signal ORDER BY low) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, signal) AS total
  FROM levels
), quant AS (
  SELECT level, lang, source, signal, max(total) AS total,
    min(low) FILTER (100 * upto >= [25, 25, 2, 2][signal + 1] * total) AS lo,
    min(low) FILTER (2 * upto >= total) AS mid,
    min(low) FILTER (100 * upto >= [75, 75, 98, 98][signal + 1] * total) AS hi
  FROM placed GROUP BY ALL
), fences AS (
  SELECT level, lang, source, signal, total,
    lo - greatest([10, 10, 1, 2][signal + 1] * (mid - lo + CAST(pow(2, greatest(length(bin(mid)) - 7, 0)) AS BIGINT) - 1), CAST(pow(2, greatest(length(bin(lo)) - 7, 0)) AS BIGINT)) AS least,
    hi + greatest([10, 10, 1, 2][signal + 1] * (hi - mid + CAST(pow(2, greatest(length(bin(mid)) - 7, 0)) AS BIGINT) - 1), CAST(pow(2, greatest(length(bin(hi)) - 7, 0)) AS BIGINT)) AS most
  FROM quant
), chosen AS (
  SELECT o.lang, o.source, o.signal,
    CASE WHEN o.total >= 100 THEN o.least WHEN l.total >= 100 THEN l.least ELSE a.least END AS least,
    CASE WHEN o.total >= 100 THEN o.most WHEN l.total >= 100 THEN l.most ELSE a.most END AS most
  FROM fences o
  JOIN fences l ON l.level = 1 AND l.signal = o.signal AND l.lang IS NOT DISTINCT FROM o.lang
  JOIN fences a ON a.level = 2 AND a.signal = o.signal
  WHERE o.level = 0
), outside AS (
  SELECT DISTINCT rid
  FROM (SELECT rid, lang, source, unnest([0, 1, 2, 3]) AS signal, unnest(s) AS v FROM f) x
  JOIN chosen c ON c.signal = x.signal AND c.lang IS NOT DISTINCT FROM x.lang
    AND c.source IS NOT DISTINCT FROM x.source
  WHERE v > most OR v < least
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rid NOT IN (SELECT rid FROM outside) AS kept
FROM f
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, text FROM documents
), marked AS (
  SELECT rid, doc_id, regexp_replace(regexp_replace(regexp_replace(text,
    '(\n)', '\1' || chr(1), 'g'), '([ \t\r])(\p{Lu})', '\1' || chr(1) || '\2', 'g'),
    '([.!?][ \t\r])([^\s\x01])', '\1' || chr(1) || '\2', 'g') AS t
  FROM d
), split AS (
  SELECT rid, doc_id, string_split(t, chr(1)) AS units FROM marked
), listed AS (
  SELECT rid, doc_id, unnest(units) AS unit, unnest(range(len(units))) AS place FROM split
), sized AS (
  SELECT *, coalesce(sum(length(unit)) OVER (PARTITION BY rid ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
    regexp_replace(trim(lower(unit), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g') AS plain
  FROM listed
), worded AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY place) AS number, len(string_split(plain, ' ')) AS words
  FROM sized WHERE plain <> ''
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY plain ORDER BY doc_id, number) AS nth FROM worded
), islands AS (
  SELECT *, number - row_number() OVER (PARTITION BY rid ORDER BY number) AS island FROM ranked WHERE nth > 1
), runs AS (
  SELECT rid, min(place) AS p, max(place) AS q, min(start) AS start, max(start + length(unit)) AS stop
  FROM islands GROUP BY rid, island HAVING sum(words) >= 30
), kept AS (
  SELECT s.rid, string_agg(s.unit, '' ORDER BY s.place) AS text
  FROM sized s WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.rid = s.rid AND s.place BETWEEN r.p AND r.q)
  GROUP BY s.rid
), spans AS (
  SELECT rid, string_agg(start::BIGINT || '-' || stop::BIGINT, ',' ORDER BY start) AS removed, count(*) AS n
  FROM runs GROUP BY rid
)
SELECT doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
  coalesce(spans.n, 0)::BIGINT AS n_removed, coalesce(spans.removed, '') AS removed
FROM d LEFT JOIN kept ON d.rid = kept.rid LEFT JOIN spans ON d.rid = spans.rid
"""

# Every repeated unit goes, with no least number of words.
SUBSTRING_DEDUP_UNITS = SUBSTRING_DEDUP.replace(" HAVING sum(words) >= 30", "")

LINE_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, text, md5(concat_ws(':', doc_id, text)) AS doc_key FROM documents
), split AS (
  SELECT rid, doc_id, doc_key, string_split(text, chr(10)) AS lines FROM d
), listed AS (
  SELECT rid, doc_id, doc_key, unnest(lines) AS bare, unnest(range(len(lines))) AS line, len(lines) AS n_lines FROM split
), sized AS (
  SELECT *, bare || CASE WHEN line < n_lines - 1 THEN chr(10) ELSE '' END AS content,
    regexp_extract_all(bare, '[^\x20\x09-\x0D]+') AS tokens
  FROM listed
), placed AS (
  SELECT *, coalesce(sum(length(content)) OVER (PARTITION BY rid ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized
), leafed AS (
  SELECT *, len(tokens) || ' ' || array_to_string(list_transform(list_slice(tokens, 1, 3),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END), ' ') AS leaf
  FROM placed WHERE len(tokens) > 0
), inner_lines AS (
  SELECT * FROM leafed
  WHERE leaf IN (SELECT leaf FROM leafed GROUP BY leaf HAVING count(DISTINCT doc_key) >= 10)
), fields AS (
  SELECT rid, doc_id, doc_key, line, leaf, unnest(tokens) AS token, unnest(range(len(tokens))) AS pos FROM inner_lines
), constant AS (
  SELECT leaf, pos, token FROM fields GROUP BY ALL HAVING count(DISTINCT doc_key) >= 10
), parsed AS (
  SELECT f.rid, f.doc_id, f.doc_key, f.line,
    string_agg(CASE WHEN c.pos IS NULL THEN '<*>' ELSE f.token END, ' ' ORDER BY f.pos) AS template
  FROM fields f LEFT JOIN constant c ON f.leaf = c.leaf AND f.pos = c.pos AND f.token = c.token
  GROUP BY ALL HAVING 2 * count(c.pos) >= count(*)
), recurring AS (
  SELECT template FROM parsed GROUP BY template HAVING count(DISTINCT doc_key) >= 10
), dropped AS (
  SELECT rid, line
  FROM (SELECT *, row_number() OVER (PARTITION BY template ORDER BY doc_id, line) AS nth
    FROM parsed SEMI JOIN recurring USING (template))
  WHERE nth > 1
), kept AS (
  SELECT rid, string_agg(content, '' ORDER BY line) AS text FROM placed ANTI JOIN dropped USING (rid, line) GROUP BY rid
), spans AS (
  SELECT rid, count(*) AS n, string_agg(start::BIGINT || '-' || (start + length(content))::BIGINT, ',' ORDER BY line) AS removed
  FROM placed SEMI JOIN dropped USING (rid, line) GROUP BY rid
)
SELECT doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text,
  coalesce(spans.n, 0)::BIGINT AS n_removed, coalesce(spans.removed, '') AS removed
FROM d LEFT JOIN kept ON d.rid = kept.rid LEFT JOIN spans ON d.rid = spans.rid
"""

EXACT_SEARCH = """
WITH points AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, p.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, p.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM points q JOIN points p ON q.vec_id <> p.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

TOOL_CHAT = r"""
WITH RECURSIVE e AS (
  SELECT row_number() OVER () AS rid, conv_id, turn AS place, role, text,
    CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
    CASE role WHEN 'user' THEN 'q' || turn WHEN 'assistant' THEN 'q' || (turn - 1) END AS call_id,
    CASE WHEN role <> 'user' OR turn % 8 < 2 THEN NULL WHEN turn % 8 < 6 THEN ['q' || (turn - turn % 8)]
      ELSE ['q' || (turn - 4), 'q' || (turn - 2)] END AS depends_on,
    len(regexp_extract_all(coalesce(text, ''), '[^ ]+')) AS words
  FROM conversations
), n AS (
  SELECT *, CASE kind WHEN 'call' THEN 'c:' || call_id WHEN 'result' THEN 'r:' || call_id END AS node,
    CASE kind WHEN 'result' THEN ['c:' || call_id] WHEN 'call' THEN list_transform(depends_on, lambda x: 'r:' || x) END AS parents,
    CASE WHEN kind = 'call' THEN CASE WHEN words <= 8 THEN 'note' ELSE 'ask' END END AS name,
    list_filter([CASE WHEN words > 32 THEN 'long' END, CASE WHEN contains(text, '?') THEN 'question' END,
      CASE WHEN contains(text, chr(10)) THEN 'lines' END], lambda x: x IS NOT NULL) AS tags
  FROM e
), edges AS (
  SELECT rid, conv_id, unnest(parents) AS parent FROM n
), steps AS (
  SELECT edges.rid, p.rid AS before, p.place FROM edges JOIN n p ON p.conv_id = edges.conv_id AND p.node = edges.parent
), paths AS (
  SELECT rid, rid AS origin, place AS ready, 0 AS depth FROM n
  UNION
  SELECT paths.rid, steps.before, greatest(ready, steps.place), depth + 1 FROM paths JOIN steps ON steps.rid = paths.origin
), ranks AS (
  SELECT rid, max(ready) AS ready, max(depth) AS depth FROM paths GROUP BY rid
), faults AS (
  SELECT rid, CASE name
    WHEN 'ask' THEN [CASE WHEN list_contains(tags, 'lines') THEN 'items tags' END, CASE WHEN place > 5 THEN 'range source.turn' END,
      CASE WHEN length(text) > 300 THEN 'range text' END,
      CASE WHEN words > 50 THEN 'range words' END]
    WHEN 'note' THEN [CASE WHEN len(tags) > 1 THEN 'range tags' END, CASE WHEN length(text) < 10 THEN 'range text' END,
      CASE WHEN text IS NULL THEN 'type text' END, CASE WHEN place > 5 THEN 'range source.turn' END, CASE WHEN words NOT BETWEEN 4 AND 7 THEN 'value words' END]
    END AS found
  FROM n
)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY ready, depth, place) - 1 AS position, kind, call_id,
  CASE WHEN kind = 'message' THEN 'message'
    WHEN kind = 'result' AND depth = 0 THEN 'orphan'
    WHEN kind = 'call' AND NOT EXISTS (SELECT 1 FROM n r WHERE r.conv_id = n.conv_id AND r.node = 'r:' || n.call_id)
    THEN 'unanswered' ELSE 'ok' END AS status,
  coalesce(array_to_string(list_sort(list_filter(found, lambda x: x IS NOT NULL)), ','), '') AS errors,
  '{"arguments":' || CASE WHEN kind = 'call' THEN json_object('source', json_object('conv', conv_id, 'turn', place), 'tags', tags,
      'text', text, 'words', words)::VARCHAR ELSE 'null' END || ',' ||
    substr(json_object('call_id', call_id, 'content', CASE WHEN kind <> 'call' THEN text END, 'depends_on', depends_on,
      'kind', kind, 'name', name, 'role', role)::VARCHAR, 2) AS json
FROM n JOIN ranks USING (rid) JOIN faults USING (rid)
"""

RANKED_SEARCH = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), i AS (
  SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark
), wanted AS (
  SELECT iid, term, count(*) AS times FROM (SELECT iid, unnest(terms) AS term FROM i) GROUP BY ALL
), total AS (
  SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0
), held AS (
  SELECT rid, doc_id, n, term, count(*) AS tf
  FROM (SELECT rid, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, total GROUP BY term, n_docs
), impacts AS (
  SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS impact
  FROM held JOIN weights USING (term), total
), scored AS (
  SELECT iid, rid, doc_id, CAST(sum(times * impact) AS BIGINT) AS score
  FROM wanted JOIN impacts USING (term) GROUP BY ALL HAVING sum(times * impact) > 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN i USING (iid) WHERE rank <= 10
"""
