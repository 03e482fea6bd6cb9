"""The registered queries as DuckDB SQL, over the same tables."""

WS = r"[\t-\r\x1c-\x20\x{1680}\x{2000}-\x{2006}\x{2008}-\x{200a}\x{2028}\x{2029}\x{205f}\x{3000}]+"
STANDARD = (
    r"(?:[\p{L}\p{M}\p{N}_]*"
    r"(?:\p{L}(?:[.:''’·]\p{L})+|\p{N}(?:[.,;'']\p{N})+))+[\p{L}\p{M}\p{N}_]*"
    r"|[\p{L}\p{M}\p{N}_]+"
)
UNIT = "chr(1)"

ARTICLES = r"""
articles AS (
  SELECT doc_id,
         'https://' || source || '.example.org/news/' || doc_id AS url,
         array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')[1:5], ' ') AS topic,
         '2024-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS date,
         source AS author,
         text AS filling
  FROM documents)"""

KEYED = f"""{ARTICLES},
keyed AS (
  SELECT *, md5(concat_ws({UNIT}, url, topic, date, author, filling)) AS doc_key FROM articles)"""


def minima(source, key, text):
    return f"""
hashes AS (
  SELECT {key},
         list_transform(
           list_distinct(list_filter(regexp_split_to_array({text}, '{WS}'), lambda t: t <> '')),
           lambda t: ('0x' || substr(md5(t), 1, 7))::BIGINT) AS h
  FROM {source}),
minima AS (
  SELECT {key},
         list_transform(range(128), lambda i: coalesce(list_min(list_transform(h, lambda v:
           (v * ((1103515245 * (i + 1) + 12345) % 2147483647)
              + ((22695477 * (i + 1) + 1) % 2147483647)) % 2147483647)), 2147483647)) AS minhash
  FROM hashes),
signed AS (
  SELECT {key}, minhash,
         array_to_string(list_transform(minhash, lambda m: (m % 2)::VARCHAR), '') AS bits
  FROM minima)"""


SIGNED = minima("documents", "doc_id", "text")
GROUPS = """
groups AS (SELECT bits, min(doc_id) AS rep, count(*) AS copies FROM signed GROUP BY bits)"""
PAIRS = """
pairs AS (
  SELECT a.rep AS rep_a, b.rep AS rep_b, a.copies AS copies_a, b.copies AS copies_b,
         hamming(a.bits, b.bits)::INTEGER AS differing_bits
  FROM groups a JOIN groups b ON a.rep < b.rep
  WHERE hamming(a.bits, b.bits) <= 12)"""


def terms(field):
    return f"""WITH {ARTICLES}
SELECT {field} AS key, count(*) AS doc_count FROM articles
GROUP BY {field} ORDER BY doc_count DESC, key LIMIT 10"""


def match(field, terms):
    tf = ", ".join(f"len(list_filter(t, lambda x: x = '{w}')) AS tf{i}" for i, w in enumerate(terms))
    seen = ", ".join(f"count(*) FILTER (tf{i} > 0) AS n{i}" for i in range(len(terms)))
    any_hit = " OR ".join(f"tf{i} > 0" for i in range(len(terms)))
    score = " + ".join(
        f"ln(1 + (n - n{i} + 0.5) / (n{i} + 0.5)) * tf{i}"
        f" / (tf{i} + 1.2 * (1 - 0.75 + 0.75 * dl / (length / n)))"
        for i in range(len(terms))
    )
    return f"""WITH {ARTICLES},
tokens AS (SELECT doc_id, {field}, regexp_extract_all(lower({field}), '{STANDARD}') AS t FROM articles),
counted AS (SELECT doc_id, {field}, len(t)::DOUBLE AS dl, {tf} FROM tokens),
stats AS (
  SELECT count(*) FILTER (dl > 0)::DOUBLE AS n, sum(dl) AS length,
         count(*) FILTER ({any_hit}) AS total_hits, {seen}
  FROM counted)
SELECT doc_id, {field}, round({score}, 6) AS score, total_hits
FROM counted, stats WHERE {any_hit}
ORDER BY score DESC, doc_id LIMIT 10"""


MESSAGES = f"""{KEYED},
sent AS (
  SELECT doc_id AS seq, * FROM keyed
  UNION ALL
  SELECT doc_id + 1000000000 AS seq, * FROM keyed WHERE doc_id % 10 = 0)"""
INDEX_VIEW = "doc_key, seq, url, topic, date, author, filling, bits"

UPSERT = f"""WITH {MESSAGES}, {SIGNED},
indexed AS (SELECT * FROM sent JOIN signed USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_key ORDER BY seq DESC) AS rn FROM indexed)
SELECT {INDEX_VIEW} FROM ranked WHERE rn = 1"""

SHINGLES = f"""
tokens AS (SELECT doc_id, regexp_extract_all(text, '{STANDARD}') AS t FROM documents),
grams AS (
  SELECT doc_id,
         list_transform(range(1, greatest(len(t) - 3, 1)), lambda i:
           t[i] || ' ' || t[i+1] || ' ' || t[i+2] || ' ' || t[i+3] || ' ' || t[i+4]) AS g
  FROM tokens)"""
SKETCHES = f"""{SHINGLES},
shingle_hashes AS (SELECT doc_id, ('0x' || substr(md5(unnest(g)), 1, 15))::BIGINT AS h FROM grams),
used AS (SELECT doc_id, h >> 51 AS b, min(h) AS v FROM shingle_hashes GROUP BY ALL),
grid AS (SELECT doc_id, b FROM (SELECT DISTINCT doc_id FROM used), range(512) r(b)),
dense AS (
  SELECT doc_id, b,
         coalesce(first_value(v IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY b
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
                  first_value(v IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY b
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS v
  FROM grid LEFT JOIN used USING (doc_id, b))"""

# The query passage is sketched with the same steps as the documents.
QUERY_SKETCH = SKETCHES
for _name in ("tokens", "grams", "shingle_hashes", "used", "grid", "dense"):
    QUERY_SKETCH = QUERY_SKETCH.replace(f"{_name} AS", f"q_{_name} AS").replace(
        f"FROM {_name}", f"FROM q_{_name}"
    ).replace(f"JOIN {_name}", f"JOIN q_{_name}")
QUERY_SKETCH = QUERY_SKETCH.replace(
    "FROM documents", "FROM (SELECT item_id AS doc_id, text FROM benchmark)"
)

# Pages in the site's layout: what extraction must find in them.
CASE = "doc_id % 16"
SITE = "'https://news.example.org/' || {} || '/'"
SITE_PAGES = rf"""{ARTICLES},
total AS (SELECT count(*) AS n FROM documents),
site AS (
  SELECT doc_id, {SITE.format('doc_id')} AS url, topic,
         CASE WHEN {CASE} = 3 THEN '' ELSE date END AS date,
         CASE WHEN {CASE} IN (2, 3) THEN '' ELSE author END AS author,
         array_to_string(list_transform(string_split(filling, chr(10)), lambda p:
           trim(regexp_replace(regexp_replace(p, '[\x{{200b}}\x{{ad}}]', '', 'g'),
                               '[ \t\n\f\r\x{{a0}}]+', ' ', 'g'))), '') AS filling
  FROM articles WHERE {CASE} NOT IN (0, 1)),
site_links AS (
  SELECT doc_id AS src, (2 * doc_id + 1) % n AS dst FROM documents, total WHERE {CASE} NOT IN (0, 1)
  UNION ALL
  SELECT doc_id, (2 * doc_id + 2) % n FROM documents, total WHERE {CASE} NOT IN (0, 1, 4)
  UNION ALL
  SELECT doc_id, (7 * doc_id + 3) % n FROM documents, total WHERE {CASE} NOT IN (0, 1, 4)),
listing_links AS (
  SELECT doc_id // 25 + 1 AS page, doc_id AS dst FROM documents WHERE {CASE} <> 5)"""
LISTING_URL = """CASE WHEN page = 1 THEN 'https://news.example.org/news/'
  ELSE 'https://news.example.org/page/' || page || '/' END"""

EDGES = r"""
edges AS (
  SELECT page_id AS src,
         ('0x' || substr(md5(unnest(regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1))), 1, 15))::BIGINT
           % (SELECT count(*) FROM pages) AS dst
  FROM pages)"""

ATTEMPTS = """
attempts AS (
  SELECT url, attempt,
         CASE ('0x' || substr(md5(url || '#' || attempt), 1, 15))::BIGINT % 4
           WHEN 0 THEN 404 WHEN 1 THEN 500 ELSE 200 END AS status, html
  FROM pages, (VALUES (1), (2), (3)) v(attempt)),
ended AS (
  SELECT url, min(attempt) FILTER (status IN (200, 404)) AS attempt,
         arg_min(status, attempt) FILTER (status IN (200, 404)) AS status
  FROM attempts WHERE attempt <= 2 GROUP BY url)"""

TASKS = """
tasks AS (
  SELECT page_id, CASE WHEN page_id % 20 <> 7 THEN url END AS url,
         (page_id % 2)::INTEGER AS doc_type, (page_id % 12)::INTEGER AS depth
  FROM pages)"""

LINES = """
lines AS (
  SELECT event_id, ts, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS stamp,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARN' ELSE 'INFO' END AS level,
         right('user-' || user_id, 10) AS thread, right('clipyard.events.Collector', 20) AS class,
         (event_id % 1000)::VARCHAR AS line_no,
         event_type || ' ' || value::DECIMAL(18,2) AS message
  FROM events),
formatted AS (
  SELECT *, stamp || ' | ' || rpad(level, 5, ' ') || ' | ' || rpad(thread, 10, ' ') || ' | '
            || class || ':' || rpad(line_no, 5, ' ') || ' | ' || message AS line
  FROM lines),
routed AS (
  SELECT event_id, sink, strftime(ts, '%Y-%m-%d') AS day, line
  FROM formatted, (VALUES ('DATA'), ('error'), ('warn'), ('all')) s(sink)
  WHERE sink IN ('DATA', 'all') OR (sink = 'error' AND level = 'ERROR') OR (sink = 'warn' AND level = 'WARN'))"""

INDEXED = """
indexed AS (
  SELECT 'logstash-' || strftime(ts, '%Y.%m.%d') AS index_name, date_trunc('day', ts)::TIMESTAMP AS created, event_id
  FROM events
  UNION ALL
  SELECT 'metrics-' || strftime(ts, '%Y.%m.%d'), date_trunc('day', ts)::TIMESTAMP, event_id
  FROM events WHERE event_type = 'purchase')"""

ORACLE_SQL = {
    "terms_author": terms("author"),
    "terms_topic": terms("topic"),
    "terms_url": terms("url"),
    "terms_date": terms("date"),
    "match_topic": match("topic", ["the", "and", "attion"]),
    "match_author": match("author", ["src8", "src12"]),
    "match_url": match("url", ["https", "src3", "example.org", "news"]),
    "match_topic_postings": match("topic", ["the", "and", "attion"]),
    "match_all_1000": f"""WITH {ARTICLES}
SELECT doc_id, to_json({{doc_id: doc_id, url: url, topic: topic, date: date, author: author,
                        filling: filling}})::VARCHAR AS source, count(*) OVER () AS total_hits
FROM articles ORDER BY doc_id LIMIT 1000""",
    "count_all": "SELECT count(*) AS total_hits FROM documents",
    "term_count": "SELECT count(*) AS total_hits FROM documents WHERE lang = 'en'",
    "term_list": """SELECT doc_id, lang, source, count(*) OVER () AS total_hits
FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 10""",
    "standard_tokens": f"""WITH tokens AS (
  SELECT doc_id, regexp_extract_all(lower(text), '{STANDARD}') AS t FROM documents)
SELECT doc_id, len(t)::INTEGER AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM tokens""",
    "doc_key": f"WITH {KEYED} SELECT doc_id, doc_key FROM keyed",
    "index_message_scan": f"""WITH {MESSAGES}
SELECT seq, url, topic, date, author, filling, 0 AS what_to_do FROM sent""",
    "index_append": f"""WITH {MESSAGES}, {SIGNED}
SELECT {INDEX_VIEW} FROM sent JOIN signed USING (doc_id)""",
    "index_upsert": UPSERT,
    "minhash_bits": f"WITH {SIGNED} SELECT doc_id, bits FROM signed",
    "near_duplicates": f"""WITH {ARTICLES}, {SIGNED}, {GROUPS}, {PAIRS}
SELECT pairs.*, 1 - differing_bits / 128.0::DOUBLE AS similarity, a.topic AS topic_a, b.topic AS topic_b
FROM pairs JOIN articles a ON a.doc_id = rep_a JOIN articles b ON b.doc_id = rep_b""",
    "near_duplicates_lsh": f"""WITH {SIGNED},
groups AS (SELECT bits, min(doc_id) AS rep, count(*) AS copies FROM signed GROUP BY bits),
banded AS (
  SELECT DISTINCT rep, copies, bits, k, minhash[4*k+1:4*k+4] AS band
  FROM signed JOIN groups USING (bits), range(32) r(k))
SELECT DISTINCT a.rep AS rep_a, b.rep AS rep_b, a.copies AS copies_a, b.copies AS copies_b,
       hamming(a.bits, b.bits)::INTEGER AS differing_bits,
       1 - hamming(a.bits, b.bits) / 128.0::DOUBLE AS similarity
FROM banded a JOIN banded b ON a.k = b.k AND a.band = b.band AND a.rep < b.rep
WHERE hamming(a.bits, b.bits) <= 12""",
    "near_duplicate_counts": f"""WITH {SIGNED}, {GROUPS},
similar_docs AS (
  SELECT a.doc_id, count(*) - 1 AS similar_docs
  FROM signed a JOIN signed b ON hamming(a.bits, b.bits) <= 12 GROUP BY a.doc_id)
SELECT doc_id, rep AS group_rep, copies, similar_docs
FROM signed JOIN groups USING (bits) JOIN similar_docs USING (doc_id)""",
    "near_duplicate_groups": f"""WITH {SIGNED}, {GROUPS}
SELECT doc_id, rep FROM signed JOIN groups USING (bits)""",
    "near_duplicate_clusters": f"""WITH RECURSIVE {SIGNED}, {GROUPS}, {PAIRS},
ends AS (SELECT rep_a AS a, rep_b AS b FROM pairs UNION ALL SELECT rep_b, rep_a FROM pairs),
reach(x, y) AS (SELECT rep, rep FROM groups UNION SELECT x, b FROM reach JOIN ends ON y = a),
labels AS (SELECT x AS rep, min(y) AS cluster FROM reach GROUP BY x)
SELECT doc_id, cluster FROM signed JOIN groups USING (bits) JOIN labels USING (rep)""",
    "near_duplicates_of_labelled": f"""WITH {SIGNED}, {GROUPS},
asked AS (
  SELECT rep, bits, count(*) AS chosen FROM signed JOIN groups USING (bits)
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY rep, bits)
SELECT a.rep, a.chosen, g.rep AS similar_rep, g.copies AS similar_copies
FROM asked a JOIN groups g ON hamming(a.bits, g.bits) <= 12""",
    "shingles5": f"""WITH {SHINGLES}
SELECT doc_id, len(g)::INTEGER AS n_shingles, md5(array_to_string(g, '|')) AS shingles_md5 FROM grams""",
    "bucket_minima_512": f"""WITH {SKETCHES},
sketch AS (SELECT doc_id, md5(string_agg(v::VARCHAR, ',' ORDER BY b)) AS sketch_md5 FROM dense GROUP BY doc_id),
counts AS (SELECT doc_id, count(*)::INTEGER AS used_buckets FROM used GROUP BY doc_id)
SELECT doc_id, coalesce(used_buckets, 0)::INTEGER AS used_buckets, coalesce(sketch_md5, md5('')) AS sketch_md5
FROM documents LEFT JOIN sketch USING (doc_id) LEFT JOIN counts USING (doc_id)""",
    "similar_to": f"""WITH {SKETCHES}, {QUERY_SKETCH},
shared AS (
  SELECT q.doc_id AS item_id, d.doc_id, count(*)::INTEGER AS shared_buckets
  FROM dense d JOIN q_dense q ON d.b = q.b AND d.v = q.v GROUP BY ALL)
SELECT item_id, doc_id, shared_buckets FROM shared
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY shared_buckets DESC, doc_id) <= 10""",
    "page_articles": "SELECT url, regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1) AS topic FROM pages",
    "page_decode": "SELECT url, html FROM pages",
    "page_links": """SELECT url, unnest(regexp_extract_all(html, '<a [^>]*?href="([^"]*)"', 1)) AS link FROM pages""",
    "site_articles": f"WITH {SITE_PAGES} SELECT url, topic, date, author, filling FROM site",
    "site_related_links": f"""WITH {SITE_PAGES}
SELECT {SITE.format('src')} AS src, 1 AS doc_type, {SITE.format('dst')} AS link FROM site_links""",
    "site_listing_links": f"""WITH {SITE_PAGES}
SELECT {LISTING_URL} AS src, 0 AS doc_type, {SITE.format('dst')} AS link FROM listing_links""",
    "seed_tasks": """WITH hosts AS (SELECT DISTINCT regexp_extract(url, '^(https?://[^/]+)', 1) AS host FROM pages)
SELECT CASE WHEN i = 1 THEN host || '/news/' ELSE host || '/page/' || i || '/' END AS url,
       0 AS doc_type, (i - 1)::INTEGER AS depth
FROM hosts, range(1, 11) r(i)""",
    "fetch_outcomes": f"""WITH {ATTEMPTS}
SELECT url, coalesce(attempt, 2)::INTEGER AS attempt,
       CASE status WHEN 200 THEN 'ok' WHEN 404 THEN 'not_found' ELSE 'exhausted' END AS outcome
FROM ended""",
    "fetched_pages": f"""WITH {ATTEMPTS}
SELECT url, html FROM ended JOIN pages USING (url) WHERE status = 200""",
    "crawl_task_scan": f"WITH {TASKS} SELECT url, doc_type, depth FROM tasks WHERE url IS NOT NULL",
    "child_tasks": f"""WITH {TASKS}
SELECT url, 1 AS doc_type, depth + 1 AS depth FROM tasks WHERE url IS NOT NULL AND depth < 10""",
    "crawl_frontier": f"""WITH RECURSIVE {EDGES},
reach(page_id, depth) AS (
  SELECT 0::BIGINT, 0
  UNION
  SELECT dst, depth + 1 FROM reach JOIN edges ON src = page_id WHERE depth < 10)
SELECT page_id, min(depth) AS depth FROM reach GROUP BY page_id""",
    "crawl_revisits": f"""WITH RECURSIVE {EDGES},
links AS (SELECT src, dst, count(*) AS n FROM edges GROUP BY ALL),
reach(page_id, depth, visits) AS (
  SELECT 0::BIGINT, 0, 1::HUGEINT
  UNION ALL
  SELECT dst, depth + 1, sum(visits * n)
  FROM reach JOIN links ON src = page_id WHERE depth < 10 GROUP BY dst, depth)
SELECT page_id, depth, visits::BIGINT AS visits FROM reach""",
    "crawl_articles": f"""WITH RECURSIVE {SITE_PAGES},
reach(doc_id, depth) AS (
  SELECT dst, page FROM listing_links WHERE page <= 10
  UNION
  SELECT dst, depth + 1 FROM reach JOIN site_links ON src = doc_id WHERE depth < 10),
found AS (SELECT doc_id, min(depth)::INTEGER AS depth FROM reach GROUP BY doc_id)
SELECT url, depth, topic, date, author, md5(filling) AS filling_md5 FROM site JOIN found USING (doc_id)""",
    "route_messages": f"""WITH {ARTICLES}, {TASKS}
SELECT 'download_Queue' AS queue, 'Route_to_download' AS route,
       CASE WHEN url IS NULL THEN to_json({{doc_type: doc_type, depth: depth}})
            ELSE to_json({{url: url, doc_type: doc_type, depth: depth}}) END::VARCHAR AS value
FROM tasks
UNION ALL
SELECT 'elastic_Queue', 'Route_to_elastic',
       to_json({{url: url, topic: topic, date: date, author: author, filling: filling,
                what_to_do: 0}})::VARCHAR
FROM articles""",
    "log_parse": f"""WITH {LINES}
SELECT event_id, date_trunc('milliseconds', ts)::TIMESTAMP AS ts, level, substr(thread, 1, 10) AS thread,
       class, line_no, message
FROM formatted""",
    "log_route": f"WITH {LINES} SELECT event_id, sink, day, line FROM routed",
    "log_daily_index": "SELECT event_id, 'logstash-' || strftime(ts, '%Y.%m.%d') AS index_name FROM events",
    "log_json": "SELECT event_id, (props->>'$.k')::INTEGER AS k, 'docker-elk' AS tags FROM events",
    "index_pattern_scan": f"""WITH {INDEXED}
SELECT index_name, count(*) AS total_hits FROM indexed
WHERE index_name LIKE 'logstash-2024.01.1%' GROUP BY index_name""",
    "all_index_count": f"WITH {INDEXED} SELECT count(*) AS total_hits FROM indexed",
    "log_retention": f"""WITH {INDEXED}
SELECT * FROM indexed
WHERE NOT (index_name LIKE 'logstash-%' AND created < TIMESTAMP '2024-01-30' - INTERVAL 2 DAY)""",
    "log_drop_expired": f"""WITH {INDEXED}
SELECT index_name, count(*) AS events FROM indexed
WHERE NOT (index_name LIKE 'logstash-%' AND created < TIMESTAMP '2024-01-30' - INTERVAL 2 DAY)
GROUP BY index_name""",
    "log_text_scan": f"WITH {LINES} SELECT level, class, count(*) AS events FROM formatted GROUP BY ALL",
    "stream_index": UPSERT,
    "stream_pages": f"WITH {SITE_PAGES} SELECT url, topic, date, author, filling FROM site",
    "stream_recrawl": f"""WITH {SITE_PAGES}, marked AS (SELECT *, substr(md5(url), 1, 1) < '8' AS changed FROM site)
SELECT url, CASE WHEN changed THEN 1700086400000000 ELSE 1700000000000000 END::BIGINT AS seq,
       CASE WHEN changed THEN 'NEW-' || topic ELSE topic END AS topic, date, author, filling FROM marked""",
    "stream_after_batch": f"""WITH {MESSAGES}
SELECT doc_key, 2 * count(*) + 1 AS rows, max(seq) AS seq FROM sent GROUP BY doc_key""",
    "declared_table": "SELECT source AS author, count(*) AS articles FROM documents GROUP BY source",
    "stream_logs": f"WITH {LINES} SELECT sink, day, line FROM routed",
    "stream_daily_index": f"""WITH {LINES}
SELECT 'logstash-' || strftime(ts, '%Y.%m.%d') AS index_name, level, count(*) AS events
FROM formatted GROUP BY ALL""",
}
