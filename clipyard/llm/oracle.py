"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from clipyard.llm.queries import PROBE_TEXT

WORD = r"[^\x20\x09-\x0D]+"

#: Base32 letters of a SHA-1: five hex digits at a time are four letters.
BASE32 = """array_to_string(list_transform(range(8), lambda g:
  array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(sha1(payload), (5 * g + 1)::BIGINT, 5))::BIGINT >> s::INTEGER) & 31)::BIGINT + 1, 1)), '')), '')"""

WARC = f"""WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS payload FROM pages),
top AS (SELECT payload, max(page_id) AS target FROM p GROUP BY payload),
q AS (SELECT *, target IS NOT NULL AND page_id IS DISTINCT FROM target AS revisit FROM p JOIN top USING (payload))
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, {BASE32} AS payload_digest,
       CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN target END AS refers_to, url
FROM q"""


def _shingled(table, key):
    return f"""
  SELECT DISTINCT {key}, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM (SELECT {key}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table})"""


LEAKS = f"""WITH items AS ({_shingled("benchmark", "item_id")}),
held AS ({_shingled("documents", "doc_id")}),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM items GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM held JOIN items USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_shingles, round(n_shared / n_shingles, 6) AS containment
FROM shared JOIN sizes USING (item_id) WHERE n_shared >= 0.8 * n_shingles - 1e-9"""

_ESCAPED = "replace(replace({0}, '\\', '\\\\'), '<|', '<\\|')"
CHAT = f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE_TEXT}'),
placed AS (
  SELECT *, row_number() OVER o AS n, lag(role) OVER o AS before
  FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(24 + length({_ESCAPED.format("text")})
              + length(replace({_ESCAPED.format("role")}, chr(10), '\\n')))::BIGINT AS formatted_chars,
       bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user')
                     WHEN before IN ('system', 'assistant') THEN role = 'user'
                     WHEN before = 'user' THEN role = 'assistant' ELSE false END) AS order_valid
FROM placed GROUP BY conv_id"""

REPEATS = f"""WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)),
firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS places
  FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (s) WHERE first < doc_id)
  GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(places, []), i)), ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)"""


def _centroids_sql(k=8, rounds=10, dims=64, scale=1024, tag="3"):
    """Lloyd rounds written out, one pair of CTEs a round."""
    q = f"list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT)"
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, {q}) AS rid, vec_id, {q} AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dims}
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))))""",
        "comps AS MATERIALIZED (SELECT rid, unnest(range(" + str(dims) + ")) AS j, unnest(v) AS x FROM kept)",
        f"""c0 AS (SELECT c, j, x FROM (
  SELECT rid, row_number() OVER (ORDER BY sha256('{tag}:' || vec_id::VARCHAR), v) - 1 AS c
  FROM kept WHERE vec_id IS NOT NULL) JOIN comps USING (rid) WHERE c < {k})""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS (SELECT v.rid, c.c, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d
  FROM comps v JOIN c{r} c USING (j) GROUP BY v.rid, c.c
  QUALIFY row_number() OVER (PARTITION BY v.rid ORDER BY d, c.c) = 1)"""
        )
        if r < rounds:
            parts.append(
                f"""c{r + 1} AS (SELECT o.c, o.j, coalesce(m.x, o.x) AS x FROM c{r} o LEFT JOIN (
  SELECT c, j, ((s - ((s % n) + n) % n) // n)::BIGINT AS x
  FROM (SELECT a.c, v.j, sum(v.x) AS s, count(*) AS n FROM a{r} a JOIN comps v USING (rid) GROUP BY a.c, v.j)) m
  USING (c, j))"""
            )
    parts.append(f"cs AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS h FROM c{rounds} GROUP BY c)")
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN kept USING (rid) JOIN cs USING (c)"""
    )


CENTROIDS = _centroids_sql()

NEGATIVES = """WITH r AS (
  SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::INTEGER AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::DOUBLE) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = 64
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE)))),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
         list_dot_product(a.v, r.v)::BIGINT AS score
  FROM r a JOIN r ON a.vec_id % 100 = 0),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s
  WHERE label = anchor_label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM pos p JOIN s ON s.anchor_id = p.anchor_id
  WHERE s.label <> s.anchor_label AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
WHERE rank <= 5"""

_BY_CAP = "ORDER BY source_size * 3 / w, src"
MIX = f"""WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         ('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][((src - 1) % 3) + 1] AS w
  FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS src FROM per)),
ordered AS (
  SELECT *, row_number() OVER ({_BY_CAP}) AS o,
         sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (
           {_BY_CAP} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER ({_BY_CAP} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wrest
  FROM weighted),
firsts AS (SELECT *, min(CASE WHEN source_size * 3 * wrest >= w * rest THEN o END) OVER () AS first FROM ordered),
levels AS (SELECT *, max(CASE WHEN o = first THEN rest / wrest END) OVER () AS level FROM firsts),
targets AS (
  SELECT source, source_size,
         CASE WHEN first IS NULL OR o < first THEN (source_size * 3)::DOUBLE ELSE level * w END AS target
  FROM levels),
fulls AS (SELECT *, (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END)::BIGINT AS copies FROM targets),
needs AS (SELECT *, target - copies * source_size AS need FROM fulls),
units AS (SELECT source, h, sum(size) AS sw FROM sized GROUP BY source, h),
bound AS (
  SELECT source, h, after - sw AS before, after, need
  FROM (SELECT u.source, h, sw, sum(sw) OVER (PARTITION BY u.source ORDER BY h) AS after, need
        FROM units u JOIN needs n ON u.source IS NOT DISTINCT FROM n.source WHERE need > 0)
  WHERE after > need QUALIFY row_number() OVER (PARTITION BY source ORDER BY h) = 1),
cuts AS (SELECT source, CASE WHEN after - need < need - before THEN h + 1 ELSE h END AS cut FROM bound)
SELECT s.doc_id, s.size, n.source_size, n.target,
       (s.size * (n.copies + CASE WHEN n.need > 0 AND (c.cut IS NULL OR s.h < c.cut) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN needs n ON s.source IS NOT DISTINCT FROM n.source
LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source"""

ORACLE_SQL = {
    "op1_warc_packages": WARC,
    "op4_benchmark_leaks": LEAKS,
    "op5_chat_format": CHAT,
    "op10_repeated_passages": REPEATS,
    "op11_centroid_clusters": CENTROIDS,
    "op12_hard_negatives": NEGATIVES,
    "op13_source_mix": MIX,
}
