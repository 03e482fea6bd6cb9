"""The registered queries: one function per operator, over the given tables."""

import uuid

from pyspark.sql import functions as F

from clipyard.functions.keys import doc_key
from clipyard.functions.minhash import bucket_minima, rotate, signature_bits
from clipyard.functions.text import shingles, standard_tokens
from clipyard.operators import crawl as crawling
from clipyard.operators import extract as ex
from clipyard.operators import logs as log_ops
from clipyard.operators import neardup, postings, search
from clipyard.plans import commands, derived
from clipyard.plans.derived import table
from clipyard.schemas import ARTICLE_FIELDS
from clipyard.session import materialize, scratch_path, spread
from clipyard.sinks import articles as article_table
from clipyard.sinks import logs as log_sinks
from clipyard.sinks import routing
from clipyard.sources import crawl as crawl_sources
from clipyard.sources import index_messages as inbox
from clipyard.sources import indices
from clipyard.sources import logs as log_sources
from clipyard.streaming import index_stream, log_stream

# Arguments of the registered searches.
TOPIC_QUERY = "The and Attion"
AUTHOR_QUERY = "src8 SRC12"
URL_QUERY = "https://src3.example.org/news/"
TERM = ("lang", "en")
INDEX_PATTERN = "logstash-2024.01.1*"
AS_OF = "2024-01-30 00:00:00"
BINDINGS = {
    "download_Queue": [routing.ROUTE_DOWNLOAD],
    "elastic_Queue": [routing.ROUTE_INDEX],
}


def _texts(spark, sf):
    """Documents, for work that is heavy on each text."""
    return spread(table(spark, sf, "documents"), "doc_id")


def _articles(spark, sf):
    return derived.articles(_texts(spark, sf))


# Counts and searches ---------------------------------------------------------------
def _fields(spark, sf, field):
    """Articles for work on one short field; only the topic is costly to derive."""
    if field == "topic":
        return _articles(spark, sf)
    return derived.articles(table(spark, sf, "documents"))


def terms_by(field):
    return lambda spark, sf: search.terms(_fields(spark, sf, field), field)


def match_on(field, query):
    def run(spark, sf):
        hits = search.match(_fields(spark, sf, field), field, query, key="doc_id")
        return hits.select("doc_id", field, "score", "total_hits")

    return run


def match_topic_postings(spark, sf):
    """``match_topic`` through a postings index: built once, then only the query terms'
    buckets and the blocks whose score bound can reach the top are read."""
    docs = _fields(spark, sf, "topic").select("doc_id", "topic")
    index = postings.build_index(docs, "topic", key="doc_id")
    return postings.search(spark, index, docs, TOPIC_QUERY)


def match_all_1000(spark, sf):
    return search.match_all(_articles(spark, sf), key="doc_id")


def count_all(spark, sf):
    return search.count_all(table(spark, sf, "documents"))


def term_count(spark, sf):
    return search.term_count(table(spark, sf, "documents"), *TERM)


def term_list(spark, sf):
    hits = search.term(table(spark, sf, "documents"), *TERM, key="doc_id")
    return hits.select("doc_id", "lang", "source", "total_hits")


def standard_token_counts(spark, sf):
    tokens = standard_tokens(F.col("text"))
    return _texts(spark, sf).select(
        "doc_id",
        F.size(tokens).alias("n_tokens"),
        F.md5(F.array_join(tokens, " ")).alias("tokens_md5"),
    )


# Index -------------------------------------------------------------------------------
def doc_keys(spark, sf):
    return _articles(spark, sf).select("doc_id", doc_key().alias("doc_key"))


def _written_index(spark, sf):
    decoded = inbox.index_messages(derived.index_messages(_texts(spark, sf)), "seq")
    path = scratch_path(spark, "articles")
    article_table.append_batch(inbox.articles_to_index(decoded), path, 0)
    return article_table.read_all(spark, path)


def _index_view(rows):
    return rows.select(
        "doc_key", "seq", *ARTICLE_FIELDS, signature_bits(F.col("minhash")).alias("bits")
    )


def index_append(spark, sf):
    return _index_view(_written_index(spark, sf))


def index_upsert(spark, sf):
    return _index_view(article_table.latest(_written_index(spark, sf)))


def index_message_scan(spark, sf):
    messages = derived.index_messages(_texts(spark, sf))
    return inbox.index_messages(messages, "seq")


# Near-duplicates -----------------------------------------------------------------------
def minhash_bits(spark, sf):
    signed = derived.signed(_texts(spark, sf))
    return signed.select("doc_id", signature_bits(F.col("minhash")).alias("bits"))


def near_duplicates(spark, sf):
    stored = materialize(derived.signed(_articles(spark, sf), "filling", "topic"), "signed")
    return commands.near_duplicates(stored, "doc_id", mode="exact")


def _stored_groups(spark, sf, mode):
    stored = materialize(derived.signed(_texts(spark, sf)), "signed")
    groups = materialize(neardup.signature_groups(stored, "doc_id", mode), "groups")
    return stored, groups


def near_duplicates_lsh(spark, sf):
    _, groups = _stored_groups(spark, sf, "lsh")
    return neardup.similar_groups(groups, "lsh")


def near_duplicate_counts(spark, sf):
    stored, groups = _stored_groups(spark, sf, "exact")
    pairs = neardup.similar_groups(groups, "exact")
    counted = neardup.near_duplicate_counts(stored, "doc_id", groups, pairs)
    return counted.select("doc_id", "group_rep", "copies", "similar_docs")


def near_duplicate_clusters(spark, sf):
    """The smallest document each one is linked to over chains of similar groups."""
    stored, groups = _stored_groups(spark, sf, "exact")
    pairs = neardup.similar_groups(groups, "exact")
    return neardup.clusters(stored, "doc_id", groups, pairs)


def near_duplicates_of_labelled(spark, sf):
    """The groups similar to the documents labelled toxic."""
    stored, groups = _stored_groups(spark, sf, "exact")
    pairs = neardup.similar_groups(groups, "exact")
    toxic = table(spark, sf, "labels").filter("toxic = 1")
    return neardup.similar_to_chosen(stored, "doc_id", groups, pairs, toxic)


def near_duplicate_groups(spark, sf):
    """Which group of equal signatures every document is in."""
    stored, groups = _stored_groups(spark, sf, "exact")
    return neardup.group_members(stored, "doc_id", groups)


def shingles5(spark, sf):
    grams = shingles(standard_tokens(F.col("text"), lowercase=False))
    return _texts(spark, sf).select("doc_id", grams.alias("g")).select(
        "doc_id", F.size("g").alias("n_shingles"), F.md5(F.array_join("g", "|")).alias("shingles_md5")
    )


def bucket_minima_512(spark, sf):
    sparse = _texts(spark, sf).select("doc_id", bucket_minima(F.col("text")).alias("m"))
    return sparse.select(
        "doc_id",
        F.size("m").alias("used_buckets"),
        F.md5(F.array_join(rotate(F.col("m")).cast("array<string>"), ",")).alias("sketch_md5"),
    )


def similar_to(spark, sf):
    """The ten most similar documents of every benchmark passage."""
    sketched = derived.sketched(_texts(spark, sf))
    passages = table(spark, sf, "benchmark")
    return search.similar_to_each(sketched, "sketch", passages, "item_id", "text", key="doc_id")


# Extraction ----------------------------------------------------------------------------
def page_articles(spark, sf):
    return ex.generic_articles(table(spark, sf, "pages"))


def page_decode(spark, sf):
    raw = table(spark, sf, "pages").select("url", F.encode("html", "UTF-8").alias("html"))
    return crawl_sources.decode_pages(raw)


def page_links(spark, sf):
    return ex.generic_links(table(spark, sf, "pages"))


def _site(spark, sf):
    """Article and listing pages in the site's layout, stored as page snapshots."""
    documents = _texts(spark, sf)
    return (
        materialize(derived.site_pages(documents), "pages"),
        materialize(derived.listing_pages(documents), "listings"),
    )


def site_articles(spark, sf):
    pages = materialize(derived.site_pages(_texts(spark, sf)), "pages")
    return ex.articles(ex.extract(pages))


def site_related_links(spark, sf):
    pages = materialize(derived.site_pages(_texts(spark, sf)), "pages")
    return ex.links(ex.extract(pages))


def site_listing_links(spark, sf):
    listings = materialize(derived.listing_pages(_texts(spark, sf)), "listings")
    return ex.links(ex.extract(listings))


# Crawl -----------------------------------------------------------------------------------
def seed_tasks(spark, sf):
    return crawl_sources.seed_tasks(derived.sites(table(spark, sf, "pages")))


def fetch_outcomes(spark, sf):
    return crawl_sources.fetch_outcomes(derived.fetch_attempts(table(spark, sf, "pages")))


def fetched_pages(spark, sf):
    return crawl_sources.fetched_pages(derived.fetch_attempts(table(spark, sf, "pages")))


def crawl_task_scan(spark, sf):
    return crawl_sources.crawl_tasks(derived.task_messages(table(spark, sf, "pages")))


def child_tasks(spark, sf):
    tasks = crawl_sources.crawl_tasks(derived.task_messages(table(spark, sf, "pages")))
    return crawling.child_tasks(tasks, "url")


def _frontier(spark, sf, dedup):
    pages = table(spark, sf, "pages")
    seeds = pages.filter("page_id = 0").select(
        F.col("page_id").alias("url"), F.lit(1).alias("doc_type"), F.lit(0).alias("depth")
    )
    reached = crawling.expand(derived.link_edges(pages), seeds, dedup=dedup)
    return reached.withColumnRenamed("url", "page_id")


def crawl_frontier(spark, sf):
    return _frontier(spark, sf, dedup=True).select("page_id", "depth")


def crawl_revisits(spark, sf):
    reached = _frontier(spark, sf, dedup=False)
    return reached.select("page_id", "depth", F.col("visits").cast("bigint").alias("visits"))


def crawl_articles(spark, sf):
    pages, listings = _site(spark, sf)
    seeds = crawl_sources.seed_tasks(derived.site_roots(table(spark, sf, "documents")))
    snapshots = pages.unionByName(listings).select("url", "html")
    _, found = crawling.crawl(snapshots, seeds)
    return found.select("url", "depth", "topic", "date", "author", F.md5("filling").alias("filling_md5"))


# Messages ----------------------------------------------------------------------------------
def route_messages(spark, sf):
    tasks = derived.task_messages(table(spark, sf, "pages")).select("route", "value")
    published = routing.publish_articles(_articles(spark, sf))
    return routing.route(tasks.unionByName(published), BINDINGS)


# Logs ----------------------------------------------------------------------------------------
def _parsed(spark, sf):
    lines = derived.log_lines(spread(table(spark, sf, "events"), "event_id"))
    return log_sources.parse_lines(lines, "value", "event_id")


def log_parse(spark, sf):
    return _parsed(spark, sf).drop("line")


def log_route(spark, sf):
    return log_ops.route_by_severity(_parsed(spark, sf)).select("event_id", "sink", "day", "line")


def log_daily_index(spark, sf):
    return log_ops.with_daily_index(table(spark, sf, "events")).select("event_id", "index_name")


def log_json(spark, sf):
    events = table(spark, sf, "events")
    parsed = log_sources.json_events(events, "k INT", "props", log_sources.JSON_TAG, "event_id")
    return parsed.select("event_id", "k", F.array_join("tags", ",").alias("tags"))


def _index_root(spark, sf):
    root = scratch_path(spark, "indices")
    rows = derived.indexed_events(table(spark, sf, "events"))
    rows.repartitionByRange("index_name", "event_id").write.partitionBy("index_name").parquet(root)
    return root


def index_pattern_scan(spark, sf):
    rows = indices.index_set(spark, _index_root(spark, sf), INDEX_PATTERN)
    return rows.groupBy("index_name").agg(F.count(F.lit(1)).alias("total_hits"))


def all_index_count(spark, sf):
    return search.count_all(indices.index_set(spark, _index_root(spark, sf)))


def log_retention(spark, sf):
    return log_ops.retain(derived.indexed_events(table(spark, sf, "events")), AS_OF)


def log_drop_expired(spark, sf):
    """What is left of a table of daily indices after its expired ones are dropped."""
    name = "daily_" + uuid.uuid4().hex
    root = _index_root(spark, sf)
    spark.sql(f"CREATE TABLE {name} (event_id BIGINT, created TIMESTAMP_NTZ, index_name STRING) USING parquet "
              f"PARTITIONED BY (index_name) LOCATION '{root}'")
    try:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        log_sinks.drop_expired(spark, name, AS_OF)
        left = spark.table(name).groupBy("index_name").agg(F.count(F.lit(1)).alias("events"))
        return materialize(left, "left-indices")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def log_text_scan(spark, sf):
    """Log lines written as text, read back as a stream of text files and parsed."""
    folder = scratch_path(spark, "log-text")
    lines = derived.log_lines(spread(table(spark, sf, "events"), "event_id"))
    lines.select("value").write.text(folder)
    path = scratch_path(spark, "log-rows")
    stream = log_sources.parse_lines(log_sources.line_stream(spark, folder), "value")
    query = stream.writeStream.format("parquet").option("path", path)
    query = query.option("checkpointLocation", scratch_path(spark, "stream-state"))
    query.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(path)
    return rows.groupBy("level", "class").agg(F.count(F.lit(1)).alias("events"))


# Streams -------------------------------------------------------------------------------------
def _stream(spark, sf, name):
    """A table as a stream of its files; a table may be one file or a folder of them."""
    schema = table(spark, sf, name).schema
    # A file source takes one file only as a pattern; this one matches just the table.
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.[p]arquet")


def stream_index(spark, sf):
    messages = derived.index_messages(_stream(spark, sf, "documents"))
    path = scratch_path(spark, "stream-articles")
    query = index_stream.start_indexing(messages, path, scratch_path(spark, "stream-state"))
    query.awaitTermination()
    return _index_view(article_table.latest(article_table.read_all(spark, path)))


def stream_after_batch(spark, sf):
    """A batch job and a new stream write batch 0 of one table; compaction comes between."""
    first, second = scratch_path(spark, "articles"), scratch_path(spark, "articles")
    decoded = inbox.index_messages(derived.index_messages(_texts(spark, sf)), "seq")
    article_table.append_batch(inbox.articles_to_index(decoded), first, 0)
    article_table.compact(spark, first, second)
    messages = derived.index_messages(_stream(spark, sf, "documents"))
    for _ in range(2):  # the second stream has a checkpoint of its own
        state = scratch_path(spark, "stream-state")
        index_stream.start_indexing(messages, second, state).awaitTermination()
    rows = article_table.read_all(spark, second)
    return rows.groupBy("doc_key").agg(F.count(F.lit(1)).alias("rows"), F.max("seq").alias("seq"))


def declared_table(spark, sf):
    """The articles table declared with its columns and read by name."""
    name, path = "articles_" + uuid.uuid4().hex, scratch_path(spark, "articles")
    article_table.append_batch(derived.articles(table(spark, sf, "documents")).withColumn("seq", F.col("doc_id")), path, 0)
    try:
        for _ in range(2):  # an existing table is kept
            article_table.create_if_absent(spark, name, path)
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        counts = spark.table(name).groupBy("author").agg(F.count(F.lit(1)).alias("articles"))
        return materialize(counts, "declared")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def stream_pages(spark, sf):
    """Pages arriving in two files, extracted and stored as articles, with a restart."""
    folder, path = scratch_path(spark, "page-feed"), scratch_path(spark, "articles")
    state = scratch_path(spark, "stream-state")
    pages = derived.site_pages(_texts(spark, sf)).select("url", "doc_type", "depth", "html")
    half = F.pmod(F.xxhash64("url"), F.lit(2))
    for part in range(2):  # the second run finds its checkpoint and new pages
        pages.filter(half == part).write.mode("append").parquet(folder)
        feed = crawl_sources.page_stream(spark, folder)
        index_stream.start_page_indexing(feed, path, state).awaitTermination()
    return article_table.read_all(spark, path).select(*ARTICLE_FIELDS)


#: Fetch times of the first crawl and of the re-crawl a day later (seconds).
FIRST_FETCH, RECRAWL = 1_700_000_000, 1_700_086_400


def stream_recrawl(spark, sf):
    """Every site page crawled, half of them re-crawled with a new heading, then all files
    read again by a stream that lost its checkpoint, a stale re-delivery of the first
    crawl, and a batch job of the first crawl beside: per url the newest article."""
    folder, path = scratch_path(spark, "page-feed"), scratch_path(spark, "articles")
    pages = derived.site_pages(_texts(spark, sf)).select("url", "doc_type", "depth", "html")
    pages = materialize(pages, "pages")
    first = pages.withColumn("fetched_at", F.timestamp_seconds(F.lit(FIRST_FETCH)))
    changed = F.substring(F.md5("url"), 1, 1) < "8"
    again = pages.filter(changed).select(
        "url", "doc_type", "depth", F.regexp_replace("html", "<h1>", "<h1>NEW-").alias("html"),
        F.timestamp_seconds(F.lit(RECRAWL)).alias("fetched_at"),
    )
    found = ex.articles(ex.extract(first.withColumn("seq", F.unix_micros("fetched_at"))), "seq")
    article_table.append_batch(found, path, 0)  # a batch job beside the streams
    kept, lost = scratch_path(spark, "stream-state"), scratch_path(spark, "stream-state")
    for feed, state in ((first, kept), (again, kept), (None, lost), (first, lost)):
        if feed is not None:
            feed.write.mode("append").parquet(folder)
        stream = crawl_sources.page_stream(spark, folder)
        index_stream.start_page_indexing(stream, path, state).awaitTermination()
    newest = article_table.latest(article_table.read_all(spark, path), key="url")
    return newest.select("url", "seq", *ARTICLE_FIELDS[1:])


def _run_log_stream(spark, sf, start):
    lines = derived.log_lines(_stream(spark, sf, "events"))
    path = scratch_path(spark, "stream-logs")
    start(lines, path, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(path)


def stream_logs(spark, sf):
    rows = _run_log_stream(spark, sf, log_stream.start_severity_files)
    return rows.select(F.col("sink").cast("string"), F.col("day").cast("string"), "line")


def stream_daily_index(spark, sf):
    rows = _run_log_stream(spark, sf, log_stream.start_daily_indices)
    return rows.groupBy("index_name", "level").agg(F.count(F.lit(1)).alias("events"))


QUERIES = {
    "terms_author": terms_by("author"),
    "terms_topic": terms_by("topic"),
    "terms_url": terms_by("url"),
    "terms_date": terms_by("date"),
    "match_topic": match_on("topic", TOPIC_QUERY),
    "match_author": match_on("author", AUTHOR_QUERY),
    "match_url": match_on("url", URL_QUERY),
    "match_topic_postings": match_topic_postings,
    "match_all_1000": match_all_1000,
    "count_all": count_all,
    "term_count": term_count,
    "term_list": term_list,
    "standard_tokens": standard_token_counts,
    "doc_key": doc_keys,
    "index_message_scan": index_message_scan,
    "index_append": index_append,
    "index_upsert": index_upsert,
    "minhash_bits": minhash_bits,
    "near_duplicates": near_duplicates,
    "near_duplicates_lsh": near_duplicates_lsh,
    "near_duplicate_counts": near_duplicate_counts,
    "near_duplicate_groups": near_duplicate_groups,
    "near_duplicate_clusters": near_duplicate_clusters,
    "near_duplicates_of_labelled": near_duplicates_of_labelled,
    "shingles5": shingles5,
    "bucket_minima_512": bucket_minima_512,
    "similar_to": similar_to,
    "page_articles": page_articles,
    "page_decode": page_decode,
    "page_links": page_links,
    "site_articles": site_articles,
    "site_related_links": site_related_links,
    "site_listing_links": site_listing_links,
    "seed_tasks": seed_tasks,
    "fetch_outcomes": fetch_outcomes,
    "fetched_pages": fetched_pages,
    "crawl_task_scan": crawl_task_scan,
    "child_tasks": child_tasks,
    "crawl_frontier": crawl_frontier,
    "crawl_revisits": crawl_revisits,
    "crawl_articles": crawl_articles,
    "route_messages": route_messages,
    "log_parse": log_parse,
    "log_route": log_route,
    "log_daily_index": log_daily_index,
    "log_json": log_json,
    "index_pattern_scan": index_pattern_scan,
    "all_index_count": all_index_count,
    "log_retention": log_retention,
    "log_drop_expired": log_drop_expired,
    "log_text_scan": log_text_scan,
    "stream_index": stream_index,
    "stream_pages": stream_pages,
    "stream_recrawl": stream_recrawl,
    "stream_after_batch": stream_after_batch,
    "declared_table": declared_table,
    "stream_logs": stream_logs,
    "stream_daily_index": stream_daily_index,
}
