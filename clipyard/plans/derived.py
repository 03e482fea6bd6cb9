"""Inputs in the library's row shapes, derived from the given tables by Spark."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipyard.functions.minhash import bucket_minima, rotate, signature, with_signature_words
from clipyard.operators.extract import generic_links
from clipyard.operators.logs import with_daily_index
from clipyard.sinks.routing import publish_articles, publish_tasks
from clipyard.sources.logs import format_line

TOPIC_WORDS = "[\\p{L}\\p{N}]+"
RESEND = 1_000_000_000
SITE = "https://news.example.org/"
SITE_ROOT = "https://news.example.org/news/"
SITE_LISTING = "https://news.example.org/page/"
PER_LISTING = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(documents: DataFrame) -> DataFrame:
    """Documents as articles: ``doc_id`` and the five text fields."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(TOPIC_WORDS), F.lit(0))
    return documents.select(
        "doc_id",
        F.concat(
            F.lit("https://"), "source", F.lit(".example.org/news/"), F.col("doc_id").cast("string")
        ).alias("url"),
        F.array_join(F.slice(words, 1, 5), " ").alias("topic"),
        F.concat(
            F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")
        ).alias("date"),
        F.col("source").alias("author"),
        F.col("text").alias("filling"),
    )


def signed(documents: DataFrame, text: str = "text", *keep: str) -> DataFrame:
    """Documents with their signature: ``doc_id, minhash, sig_hi, sig_lo``."""
    minima = signature(F.col(text)).alias("minhash")
    return with_signature_words(documents.select("doc_id", *keep, minima))


def sketched(documents: DataFrame) -> DataFrame:
    """Documents with the dense 512-bucket sketch."""
    return documents.select("doc_id", rotate(bucket_minima(F.col("text"))).alias("sketch"))


# Messages and fetches --------------------------------------------------------------
def index_messages(documents: DataFrame) -> DataFrame:
    """Articles as index messages ``seq, value``; a tenth is sent a second time."""
    rows = publish_articles(articles(documents).withColumn("seq", F.col("doc_id")), keep=["seq"])
    again = rows.filter(F.col("seq") % 10 == 0).withColumn("seq", F.col("seq") + RESEND)
    return rows.unionByName(again).select("seq", "value")


def task_messages(pages: DataFrame) -> DataFrame:
    """Crawl-task messages over the pages, some without url, depths 0..11."""
    tasks = pages.select(
        "page_id",
        F.when(F.col("page_id") % 20 != 7, F.col("url")).alias("url"),
        (F.col("page_id") % 2).cast("int").alias("doc_type"),
        (F.col("page_id") % 12).cast("int").alias("depth"),
    )
    return publish_tasks(tasks, keep=["page_id"])


def md5_int(column) -> Column:
    return F.conv(F.substring(F.md5(column), 1, 15), 16, 10).cast("bigint")


def fetch_attempts(pages: DataFrame) -> DataFrame:
    """Three attempts per page with a status drawn from the url's hash."""
    tried = pages.select("url", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("attempt"), "html")
    draw = md5_int(F.concat("url", F.lit("#"), F.col("attempt").cast("string"))) % 4
    status = F.when(draw == 0, 404).when(draw == 1, 500).otherwise(200)
    return tried.withColumn("status", status).select(
        "url", "attempt", "status", F.when(F.col("status") == 200, F.col("html")).alias("html")
    )


def sites(pages: DataFrame) -> DataFrame:
    """One row per host of the pages: its root and the prefix of its listing pages."""
    host = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    return pages.select(host.alias("host")).distinct().select(
        F.concat("host", F.lit("/news/")).alias("root"),
        F.concat("host", F.lit("/page/")).alias("listing"),
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """Page graph from the anchors: ``src, doc_type, link`` with page numbers."""
    total = pages.agg(F.count(F.lit(1)).alias("n")).scalar()
    anchors = generic_links(pages.select(F.col("page_id").alias("url"), "html"))
    edges = anchors.withColumn("n", total)
    return edges.select(
        F.col("url").alias("src"),
        F.lit(1).alias("doc_type"),
        (md5_int("link") % F.col("n")).alias("link"),
    )


# Pages in the site's layout ----------------------------------------------------------
def _escaped(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def site_url(doc_id: Column) -> Column:
    return F.concat(F.lit(SITE), doc_id.cast("string"), F.lit("/"))


def site_pages(documents: DataFrame) -> DataFrame:
    """Documents as article pages ``url, doc_type, depth, html``.

    The layout varies with ``doc_id % 16``: 0 has no article body, 1 a body of two
    children, 2 two meta items, 3 no meta block, 4 a malformed second related
    block. Each page links to three others.
    """
    total = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    case = F.col("doc_id") % 16
    item = "<li> <a href='#'>%s</a>\n</li>"

    def li(column):
        before, after = item.split("%s")
        return F.concat(F.lit(before), column, F.lit(after))

    def related(target):
        return F.concat(
            F.lit('<div class="recent-wrap item"><div><a href="'),
            site_url(target % F.col("n")),
            F.lit('">more</a></div></div>'),
        )

    parts = F.array_join(
        F.transform(F.split("filling", "\n"), lambda p: F.concat(F.lit("<p>"), _escaped(p))), "\n"
    )
    third = F.when(case == 2, F.lit("")).otherwise(li(F.col("author")))
    meta = F.when(case == 3, F.lit("<div></div>")).otherwise(
        F.concat(
            F.lit('<div class="post-meta"><ul>'),
            li(F.col("date")),
            F.lit("<li>by"),
            third,
            F.lit("</ul></div>"),
        )
    )
    body = F.when(case == 1, F.lit("")).otherwise(F.concat(F.lit("<div>"), parts, F.lit("</div>")))
    body_class = F.when(case == 0, "post-body").otherwise("post-single-details-body")
    number = F.col("doc_id")
    blocks = F.concat(
        related(2 * number + 1),
        F.when(case == 4, F.lit("<div class=recent-wrap></div>")).otherwise(related(2 * number + 2)),
        related(7 * number + 3),
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><script>var a='<p>';</script></head><body><div class='wide "),
        body_class,
        F.lit("'><h1>"),
        F.col("topic"),
        F.lit("</h1>"),
        meta,
        body,
        F.when(case == 1, F.lit("")).otherwise(blocks),
        F.lit("</div></body></html>"),
    )
    return (
        articles(documents)
        .withColumn("n", total)
        .select(site_url(number).alias("url"), F.lit(1).alias("doc_type"), F.lit(0).alias("depth"), html.alias("html"))
    )


def listing_pages(documents: DataFrame) -> DataFrame:
    """Listing pages of 25 articles each; the first is the root page.

    Blocks of articles with ``doc_id % 16 = 5`` are malformed.
    """
    link = F.concat(
        F.lit("<div class='post-blog-list'><div><img src=x><div><h2><b><a href=\""),
        site_url(F.col("doc_id")),
        F.lit('">t</a></b></h2></div></div></div>'),
    )
    block = F.when(F.col("doc_id") % 16 == 5, "<div class='post-blog-list'></div>").otherwise(link)
    number = F.floor(F.col("doc_id") / PER_LISTING) + 1
    grouped = (
        documents.select(number.alias("page"), F.struct("doc_id", block.alias("block")).alias("b"))
        .groupBy("page")
        .agg(F.array_sort(F.collect_list("b")).alias("blocks"))
    )
    url = F.when(F.col("page") == 1, F.lit(SITE_ROOT)).otherwise(
        F.concat(F.lit(SITE_LISTING), F.col("page").cast("string"), F.lit("/"))
    )
    html = F.concat(
        F.lit("<html><body>"), F.array_join(F.col("blocks.block"), "\n"), F.lit("</body></html>")
    )
    return grouped.select(
        url.alias("url"), F.lit(0).alias("doc_type"), F.lit(0).alias("depth"), html.alias("html")
    )


def site_roots(documents: DataFrame) -> DataFrame:
    """The one site the derived pages belong to, as input for seeds."""
    return documents.select(
        F.lit(SITE_ROOT).alias("root"), F.lit(SITE_LISTING).alias("listing")
    ).distinct()


# Logs --------------------------------------------------------------------------------
def log_lines(events: DataFrame) -> DataFrame:
    """Events as log lines ``event_id, value``."""
    level = (
        F.when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "click", "WARN")
        .otherwise("INFO")
    )
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    line = format_line(
        F.col("ts"),
        level,
        F.concat(F.lit("user-"), F.col("user_id").cast("string")),
        F.lit("clipyard.events.Collector"),
        (F.col("event_id") % 1000).cast("string"),
        F.concat_ws(" ", "event_type", amount),
    )
    return events.select("event_id", line.alias("value"))


def indexed_events(events: DataFrame) -> DataFrame:
    """Events in daily indices, purchases in an old index of another prefix as well."""
    daily = with_daily_index(events).select(
        "index_name", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("created"), "event_id"
    )
    other = events.filter("event_type = 'purchase'").select(
        F.concat(F.lit("metrics-"), F.date_format("ts", "yyyy.MM.dd")).alias("index_name"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("created"),
        "event_id",
    )
    return daily.unionByName(other)
