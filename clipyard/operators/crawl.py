"""The crawl: expand a frontier of pages over their links, down to a depth.

Every page snapshot is parsed once, up front, into a slim edge table; the rounds
then join the frontier to edges only and never touch HTML again. Each level is
written to the shared folder, so lineage stays one round long and a lost executor
re-reads a file.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipyard.operators import extract as ex
from clipyard.session import (
    materialize,
    materialize_bucketed,
    materialize_counted,
    scratch_path,
)
from clipyard.sources.crawl import MAX_DEPTH

#: Edges of one page under one key: a page with more gets a lane for each such many.
LANE_EDGES = 10_000
#: Edges that a bucket of the stored edge table is meant to hold.
BUCKET_EDGES = 4_000_000

TASK = ["url", "doc_type"]
#: Paths multiply from level to level: 38 digits hold ten levels of 6,000 links each.
VISITS = "decimal(38,0)"


def child_tasks(parents: DataFrame, link: str, max_depth: int = MAX_DEPTH, *keep) -> DataFrame:
    """Tasks for the links of fetched pages: one deeper, always article pages.

    Pages at ``max_depth`` have no children. ``keep`` names columns to carry along.
    """
    return parents.filter(F.col("depth") < max_depth).select(
        F.col(link).alias("url"),
        F.lit(ex.ARTICLE).alias("doc_type"),
        (F.col("depth") + 1).alias("depth"),
        *keep,
    )


class _Edges:
    """Edges stored by source page; a page's edges are spread over lanes by their number.

    Stored once in buckets, so a round shuffles its frontier but not the edges.
    """

    KEYS = ["src", "doc_type", "salt"]

    def __init__(self, edges: DataFrame):
        self.spark = edges.sparkSession
        degrees = materialize(
            edges.groupBy("src", "doc_type").agg(F.count(F.lit(1)).alias("degree")), "degrees"
        )
        lanes = F.ceil(F.col("degree") / LANE_EDGES).cast("int").alias("lanes")
        self.wide = degrees.filter(F.col("degree") > LANE_EDGES).select("src", "doc_type", lanes)
        total = degrees.agg(F.sum("degree")).first()[0] or 0
        buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_EDGES))
        laned = edges.join(self.wide, ["src", "doc_type"], "left")
        salt = F.pmod(F.xxhash64("link"), F.coalesce("lanes", F.lit(1))).cast("int")
        self.table = materialize_bucketed(
            laned.select("src", "doc_type", "link", salt.alias("salt")), "edges", self.KEYS, buckets
        )

    def follow(self, level: DataFrame) -> DataFrame:
        """Links of the tasks of one level: ``link, depth, visits``."""
        parents = level.withColumnRenamed("url", "src").join(self.wide, ["src", "doc_type"], "left")
        lanes = F.sequence(F.lit(0), F.coalesce("lanes", F.lit(1)) - 1)
        parents = parents.withColumn("salt", F.explode(lanes)).drop("lanes")
        return parents.join(self.spark.table(self.table), self.KEYS).select("link", "depth", "visits")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def expand(
    edges: DataFrame, seeds: DataFrame, max_depth: int = MAX_DEPTH, dedup: bool = True
) -> DataFrame:
    """Reached tasks ``url, doc_type, depth, visits``.

    ``edges`` has ``src, doc_type, link`` (``doc_type`` of the page the link is on),
    ``seeds`` has ``url, doc_type, depth``. With ``dedup`` every task is visited
    once, at its smallest depth. Without, a task is visited once per path that
    leads to it: paths are counted per level, never spelled out.
    """
    keyed = _Edges(edges)
    try:
        return _expand(keyed, seeds, max_depth, dedup)
    finally:
        keyed.drop()


def _expand(keyed: _Edges, seeds: DataFrame, max_depth: int, dedup: bool) -> DataFrame:
    spark = keyed.spark
    seeds, seed_rows = materialize_counted(seeds.filter("url IS NOT NULL"), "seeds")
    last_seed = seeds.agg(F.max("depth")).first()[0] if seed_rows else -1
    one = F.lit(1).cast(VISITS)
    paths, level, reached = [], None, None
    for depth in range(max_depth + 1):
        tasks = None
        if depth <= last_seed:
            tasks = seeds.filter(F.col("depth") == depth).select(*TASK, one.alias("visits"))
        if level is not None:
            links = child_tasks(keyed.follow(level), "link", max_depth, "visits").drop("depth")
            tasks = tasks.unionByName(links) if tasks is not None else links
        if tasks is None:
            break
        tasks = tasks.filter("url IS NOT NULL").groupBy(*TASK).agg(F.sum("visits").cast(VISITS).alias("visits"))
        if dedup:
            tasks = tasks.withColumn("visits", one)
            if reached is not None:
                tasks = tasks.join(reached.select(*TASK), TASK, "left_anti")
        tasks = tasks.select(*TASK, F.lit(depth).alias("depth"), "visits")
        path = scratch_path(spark, f"level-{depth}")
        level, rows = materialize_counted(tasks, path=path)
        if rows:
            paths.append(path)
            reached = spark.read.schema(level.schema).parquet(*paths)
        else:
            level = None
            if depth >= last_seed:
                break
    if reached is None:
        return seeds.limit(0).select(*TASK, "depth", one.alias("visits"))
    return reached


def latest_snapshots(pages: DataFrame, version: str | None = None) -> DataFrame:
    """One snapshot per url: the newest ``version``, ties by a hash of the page."""
    newest = [F.desc_nulls_last(version)] if version else []
    order = Window.partitionBy("url").orderBy(*newest, F.xxhash64("html"))
    ranked = pages.filter("url IS NOT NULL").withColumn("_rank", F.row_number().over(order))
    return ranked.filter("_rank = 1").drop("_rank")


def crawl(
    pages: DataFrame,
    seeds: DataFrame,
    max_depth: int = MAX_DEPTH,
    dedup: bool = True,
    sep: str = "",
    resolve: bool = False,
    version: str | None = None,
):
    """Crawl page snapshots (``url, html``) from the seeds.

    Of several snapshots of a url the latest by the column ``version`` counts. Returns ``(reached, articles)``: the visited tasks and the extracted articles
    of the reached pages, with the depth they were found at.
    """
    pages = latest_snapshots(pages, version)
    listings = seeds.filter(F.col("doc_type") == ex.LISTING).select("url").distinct()
    snapshots = (
        pages.select("url", F.lit(ex.ARTICLE).alias("doc_type"), "html")
        .unionByName(
            pages.join(listings, "url", "left_semi").select(
                "url", F.lit(ex.LISTING).alias("doc_type"), "html"
            )
        )
    )
    parsed = materialize(ex.extract(snapshots, sep, resolve), "parsed")
    reached = expand(ex.links(parsed), seeds, max_depth, dedup)
    found = ex.articles(parsed, "doc_type").join(reached, TASK).drop("doc_type")
    return reached, found
