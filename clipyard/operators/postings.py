"""A postings index for keyword search, with score bounds per document block.

The index of one text field is two tables written once, both bucketed by term:

* ``postings``: ``term, block, key, tf, dl`` for every distinct token of every document;
* ``blocks``: per ``(term, block)`` the postings count, the largest ``tf`` and the
  shortest document, from which a BM25 bound of the term in that block follows.

Blocks are ranges of a hash of the key (``BLOCK_DOCS`` documents each on average), so
block ``b`` means the same documents for every term and a block's bound for a query
is the sum of its terms' bounds. A search reads the query terms' buckets only (an
``IN`` filter on the bucket column prunes files), scores the documents of the blocks
with the largest bounds exactly to get a threshold, drops every block whose bound is
below it (block-max pruning), and scores the rest exactly. Results equal those of
``search.match``: BM25 with the same statistics, scores rounded to 6 digits, ties by key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipyard.functions.text import standard_tokens
from clipyard.operators.search import BM25_B, BM25_K1, DEFAULT_HITS, query_terms
from clipyard.session import materialize_bucketed

BLOCK_DOCS = 4096
BUCKETS = 64


@dataclass
class PostingsIndex:
    postings: str  # table names
    blocks: str
    field: str
    key: str
    docs: int  # documents with at least one token
    length: int  # tokens of all documents
    n_blocks: int


def _block(key: str, n_blocks: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n_blocks))


def build_index(df: DataFrame, field: str, key: str = "doc_key", buckets: int = BUCKETS) -> PostingsIndex:
    """Tokenize ``field`` once and write the postings and block tables."""
    tokens = standard_tokens(F.coalesce(F.col(field), F.lit("")))
    per_doc = df.select(F.col(key).alias("key"), tokens.alias("_t")).select("key", F.size("_t").alias("dl"), "_t")
    stats = per_doc.agg(F.count_if(F.col("dl") > 0).alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("length")).first()
    n_blocks = max(1, -(-stats["n"] // BLOCK_DOCS))
    postings = (
        per_doc.where("dl > 0")
        .select("key", "dl", F.explode("_t").alias("term"))
        .groupBy("term", "key", "dl")
        .agg(F.count(F.lit(1)).alias("tf"))
        .withColumn("block", _block("key", n_blocks))
    )
    postings_table = materialize_bucketed(postings.select("term", "block", "key", "tf", "dl"), "postings", ["term"], buckets)
    spark = df.sparkSession
    blocks = spark.table(postings_table).groupBy("term", "block").agg(
        F.count(F.lit(1)).alias("n"), F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl")
    )
    blocks_table = materialize_bucketed(blocks, "postings-blocks", ["term"], buckets)
    return PostingsIndex(postings_table, blocks_table, field, key, stats["n"], stats["length"], n_blocks)


def _bm25(tf, dl, idf, average):
    return idf * tf / (tf + BM25_K1 * (1 - BM25_B + BM25_B * dl / average))


def search(spark: SparkSession, index: PostingsIndex, docs: DataFrame, query: str, k: int = DEFAULT_HITS) -> DataFrame:
    """Top ``k`` rows of ``docs`` for ``query``, with ``score`` and ``total_hits``."""
    terms = query_terms(spark, query)
    key = index.key
    empty = docs.limit(0).select("*", F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("total_hits"))
    if not terms or index.docs == 0:
        return empty
    postings = spark.table(index.postings).where(F.col("term").isin(terms))
    blocks = spark.table(index.blocks).where(F.col("term").isin(terms))
    seen = dict(blocks.groupBy("term").agg(F.sum("n")).collect())  # one row a query term
    average = index.length / index.docs
    idf = {t: F.log(F.lit(1 + (index.docs - seen.get(t, 0) + 0.5) / (seen.get(t, 0) + 0.5))) for t in terms}
    idf_of = F.coalesce(*[F.when(F.col("term") == t, idf[t]) for t in terms])

    # Bound of each block: the sum over terms of the best score the term can give there.
    bound = blocks.select("block", "n", _bm25(F.col("max_tf"), F.col("min_dl"), idf_of, average).alias("ub"))
    per_block = bound.groupBy("block").agg(F.sum("ub").alias("ub"), F.sum("n").alias("n"))
    best_first = Window.orderBy(F.desc("ub"), "block")
    ranked = per_block.withColumn("_before", F.sum("n").over(best_first.rowsBetween(Window.unboundedPreceding, -1)))
    seed_blocks = ranked.where(F.coalesce("_before", F.lit(0)) < k).select("block")

    def scored(frame: DataFrame) -> DataFrame:
        tf = {t: F.max(F.when(F.col("term") == t, F.col("tf"))) for t in terms}
        wide = frame.groupBy("key").agg(F.first("dl").alias("dl"), *[tf[t].alias(f"_tf{i}") for i, t in enumerate(terms)])
        score = F.lit(0.0)
        for i, t in enumerate(terms):  # in query order, as search.match adds them
            score = score + _bm25(F.coalesce(F.col(f"_tf{i}"), F.lit(0)), F.col("dl"), idf[t], average)
        return wide.select("key", F.round(score, 6).alias("score"))

    # Threshold: the k-th best exact score in the blocks of largest bound (0 if fewer hits).
    seed = scored(postings.join(F.broadcast(seed_blocks), "block"))
    top_seed = seed.orderBy(F.desc("score"), "key").limit(k).collect()
    theta = top_seed[-1]["score"] if len(top_seed) >= k else 0.0
    alive = per_block.where(F.col("ub") >= theta - 1e-6).select("block")
    top = scored(postings.join(alive, "block")).orderBy(F.desc("score"), "key").limit(k)
    total = postings.select("key").distinct().count()
    hits = docs.join(F.broadcast(top.withColumnRenamed("key", key)), key)
    return hits.select(*docs.columns, "score", F.lit(total).cast("bigint").alias("total_hits")).orderBy(
        F.desc("score"), key
    )
