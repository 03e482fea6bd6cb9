"""Keyword search, exact terms, counts and match-all over an articles table."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipyard.functions.columns import with_once
from clipyard.functions.minhash import bucket_minima, equal_buckets, rotate
from clipyard.functions.text import standard_tokens

# Relevance parameters and default result sizes.
BM25_K1 = 1.2
BM25_B = 0.75
DEFAULT_HITS = 10
MATCH_ALL_HITS = 1000
AGGREGATION_FIELDS = ["url", "topic", "date", "author"]
DEFAULT_AGGREGATION_FIELD = "author"


def query_terms(spark, query: str) -> list[str]:
    """Distinct tokens of a query string, analysed like the field."""
    row = spark.range(1).select(F.array_distinct(standard_tokens(F.lit(query))).alias("t")).first()
    return row["t"]


def _frequency(tokens, term: str):
    return F.size(F.filter(tokens, lambda t: t == F.lit(term)))


def match(df: DataFrame, field: str, query: str, k: int = DEFAULT_HITS, key="doc_key") -> DataFrame:
    """Top ``k`` documents containing any query token, ranked by BM25.

    Adds ``score`` (rounded to 6 digits, which also settles ties) and
    ``total_hits``. Two narrow passes: one aggregate for the collection
    statistics, read back as a scalar subquery, and one scoring pass that keeps
    ``k`` rows per task.
    """
    terms = query_terms(df.sparkSession, query)
    if not terms:
        return df.limit(0).select("*", F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("total_hits"))
    tokens = standard_tokens(F.coalesce(F.col(field), F.lit("")))

    def counted(frame, *keep):
        # Exploding a one-element array computes the tokens once per row: neither
        # the later filter nor the score can pull the tokenizer in again.
        counts = F.transform(
            F.array(tokens),
            lambda t: F.struct(
                F.size(t).alias("_dl"),
                *[_frequency(t, term).alias(f"_tf{i}") for i, term in enumerate(terms)],
            ),
        )
        return frame.select(*keep, F.inline(counts))

    tfs = [F.col(f"_tf{i}") for i in range(len(terms))]
    any_hit = F.greatest(*tfs, F.lit(0)) > 0
    statistics = (
        counted(df)
        .agg(
            F.count_if(F.col("_dl") > 0).alias("n"),
            F.sum("_dl").alias("length"),
            F.count_if(any_hit).alias("hits"),
            *[F.count_if(tf > 0).alias(f"n{i}") for i, tf in enumerate(tfs)],
        )
        .select(F.struct("*").alias("s"))
        .scalar()
    )
    scored = counted(df, "*").filter(any_hit).withColumn("_s", statistics)
    average = F.col("_s.length") / F.col("_s.n")
    norm = BM25_K1 * (1 - BM25_B + BM25_B * F.col("_dl") / average)
    score = F.lit(0.0)
    for i, tf in enumerate(tfs):
        seen = F.col(f"_s.n{i}")
        idf = F.log(1 + (F.col("_s.n") - seen + 0.5) / (seen + 0.5))
        score = score + idf * tf / (tf + norm)
    return (
        scored.select(
            *df.columns, F.round(score, 6).alias("score"), F.col("_s.hits").alias("total_hits")
        )
        .orderBy(F.desc("score"), key)
        .limit(k)
    )


def similar_to(df: DataFrame, sketch: str, query: DataFrame, k=DEFAULT_HITS, key="doc_key") -> DataFrame:
    """Top ``k`` documents by number of bucket minima shared with one text.

    ``sketch`` names the dense 512-bucket column of ``df``; ``query`` is a frame of
    one row and one column, the text. Narrow: the query's sketch is a scalar.
    """
    column = F.col(query.columns[0])
    wanted = query.select(rotate(bucket_minima(column))).scalar()
    shared = with_once(
        df.withColumn("_q", wanted), shared_buckets=equal_buckets(F.col(sketch), F.col("_q"))
    )
    return (
        shared.filter("shared_buckets > 0")
        .drop("_q")
        .orderBy(F.desc("shared_buckets"), key)
        .limit(k)
    )


def similar_to_each(
    df: DataFrame, sketch: str, queries: DataFrame, query_key: str, text: str, k=DEFAULT_HITS, key="doc_key"
) -> DataFrame:
    """``similar_to`` for every text of ``queries``: top ``k`` documents each.

    Sketches meet in an equi-join on (bucket, value): small query tables are broadcast by
    their size, larger ones shuffled with frequent values split as skewed keys. Ranks
    are cut to ``k`` rows per query in each task before they are shuffled.
    """
    dense = F.posexplode(rotate(bucket_minima(F.col(text)))).alias("bucket", "value")
    asked = queries.select(F.col(query_key).alias("_query"), dense)
    held = df.select(F.col(key).alias("_doc"), F.posexplode(sketch).alias("bucket", "value"))
    shared = (
        held.join(asked, ["bucket", "value"])
        .groupBy("_query", "_doc")
        .agg(F.count(F.lit(1)).cast("int").alias("shared_buckets"))
    )
    order = Window.partitionBy("_query").orderBy(F.desc("shared_buckets"), "_doc")
    best = shared.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
    return best.select(F.col("_query").alias(query_key), F.col("_doc").alias(key), "shared_buckets")


def term(df: DataFrame, field: str, value, k: int = DEFAULT_HITS, key="doc_key") -> DataFrame:
    """First ``k`` documents whose field equals ``value`` exactly (not analysed).

    ``total_hits`` counts all of them, by a scan of that one column.
    """
    found = df.filter(F.col(field) == F.lit(value))
    return found.orderBy(key).limit(k).withColumn("total_hits", count_all(found).scalar())


def term_count(df: DataFrame, field: str, value) -> DataFrame:
    return count_all(df.filter(F.col(field) == F.lit(value)))


def count_all(df: DataFrame) -> DataFrame:
    """Total hits."""
    return df.agg(F.count(F.lit(1)).alias("total_hits"))


def match_all(df: DataFrame, k: int = MATCH_ALL_HITS, key="doc_key") -> DataFrame:
    """The first ``k`` documents as JSON strings, in key order, with the number of all."""
    first = df.orderBy(key).limit(k).select(key, F.to_json(F.struct(*df.columns)).alias("source"))
    return first.withColumn("total_hits", count_all(df).scalar())


def aggregation_field(name: str | None) -> str:
    """The field to count by; anything unknown means the author."""
    return name if name in AGGREGATION_FIELDS else DEFAULT_AGGREGATION_FIELD


def terms(df: DataFrame, field: str | None, k: int = DEFAULT_HITS) -> DataFrame:
    """The ``k`` most frequent exact values of a field with their counts."""
    return (
        df.groupBy(F.col(aggregation_field(field)).alias("key"))
        .agg(F.count(F.lit(1)).alias("doc_count"))
        .filter(F.col("key").isNotNull())
        .orderBy(F.desc("doc_count"), "key")
        .limit(k)
    )
