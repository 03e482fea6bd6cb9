"""The postings index against the full scan, and the buckets a search reads."""

import random

from pyspark.sql import functions as F

from clipyard.operators import postings, search


def _docs(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "Eta", "theta"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 9))) if i % 17 else None) for i in range(600)]
    rows += [(1000 + i, "alpha alpha beta") for i in range(30)]  # ties, settled by key
    return spark.createDataFrame(rows, "doc_id long, body string")


def test_search_equals_full_scan(spark, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_DOCS", 16)  # many blocks, most pruned
    docs = _docs(spark)
    index = postings.build_index(docs, "body", key="doc_id", buckets=8)
    for query, k in [("alpha beta", 10), ("theta", 5), ("eta GAMMA zeta", 25), ("nothing", 10), ("", 10)]:
        want = [tuple(r) for r in search.match(docs, "body", query, k=k, key="doc_id").collect()]
        got = [tuple(r) for r in postings.search(spark, index, docs, query, k=k).collect()]
        assert got == want, query


def test_search_reads_only_the_query_buckets(spark):
    docs = _docs(spark)
    index = postings.build_index(docs, "body", key="doc_id", buckets=8)
    table = spark.table(index.postings)
    read = table.where(F.col("term").isin(["alpha"])).select(F.input_file_name()).distinct().count()
    assert read == 1 < table.select(F.input_file_name()).distinct().count()  # one bucket's files


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, body string")
    index = postings.build_index(docs, "body", key="doc_id", buckets=4)
    assert postings.search(spark, index, docs, "alpha").count() == 0
