"""Search operators against plain Python."""

from math import log

import pytest
from pyspark.sql import functions as F

from clipyard.functions.minhash import bucket_minima, rotate
from clipyard.operators import search
from clipyard.plans import commands

DOCS = [
    ("k1", "red fox", "ann"),
    ("k2", "Red red fox, blue", "bob"),
    ("k3", "blue", "ann"),
    ("k4", "", "cid"),
    ("k5", "fox fox fox fox", None),
    ("k6", None, "bob"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, f"https://h.org/{k}", t, "2024", a, "x") for k, t, a in DOCS]
    return spark.createDataFrame(
        rows, "doc_key string, url string, topic string, date string, author string, filling string"
    ).cache()


def bm25(query):
    fields = {k: (t or "").lower().replace(",", "").split() for k, t, _ in DOCS}
    filled = [t for t in fields.values() if t]
    average = sum(map(len, filled)) / len(filled)
    scores = {}
    for key, tokens in fields.items():
        total = 0.0
        for term in dict.fromkeys(query.lower().split()):
            tf, n = tokens.count(term), sum(term in t for t in filled)
            idf = log(1 + (len(filled) - n + 0.5) / (n + 0.5))
            total += idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(tokens) / average))
        if any(t in tokens for t in query.lower().split()):
            scores[key] = round(total, 6)
    return scores


@pytest.mark.parametrize("query", ["fox", "RED blue red", "blue nothing"])
def test_match(docs, query):
    rows = search.match(docs, "topic", query).collect()
    want = bm25(query)
    assert [(r["doc_key"], r["score"]) for r in rows] == sorted(want.items(), key=lambda i: (-i[1], i[0]))
    assert {r["total_hits"] for r in rows} == {len(want)}


def test_match_limits_but_counts_all(docs):
    rows = search.match(docs, "topic", "fox", k=2).collect()
    assert len(rows) == 2 and rows[0]["total_hits"] == 3


@pytest.mark.parametrize("query", ["", "...", "absent"])
def test_match_without_hits(docs, query):
    assert search.match(docs, "topic", query).count() == 0


def test_terms(docs):
    assert [tuple(r) for r in search.terms(docs, "author").collect()] == [("ann", 2), ("bob", 2), ("cid", 1)]
    assert search.terms(docs, "nonsense", k=1).first()["key"] == "ann"


def test_term_and_counts(docs):
    assert [r["doc_key"] for r in search.term(docs, "author", "bob").collect()] == ["k2", "k6"]
    assert search.term_count(docs, "topic", "blue").first()[0] == 1
    assert search.count_all(docs).first()[0] == 6


def test_match_all(docs):
    rows = search.match_all(docs, k=2).collect()
    assert {r["total_hits"] for r in rows} == {6}
    assert [r["doc_key"] for r in rows] == ["k1", "k2"] and '"topic":"red fox"' in rows[0]["source"]


def test_similar_to(spark):
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(words), " ".join(words[:150]), "a b c d e f", "short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_key long, text string")
    docs = docs.withColumn("sketch", rotate(bucket_minima(F.col("text"))))
    query = spark.createDataFrame([(texts[0],)], "text string")
    rows = search.similar_to(docs, "sketch", query).collect()
    assert [r["doc_key"] for r in rows] == [0, 1] and rows[0]["shared_buckets"] == 512


def test_commands(docs):
    run = commands.run_command
    assert run(docs, commands.MATCH_AUTHOR, "bob").count() == 2
    assert run(docs, commands.MATCH_TOPIC, "blue").count() == 2
    assert run(docs, commands.MATCH_URL, "h.org").first()["total_hits"] == 6
    assert run(docs, commands.COUNT, "Aggregate_date").first()["key"] == "2024"
    assert run(docs, commands.COUNT, "?").first()["key"] == "ann"
    assert run(docs, 6).count() == run(docs, 99).count() == 6
    with pytest.raises(ValueError):
        run(docs, commands.INDEX)
