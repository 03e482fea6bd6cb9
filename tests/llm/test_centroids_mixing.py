import math

import duckdb
import pytest

from clipyard.llm import centroids, mixing
from clipyard.llm.oracle import CENTROIDS, MIX

EMB = "vec_id bigint, embedding array<float>, label int"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _sql(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return sorted((tuple(r) for r in con.execute(sql).fetchall()), key=repr)


def _vectors(n, dims=64):
    rows = []
    for i in range(n):
        rows.append((i, [math.sin(i * 7 + j) * (1 + i % 3) for j in range(dims)], i % 10))
    return rows


def test_centroids_equal_sql_with_edge_rows(spark):
    rows = _vectors(40)
    rows += [
        (100, None, 1),  # null vector
        (101, [0.1] * 63, 1),  # wrong length
        (102, [0.1] * 63 + [float("nan")], 1),  # non-finite
        (103, [0.2] * 63 + [None], 1),  # null component
        (5, rows[5][1], 5),  # repeated row
        (None, rows[7][1], 3),  # null id: clustered, never a seed
    ]
    emb = spark.createDataFrame(rows, EMB).withColumn("_c_v", __import__("pyspark.sql.functions").sql.functions.lit(1))
    assigned, cents = centroids.cluster(emb)
    got = _rows(centroids.with_inertia(assigned, cents))
    assert len(got) == 42 and len(cents) == 8
    assert got == _sql(CENTROIDS, embeddings=spark.createDataFrame(rows, EMB))


def test_centroids_few_or_none(spark):
    few = spark.createDataFrame(_vectors(3), EMB)
    assigned, cents = centroids.cluster(few)
    out = _rows(centroids.with_inertia(assigned, cents))
    assert len(cents) == 3 and [r[2] for r in out] == [0, 0, 0]  # each vector its own centroid
    empty = spark.createDataFrame([], EMB)
    assigned, cents = centroids.cluster(empty)
    assert cents == [] and centroids.with_inertia(assigned, cents).count() == 0


def _docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def test_mix_equal_sql_and_bounds(spark):
    words = "a b c d e f g h".split()
    rows = []
    for i in range(300):
        src = None if i % 29 == 0 else f"s{i % 4 if i % 5 else 0}"  # s0 is hot
        text = None if i % 31 == 0 else " ".join(words[: 1 + i % 8] * (1 + i % 5))
        rows.append((i, text, "en", src, 0))
    rows += [(7, rows[7][1], "en", rows[7][3], 0), (None, "x y", "en", "s1", 0), (400, "", "en", "s9", 0)]
    docs = _docs(spark, rows).withColumn("_m_h", __import__("pyspark.sql.functions").sql.functions.lit(3))
    got = _rows(mixing.mix(docs))
    assert got == _sql(MIX, documents=_docs(spark, rows))
    assert len(got) == len(rows)
    assert all(taken <= 3 * size for _, size, _, _, taken in got)
    per = {}
    for _, size, src_size, target, taken in got:
        per.setdefault((src_size, target), [0, 0])
        per[(src_size, target)][0] += taken
        per[(src_size, target)][1] = max(per[(src_size, target)][1], size)
    for (src_size, target), (taken, biggest) in per.items():
        assert abs(taken - target) <= biggest  # whole documents: within one document of the target
    assert _rows(mixing.mix(docs)) == got  # reruns agree


def test_mix_empty(spark):
    assert mixing.mix(_docs(spark, [])).count() == 0
