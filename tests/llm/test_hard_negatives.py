import math
import tracemalloc

import duckdb
import numpy as np

from clipyard.llm import hard_negatives
from clipyard.llm.oracle import NEGATIVES

EMB = "vec_id bigint, embedding array<float>, label int"


def _rows(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def _sql(df):
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    return _rows(con.execute(NEGATIVES).fetchall())


def _fixture(n):
    rows = []
    for i in range(n):
        vec = [math.sin(i * 3 + j * 0.7) * 0.4 + (0.3 if j == i % 5 else 0.0) for j in range(64)]
        rows.append((i, vec, (i // 3) % 4))
    common = [0.2] * 64
    rows += [(1000 + i, common, i % 4) for i in range(60)]  # one very common vector
    rows += [
        (1100, None, 1),
        (1101, [0.1] * 64, None),
        (1102, [0.1] * 63 + [float("inf")], 1),
        (1103, [0.1] * 63, 1),
        (None, [0.1] * 64, 2),
        (300, rows[300][1], rows[300][2]),  # repeated anchor row
        (105, rows[105][1], 3),
    ]
    return rows


def test_mine_equals_brute_force_with_small_leaves(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", 25)  # hot leaf cut into chunks
    monkeypatch.setattr(hard_negatives, "SAMPLE", 64)
    df = spark.createDataFrame(_fixture(900), EMB)
    got = _rows(hard_negatives.mine(df).collect())
    assert got and got == _sql(df)
    assert all(1 <= r[2] <= 5 for r in got)


def test_mine_empty_and_extra_columns(spark):
    empty = spark.createDataFrame([], EMB)
    assert hard_negatives.mine(empty).count() == 0
    df = spark.createDataFrame(_fixture(250), EMB)
    clashing = df.withColumnRenamed("label", "label").selectExpr("*", "1 AS q", "2 AS cell", "3 AS score")
    assert _rows(hard_negatives.mine(clashing).collect()) == _sql(df)


def test_repeated_rows_of_large_values_in_several_anchor_blocks(spark, monkeypatch):
    """A row that comes many times is one sample row: its score is not the fifth best."""
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 3, raising=False)
    rows = [(i, v and [x * 1000 for x in v], label) for i, v, label in _fixture(700)]
    rows += [rows[i] for i in range(0, 600, 50) for _ in range(7)]
    df = spark.createDataFrame(rows, EMB)
    got = _rows(hard_negatives.mine(df).collect())
    assert got and got == _sql(df)


def test_scores_of_many_anchors_and_rows_are_never_in_memory_at_once():
    rng = np.random.default_rng(1)
    anchors, rows = (rng.integers(-100, 100, (n, 64)).astype(np.float32) for n in (3000, 20000))
    lo = np.full(len(anchors), 100_000, dtype=np.int64)
    tracemalloc.start()
    found = [(i, j, s) for i, j, s in hard_negatives._scored(anchors, lo, rows)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # all scores at once take 240 MB
    i, j, s = (np.concatenate(x) for x in zip(*found))
    assert len(i) and (s == (anchors[i].astype(np.int64) * rows[j].astype(np.int64)).sum(axis=1)).all()
    assert len(i) == sum(int((anchors[k] @ rows.T >= 100_000).sum()) for k in range(len(anchors)))
