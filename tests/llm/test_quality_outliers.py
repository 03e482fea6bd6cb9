"""Robust outliers against a plain numpy version; held-out labels."""

import math
import os
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from clipyard.llm import robust_outliers as ro  # noqa: E402


def features(text):
    n_words, chars, symbols, dup, repeat, failed = brute.quality(text)
    lines = [x for x in (text or "").split("\n") if brute.WORD.search(x)]
    capitals = sum(c.isupper() for c in text or "")
    x = [math.log(max(chars, 1) / max(n_words, 1)), *(math.sqrt(a / max(b, 1)) for a, b in ((symbols, chars), (capitals, chars), (repeat, n_words), (dup, len(lines))))]
    return [int(math.floor(v * ro.SCALE + 0.5)) / ro.SCALE for v in x], failed


def plain_judge(rows):
    """rows: (lang, source, text) -> (failed, distance or None, kept)."""
    vectors = [features(t) for _, _, t in rows]
    keys = [(lang or "", source or "") for lang, source, _ in rows]
    ok = [not failed for _, failed in vectors]
    sizes = Counter(k for k, good in zip(keys, ok) if good)
    pool = {k: k if n >= ro.MIN_GROUP else (k[0], "*") for k, n in sizes.items()}
    pooled = Counter()
    for k, n in sizes.items():
        pooled[pool[k]] += n
    pool = {k: p if pooled[p] >= ro.MIN_GROUP else ("*", p[1]) for k, p in pool.items()}
    groups = defaultdict(list)
    for i, k in enumerate(keys):
        if ok[i]:
            groups[pool[k]].append(i)
    floors = np.diag([ro.FLOORS[n] ** 2 for n in ro.FEATURES])
    out = [(not good, None, good) for good in ok]
    for members in groups.values():
        x = np.array([vectors[i][0] for i in members])

        def cells(mean, cov):
            z = np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)
            d = (z**2).sum(axis=0)
            return d, np.floor(np.log2(d + 1e-6) * 16)

        q = np.percentile(x, [25, 50, 75], axis=0)
        spread = np.maximum((q[2] - q[0]) / 1.349, np.sqrt(np.diag(floors)))
        mean, cov = q[1], np.diag(spread**2)
        for _ in range(ro.STEPS):
            _, cell = cells(mean, cov)
            cut = np.sort(cell)[math.ceil(ro.NEAR * len(x)) - 1]
            near = x[cell <= cut]
            mean, cov = near.mean(axis=0), np.cov(near.T, bias=True) + floors
        d, cell = cells(mean, cov)
        cut = np.sort(cell)[math.ceil(ro.NEAR * len(x)) - 1]
        d = d * ro.NEAR_CHI2 / 2 ** ((cut + 1) / 16)
        for i, v in zip(members, d):
            if len(x) >= ro.MIN_FIT:
                out[i] = (False, float(v), bool(v <= ro.CUTOFF))
    return out


def corpus():
    rng = random.Random(9)
    vocabulary = [f"{a}{b}{c}" for a in ("ta", "so", "mi") for b in ("n", "rr", "lle") for c in "aeiou"]
    rows = []

    def text(n, shape="{}"):
        out = []
        for _ in range(max(1, n // 12)):
            out.append(" ".join(shape.format(w) for w in rng.choices(vocabulary, k=12)).capitalize() + ".")
        return "\n".join(out)

    for i in range(900):
        rows.append((rng.choice(["en", "en", "de"]), rng.choice(["a", "a", "b", f"s{i % 30}"]), text(rng.randrange(20, 300))))
    junk = [text(120, "{}$$$"), text(90, "{} |"), text(100).upper(), text(100, "#{}%%")]
    rows += [("en", "a", t) for t in junk] + [("fr", "only", t) for t in junk]
    line = text(12)
    rows += [("en", "b", text(100) + "\n" + line + "\n" + line), ("en", None, None), (None, None, ""), ("en", "a", " \x0b\n"), (None, "b", text(80)), ("en", "a", "x " * 60)]
    rows += [("es", "copies", rows[0][2])] * 300
    return rows, junk


def test_judge_equals_numpy(spark):
    rows, junk = corpus()
    table = [(i, t, lang, source, "clash", 1.0, 5) for i, (lang, source, t) in enumerate(rows)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, kept string, distance double, n_words int")
    got = {r.doc_id: r for r in ro.judge(docs, carry=["doc_id"]).collect()}
    want = plain_judge(rows)
    for i, (failed, distance, kept) in enumerate(want):
        row = got[i]
        stats = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)
        assert stats == brute.quality(rows[i][2])
        assert (row.base_failed, row.kept) == (failed, kept)
        assert row.distance == (None if distance is None else pytest.approx(distance, rel=1e-6, abs=1e-6))
    assert not any(got[900 + k].kept for k in range(4))
    assert all(got[i].kept or got[i].base_failed for i in range(900))
    assert got[908].kept  # one repeated line is no fault
    assert all(got[i].kept == got[0].kept for i in range(914, 1214))
    carried = ro.judge(docs.limit(20)).columns
    assert {"text", "lang", "source", "kept", "distance", "n_words"} <= set(carried) and len(carried) == len(set(carried))
    assert ro.judge(docs.limit(0)).count() == 0


def test_shuffled_rows_get_equal_verdicts(spark):
    rows, _ = corpus()
    docs = spark.createDataFrame([(i, t, a, b) for i, (a, b, t) in enumerate(rows)], "doc_id long, text string, lang string, source string")
    pick = ["doc_id", "distance", "kept"]
    a = ro.judge(docs.repartition(3), carry=["doc_id"], steps=2).select(*pick).collect()
    b = ro.judge(docs.repartition(7, "text"), carry=["doc_id"], steps=2).select(*pick).collect()
    assert sorted(a, key=str) == sorted(b, key=str)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data")
def test_labels_agree(spark):
    """The verdict uses no labels; they tell how well it does."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = ro.judge(docs, carry=["doc_id"]).filter("not base_failed").join(labels, "doc_id")
    n = Counter((r.quality, r.kept) for r in judged.select("quality", "kept").collect())
    assert n[1, True] >= 0.99 * (n[1, True] + n[1, False])
    assert n[0, False] >= 0.9 * (n[0, True] + n[0, False])
