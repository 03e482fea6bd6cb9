"""The five-word near-copy operator against all pairs of five-word shingle sets.

The pipeline's stage is SimHash now (its contract); `test_pipeline.py` covers it."""

import random

from clipyard.llm import near_copies


def shingles(text):
    words = (text or "").lower().split()
    n = min(5, len(words))
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def plain_keep(rows):
    """rows: (doc_id, text), different in one of both."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] == sets[j] or 10 * shared >= 8 * (len(sets[i]) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    first = {}
    for i, (d, _) in enumerate(rows):
        key = (d is None, d or 0)
        first[root(i)] = min(first.get(root(i), key), key)
    return sorted(first.values())


def test_near_copies_go(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    rows, planted = [], []
    for i in range(60):  # copies with a share of their words changed, on both sides of 0.8
        base = rng.choices(words, k=rng.choice([60, 90, 150, 300]))
        rows.append((i, " ".join(base)))
        for k in range(3):
            copy = list(base)
            for _ in range(max(1, len(copy) * rng.choice([1, 2, 3, 5]) // 100)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((1000 + 10 * i + k, " ".join(copy).title()))
            a, b = shingles(rows[-1][1]), shingles(rows[-k - 2][1])
            if len(a & b) >= 0.8 * len(a | b):
                planted.append(rows[-1][0])
    chain = rng.choices(words, k=200)
    for i in range(40):  # a chain: only neighbours are near
        chain = chain[:]
        for at in range(5 * i % 150, 5 * i % 150 + 8):
            chain[at] = f"c{i}-{at}"
        rows.append((3000 + i, " ".join(chain)))
    family = rng.choices(words, k=300)
    for i in range(300):
        rows.append((4000 + i, " ".join([*family[:-1], f"end{i}"])))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (5003, "a b"), (5004, "A\tb"), (None, "one more text"), (None, rows[0][1])]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = near_copies.keep_one_of_each(docs).select("doc_id").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == plain_keep(rows)
    left = {r.doc_id for r in got}
    assert len(planted) > 60 and not left & set(planted)
    assert near_copies.keep_one_of_each(docs.limit(0)).count() == 0
    twice = near_copies.keep_one_of_each(docs.limit(5).union(docs.limit(5)))
    assert twice.count() == near_copies.keep_one_of_each(docs.limit(5)).count()
