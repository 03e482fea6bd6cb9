import random

import numpy as np
import pytest
import xxhash

from clipyard.llm import simhash
from clipyard.operators.components import components


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    n = 3 if len(words) >= 3 else len(words)
    hashes = [
        xxhash.xxh64(" ".join(words[i : i + n]).encode(), seed=42).intdigest()
        for i in range(len(words) - n + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    out = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            out[root(i)] = min(d, out.get(root(i), d))
    return sorted(((d, f"{prints[i]:016x}", out.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 40, 120]))) for _ in range(60)]
    rows = list(enumerate(base))
    for i in range(60):
        t = rng.choice(base).split()
        for _ in range(rng.choice([0, 1, 1, 2])):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((100 + i, rng.choice([" ", "\n\t"]).join(t).upper()))
    rows += [(500, None), (501, ""), (502, " \n"), (None, "a b"), (None, None), (7, base[7]), (7, "z z z z")]
    rows += [(503, "Ä B ä\x0bb c"), (504, "long " * 70000)]
    docs = spark.createDataFrame([(d, t, t, 1) for d, t in rows], "doc_id long, text string, fp string, component long")
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits("fp"), "component_id")
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(rows)


@pytest.mark.parametrize("parts", [1, 2, 3, 4])
def test_links_lose_nothing(spark, parts):
    rng = random.Random(parts)
    prints = set()
    for _ in range(30):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(8):
            y = x
            for b in rng.sample(range(64), rng.randrange(5)):
                y ^= 1 << b
            prints.add(y)
    low = rng.getrandbits(32)
    prints |= {low | rng.getrandbits(32) << 32 for _ in range(200)}  # one half shared by many
    signed = [simhash._signed(x) for x in prints]
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    if parts == 1:
        got = simhash.links(nodes, max_bits=1, parts=1).collect()
        want = {(a, b) for a, b in want if ((a ^ b) & (2**64 - 1)).bit_count() <= 1}
    else:
        got = simhash.links(nodes, parts=parts).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_thresholds_sum_and_minimise():
    rng = np.random.default_rng(1)
    costs = rng.random((50, 3, 5))
    out = simhash.allocate(costs, 1)
    assert (out.sum(axis=1) == 1).all() and (out >= -1).all()
    for row in range(50):
        best = min(
            costs[row, 0, a] + costs[row, 1, b] + costs[row, 2, c]
            for a in range(5) for b in range(5) for c in range(5) if a + b + c - 3 == 1
        )
        assert abs(sum(costs[row, k, out[row, k] + 1] for k in range(3)) - best) < 1e-12


def test_components_of_chain_and_empty(spark):
    chain = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(200, 300), (300, 200), (5, 5)], "a long, b long")
    got = dict(map(tuple, components(chain).collect()))
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 300: 200}
    assert components(chain.limit(0)).count() == 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
