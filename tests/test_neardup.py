"""Near-duplicate joins against brute force."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from clipyard.functions.minhash import signature, with_signature_words
from clipyard.operators import neardup


def signed_long(v):
    return v - 2**64 if v >= 2**63 else v


def random_signatures(seed, n=250):
    """Random signatures, with copies and neighbours 1..16 bits away."""
    rng = random.Random(seed)
    values = [rng.getrandbits(128) for _ in range(n // 4)]
    while len(values) < n:
        v = rng.choice(values)
        for bit in rng.sample(range(128), rng.choice([0, 1, 6, 11, 12, 13, 16])):
            v ^= 1 << bit
        values.append(v)
    return values


def near(a, b):
    return (a ^ b).bit_count() <= 12


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    values = random_signatures(request.param)
    rows = [(i, signed_long(v >> 64), signed_long(v & (2**64 - 1))) for i, v in enumerate(values)]
    docs = spark.createDataFrame(rows, "doc_id long, sig_hi long, sig_lo long").cache()
    return values, docs, neardup.signature_groups(docs, "doc_id", "exact").cache()


def expected_pairs(values):
    reps = {}
    for i, v in enumerate(values):
        reps.setdefault(v, i)
    pairs = combinations(sorted((i, v) for v, i in reps.items()), 2)
    return {(i, j): (v ^ w).bit_count() for (i, v), (j, w) in pairs if near(v, w)}


@pytest.mark.parametrize("per_key", [1, 2, 3])
@pytest.mark.parametrize("block_rows", [8192, 2])
def test_exact_equals_brute_force(case, per_key, block_rows):
    values, _, groups = case
    pairs = neardup.similar_groups(groups, "exact", per_key=per_key, block_rows=block_rows).collect()
    got = [((r["rep_a"], r["rep_b"]), r["differing_bits"]) for r in pairs]
    assert len(got) == len(set(got))
    assert dict(got) == expected_pairs(values)


def test_counts_and_listing(case, spark):
    values, docs, groups = case
    pairs = neardup.similar_groups(groups, "exact", rows=len(values)).cache()
    counts = neardup.near_duplicate_counts(docs, "doc_id", groups, pairs).collect()
    want = {i: sum(near(v, w) for w in values) - 1 for i, v in enumerate(values)}
    assert {r["doc_id"]: r["similar_docs"] for r in counts} == want
    assert {r["doc_id"]: r["copies"] for r in counts} == {i: values.count(v) for i, v in enumerate(values)}

    chosen = [3, 100, 101, 249]
    wanted = spark.createDataFrame([(i,) for i in chosen], "doc_id long")
    rows = neardup.similar_to_chosen(docs, "doc_id", groups, pairs, wanted).collect()
    members = {}
    for r in neardup.group_members(docs, "doc_id", groups).collect():
        members.setdefault(r["rep"], set()).add(r["doc_id"])
    assert sorted(i for m in members.values() for i in m) == list(range(len(values)))
    for i in chosen:
        listed = [r for r in rows if i in members[r["rep"]]]
        assert all(r["chosen"] == len(members[r["rep"]] & set(chosen)) for r in listed)
        assert all(r["similar_copies"] == len(members[r["similar_rep"]]) for r in listed)
        found = [j for r in listed for j in members[r["similar_rep"]]]
        assert sorted(found) == [j for j, w in enumerate(values) if near(values[i], w)]


def test_one_text_with_a_third_of_all_rows(spark):
    values = random_signatures(5, 60)
    values += [values[0]] * 30 + [values[0] ^ 1] * 10
    rows = [(i, signed_long(v >> 64), signed_long(v & (2**64 - 1))) for i, v in enumerate(values)]
    docs = spark.createDataFrame(rows, "doc_id long, sig_hi long, sig_lo long")
    groups = neardup.signature_groups(docs, "doc_id", "exact").cache()
    pairs = neardup.similar_groups(groups, "exact", rows=100, block_rows=2)
    counts = neardup.near_duplicate_counts(docs, "doc_id", groups, pairs).collect()
    want = {i: sum(near(v, w) for w in values) - 1 for i, v in enumerate(values)}
    assert {r["doc_id"]: r["similar_docs"] for r in counts} == want


def test_lsh_finds_a_subset_and_the_close_texts(spark):
    rng = random.Random(3)
    base = [f"t{i}" for i in range(400)]
    texts = []
    for n in range(40):
        words = rng.sample(base, 150)
        texts.append(" ".join(words))
        texts.append(" ".join(words[: 150 - n % 5]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = with_signature_words(df.select("doc_id", signature(F.col("text")).alias("minhash"))).cache()

    def pairs(mode):
        groups = neardup.signature_groups(docs, "doc_id", mode).cache()
        found = neardup.similar_groups(groups, mode, block_rows=7).cache()
        rows = neardup.similar_to_chosen(docs, "doc_id", groups, found, docs.select("doc_id")).collect()
        rep = {r["doc_id"]: r["rep"] for r in neardup.group_members(docs, "doc_id", groups).collect()}
        linked = {(r["rep"], r["similar_rep"]) for r in rows}
        return {(i, j) for i in rep for j in rep if i != j and (rep[i], rep[j]) in linked}

    exact, lsh = pairs("exact"), pairs("lsh")
    assert lsh <= exact
    assert {(2 * n, 2 * n + 1) for n in range(40)} <= lsh


def test_plan_is_an_equi_join(case, capsys):
    _, _, groups = case
    neardup.similar_groups(groups, "exact", per_key=1).explain()
    plan = capsys.readouterr().out
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("per_key", [1, 2])
def test_exploded_keys_are_never_broadcast(case, spark, capsys, tmp_path, per_key):
    """Spark takes exploded keys for as small as the stored groups, whose size allows a broadcast."""
    case[2].write.parquet(str(tmp_path / "groups"))
    groups = spark.read.parquet(str(tmp_path / "groups"))
    neardup.similar_groups(groups, "exact", per_key=per_key).explain()
    plan = capsys.readouterr().out
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") >= 2


def test_key_length_grows_with_the_table():
    lengths = [neardup.bands_per_key(10**n, 12) for n in range(1, 13)]
    assert lengths[:5] == [1] * 5 and lengths == sorted(lengths) and lengths[-1] == 4


def test_unknown_mode(case):
    with pytest.raises(ValueError):
        neardup.similar_groups(case[2], mode="fuzzy")


def test_equal_bits_keep_the_bands_of_every_member(spark):
    """b and c have equal bits; only c shares bands with a."""
    a = list(range(128))
    c = a[:124] + [v + 1000 for v in a[124:]]
    b = [v + 2000 for v in c]
    rows = [("a", a), ("b", b), ("c", c)]
    docs = with_signature_words(spark.createDataFrame(rows, "doc_id string, minhash array<long>"))
    pairs = [(r.rep_a, r.rep_b) for r in neardup.similar_groups(neardup.signature_groups(docs, "doc_id")).collect()]
    exact = neardup.similar_groups(neardup.signature_groups(docs, "doc_id", "exact"), "exact").collect()
    assert pairs == [(r.rep_a, r.rep_b) for r in exact]
