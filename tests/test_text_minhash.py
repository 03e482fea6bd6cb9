"""Tokenizers and sketches against plain Python."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipyard.functions import minhash as mh
from clipyard.functions.text import shingles, standard_tokens, whitespace_tokens

WORDS = [f"w{i}" for i in range(60)]


def python_minima(text):
    values = {int(hashlib.md5(t.encode()).hexdigest()[:7], 16) for t in text.split()}
    return [min(((a * v + b) % mh.PRIME for v in values), default=mh.PRIME) for a, b in mh.multipliers()]


def python_buckets(text):
    tokens = text.split()
    grams = [" ".join(tokens[i : i + 5]) for i in range(len(tokens) - 4)]
    used = {}
    for g in grams:
        h = int(hashlib.md5(g.encode()).hexdigest()[:15], 16)
        used[h >> 51] = min(h, used.get(h >> 51, h))
    if not used:
        return []
    dense = []
    for b in range(512):
        while b % 512 not in used:
            b += 1
        dense.append(used[b % 512])
    return dense


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    return ["", " \n", "one", "a b c d", "a b c d e"] + [
        " ".join(rng.choices(WORDS, k=rng.randint(1, 900))) for _ in range(40)
    ]


def column(spark, texts, expr):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return [r[0] for r in df.orderBy("id").select(expr(F.col("text"))).collect()]


def test_signature(spark, texts):
    assert column(spark, texts, mh.signature) == [python_minima(t) for t in texts]


def test_signature_ignores_order_and_repeats(spark):
    a, b = column(spark, ["x y z y", "z\ty x"], mh.signature)
    assert a == b


def test_signature_of_rare_white_space_and_bad_bytes(spark):
    """No-break spaces and next-line keep a token whole, bad bytes become U+FFFD."""
    rare, plain = "a\x85b\xa0c\u2007d\u202fe \u3000f\x1fg", ["a\x85b\xa0c\u2007d\u202fe", "f", "g"]
    bad = b"ab\xff c\xe2\x82 d"
    df = spark.createDataFrame([(0, rare.encode()), (1, bad)], "id int, b binary")
    got = [r[0] for r in df.orderBy("id").select(mh.signature(F.col("b").cast("string"))).collect()]
    values = {int(hashlib.md5(t.encode()).hexdigest()[:7], 16) for t in plain}
    assert got[0] == [min((a * v + b) % mh.PRIME for v in values) for a, b in mh.multipliers()]
    assert got[1] == python_minima(bad.decode("utf-8", "replace"))


def test_a_token_is_hashed_once_for_many_texts(monkeypatch):
    hashed = []
    monkeypatch.setattr(mh, "md5", lambda b: hashed.append(b) or hashlib.md5(b))
    found = mh._slice_minima(["a b a", "", "b c"] * 500)
    assert sorted(hashed) == [b"a", b"b", b"c"]
    assert found.tolist() == [python_minima(t) for t in ["a b a", "", "b c"]] * 500


def test_hash_family_at_the_ends_of_its_range():
    values = [0, 1, 2**28 - 1, 2**27]
    for (a, b), got in zip(mh.multipliers(), mh._family(np.array(values))):
        assert got.tolist() == [(a * v + b) % mh.PRIME for v in values]


def test_null_text_counts_as_empty(spark):
    empty, null = column(spark, ["", None], mh.signature)
    assert empty == null == [mh.PRIME] * 128


def test_words_match_bits(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = mh.with_signature_words(df.select(mh.signature(F.col("text")).alias("minhash"))).withColumn(
        "bits", mh.signature_bits(F.col("minhash"))
    )
    for r in rows.collect():
        word = lambda v: format(v & (2**64 - 1), "064b")
        assert word(r["sig_hi"]) + word(r["sig_lo"]) == r["bits"]


def test_rotation(spark, texts):
    assert column(spark, texts, lambda c: mh.rotate(mh.bucket_minima(c))) == [python_buckets(t) for t in texts]


def test_threshold_is_strict():
    assert mh.max_differing_bits(0.9) == 12
    assert mh.max_differing_bits(0.75) == 31


@pytest.mark.parametrize(
    "text, tokens",
    [
        ("https://www.example.org/news/", ["https", "www.example.org", "news"]),
        ("Don't stop, 3.14 or 1,000; v2.0b a.b.c", ["don't", "stop", "3.14", "or", "1,000", "v2.0b", "a.b.c"]),
        ("src3.example _x_ a.1 1.a", ["src3", "example", "_x_", "a", "1", "1", "a"]),
        ("Éa’b ... ''", ["éa’b"]),
        ("Мариуполя Азовстали", ["мариуполя", "азовстали"]),
        ("", []),
    ],
)
def test_standard_tokens(spark, text, tokens):
    assert column(spark, [text], standard_tokens) == [tokens]


def test_long_dotted_run_is_one_token(spark):
    text = ".".join(["ab"] * 50_000)
    assert column(spark, [text], lambda c: F.size(standard_tokens(c))) == [1]


def test_whitespace_tokens(spark):
    text = "a,b c d\x0be\x1cf  "
    assert column(spark, [text], whitespace_tokens) == [["a,b", "c d", "e", "f"]]


def test_shingles(spark):
    got = column(spark, ["A b c d e F", "a b c d"], lambda c: shingles(standard_tokens(c, lowercase=False)))
    assert got == [["A b c d e", "b c d e F"], []]
