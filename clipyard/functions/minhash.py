"""Min-hash signatures and one-permutation bucket minima.

Two sketches are kept, as in the index they serve:

* a signature of 128 minima over whitespace tokens, of which the low bits form
  128 one-bit hashes; the share of equal bits estimates ``(1 + J) / 2``
  (Li & Koenig 2010);
* 512 bucket minima over 5-word shingles with rotation into empty buckets
  (Shrivastava & Li 2014).

Hashes start from MD5 so that SQL engines can reproduce them.
"""

import re
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipyard.functions.columns import bind
from clipyard.functions.text import WHITESPACE, shingles, standard_tokens

# Sketch sizes and thresholds.
NUM_HASHES = 128
SHINGLE_SIZE = 5
NUM_BUCKETS = 512
SIMILARITY_THRESHOLD = 0.9

#: Modulus of the hash family, a Mersenne prime.
PRIME = (1 << 31) - 1
#: Text that is Python objects at a time.
SLICE_BYTES = 1 << 20
#: ``str.split`` splits at the same characters and at these.
_SPLIT, _NO_SPLIT = re.compile(WHITESPACE).split, "\x85\xa0\u2007\u202f"
#: 60-bit shingle hashes keep their bucket in the top 9 bits.
BUCKET_SHIFT = 51


def multipliers():
    """``(a_i, b_i)`` of the hash family ``h_i(v) = (a_i * v + b_i) mod PRIME``."""
    return [
        ((1103515245 * (i + 1) + 12345) % PRIME, (22695477 * (i + 1) + 1) % PRIME)
        for i in range(NUM_HASHES)
    ]


def _hex_hash(token: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(token), 1, digits), 16, 10).cast("bigint")


def _family(values: np.ndarray):
    """Every hash function over 28-bit values, one array at a time.

    Products stay below 2**60. One fold of the high bits leaves less than twice PRIME;
    a difference below zero wraps round to more than that in 32 bits without sign.
    """
    values = values.astype(np.uint64)
    work, high = np.empty_like(values), np.empty_like(values)
    for a, b in multipliers():
        np.multiply(values, np.uint64(a), out=work)
        work += np.uint64(b)
        np.right_shift(work, np.uint64(31), out=high)
        work &= np.uint64(PRIME)
        work += high
        folded = work.astype(np.uint32)
        yield np.minimum(folded, folded - np.uint32(PRIME))


def _slice_minima(texts: list[str]) -> np.ndarray:
    """Per text, the minimum of every hash function over its tokens' 28-bit hashes.

    A token is hashed once a slice; texts look its values up.
    """
    known: dict[str, int] = {}
    codes, sizes = [], np.zeros(len(texts), dtype=np.int64)
    for n, text in enumerate(texts):
        words = set(_SPLIT(text) if any(c in text for c in _NO_SPLIT) else text.split()) - {""}
        sizes[n] = len(words)
        codes.extend([known.setdefault(w, len(known)) for w in words])
    out = np.full((NUM_HASHES, len(texts)), PRIME, dtype=np.int64)
    if codes:
        digests = b"".join([md5(w.encode()).digest()[:4] for w in known])
        codes = np.array(codes, dtype=np.intp)
        looked_up = np.empty(len(codes), dtype=np.uint32)
        filled = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[filled]
        for row, hashed in zip(out, _family(np.frombuffer(digests, dtype=">u4") >> 4)):
            hashed.take(codes, out=looked_up, mode="clip")
            row[filled] = np.minimum.reduceat(looked_up, starts)
    return out.T


@F.arrow_udf(T.ArrayType(T.LongType(), False))
def _minima(text: pa.Array) -> pa.Array:
    """128 minima a row, ``SLICE_BYTES`` of text at a time as Python objects.

    Arrow in, Arrow out. A row without tokens gets PRIME everywhere.
    """
    size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), len(text)]
    found = [_slice_minima(text.slice(i, j - i).to_pylist()) for i, j in zip(edges, edges[1:])]
    offsets = np.arange(len(text) + 1, dtype=np.int32) * NUM_HASHES
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).ravel()))


def signature(text: Column) -> Column:
    """128 minima over a text's whitespace tokens as ``array<bigint>``; narrow, no shuffle."""
    return _minima(F.make_valid_utf8(F.coalesce(text, F.lit(""))))


def signature_bits(minima: Column) -> Column:
    """The 128 one-bit hashes as a string of 0 and 1."""
    return F.array_join(F.transform(minima, lambda m: (m % 2).cast("string")), "")


def _word(minima: Column, start: int) -> Column:
    return F.aggregate(
        F.slice(minima, start, 64),
        F.lit(0).cast("bigint"),
        lambda acc, m: F.shiftleft(acc, 1).bitwiseOR(m % 2),
    )


def with_signature_words(df, minima="minhash"):
    """Add the 128 bits as two longs, ``sig_hi`` and ``sig_lo``."""
    return df.withColumn("sig_hi", _word(F.col(minima), 1)).withColumn(
        "sig_lo", _word(F.col(minima), 65)
    )


def differing_bits(hi_a, lo_a, hi_b, lo_b) -> Column:
    return F.bit_count(hi_a.bitwiseXOR(hi_b)) + F.bit_count(lo_a.bitwiseXOR(lo_b))


def max_differing_bits(threshold: float = SIMILARITY_THRESHOLD) -> int:
    """Largest number of unequal bits with ``similarity > threshold`` (strict)."""
    return max(d for d in range(NUM_HASHES + 1) if 1 - d / NUM_HASHES > threshold)


def similarity(differing: Column) -> Column:
    """Share of equal bits."""
    return 1 - differing / F.lit(float(NUM_HASHES))


def bucket_minima(text: Column) -> Column:
    """Sparse 512-bucket minima: the smallest shingle hash of each used bucket.

    Sorted by bucket. The hash carries its bucket in the top bits, so one sort
    orders by bucket and, inside it, puts the minimum first.
    """
    hashes = F.transform(
        shingles(standard_tokens(F.coalesce(text, F.lit("")), lowercase=False), SHINGLE_SIZE),
        lambda s: _hex_hash(s, 15),
    )
    return bind(
        F.sort_array(hashes),  # array_sort calls an interpreted comparator
        lambda h: F.filter(
            h,
            lambda x, i: (i == 0) | (bucket_of(x) != bucket_of(F.get(h, i - 1))),
        ),
    )


def bucket_of(value: Column) -> Column:
    return F.shiftright(value, BUCKET_SHIFT).cast("int")


def rotate(minima: Column) -> Column:
    """Dense form: 512 values, an empty bucket takes the next used one, circularly.

    Each used bucket repeats over the gap in front of it and the first one also
    fills the tail, so the array is built by run lengths.
    """

    def fill(m):
        runs = F.transform(
            m,
            lambda x, i: F.array_repeat(
                x, bucket_of(x) - F.coalesce(bucket_of(F.get(m, i - 1)), F.lit(-1))
            ),
        )
        tail = F.array_repeat(
            F.get(m, F.lit(0)), NUM_BUCKETS - 1 - bucket_of(F.get(m, F.size(m) - 1))
        )
        return F.when(F.size(m) > 0, F.concat(F.flatten(runs), tail)).otherwise(
            F.array().cast("array<bigint>")
        )

    return bind(minima, fill)


def equal_buckets(a: Column, b: Column) -> Column:
    """Number of buckets in which two dense sketches agree."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)),
        F.lit(0),
        lambda acc, hit: acc + hit,
    )
