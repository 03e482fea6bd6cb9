"""Near copies: texts whose sets of five-word shingles have a Jaccard of 0.8 or more.

Words are those of ``simhash``: lower-cased (A-Z), cut at ``[\\x20\\x09-\\x0D]+``; fewer
than five words make one shingle, no words an empty set, equal to any other empty one.

MinHash bands propose, exact sets decide. 32 bands of 4 minima lose a pair at Jaccard 0.8
with a chance of 5e-8, one above with less. Work is done on distinct sets. A band key with
several members is a bucket; its members are first held against its smallest one, so a
family of n copies costs n comparisons. Only members that are in different groups after
that are compared with each other.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipyard.llm.simhash import _id_key
from clipyard.operators.components import components
from clipyard.session import materialize

WORDS_PER_SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
SEED = 42
_CHUNK = 1 << 11
_RANDOM = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
_ODD, _FLIP = _RANDOM[0] | np.uint64(1), _RANDOM[1]


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct XXH64 values of the shingles of one UTF-8 text."""
    words = (text or b"").lower().split()
    n = min(WORDS_PER_SHINGLE, len(words))
    if not words:
        return np.zeros(0, np.uint64)
    flat = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    first, last = (ends - sizes)[: len(words) - n + 1], ends[n - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(flat[a:b], SEED) for a, b in zip(first.tolist(), last.tolist())], np.uint64))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of a set."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), _CHUNK):
        part = shingles[at : at + _CHUNK, None] ^ _FLIP
        part *= _ODD
        np.minimum(least, part.min(axis=0), out=least)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ (keys >> np.uint64(29)) ^ row) * _ODD[0]
    return keys


def _prints(docs: DataFrame) -> DataFrame:
    """``_id_key, row_key, node, bands``: node names the set of a row."""

    def run(batches):
        for batch in batches:
            nodes, bands = [], []
            for text in batch.column("text").cast(pa.large_binary()):
                own = shingle_set(text.as_py())
                nodes.append(xxhash.xxh64_intdigest(own.tobytes(), SEED))
                bands.append(band_keys(own))
            flat = np.concatenate(bands) if bands else np.zeros(0, np.uint64)
            offsets = np.arange(len(nodes) + 1, dtype=np.int32) * BANDS
            keys = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
            names = pa.array(np.array(nodes, np.uint64).view(np.int64))
            columns = [batch.column("_id_key"), batch.column("row_key"), names, keys]
            yield pa.RecordBatch.from_arrays(columns, ["_id_key", "row_key", "node", "bands"])

    rows = docs.select(_id_key("doc_id"), F.xxhash64("text").alias("row_key"), "text")
    return rows.mapInArrow(run, "_id_key bigint, row_key bigint, node bigint, bands array<bigint>")


@F.arrow_udf(T.ArrayType(T.LongType()))
def _sets(texts: pa.Array) -> pa.Array:
    found = [shingle_set(t.as_py()).view(np.int64) for t in texts.cast(pa.large_binary())]
    offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*found, np.zeros(0, np.int64)])))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets have a Jaccard of THRESHOLD or more."""
    met = pairs.join(sets.toDF("b", "_b"), "b").join(sets.toDF("a", "_a"), "a")
    sizes = F.size("_a") + F.size("_b")
    shared = F.size(F.array_intersect("_a", "_b"))
    # J = s / (n - s) >= t, as s (1 + t) >= t n; a set that is too small is not looked at.
    near = (F.least(F.size("_a"), F.size("_b")) >= F.lit(THRESHOLD) * F.greatest(F.size("_a"), F.size("_b")) - 1e-9) & (
        F.lit(1 + THRESHOLD) * shared >= F.lit(THRESHOLD) * sizes - 1e-9
    )
    return met.filter(near).select("a", "b")


def links(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of nearly equal sets that connect what all such pairs connect.

    ``nodes``: a stored table ``node, _id_key, row_key, bands`` with a row of ``docs`` for
    each set.
    """
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = materialize(keyed.join(shared, "key").select("key", "node", "hub"), "copy_buckets")
    wanted = buckets.select("node").distinct().join(nodes.drop("bands"), "node")
    own = docs.select(_id_key("doc_id"), F.xxhash64("text").alias("row_key"), "text")
    keys = ["_id_key", "row_key"]
    once = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    texts = own.join(wanted, keys).withColumn("_once", once).filter("_once = 1")
    sets = materialize(texts.select("node", _sets(F.col("text")).alias("s")), "copy_sets")

    stars = materialize(buckets.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "copy_stars")
    found = materialize(_verified(stars, sets), "copy_links")

    named = components(found).toDF("node", "component")
    tagged = buckets.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    hubs = tagged.filter("node = hub").select("key", F.col("component").alias("of_hub"))
    tagged = materialize(tagged.filter("node <> hub").join(hubs, "key"), "copy_members")
    away = tagged.filter("component <> of_hub").select("key", F.col("node").alias("x"), F.col("component").alias("of_x"))
    # A member that is in its hub's group meets those that are not; they meet each other once.
    other = F.col("of_x") != F.col("component")
    once = (F.col("component") == F.col("of_hub")) | (F.col("x") < F.col("node"))
    met = away.join(tagged, "key").filter(other & once)
    rest = met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
    rest = materialize(rest.join(stars, ["a", "b"], "left_anti"), "copy_rest")
    return found.union(_verified(rest, sets))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text, ...``) without near copies: of each connected
    group the one with the smallest id, then the smallest ``xxhash64`` of its text; one of
    rows that repeat both. A null id comes after all others. An empty table gives no rows."""
    prints = materialize(_prints(docs), "copy_prints")
    row = F.struct("_id_key", "row_key")
    nodes = prints.groupBy("node").agg(F.min(row).alias("k"), F.any_value("bands").alias("bands"))
    nodes = materialize(nodes.select("node", "k._id_key", "k.row_key", "bands"), "copy_nodes")
    named = components(links(docs, nodes)).toDF("node", "component")
    grouped = nodes.join(named, "node", "left").groupBy(F.coalesce("component", "node").alias("g"))
    kept = materialize(grouped.agg(F.min(row).alias("k")).select("k._id_key", F.col("k.row_key").alias("_row_key")), "kept_copies")
    keyed = docs.select("*", _id_key("doc_id"), F.xxhash64("text").alias("_row_key"))
    keys = ["_id_key", "_row_key"]
    # Joined and numbered on the same keys: the texts are shuffled once.
    once = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    left = keyed.join(kept, keys, "left_semi").withColumn("_once", once)
    return left.filter("_once = 1").select(*[left[c] for c in docs.columns])
