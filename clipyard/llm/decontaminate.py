"""Benchmark decontamination: MinHash containment search, verified by exact shingles.

DataFrame functions only. Items and documents are sets of five-word shingles over
lower-cased words of letters and digits. The question is containment: which share of
the (few) shingles of an item does a (long) document hold? The item is the sketched
side, as in containment MinHash: its sketch is its bottom-k shingles in hash order.

Items are partitioned by size. In a partition whose items have at most u shingles,
a document that holds a share t of an item misses at most floor((1 - t) u) of them, so
a sketch of one more than that has a shingle in the document: k = floor((1 - t) u) + 1
finds every pair, and a document's size does not matter. Pairs that meet on a sketch
shingle are verified on whole shingle sets.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipyard.functions.columns import bind, fresh
from clipyard.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def shingles(tokens: Column) -> Column:
    """Runs of five words joined by spaces; of fewer words, the whole sequence; none of none."""

    def build(t):
        runs = F.transform(
            F.sequence(F.lit(0), F.size(t) - SHINGLE),
            lambda i: F.concat_ws(" ", *[F.get(t, i + k) for k in range(SHINGLE)]),
        )
        few = F.when(F.size(t) > 0, F.array(F.array_join(t, " "))).otherwise(F.array())
        return F.when(F.size(t) >= SHINGLE, runs).otherwise(few.cast("array<string>"))

    return bind(tokens, build)


def shingle_hashes(tokens: Column) -> Column:
    """One 64-bit hash per shingle, chained over its words; repeats included."""

    def build(t):
        runs = F.transform(
            F.sequence(F.lit(0), F.size(t) - SHINGLE),
            lambda i: F.xxhash64(*[F.get(t, i + k) for k in range(SHINGLE)]),
        )
        few = F.when(F.size(t) > 0, F.array(F.xxhash64(F.array_join(t, " "), F.size(t)))).otherwise(F.array())
        return F.when(F.size(t) >= SHINGLE, runs).otherwise(few.cast("array<bigint>"))

    return bind(tokens, build)


def sketches(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``item_id, n_shingles, size_class, hash``: the sketch of every item, one row a hash.

    ``items`` has ``item_id, text``. Size classes double: class c holds items of
    2**c to 2**(c + 1) - 1 distinct shingles. Items without words have no row.
    """
    sets = (
        items.select("item_id", shingle_hashes(words(F.col("text"))).alias("h"))
        .groupBy("item_id")
        .agg(F.array_distinct(F.flatten(F.collect_list("h"))).alias("h"))
    )
    sized = sets.withColumn("n_shingles", F.size("h").cast("bigint")).filter("n_shingles > 0")
    classed = sized.withColumn("size_class", F.floor(F.log2("n_shingles")).cast("int"))
    upper = F.pow(F.lit(2), F.col("size_class") + 1) - 1
    k = (F.floor(F.lit(1 - threshold) * upper + 1e-9) + 1).cast("int")
    return classed.select(
        "item_id", "n_shingles", "size_class", F.explode(F.slice(F.array_sort("h"), F.lit(1), k)).alias("hash")
    )


def candidates(docs: DataFrame, sketch: DataFrame) -> DataFrame:
    """Pairs ``doc_id, row_key, item_id`` that share a sketch shingle.

    ``sketch`` is a stored table: where it is small, Spark broadcasts it by the size of its
    files and documents are not shuffled; beyond that limit both sides are shuffled.
    Hashes are grouped first, so a shingle of many items is one row on that side.
    """
    by_hash = sketch.groupBy("hash").agg(F.collect_set("item_id").alias("items"))
    by_hash = materialize(by_hash, "sketch_hashes")
    asked = docs.select(
        "doc_id", "row_key", F.explode(shingle_hashes(words(F.col("text")))).alias("hash")
    )
    met = asked.join(by_hash, "hash").select("doc_id", "row_key", F.explode("items").alias("item_id"))
    return met.distinct()


def find_contained(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pairs with ``containment >= threshold``: ``doc_id, row_key, item_id, n_shared,
    n_shingles, containment``.

    ``n_shingles`` counts the distinct shingles of the item, ``n_shared`` those the
    document has. ``row_key`` is ``xxhash64`` of the text and tells apart rows that share
    an id; equal rows give one pair. Items and documents with null or empty texts match
    nothing; an item of fewer than five words matches a document of just those words.
    Repeated item ids are judged as one item with the shingles of all its rows. Other
    columns are ignored. Empty tables give no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("row_key"), F.col(text_col).alias("text")
    )
    # One row an item; items are the small side and are read twice.
    merged = materialize(
        items.select("item_id", F.explode(shingles(words(F.col("text")))).alias("shingle"))
        .distinct(),
        "item_shingles",
    )
    sizes = merged.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"))
    sketch = materialize(sketches(items, threshold), "sketches")
    pairs = materialize(candidates(rows, sketch), "candidates")
    chosen = pairs.select("doc_id", "row_key").distinct()
    # Only candidate documents are cut into shingle texts. The list of candidates is a
    # stored table, so it is broadcast where its files are small and joined otherwise.
    texts = rows.join(materialize(chosen, "candidate_docs").toDF("_id", "_key"), (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("row_key") == F.col("_key")))
    held = texts.select("doc_id", "row_key", F.explode(F.array_distinct(shingles(words(F.col("text"))))).alias("shingle"))
    shared = (
        held.join(merged, "shingle")
        .groupBy("doc_id", "row_key", "item_id")
        .agg(F.count_distinct("shingle").alias("n_shared"))
    )
    met = pairs.toDF("_id", "_key", "_item")
    verified = shared.join(
        met,
        shared["doc_id"].eqNullSafe(met["_id"]) & (shared["row_key"] == met["_key"]) & (shared["item_id"] == met["_item"]),
        "left_semi",
    )
    return (
        verified.join(sizes, "item_id")
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
        .filter(F.col("n_shared") >= F.lit(threshold) * F.col("n_shingles") - 1e-9)
        .select("doc_id", "row_key", "item_id", "n_shared", "n_shingles", "containment")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text, ...``) that hold no item."""
    found = find_contained(docs, items, threshold).select("doc_id", "row_key").distinct()
    # Internal names that no column of ``docs`` has: extra columns pass through unchanged.
    found_id, found_key, row_key = (fresh(docs.columns, n) for n in ("_id", "_key", "_row_key"))
    found = materialize(found, "contaminated").toDF(found_id, found_key)
    keyed = docs.withColumn(row_key, F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(found[found_id]) & (keyed[row_key] == found[found_key])
    # The list is stored: where its files are small it is broadcast and no text moves.
    return keyed.join(found, same, "left_anti").select(*[keyed[c] for c in docs.columns])
