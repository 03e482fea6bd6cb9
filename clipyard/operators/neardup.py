"""Near-duplicate search over min-hash signatures.

Two articles are near-duplicates when more than 90 % of their 128 one-bit
hashes agree. Listing every pair of documents is quadratic as soon as one text
has many copies, so the result is kept in a lossless compact form:

* documents with the same signature form a *group* (its ``rep`` is the smallest
  document key, ``copies`` its size);
* similar groups are listed as pairs, once, with ``rep_a < rep_b``.

Two documents are near-duplicates exactly if they share a group or their groups
are a listed pair. ``near_duplicate_counts`` turns that into one row per
document, ``similar_to_chosen`` into the neighbours of chosen documents, and
``group_members`` lists who is in a group.

Candidates come from an equi-join on band keys:

* ``exact``: 128 bits are cut into ``12 + k`` bands. At most 12 bits may differ,
  so any similar pair agrees on at least ``k`` whole bands and every choice of
  ``k`` bands is a key. ``k`` grows with the number of rows to keep buckets small.
* ``lsh``: 32 bands of 4 full minima (misses about 5e-8 of pairs at J = 0.8);
  32 keys per group whatever the table size, the mode for very large tables.

Buckets are counted first (a partial aggregate): keys with one member are
dropped before the join, and a bucket above BLOCK_ROWS is cut into blocks whose
pairings go to different tasks, so no task sees more than BLOCK_ROWS rows of a
key per side. Only verified pairs leave the join.
"""

from itertools import combinations
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipyard.functions.columns import with_once
from clipyard.functions.minhash import (
    NUM_HASHES,
    SIMILARITY_THRESHOLD,
    differing_bits,
    max_differing_bits,
    similarity,
)
from clipyard.operators.components import components
from clipyard.operators.skew import lookup

LSH_BANDS = 32
LSH_ROWS = NUM_HASHES // LSH_BANDS
BLOCK_ROWS = 8192
#: Exact mode accepts buckets of about this many rows before it lengthens the key.
BUCKET_TARGET_BITS = 8
MAX_BANDS_PER_KEY = 4


def signature_groups(docs: DataFrame, key: str, mode: str = "lsh") -> DataFrame:
    """One row per distinct signature: ``sig_hi, sig_lo, rep, copies``.

    For ``lsh`` also ``bands``, the distinct ``band, key`` of all members: equal bits do
    not mean equal minima, and each member may have bands of its own.
    """
    totals = [F.min(key).alias("rep"), F.count(F.lit(1)).alias("copies")]
    if mode == "lsh":
        # Copies have equal minima and are one element of the set, combined before the shuffle.
        keyed = F.transform(
            lsh_keys(F.col("minhash")), lambda k, band: F.struct(band.alias("band"), k.alias("key"))
        )
        totals.append(F.array_distinct(F.flatten(F.collect_set(keyed))).alias("bands"))
    return docs.groupBy("sig_hi", "sig_lo").agg(*totals)


def bands_per_key(rows: int, max_differing: int) -> int:
    """How many bands an exact key must combine for buckets to stay small."""
    wanted = log2(max(rows, 2)) - BUCKET_TARGET_BITS
    for k in range(1, MAX_BANDS_PER_KEY):
        if NUM_HASHES * k / (max_differing + k) >= wanted:
            return k
    return MAX_BANDS_PER_KEY


def _bits(hi: Column, lo: Column, start: int, width: int) -> Column:
    """Bits ``start .. start+width`` of the signature, bit 0 being the first hash."""
    end = start + width
    if start < 64 < end:
        left, right = 64 - start, end - 64
        return F.shiftleft(_bits(hi, lo, start, left), right).bitwiseOR(
            _bits(hi, lo, 64, right)
        )
    word, end = (hi, end) if end <= 64 else (lo, end - 64)
    mask = F.lit((1 << width) - 1).cast("bigint")
    return F.shiftrightunsigned(word, 64 - end).bitwiseAND(mask)


def _band_layout(bands: int):
    edges = [NUM_HASHES * i // bands for i in range(bands + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def exact_keys(hi: Column, lo: Column, bands: int, per_key: int) -> Column:
    """Array of keys, one per choice of ``per_key`` out of ``bands`` bands."""
    layout = _band_layout(bands)
    values = F.array(*[_bits(hi, lo, a, w) for a, w in layout])
    if per_key == 1:
        return values
    width = max(w for _, w in layout)
    choices = F.expr(
        "array(%s)"
        % ", ".join(f"array({', '.join(map(str, c))})" for c in combinations(range(bands), per_key))
    )
    return F.transform(
        F.array(values),
        lambda v: F.transform(
            choices,
            lambda c: F.aggregate(
                c,
                F.lit(0).cast("bigint"),
                lambda acc, i: F.shiftleft(acc, width).bitwiseOR(F.get(v, i)),
            ),
        ),
    )[0]


def lsh_keys(minima: Column) -> Column:
    """Array of 32 band keys, each a hash of four full minima."""
    return F.array(
        *[
            F.xxhash64(*[F.get(minima, F.lit(b * LSH_ROWS + r)) for r in range(LSH_ROWS)])
            for b in range(LSH_BANDS)
        ]
    )


def _first_shared_key(bands: int, per_key: int) -> Column:
    """Is ``band`` the first key on which the pair agrees? (exact mode)

    Keys are numbered in lexicographic order of their bands, so the first shared
    one consists of the first ``per_key`` agreeing bands. Lets each pair out once
    without a distinct.
    """
    hi, lo = F.col("hi_a").bitwiseXOR(F.col("hi_b")), F.col("lo_a").bitwiseXOR(F.col("lo_b"))
    agree = [
        F.when(_bits(hi, lo, a, w) == 0, F.lit(i))
        for i, (a, w) in enumerate(_band_layout(bands))
    ]
    if per_key == 1:
        return F.col("band") == F.coalesce(*agree)
    choices = F.expr(
        "array(%s)"
        % ", ".join(f"array({', '.join(map(str, c))})" for c in combinations(range(bands), per_key))
    )
    return F.get(choices, F.col("band")) == F.slice(F.array_compact(F.array(*agree)), 1, per_key)


def bucket_pairs(keyed: DataFrame, max_differing: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Verified pairs among rows sharing ``(band, key)``; may repeat over bands.

    ``keyed`` has ``band, key, rep, copies, sig_hi, sig_lo``.

    Both joins are asked to be shuffled: Spark takes exploded rows for as small as the
    groups they come from, and would gather all keys of a large table in the driver.
    """
    bucket = ["band", "key"]
    sizes = keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = lookup(keyed.hint("merge"), sizes, bucket, how="inner")
    shared = shared.withColumn(
        "blocks", F.ceil(F.col("members") / block_rows).cast("int")
    ).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))

    def side(suffix, block_from, block_to, own):
        other = F.explode(F.sequence(block_from, block_to))
        rows = shared.select(
            *bucket,
            "block",
            other.alias("other"),
            F.col("rep").alias(f"rep_{suffix}"),
            F.col("copies").alias(f"copies_{suffix}"),
            F.col("sig_hi").alias(f"hi_{suffix}"),
            F.col("sig_lo").alias(f"lo_{suffix}"),
        )
        return rows.withColumnsRenamed(
            {"block": own, "other": "block_1" if own == "block_2" else "block_2"}
        )

    left = side("a", F.col("block"), F.col("blocks") - 1, "block_1")
    right = side("b", F.lit(0), F.col("block"), "block_2")
    differing = differing_bits(*[F.col(c) for c in ("hi_a", "lo_a", "hi_b", "lo_b")])
    on = [left[c] == right[c] for c in [*bucket, "block_1", "block_2"]]
    verified = (differing <= max_differing) & (
        (left["block_1"] < left["block_2"]) | (F.col("rep_a") < F.col("rep_b"))
    )
    pairs = left.join(right.hint("merge"), [*on, verified]).select(
        left["band"], *[c for c in left.columns if c.endswith("_a")],
        *[c for c in right.columns if c.endswith("_b")], differing.alias("differing_bits"),
    )
    forward = F.col("rep_a") < F.col("rep_b")
    swap = {
        f"{name}_{s}": F.when(forward, F.col(f"{name}_{s}")).otherwise(F.col(f"{name}_{o}"))
        for name in ("rep", "copies", "hi", "lo")
        for s, o in ("ab", "ba")
    }
    return pairs.select("band", "differing_bits", *[c.alias(n) for n, c in swap.items()])


def similar_groups(
    groups: DataFrame,
    mode: str = "lsh",
    threshold: float = SIMILARITY_THRESHOLD,
    rows: int | None = None,
    per_key: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of similar groups: ``rep_a, rep_b, copies_a, copies_b, differing_bits, similarity``.

    ``groups`` is read several times: hand in a stored table. ``rows`` (an upper
    bound of its size) sets the key length of exact mode, unless ``per_key`` does.
    """
    limit = max_differing_bits(threshold)
    head = ["rep", "copies", "sig_hi", "sig_lo"]
    if mode == "lsh":
        keyed, canonical = groups.select(*head, F.inline("bands")), None
    elif mode == "exact":
        per_key = per_key or bands_per_key(rows or groups.count(), limit)
        bands = limit + per_key
        keys = exact_keys(F.col("sig_hi"), F.col("sig_lo"), bands, per_key)
        keyed = groups.select(*head, F.posexplode(keys).alias("band", "key"))
        canonical = _first_shared_key(bands, per_key)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    pairs = bucket_pairs(keyed, limit, block_rows)
    columns = ["rep_a", "rep_b", "copies_a", "copies_b", "differing_bits"]
    if canonical is not None:
        # Kept out of the join condition, which runs for every candidate.
        pairs = with_once(pairs, first=canonical).filter("first").select(*columns)
    else:
        pairs = pairs.select(*columns).dropDuplicates(["rep_a", "rep_b"])
    return pairs.withColumn("similarity", similarity(F.col("differing_bits")))


def near_duplicate_counts(docs: DataFrame, key: str, groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per document: its group, the group size and how many others are similar.

    Grows with the documents and the group pairs, never with document pairs. The
    join back to the documents is skewed when a text has many copies, see ``lookup``.
    """
    ends = F.array(
        F.struct(F.col("rep_a").alias("rep"), F.col("copies_b").alias("n")),
        F.struct(F.col("rep_b").alias("rep"), F.col("copies_a").alias("n")),
    )
    nearby = (
        pairs.select(F.explode(ends).alias("e"))
        .groupBy(F.col("e.rep").alias("rep"))
        .agg(F.sum("e.n").alias("nearby"))
    )
    summary = groups.join(nearby, "rep", "left").select(
        "sig_hi",
        "sig_lo",
        F.col("rep").alias("group_rep"),
        "copies",
        (F.col("copies") - 1 + F.coalesce("nearby", F.lit(0))).alias("similar_docs"),
    )
    counted = lookup(docs, summary, ["sig_hi", "sig_lo"])
    return counted


def similar_to_chosen(
    docs: DataFrame, key: str, groups: DataFrame, pairs: DataFrame, chosen: DataFrame
) -> DataFrame:
    """The groups similar to chosen documents: ``rep, chosen, similar_rep, similar_copies``.

    ``chosen`` lists document keys in a column ``key``. They are counted per group
    first, so many chosen copies of one text cost one row; the group itself is
    listed as its own neighbour. Members come from ``group_members``.
    """
    signature = ["sig_hi", "sig_lo"]
    counted = (
        docs.join(chosen.select(key).distinct(), key, "left_semi")
        .groupBy(*signature)
        .agg(F.count(F.lit(1)).alias("chosen"))
    )
    asked = counted.join(groups, signature).select("rep", "chosen", "copies")
    own = asked.select(
        "rep", "chosen", F.col("rep").alias("similar_rep"), F.col("copies").alias("similar_copies")
    )
    ends = F.array(
        *[
            F.struct(
                F.col(f"rep_{a}").alias("rep"),
                F.col(f"rep_{b}").alias("similar_rep"),
                F.col(f"copies_{b}").alias("similar_copies"),
            )
            for a, b in ("ab", "ba")
        ]
    )
    near = pairs.select(F.inline(ends))
    others = asked.join(near, "rep").select("rep", "chosen", "similar_rep", "similar_copies")
    return own.unionByName(others)


def clusters(docs: DataFrame, key: str, groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per document the smallest document it is linked to over any chain: ``key, cluster``.

    One row per document however many pairs a family of near-copies has.
    """
    linked = components(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    labelled = groups.join(linked, F.col("rep") == F.col("node"), "left").select(
        "sig_hi", "sig_lo", F.coalesce("component", "rep").alias("cluster")
    )
    return lookup(docs.select(key, "sig_hi", "sig_lo"), labelled, ["sig_hi", "sig_lo"]).select(key, "cluster")


def group_members(docs: DataFrame, key: str, groups: DataFrame) -> DataFrame:
    """Documents of the given groups: ``key, rep``."""
    found = lookup(
        docs.select(key, "sig_hi", "sig_lo"),
        groups.select("sig_hi", "sig_lo", "rep", "copies"),
        ["sig_hi", "sig_lo"],
        how="inner",
    )
    return found.select(key, "rep")
