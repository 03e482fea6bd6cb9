"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions only.

A document's size is its number of words. Sources, ordered by code point with null
last, weigh 5, 2, 1, 5, 2, 1, ...; together their targets are all words of the
corpus, and a target stops at ``CAP`` times its source's words, the excess shared
again by weight until none is above (water filling, solved in one ordered pass over
the per-source table: sources capped form a prefix by cap over weight).

A source's ratio ``r = target / words`` is met by taking every document ``floor(r)``
times and once more where its 60-bit hash lies below a cut. The cut is found
without sorting documents: words are summed by (source, hash bucket) of 1024
buckets, the bucket where the running sum passes the remaining budget is the only
one refined at the next 10 bits, and so on until the boundary bucket holds one
document or one hash value. The cut is then the nearer edge of that bucket, so a
source takes the whole-document prefix of its hash order nearest to its budget.
Each round is one aggregate (partial on the map side, so a source with a third of
all rows is no hot task) joined to a per-source table; documents are filtered
against the cuts at the end.

Edge cases, each with a defined result: a null or empty text has size 0 and takes
nothing; null sources form one source, last; a null ``doc_id`` hashes as the empty
string; repeated rows share their hash and are taken or left together, each row
returned; a source of no words gets target 0; an empty table gives an empty result;
extra columns are not carried, so names cannot clash. Reruns agree: the hash is of
the ``doc_id`` alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipyard.session import materialize

# Fixed values of the contract.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3

HASH_BITS = 60
STEP_BITS = 10


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)).cast("bigint")


def unit_hash(doc_id: Column) -> Column:
    """First 60 bits of the sha256 of the decimal ``doc_id`` (null: empty string)."""
    digest = F.sha2(F.coalesce(doc_id.cast("string"), F.lit("")), 256)
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(sized: DataFrame) -> DataFrame:
    """Per source: ``_m_src`` (rank), ``source``, ``source_size``, ``target``, ``full``, ``need``.

    ``full`` whole copies of every document, and ``need`` more words from the hash order.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.select(
        "source",
        "source_size",
        F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("_m_src"),
    ).withColumn("w", F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.col("_m_src") - 1) % len(WEIGHTS) + 1).cast("int")))
    every = Window.partitionBy(F.lit(1))
    by_cap = Window.orderBy(F.col("source_size") * CAP / F.col("w"), "_m_src")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    t, wsum = F.sum("source_size").over(every), F.sum("w").over(every)
    left = ranked.select(
        "*",
        (t - F.coalesce(F.sum(F.col("source_size") * CAP).over(before), F.lit(0))).alias("rest"),
        (wsum - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("wrest"),
    )
    # Not capped: the cap is no less than the share of what is left (exact in integers).
    fits = F.col("source_size") * CAP * F.col("wrest") >= F.col("w") * F.col("rest")
    ordered = left.withColumn("_m_order", F.row_number().over(by_cap))
    ordered = ordered.withColumn("_first", F.min(F.when(fits, F.col("_m_order"))).over(every))
    level = F.max(F.when(F.col("_m_order") == F.col("_first"), F.col("rest") / F.col("wrest"))).over(every)
    capped = F.col("_first").isNull() | (F.col("_m_order") < F.col("_first"))
    target = F.when(capped, (F.col("source_size") * CAP).cast("double")).otherwise(level * F.col("w"))
    out = ordered.select("_m_src", "source", "source_size", target.alias("target"))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return out.select("*", full.cast("bigint").alias("full")).withColumn(
        "need", F.col("target") - F.col("full") * F.col("source_size")
    )


def _refine(units: DataFrame, state: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """One histogram round over the boundary buckets of ``state`` at ``depth`` bits.

    Returns (cuts resolved in this round, state of the next round).
    """
    finer = depth + STEP_BITS
    joined = units.join(state, "_m_src").where(F.shiftright("_m_h", HASH_BITS - depth) == F.col("prefix"))
    hist = joined.groupBy("_m_src", F.shiftright("_m_h", HASH_BITS - finer).alias("q")).agg(
        F.sum("size").alias("sw"), F.count(F.lit(1)).alias("cn"), F.first("below").alias("below"), F.first("need").alias("need")
    )
    running = Window.partitionBy("_m_src").orderBy("q")
    hist = hist.withColumn("after", F.col("below") + F.sum("sw").over(running))
    hist = hist.withColumn("before", F.col("after") - F.col("sw"))
    past = hist.where(F.col("after") > F.col("need"))
    first = past.withColumn("_k", F.row_number().over(running)).where("_k = 1").drop("_k")
    single = (F.col("cn") <= 1) | F.lit(finer >= HASH_BITS)
    nearer_after = (F.col("after") - F.col("need")) < (F.col("need") - F.col("before"))
    edge = F.when(nearer_after, F.col("q") + 1).otherwise(F.col("q"))
    resolved = first.where(single).select("_m_src", F.shiftleft(edge, HASH_BITS - finer).alias("cut"))
    going = first.where(~single).select("_m_src", F.col("q").alias("prefix"), F.col("before").alias("below"), "need")
    # Sources whose boundary lies past every document of the bucket take all of it.
    reach = state.join(first.select("_m_src"), "_m_src", "left_anti").select(
        "_m_src", F.shiftleft(F.col("prefix") + 1, HASH_BITS - depth).alias("cut")
    )
    return resolved.unionByName(reach), going


def mix(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken`` (see the module text)."""
    sized = materialize(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            word_count(F.col("text")).alias("size"),
            unit_hash(F.col("doc_id")).alias("_m_h"),
        ),
        "mix-sized",
    )
    targets = materialize(source_targets(sized), "mix-targets")
    ranks = targets.select("_m_src", F.col("source").alias("_m_source"))
    units = sized.join(ranks, sized["source"].eqNullSafe(ranks["_m_source"])).select("doc_id", "size", "_m_h", "_m_src")
    state = targets.where(F.col("need") > 0).select(
        "_m_src", F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("below"), "need"
    )
    cuts = []
    depth = 0
    while depth < HASH_BITS:
        state = materialize(state, "mix-state")
        if state.isEmpty():
            break
        resolved, state = _refine(units, state, depth)
        cuts.append(materialize(resolved, "mix-cuts"))
        depth += STEP_BITS
    spark = docs.sparkSession
    found = spark.createDataFrame([], "_m_src int, cut bigint")
    for part in cuts:
        found = found.unionByName(part)
    # Written, so the join sees its real size (one row a source) and broadcasts it
    # only under the session's limit; a hot source then is no hot task.
    placed = materialize(
        targets.join(found, "_m_src", "left").select("_m_src", "source_size", "target", "full", "cut"), "mix-placed"
    )
    extra = F.when(F.col("cut").isNotNull() & (F.col("_m_h") < F.col("cut")), 1).otherwise(0)
    return units.join(placed, "_m_src").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("full") + extra)).cast("bigint").alias("taken"),
    )
