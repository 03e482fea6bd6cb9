"""Near-duplicates by SimHash and a generalised pigeonhole search.

Fingerprint: a text is lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and
shingles of three words, repeats included; a bit is set if it is set in over half of
the XXH64 values (seed 42) of the shingles.

Search (generalised pigeonhole, Qin et al. 2018): the 64 bits are dealt into parts,
correlated bits together. Every fingerprint gets thresholds ``t_1 .. t_m`` of its own
with ``sum(t) = d - m + 1`` (-1 skips a part): whatever differs from it in at most
``d`` bits differs in at most ``t_i`` bits of some part i. A dynamic program picks the
thresholds with the fewest estimated candidates, so a value that a large family of
texts shares is left out and another part is probed more widely. Probes meet the
fingerprints in an equi-join on (part, value), and the full distance is checked in
the join condition, so candidates are never written.

Work is done on distinct fingerprints. Copies, however many, cost one row there.
"""

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipyard.functions.columns import fresh
from clipyard.operators.components import components
from clipyard.session import materialize

WORDS_PER_SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: With two parts a probe meets n / 2**32 rows by chance, which holds for billions of
#: fingerprints; a fingerprint sends about 66 probes.
PARTS = 2
#: Coarse histogram of each part: bits that number its cells.
CELL_BITS = 12
_CHUNK = 1 << 16


def fingerprint_of(text: bytes | None) -> int:
    """64-bit fingerprint of one UTF-8 text (unsigned); 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < WORDS_PER_SHINGLE:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        flat = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        first, last = (ends - sizes)[: 1 - WORDS_PER_SHINGLE], ends[WORDS_PER_SHINGLE - 1 :]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(flat[a:b], SEED) for a, b in zip(first.tolist(), last.tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[at : at + _CHUNK], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


@F.arrow_udf(T.LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """SimHash of a text column as the signed long with the same bits; null as empty."""
    # Bytes, one text at a time: nothing but 8 bytes a row is kept.
    raw = texts.cast(pa.large_binary())
    prints = np.fromiter((fingerprint_of(t.as_py()) for t in raw), np.uint64, len(raw))
    return pa.array(prints.view(np.int64))


def hex_digits(bits: Column) -> Column:
    """16 lower-case hex digits of a signed 64-bit value."""
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def correlated_parts(prints: DataFrame, parts: int = PARTS) -> list[list[int]]:
    """Deal the 64 bits into ``parts`` groups, bits that vary together in one group.

    Counts come from all fingerprints: each task sums a 64 x 64 table of bits set
    together, and those tables are added up in a grouped sum of 4,096 keys.
    """

    def tally(batches):
        together = np.zeros((64, 64), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8)
            for at in range(0, len(values), 8 * _CHUNK):
                bits = np.unpackbits(
                    values[at : at + 8 * _CHUNK].reshape(-1, 8), axis=1, bitorder="little"
                ).astype(np.float32)  # exact: below 2**24 rows a chunk
                together += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(4096)), pa.array(together.ravel())], ["cell", "n"]
        )

    cells = (
        prints.select("fp")
        .mapInArrow(tally, "cell bigint, n bigint")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .collect()  # 4,096 rows whatever the input
    )
    together = np.zeros(4096)
    for cell in cells:
        together[cell["cell"]] = cell["n"]
    together = together.reshape(64, 64)
    ones, rows = np.diag(together), max(1, prints.count())
    cov = together / rows - np.outer(ones, ones) / rows**2
    spread = np.sqrt(np.clip(np.diag(cov), 1e-12, None))
    alike = np.abs(cov / np.outer(spread, spread))
    np.fill_diagonal(alike, 0)
    left, groups = list(range(64)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        pick = max(left, key=lambda b: (alike[b, left].max(), -b))
        group = [pick]
        while len(group) < width:
            rest = [b for b in left if b not in group]
            group.append(max(rest, key=lambda b: (alike[b, group].sum(), -b)))
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def _near_cells(cells: np.ndarray, radius: int) -> np.ndarray:
    """``[j, c]``: rows in the cells that differ from c in exactly j bits."""
    at = np.arange(len(cells))
    near = np.zeros((radius + 1, len(cells)))
    near[0] = cells
    for bit in range(int(len(cells)).bit_length() - 1):
        for j in range(radius, 0, -1):
            near[j] += near[j - 1][at ^ (1 << bit)]
    return near


def expected_candidates(cells: np.ndarray, width: int, radius: int) -> np.ndarray:
    """``[t, cell]``: rows expected within t bits of a value of a part, from its cells."""
    rest = width - (int(len(cells)).bit_length() - 1)
    near = _near_cells(cells, radius)
    share = np.cumsum([comb(rest, k) / 2.0**rest for k in range(radius + 1)])
    return np.array(
        [sum(near[j] * share[t - j] for j in range(t + 1)) for t in range(radius + 1)]
    )


def allocate(costs: np.ndarray, total: int) -> np.ndarray:
    """Thresholds per row: ``costs[row, part, t + 1]`` for t = -1 .. d, summing to ``total``.

    Dynamic program over the parts; ties go to the smaller threshold first.
    """
    rows, parts, choices = costs.shape
    sums = total + parts + 1  # every t is shifted by one
    best = np.full((rows, sums), np.inf)
    best[:, 0] = 0
    taken = []
    for part in range(parts):
        grown = np.full((rows, sums), np.inf)
        choice = np.zeros((rows, sums), np.int8)
        for step in range(min(choices, sums)):
            cost = best[:, : sums - step] + costs[:, part, step][:, None]
            better = cost < grown[:, step:]
            grown[:, step:][better] = cost[better]
            choice[:, step:][better] = step
        best = grown
        taken.append(choice)
    out = np.zeros((rows, parts), np.int32)
    at = np.full(rows, sums - 1)
    for part in range(parts - 1, -1, -1):
        step = taken[part][np.arange(rows), at]
        out[:, part] = step - 1
        at = at - step
    return out


def links(nodes: DataFrame, max_bits: int = MAX_BITS, parts: int = PARTS) -> DataFrame:
    """Every pair ``a < b`` of distinct fingerprints (``fp``) at ``max_bits`` or fewer.

    ``nodes`` is read several times: hand in a stored table of distinct values.
    """
    spark = nodes.sparkSession
    groups = correlated_parts(nodes, parts)
    masks = [_signed(sum(1 << b for b in g)) for g in groups]
    coarse = [_signed(sum(1 << b for b in g[:CELL_BITS])) for g in groups]
    bits = F.col("fp")
    keyed = nodes.select("fp", F.posexplode(F.array(*[bits.bitwiseAND(m) for m in masks])).alias("part", "value"))
    # A row for each cell of each part: 4,096 x parts at most.
    cells = np.zeros((parts, 1 << CELL_BITS))
    found = keyed.groupBy(
        "part",
        F.get(F.array(*[F.lit(c) for c in coarse]), F.col("part")).bitwiseAND(F.col("value")).alias("cell"),
    ).count()

    def number(values: np.ndarray, group: list[int]) -> np.ndarray:
        out = np.zeros(len(values), np.int64)
        for k, b in enumerate(group[:CELL_BITS]):
            out |= ((values >> b) & 1) << k
        return out

    for part, cell, n in found.collect():
        cells[part, number(np.array([cell]), groups[part])[0]] += n
    guess = [expected_candidates(cells[k], len(groups[k]), max_bits) for k in range(parts)]
    probes = np.array([[sum(comb(len(g), j) for j in range(t + 1)) for t in range(max_bits + 1)] for g in groups])

    @F.arrow_udf("array<int>")
    def thresholds(prints: pa.Array, same: pa.Array) -> pa.Array:
        values = prints.to_numpy(zero_copy_only=False)
        exact = same.flatten().to_numpy(zero_copy_only=False).reshape(len(values), parts)
        costs = np.zeros((len(values), parts, max_bits + 2))
        for k in range(parts):
            at = number(values, groups[k])
            for t in range(max_bits + 1):
                costs[:, k, t + 1] = probes[k, t] + exact[:, k] + guess[k][t][at]
        out = allocate(costs, max_bits - parts + 1)
        offsets = np.arange(len(values) + 1, dtype=np.int32) * parts
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    sizes = keyed.groupBy("part", "value").count()
    known = (
        keyed.join(sizes, ["part", "value"])
        .groupBy("fp")
        .agg(F.sort_array(F.collect_list(F.struct("part", "count"))).alias("s"))
        .select("fp", thresholds(F.col("fp"), F.col("s.count")).alias("t"))
    )
    # The flips of up to t bits of a part; a table of fixed size (5,489 rows a part at d = 3).
    flips = [
        (k, t, _signed(sum(1 << b for b in chosen)))
        for k, g in enumerate(groups)
        for t in range(max_bits + 1)
        for j in range(t + 1)
        for chosen in combinations(g, j)
    ]
    flips = spark.createDataFrame(flips, "part int, t int, flip bigint")
    asked = known.select("fp", F.posexplode("t").alias("part", "t")).join(F.broadcast(flips), ["part", "t"])
    asked = asked.select(
        F.col("fp").alias("a"),
        "part",
        F.get(F.array(*[F.lit(m) for m in masks]), F.col("part")).bitwiseAND(F.col("a")).bitwiseXOR(F.col("flip")).alias("value"),
    )
    stored = keyed.withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    on = (asked["part"] == stored["part"]) & (asked["value"] == stored["value"])
    return asked.join(stored, on & near & (F.col("a") < F.col("b"))).select("a", "b").distinct()


def grouped_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, parts: int = PARTS
) -> DataFrame:
    """``doc_id, row_key, fp, component, component_id`` for every row of ``docs``.

    ``row_key`` is ``xxhash64`` of the text, ``component`` a fingerprint of the group that
    names it, ``component_id`` its smallest id.
    """
    prints = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("row_key"), fingerprint(F.col(text_col)).alias("fp")
        ),
        "simhash",
    )
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash_nodes")
    found = components(links(nodes, max_bits, parts)).toDF("fp", "component")
    grouped = materialize(
        nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp")),
        "simhash_groups",
    )
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    named = grouped.join(smallest, "component").select("fp", "component", "component_id")
    # A fingerprint with a third of the rows is split by the adaptive skew join.
    return prints.join(named, "fp", "left").select("doc_id", "row_key", "fp", "component", "component_id")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, parts: int = PARTS
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of ``max_bits`` or fewer
    bits; equal fingerprints are linked. A null text counts as empty, texts without
    words share fingerprint zero and are linked like any other. Ids may repeat; a null
    id is never the smallest (a component of null ids only has a null id). Other
    columns are ignored. An empty table gives no rows.
    """
    return grouped_rows(docs, id_col, text_col, max_bits, parts).select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, max_bits: int = MAX_BITS, parts: int = PARTS) -> DataFrame:
    """The rows of ``docs`` (``doc_id, text, ...``) without near-duplicates: of each group
    the one with the smallest id, then the smallest ``xxhash64`` of its text; one of rows
    that repeat both. A null id comes after all others. Other columns, whatever their
    names, come along unchanged."""
    rows = grouped_rows(docs, max_bits=max_bits, parts=parts)
    first = rows.groupBy("component").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "row_key")).alias("k"))
    # Internal names that no column of ``docs`` has: extra columns pass through unchanged.
    id_key, row_key, once_col = (fresh(docs.columns, n) for n in ("_id_key", "_row_key", "_once"))
    kept = materialize(first.select(_id_key("k.doc_id").alias(id_key), F.col("k.row_key").alias(row_key)), "kept_rows")
    keyed = docs.select("*", _id_key("doc_id").alias(id_key), F.xxhash64("text").alias(row_key))
    keys = [id_key, row_key]
    # Joined and numbered on the same keys: the texts are shuffled once.
    once = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    left = keyed.join(kept, keys, "left_semi").withColumn(once_col, once)
    return left.filter(F.col(once_col) == 1).select(*[left[c] for c in docs.columns])


def _id_key(column: str) -> Column:
    """An id that can be joined on; null goes behind all others."""
    return F.coalesce(F.col(column).cast("bigint"), F.lit((1 << 63) - 1)).alias("_id_key")
