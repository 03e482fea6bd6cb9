"""Shards of near-equal bytes by histogram sort.

Rows are ordered by (hash of the text, id). Splitters between shards are found by
counting: each round counts, over all rows, the exact bytes below a set of probe keys
for every splitter and keeps the interval that holds its target; a splitter is done
when the bytes below one of its probes meet the tolerance, or at a single key. Then
every row knows its shard and is exchanged once.

Equal texts have one hash, so they stay together unless their bytes alone are more
than the tolerance; then probes go on into the ids and the group is cut there.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipyard.session import materialize

#: Bytes a row costs besides its text.
ROW_BYTES = 16
#: Share of a mean shard by which a splitter may miss its target.
TOLERANCE = 0.005
#: Bits of the key a round refines: 16 probes for each splitter.
STEP = 4
#: Pieces of a shard are sorted by one task each; at most this many splitters in all.
PIECE_BYTES = 128 << 20
MAX_PIECES = 8192

_SIGN = 1 << 63


def _ordered(column):
    """A signed long as 64 bits whose unsigned order is the order of the values."""
    return column.bitwiseXOR(F.lit(-_SIGN))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


class Splitters:
    """Keys ``(h, k)``, both unsigned 64-bit; a row belongs after those at or below its key."""

    def __init__(self, high, low):
        self.high, self.low = np.array(high, np.uint64), np.array(low, np.uint64)

    def locate(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Number of splitters at or below each key."""
        out = np.searchsorted(self.high, high, "left")
        # Splitters with the same first half are compared by the second.
        last = np.searchsorted(self.high, high, "right")
        for i in np.flatnonzero(last > out):
            out[i] += np.searchsorted(self.low[out[i] : last[i]], low[i], "right")
        return out


def find_splitters(keys: DataFrame, parts: int, tolerance: float = TOLERANCE) -> Splitters:
    """``parts - 1`` splitters of ``keys`` (``high, low`` unsigned as longs, ``size``).

    ``keys`` is read once a round: hand in a stored narrow table. The driver holds 16
    counts for each splitter and round, whatever the number of rows.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    targets = [total * (i + 1) / parts for i in range(parts - 1)]
    slack = tolerance * total / parts
    # Per splitter: fixed bits so far (prefix of ``depth`` bits of 128) and bytes below it.
    prefix, below, done = [0] * len(targets), [0] * len(targets), [None] * len(targets)
    for depth in range(0, 128, STEP):
        open_ = [i for i in range(len(targets)) if done[i] is None]
        if not open_:
            break
        wanted = sorted({prefix[i] for i in open_})
        counts: dict[int, np.ndarray] = {p: np.zeros(1 << STEP, dtype=object) for p in wanted}
        half, shift = ("high", 64 - STEP - depth) if depth < 64 else ("low", 128 - STEP - depth)
        digit = F.shiftrightunsigned(half, shift).bitwiseAND((1 << STEP) - 1).cast("int")
        if depth == 0:
            rows = keys.withColumn("_at", F.lit(0))
        else:
            # The rows under one of the open prefixes: an equi-join with that short list.
            first = min(depth, 64)
            names = [(int(_signed(np.array([p >> (depth - first)], np.uint64))[0]), int(p & ((1 << (depth - first)) - 1)), k) for k, p in enumerate(wanted)]
            names = [(h, int(_signed(np.array([r], np.uint64))[0]), k) for h, r, k in names]
            listed = keys.sparkSession.createDataFrame(names, "_h bigint, _r bigint, _at int")
            head = F.shiftrightunsigned("high", 64 - first) if first < 64 else F.col("high")
            rest = F.shiftrightunsigned("low", 128 - depth) if depth > 64 else F.lit(0).cast("bigint")
            rows = keys.withColumns({"_h": head, "_r": rest}).join(F.broadcast(listed), ["_h", "_r"])
        found = rows.groupBy("_at", digit.alias("_digit")).agg(F.sum("size").alias("bytes")).collect()
        for at, d, n in found:
            counts[wanted[at]][d] = n
        for i in open_:
            own = counts[prefix[i]]
            edges = np.concatenate([[0], np.cumsum(own)]) + below[i]
            # The probe nearest to the target; met, the splitter is where its cell begins.
            best = min(range(len(edges)), key=lambda j: (abs(edges[j] - targets[i]), j))
            left = 128 - depth - STEP
            if abs(edges[best] - targets[i]) <= slack or left == 0:
                done[i] = min(((prefix[i] << STEP) + best) << left, (1 << 128) - 1)
                continue
            cell = next(j for j in range(1 << STEP) if edges[j + 1] >= targets[i])
            prefix[i], below[i] = (prefix[i] << STEP) + cell, edges[cell]
    done = sorted(done)
    return Splitters([d >> 64 for d in done], [d & ((1 << 64) - 1) for d in done])


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``; shards hold near-equal bytes.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 16. ``shard`` goes from 0,
    ``slot`` numbers the rows of a shard from 0 without gaps, in key order. Rows with a
    null id come first among equal texts; repeated rows are told apart by all their
    columns. Columns of ``docs`` named as the result are replaced. With fewer rows than
    shards some shards are empty; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.withColumn(
        "size", (F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES).cast("bigint")
    ).withColumns(
        {
            "_high": _ordered(F.xxhash64(text_col)),
            "_low": _ordered(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-_SIGN))),
        }
    )
    keys = materialize(rows.select(F.col("_high").alias("high"), F.col("_low").alias("low"), "size"), "shard_keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    pieces = max(1, min(MAX_PIECES // shards, -(-total // (shards * PIECE_BYTES))))
    # Every shard is cut into the same number of pieces, so shard splitters are among these.
    splitters = find_splitters(keys, shards * pieces, tolerance * (1 if pieces == 1 else pieces))
    high, low = splitters.high, splitters.low

    @F.arrow_udf(T.IntegerType())
    def piece_of(highs: pa.Array, lows: pa.Array) -> pa.Array:
        found = Splitters(high, low).locate(
            highs.to_numpy(zero_copy_only=False).view(np.uint64), lows.to_numpy(zero_copy_only=False).view(np.uint64)
        )
        return pa.array(found.astype(np.int32))

    counts = keys.groupBy(piece_of("high", "low").alias("piece")).count().collect()
    in_piece = dict.fromkeys(range(shards * pieces), 0) | {r["piece"]: r["count"] for r in counts}
    base, start = [], 0
    for p in range(shards * pieces):
        start = 0 if p % pieces == 0 else start
        base.append((p, start))
        start += in_piece[p]
    bases = spark.createDataFrame(base, "_piece int, _base bigint")
    order = F.row_number().over(_in_piece(docs))
    return (
        rows.withColumn("_piece", piece_of("_high", "_low"))
        .withColumn("_row", order)
        .join(F.broadcast(bases), "_piece")  # MAX_PIECES rows at most
        .withColumns({"shard": (F.col("_piece") / pieces).cast("int"), "slot": F.col("_base") + F.col("_row") - 1})
        .drop("_piece", "_row", "_base", "_high", "_low")
    )


def _in_piece(docs: DataFrame):
    from pyspark.sql import Window

    tie = F.xxhash64(*docs.columns) if docs.columns else F.lit(0)
    return Window.partitionBy("_piece").orderBy(
        F.col("_high").bitwiseXOR(F.lit(-_SIGN)), F.col("_low").bitwiseXOR(F.lit(-_SIGN)), tie
    )
