"""Hard-negative mining with a GNAT-style multiway tree and exact leaves.

Scores are exact integer inner products of ``floor(256 * x)`` vectors. To search by
score with a metric tree, every row ``y`` becomes ``(y, sqrt(M - |y|^2))`` and an anchor
``a`` becomes ``(a, 0)``, with ``M`` the largest squared norm: then
``|a' - y'|^2 = M + |a|^2 - 2 a.y``, so a window of scores is an annulus of distances.

The tree has two levels. ``FANOUT`` split points are the rows of smallest hash; each
row goes to its nearest one, and inside each cell to the nearest of up to ``FANOUT``
split points of that cell, taken from the ``SAMPLE`` rows of smallest hash (a bounded,
documented sample; every row is indexed). For every split point and every sibling
subtree the tree stores the range of distances from the point to the subtree's rows,
computed over all rows by one aggregate. A query drops a subtree when, for some split
point, the distances the range allows cannot meet its annulus (triangle inequality,
with a small margin for rounding); leaves that survive are scanned exactly, on
integers. Leaves are cut into chunks of about ``LEAF_ROWS`` rows and anchors into blocks
of about ``ANCHOR_ROWS``, both by a hash of the whole row, so a leaf of a third of all rows
(one very common vector) is many tasks. A task meets one chunk with one block, and holds
``BLOCK`` of their scores at a time. Rows are packed in the narrowest integers that hold
them and multiplied in the narrowest floats that are exact for them.

Search, per anchor (rows whose ``vec_id`` is divisible by 100):

1. positives: the first 5 other rows of the same label by score (higher first, ties by
   smaller ``vec_id``). The 5th best same-label score among the sample rows bounds the
   answer from below, so only the ball of scores at least that large is searched.
2. negatives: for each positive of score ``p``, the first 5 rows of another label with
   ``80 p <= 100 n <= 100 p``. The sample again gives a lower bound inside the window.
   An anchor visits a leaf once for all its positives.

Each leaf task returns at most 5 rows per anchor (or per anchor and positive); the
final ranking is a window over those few rows per anchor.

Edge cases, each with a defined result: rows with a null ``vec_id``, label or vector,
a vector not of ``DIMS`` components, or a null or non-finite component take no part;
repeated rows (equal ``vec_id``, label and vector) count once, as anchors and as
candidates; "other rows" excludes rows with the anchor's own ``vec_id``; ties in
score go to the smaller ``vec_id``; an anchor with no positive, or positives of
negative score, gives no rows; an empty table gives an empty result; extra columns
are not carried.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipyard.session import materialize

# Fixed values of the contract.
SCALE = 256
DIMS = 64
RELABEL_EVERY = 7
CLASSES = 10
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100

#: Tree shape and bounded sample.
FANOUT = 8
SAMPLE = 4096
LEAF_ROWS = 20000
SEED = 12

#: Anchors that meet a leaf chunk in one task, and scores that are in memory at a time.
ANCHOR_ROWS = 8192
BLOCK = 2**20
#: A lower bound of scores that is none.
FREE = -(2**62)


def prepared(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, q, n2``: rows that take part, relabelled, as integer vectors."""
    vec = F.col("embedding")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % CLASSES).otherwise(F.col("label"))
    q = F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull())
        .where((F.size(vec) == DIMS) & finite)
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("int").alias("label"), q.alias("q"))
        .withColumn("n2", F.aggregate("q", F.lit(0).cast("bigint"), lambda acc, x: acc + x * x))
    )


class Tree:
    """Split points, their cells and the stored distance ranges (all bounded by parameters)."""

    def __init__(self, m2: int, top: np.ndarray):
        self.m2 = float(m2)
        # A component is at most sqrt(M), any partial sum of an inner product at most M:
        # the narrowest types that hold them exactly.
        self.stored = np.dtype("<i2" if m2 < 2**30 else "<i4" if m2 < 2**62 else "<i8")
        self.exact = np.dtype(np.float32 if m2 < 2**24 else np.float64 if m2 < 2**53 else np.int64)
        self.top = top  # FANOUT x DIMS integers
        self.subs = []  # per cell: up to FANOUT x DIMS integers
        self.leaves = []  # (cell, sub)
        self.ranges = {}  # cell or (cell, sub) -> (lo, hi) arrays over the split points of that level

    def vectors(self, column) -> np.ndarray:
        """Packed vectors as a matrix whose products are exact."""
        flat = np.frombuffer(b"".join(column.to_pylist()), dtype=self.stored)
        return flat.reshape(-1, DIMS).astype(self.exact)

    def _rows_to(self, q: np.ndarray, n2: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances of rows (lifted) to split points (lifted)."""
        pn2 = (points * points).sum(axis=1)
        lift = np.sqrt(np.maximum(self.m2 - n2, 0.0))[:, None] * np.sqrt(np.maximum(self.m2 - pn2, 0.0))[None, :]
        d2 = 2 * self.m2 - 2 * (q.astype(self.exact) @ points.T.astype(self.exact)).astype(np.float64) - 2 * lift
        return np.sqrt(np.maximum(d2, 0.0))

    def _query_to(self, q: np.ndarray, n2: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances of anchors (not lifted) to split points (lifted)."""
        d2 = self.m2 + n2[:, None].astype(np.float64) - 2 * (q @ points.T.astype(self.exact)).astype(np.float64)
        return np.sqrt(np.maximum(d2, 0.0))

    def place(self, q: np.ndarray, n2: np.ndarray):
        """Cell, sub-cell and distances to the split points of both levels (the second padded)."""
        d1 = self._rows_to(q, n2, self.top)
        cell = d1.argmin(axis=1)
        sub = np.zeros(len(q), dtype=np.int64)
        d2 = np.full((len(q), FANOUT), np.nan)
        for c in np.unique(cell):
            points, rows = self.subs[c], np.flatnonzero(cell == c)
            if len(points):
                dist = self._rows_to(q[rows], n2[rows], points)
                sub[rows] = dist.argmin(axis=1)
                d2[rows, : len(points)] = dist
        return cell, sub, d1, d2

    def reach(self, q: np.ndarray, n2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest lifted distance a row of each leaf may have from each anchor."""
        near, far = (np.empty((len(q), len(self.leaves))) for _ in range(2))
        levels = {}
        for c in {c for c, _ in self.leaves}:
            levels[c] = self._query_to(q, n2, self.top), self._query_to(q, n2, self.subs[c])
        for k, (c, s) in enumerate(self.leaves):
            near[:, k], far[:, k] = 0.0, np.inf
            for d, (lo, hi) in zip(levels[c], (self.ranges[c], self.ranges[c, s])):
                if len(lo):
                    near[:, k] = np.maximum(near[:, k], np.maximum(d - hi, lo - d).max(axis=1))
                    far[:, k] = np.minimum(far[:, k], (d + hi).min(axis=1))
        return near, far

    def meets(self, near: np.ndarray, far: np.ndarray, n2: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Which leaves may hold rows of score ``lo`` to ``hi``, for windows of anchors of that reach."""
        margin = 1e-7 * np.sqrt(4 * self.m2 + np.abs(n2)) + 1e-6
        base = self.m2 + n2
        least = np.sqrt(np.maximum(base - 2.0 * hi, 0.0)) - margin
        most = np.sqrt(np.maximum(base - 2.0 * lo, 0.0)) + margin
        return (far >= least[:, None]) & (near <= most[:, None])


def _hash(*cols: str):
    return F.xxhash64(F.lit(SEED), *cols)


def _lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def _numbers(column) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def build(rows: DataFrame, m2: int) -> tuple[Tree, DataFrame, pd.DataFrame, DataFrame]:
    """The tree, all rows placed in it (``cell, sub, chunk``), the sample rows and chunks a leaf."""
    sample = rows.orderBy(_hash("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    q = np.stack(sample["q"]).astype(np.int64)
    n2 = sample["n2"].to_numpy(dtype=np.int64)
    top = q[:FANOUT]
    tree = Tree(m2, top)
    cells = tree._rows_to(q, n2, top).argmin(axis=1)
    tree.subs = [q[cells == c][:FANOUT] for c in range(len(top))]

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("q").flatten().to_numpy().reshape(-1, DIMS)
            cell, sub, d1, d2 = tree.place(vectors, batch.column("n2").to_numpy())
            packed = pa.array([v.tobytes() for v in vectors.astype(tree.stored)], pa.binary())
            columns = [*(batch.column(c) for c in ("vec_id", "label", "n2")), packed, pa.array(cell), pa.array(sub)]
            yield pa.RecordBatch.from_arrays([*columns, _lists(d1), _lists(d2)], names)

    schema = "vec_id bigint, label int, n2 bigint, q binary, cell bigint, sub bigint, d1 array<double>, d2 array<double>"
    names = [c.split()[0] for c in schema.split(", ")]
    placed = materialize(rows.mapInArrow(place, schema), "negatives-placed")

    def bounds(column, n):
        return [f(F.col(column)[i]).alias(f"{f.__name__}{i}") for i in range(n) for f in (F.min, F.max)]

    def ranges(row, n):
        return tuple(np.array([row[f"{f}{i}"] for i in range(n)]) for f in ("min", "max"))

    tree.ranges = {r["cell"]: ranges(r, len(top)) for r in placed.groupBy("cell").agg(*bounds("d1", len(top))).collect()}
    chunks = []
    for r in placed.groupBy("cell", "sub").agg(F.count(F.lit(1)).alias("n"), *bounds("d2", FANOUT)).collect():
        tree.ranges[r["cell"], r["sub"]] = ranges(r, len(tree.subs[r["cell"]]))
        tree.leaves.append((r["cell"], r["sub"]))
        chunks.append((r["cell"], r["sub"], -(-r["n"] // LEAF_ROWS)))
    counts = F.broadcast(rows.sparkSession.createDataFrame(chunks, "cell bigint, sub bigint, n_chunks bigint"))
    # Rows are distinct, so a chunk has about LEAF_ROWS rows whatever ids repeat.
    chunk = F.pmod(_hash("vec_id", "label", "q"), F.col("n_chunks"))
    leaves = placed.drop("d1", "d2").join(counts, ["cell", "sub"]).withColumn("chunk", chunk).drop("n_chunks")
    return tree, leaves, sample, counts


def _fifth(scores: np.ndarray, ok: np.ndarray, k: int) -> np.ndarray:
    """Per row the ``k``-th largest of the scores that are ``ok``; ``FREE`` where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), FREE)
    kth = np.partition(np.where(ok, scores.astype(np.int64), FREE), -k, axis=1)
    return kth[:, -k]


def _visits(anchors: DataFrame, tree: Tree, windows, counts: DataFrame, n_blocks: int) -> DataFrame:
    """Anchor rows with their windows of scores, for each leaf chunk that an annulus meets.

    ``windows(batch, at, q)`` gives, for the anchors from ``at`` on of vectors ``q``, the
    anchor of each window, counted from ``at``, in order, and its lowest and highest score.
    """
    step = max(1, BLOCK // SAMPLE)

    def route(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                q, n2 = tree.vectors(part.column("q")), part.column("n2").to_numpy()
                owner, lo, hi = windows(part, q)
                near, far = tree.reach(q, n2)
                met = tree.meets(near[owner], far[owner], n2[owner], lo, hi)
                ends = np.searchsorted(owner, np.arange(len(q) + 1)).astype(np.int32)
                lows = pa.ListArray.from_arrays(pa.array(ends), pa.array(lo))
                for k, (c, s) in enumerate(tree.leaves):
                    picked = pa.array(np.unique(owner[met[:, k]]))
                    if len(picked):
                        taken = [x.take(picked) for x in (*part.columns, lows)]
                        leaf = [pa.array(np.full(len(picked), x, dtype=np.int64)) for x in (c, s)]
                        yield pa.RecordBatch.from_arrays([*taken, *leaf], [*part.schema.names, "lo", "cell", "sub"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
    routed = anchors.mapInArrow(route, f"{schema}, lo array<bigint>, cell bigint, sub bigint")
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_chunks") - 1)).alias("chunk")
    block = F.pmod(_hash("anchor_id", "q"), F.lit(n_blocks)).alias("block")
    return routed.drop("n2").join(F.broadcast(counts.select("cell", "sub", chunk)), ["cell", "sub"]).select("*", block)


def _scored(a: np.ndarray, lo: np.ndarray, r: np.ndarray):
    """Pairs of an anchor and a row of score ``lo`` or more, in order, ``BLOCK`` scores at a time."""
    step = max(1, BLOCK // max(1, len(r)))
    for at in range(0, len(a) if len(r) else 0, step):
        scores = a[at : at + step] @ r.T
        found = np.flatnonzero(scores >= lo[at : at + step, None].astype(scores.dtype))
        i, j = np.divmod(found, len(r))
        yield at + i, j, scores.ravel()[found].astype(np.int64)


def _top(group: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each group by score; equal scores stay in order."""
    order = np.lexsort((-score, group))
    of = group[order]
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    return order[rank < k]


def _by_id(tree: Tree, rows: pa.Table):
    """Ids, labels and vectors of a chunk's rows in order of their ids."""
    ids = _numbers(rows["vec_id"])
    order = np.argsort(ids, kind="stable")
    return ids[order], _numbers(rows["label"])[order], tree.vectors(rows["q"])[order]


def _result(schema: str, parts: list[list[np.ndarray]]) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, dtype=np.int64)] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names)


def mine(embeddings: DataFrame) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    rows = materialize(prepared(embeddings).distinct(), "negatives-rows")
    spark = rows.sparkSession
    is_anchor = F.col("vec_id") % ANCHOR_EVERY == 0
    m2, n_anchors = rows.agg(F.max("n2"), F.count_if(is_anchor)).first()
    if m2 is None:
        schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return spark.createDataFrame([], schema)
    tree, leaves, sample, counts = build(rows, m2)
    sq = np.stack(sample["q"]).astype(tree.exact)
    slab, sid = sample["label"].to_numpy(), sample["vec_id"].to_numpy()
    anchors = leaves.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "q", "n2")
    key = ["cell", "sub", "chunk", "block"]
    n_blocks = max(1, -(-n_anchors // ANCHOR_ROWS))
    block = F.explode(F.expr(f"sequence(0L, {n_blocks - 1}L)")).alias("block")
    searched = leaves.select("vec_id", "label", "q", *key[:3], block).groupBy(*key)

    # 1. Positives: the ball of scores no lower than the 5th best same-label sample row.
    def ball(part, q):
        ids, labels = part.column("anchor_id").to_numpy(), part.column("label").to_numpy()
        other = (slab[None, :] == labels[:, None]) & (sid[None, :] != ids[:, None])
        tau = _fifth(q @ sq.T, other, POSITIVES)
        return np.arange(len(q)), tau, np.full(len(q), -FREE)

    pos_schema = "anchor_id bigint, vec_id bigint, score bigint"

    def best_same(a: pa.Table, r: pa.Table) -> pa.Table:
        ids, labels, vectors = _by_id(tree, r)
        a_ids, a_labels, a_vectors = _numbers(a["anchor_id"]), _numbers(a["label"]), tree.vectors(a["q"])
        lo, found = _numbers(a["lo"].combine_chunks().flatten()), []
        for label in np.unique(a_labels):
            mine_, same = np.flatnonzero(a_labels == label), np.flatnonzero(labels == label)
            for i, j, score in _scored(a_vectors[mine_], lo[mine_], vectors[same]):
                i, j = mine_[i], same[j]
                other = a_ids[i] != ids[j]
                i, j, score = i[other], j[other], score[other]
                best = _top(i, score, POSITIVES)
                found.append([a_ids[i[best]], ids[j[best]], score[best]])
        return _result(pos_schema, found)

    pos = _visits(anchors, tree, ball, counts, n_blocks).groupBy(*key).cogroup(searched).applyInArrow(best_same, pos_schema)
    order = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    positives = materialize(
        pos.withColumn("r", F.row_number().over(order)).where(F.col("r") <= POSITIVES).select(
            "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        "negatives-positives",
    )

    # 2. Negatives: the window of each positive, narrowed by the sample. An anchor goes on
    # once with all its positives; 80 p <= 100 n <= 100 p holds for no n if p < 0.
    pair = F.collect_list(F.struct("positive_id", "positive_score")).alias("p")
    of_anchor = positives.where("positive_score >= 0").groupBy("anchor_id").agg(pair)
    with_pos = anchors.join(of_anchor, "anchor_id").select(
        "anchor_id", "label", "q", "n2", F.col("p.positive_id").alias("ids"), F.col("p.positive_score").alias("scores")
    )

    def annulus(part, q):
        sizes = part.column("ids").value_lengths().to_numpy()
        owner, ps = np.repeat(np.arange(len(q)), sizes), part.column("scores").flatten().to_numpy()
        floor = -(-LOW * ps // HIGH)
        scores, labels = (q @ sq.T).astype(np.int64), part.column("label").to_numpy()
        for at in range(0, len(owner), len(q)):
            w = slice(at, at + len(q))
            s, p = scores[owner[w]], ps[w][:, None]
            inside = (slab[None, :] != labels[owner[w]][:, None]) & (LOW * p <= HIGH * s) & (s <= p)
            floor[w] = np.maximum(floor[w], _fifth(s, inside, NEGATIVES))
        return owner, floor, ps

    neg_schema = "anchor_id bigint, positive_id bigint, positive_score bigint, vec_id bigint, score bigint"

    def best_other(a: pa.Table, r: pa.Table) -> pa.Table:
        ids, labels, vectors = _by_id(tree, r)
        a_ids, a_labels, a_vectors = _numbers(a["anchor_id"]), _numbers(a["label"]), tree.vectors(a["q"])
        p_ids, ps, lo = (_numbers(a[c].combine_chunks().flatten()) for c in ("ids", "scores", "lo"))
        sizes = _numbers(a["ids"].combine_chunks().value_lengths())
        first, found = np.cumsum(sizes) - sizes, []
        lowest = np.minimum.reduceat(lo, first) if len(lo) else lo
        for i, j, score in _scored(a_vectors, lowest, vectors):
            other = a_labels[i] != labels[j]
            i, j, score = i[other], j[other], score[other]
            for n in range(sizes.max()):
                w = np.where(sizes[i] > n, first[i] + n, 0)
                inside = (sizes[i] > n) & (lo[w] <= score) & (LOW * ps[w] <= HIGH * score) & (score <= ps[w])
                of, w, row, s = i[inside], w[inside], j[inside], score[inside]
                best = _top(w, s, NEGATIVES)
                found.append([a_ids[of[best]], p_ids[w[best]], ps[w[best]], ids[row[best]], s[best]])
        return _result(neg_schema, found)

    neg = _visits(with_pos, tree, annulus, counts, n_blocks).groupBy(*key).cogroup(searched).applyInArrow(best_other, neg_schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        neg.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= NEGATIVES)
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
