"""Centroid clustering of integer vectors with an incremental distance matrix.

Every vector keeps, in its row, the exact integer dot products with all current
centroids. A round needs only the argmin of ``|v|^2 - 2 v.c + |c|^2`` from those and
one aggregate of component sums per centroid (partial on the map side, so a cluster
holding a third of all rows costs no more than a small one). When centroids move,
each stored product changes by ``sum_j v_j * delta_j`` over the components that
actually changed; unchanged centroids cost nothing. Centroid tables are ``k`` by
``dims`` integers (parameters, not data) and the only thing that reaches the driver.

Edge cases, each with a defined result:

* vectors that are null, of another length, or with a null or non-finite component
  take no part and are not returned;
* a null ``vec_id`` is clustered like any other row but never seeds a centroid;
* repeated rows are separate vectors; seeds tied on their hash are ordered by their
  components;
* fewer kept vectors than ``k`` give that many centroids; none give an empty result;
* distance ties go to the centroid with the smaller number; an empty centroid stays;
* extra columns of the input are not carried, so names cannot clash.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipyard.session import materialize

DIMS = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED_TAG = "3"
#: Rounds between writes of the stored products to the shared folder.
CUT_EVERY = 4

_V, _N2, _DOTS = "_c_v", "_c_n2", "_c_dots"


def integer_vectors(
    embeddings: DataFrame, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """``(vec_id, _c_v)``: kept vectors, each component ``floor(scale * x)`` as a long."""
    vec = F.col(vec_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return embeddings.where(vec.isNotNull() & (F.size(vec) == dims) & finite).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias(_V),
    )


def _dot(v: str, centroid: list[int]) -> str:
    """SQL text of ``v . centroid`` over the centroid's nonzero components only.

    Expressions are built as SQL text: one parse instead of thousands of column calls.
    """
    terms = [f"{v}[{j}] * {x}L" for j, x in enumerate(centroid) if x]
    return "(" + " + ".join(terms) + ")" if terms else "0L"


def _nearest(norms: list[int]) -> Column:
    """``struct(d, c)`` of the nearest centroid; ties go to the smaller ``c``."""
    cands = [f"named_struct('d', {_N2} - 2 * {_DOTS}[{i}] + {n}L, 'c', {i})" for i, n in enumerate(norms)]
    if not cands:
        return F.expr("CAST(NULL AS STRUCT<d: BIGINT, c: INT>)")
    return F.expr(f"array_min(array({', '.join(cands)}))")


def seeds(vectors: DataFrame, k: int = CENTROIDS, tag: str = SEED_TAG) -> list[list[int]]:
    """The ``k`` vectors of smallest lowercase-hex ``sha256(f"{tag}:{vec_id}")``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{tag}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where(F.col("vec_id").isNotNull()).orderBy(key, _V).limit(k).select(_V).collect()
    return [list(r[0]) for r in rows]


def cluster(
    embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE
) -> tuple[DataFrame, list[list[int]]]:
    """Lloyd rounds on exact integers; returns (per vector ``vec_id, cluster, distance``, centroids).

    Each round assigns every vector to its nearest centroid and replaces every
    non-empty centroid by the componentwise ``floor(sum / count)`` of its vectors;
    after ``rounds`` rounds vectors are assigned once more.
    """
    vectors = integer_vectors(embeddings, dims, scale)
    cents = seeds(vectors, k)
    v = F.col(_V)
    stale: list[DataFrame] = []
    n2 = F.aggregate(v, F.lit(0).cast("bigint"), lambda acc, x: acc + x * x)
    dots0 = F.expr(f"array({', '.join(_dot(_V, c) for c in cents)})") if cents else F.array().cast("array<bigint>")
    state = vectors.select("vec_id", _V, n2.alias(_N2), dots0.alias(_DOTS))
    state = materialize(state, "centroid-dots").persist()
    for done in range(1, rounds + 1 if cents else 0):
        norms = [sum(x * x for x in c) for c in cents]
        sums = (
            state.groupBy(_nearest(norms)["c"].alias("c"))
            .agg(F.count(F.lit(1)).alias("n"), *[F.expr(f"sum({_V}[{j}])").alias(f"s{j}") for j in range(dims)])
            .selectExpr("c", *[f"(s{j} - pmod(s{j}, n)) div n AS m{j}" for j in range(dims)])
            .collect()
        )
        for old in stale:
            old.unpersist()
        stale = []
        moved = [list(c) for c in cents]
        for row in sums:
            moved[row["c"]] = [row[f"m{j}"] for j in range(dims)]
        if moved == cents:
            break  # nothing changes in any later round either
        dots = []
        for i, (old, new) in enumerate(zip(cents, moved)):
            change = [b - a for a, b in zip(old, new)]
            dots.append(f"{_DOTS}[{i}] + {_dot(_V, change)}" if any(change) else f"{_DOTS}[{i}]")
        stale.append(state)
        state = state.select("vec_id", _V, _N2, F.expr(f"array({', '.join(dots)})").alias(_DOTS))
        # Cached between rounds; written to the shared folder every few rounds, so a
        # lost executor recomputes at most CUT_EVERY narrow updates of its split.
        state = (materialize(state, "centroid-dots") if done % CUT_EVERY == 0 else state).persist()
        cents = moved
    norms = [sum(x * x for x in c) for c in cents]
    near = _nearest(norms)
    assigned = state.select("vec_id", near["c"].alias("cluster"), near["d"].alias("distance"))
    return assigned, cents


def centroid_sha256(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(str(x) for x in centroid).encode()).hexdigest()


def with_inertia(assigned: DataFrame, cents: list[list[int]]) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; ``k`` values reach the driver."""
    per = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())
    total = sum(per.values())

    def lookup(values: dict) -> Column:
        if not values:
            return F.lit(None)
        return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("cluster"))

    return assigned.select(
        "vec_id",
        F.col("cluster").cast("int").alias("cluster"),
        "distance",
        lookup(per).cast("bigint").alias("cluster_inertia"),
        F.lit(total).cast("bigint").alias("inertia"),
        lookup({i: centroid_sha256(c) for i, c in enumerate(cents)}).cast("string").alias("centroid_sha256"),
    )
