"""Connected components over a table of links, by minimum labels and shortcuts."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clipyard.session import materialize, scratch_path


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b``: same type).

    ``component`` is the smallest node reachable. A round takes the smallest label
    among the neighbours, then the label of that label; a chain of n links is done
    in about log n rounds. Each round is written to the shared folder, so a lost
    executor costs one round and lineage stays short. Labels and links are joined
    as tables: nothing is gathered, and a hub is split as any skewed join key. An
    empty table of links gives no rows.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    links = materialize(both.filter("a <> b").distinct().toDF("node", "other"), "links")
    labels = materialize(
        links.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels"
    )
    while True:
        near = (
            links.join(labels.toDF("other", "_near"), "other")
            .groupBy("node")
            .agg(F.min("_near").alias("_near"))
        )
        pulled = labels.join(near, "node").select(
            "node", F.col("component").alias("_old"), F.least("component", "_near").alias("_new")
        )
        jump = labels.toDF("_new", "_jump")
        stepped = pulled.join(jump, "_new").select(
            "node", "_old", F.least("_new", "_jump").alias("component")
        )
        seen = Observation()
        path = scratch_path(edges.sparkSession, "labels")
        (
            stepped.observe(seen, F.count_if(F.col("_old") != F.col("component")).alias("moved"))
            .select("node", "component")
            .write.parquet(path)
        )
        labels = edges.sparkSession.read.schema(labels.schema).parquet(path)
        if not seen.get["moved"]:
            return labels
