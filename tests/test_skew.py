"""The lookup join on a table where one key holds a third of the rows."""

from pyspark.sql import functions as F

from clipyard.operators import skew


def tables(spark):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("long")
    facts = spark.range(3000).select("id", key.alias("k"))
    keys = facts.filter("k < 40").groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 10)
    return facts, keys


def test_lookup(spark):
    facts, keys = tables(spark)
    want = {i: (k, k * 10 if k < 40 else None) for i, k in ((i, 7 if i % 3 == 0 else i % 50) for i in range(3000))}
    left = skew.lookup(facts, keys, "k").collect()
    assert len(left) == 3000 and {r["id"]: (r["k"], r["v"]) for r in left} == want
    inner = skew.lookup(facts, keys, "k", how="inner").collect()
    assert {r["id"]: (r["k"], r["v"]) for r in inner} == {i: kv for i, kv in want.items() if kv[1] is not None}


def test_hot_keys_are_split_whatever_their_number(spark):
    """2,000 hot keys: Spark splits the skewed partitions of the join."""
    own = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in own}
    try:
        for name, value in own.items():
            spark.conf.set(name, value)
        key = F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id") % 2000).cast("long")
        facts = spark.range(0, 400_000, 1, 8).select("id", key.alias("k"))
        found = skew.lookup(facts, facts.groupBy("k").agg(F.count("*").alias("n")), "k")
        assert found.count() == 400_000
        rows = found.select(F.spark_partition_id().alias("p"), "k").filter("k = 5")
        assert rows.groupBy("p").count().count() > 1
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
