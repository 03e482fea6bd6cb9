"""Session settings and the shared scratch folder."""

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Settings the library is tuned for; a cluster may override any of them.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores="*", shuffle_partitions=8, **conf):
    """A local session with the recommended settings (tests, benchmarks)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("clipyard")
    settings = {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Temporary folders of local sessions that name none, by application.
_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[application] = tempfile.mkdtemp(prefix="clipyard-")
    return _LOCAL_SCRATCH[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage like a reliable checkpoint, but as Parquet: readers prune
    columns and push filters, and a lost executor costs a re-read only.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, name: str = "table", path: str | None = None):
    """``materialize`` that also returns the row count, observed during the write."""
    path = path or scratch_path(df.sparkSession, name)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def materialize_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> str:
    """Write ``df`` to the shared folder hashed and sorted by ``keys``; returns a table name.

    Joins on exactly these keys read the table in place and shuffle the other side
    only. The caller drops the name when done; the files stay with the scratch folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )
    return table


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a scan with few splits enough tasks for CPU-heavy work on each row.

    A large table already has more splits than the cluster has cores and is passed
    through without a shuffle; so is a stream.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(2 * cores, key)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a running session.

    The same as submitting with ``--py-files``; done once per application.
    """
    key = "clipyard.shipped"
    if spark.conf.get(key, None) == spark.sparkContext.applicationId:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="clipyard-package-"), "clipyard")
    archive = shutil.make_archive(base, "zip", os.path.dirname(root), os.path.basename(root))
    spark.sparkContext.addPyFile(archive)
    spark.conf.set(key, spark.sparkContext.applicationId)
