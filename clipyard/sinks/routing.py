"""Publishing messages: encode rows and send each to the sinks bound to its key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipyard.functions.messages import encode
from clipyard.schemas import ARTICLE_FIELDS

# Routing keys.
ROUTE_DOWNLOAD = "Route_to_download"
ROUTE_INDEX = "Route_to_elastic"


def publish_tasks(tasks: DataFrame, keep=()) -> DataFrame:
    """Crawl tasks as routed messages ``route, value``."""
    return tasks.select(
        *keep,
        F.lit(ROUTE_DOWNLOAD).alias("route"),
        encode("url", "doc_type", "depth").alias("value"),
    )


def publish_articles(articles: DataFrame, code: int = 0, keep=()) -> DataFrame:
    """Articles as routed index messages ``route, value``."""
    coded = articles.withColumn("what_to_do", F.lit(code))
    return coded.select(
        *keep,
        F.lit(ROUTE_INDEX).alias("route"),
        encode(*ARTICLE_FIELDS, "what_to_do").alias("value"),
    )


def route(messages: DataFrame, bindings: dict[str, list[str]]) -> DataFrame:
    """Deliver messages to queues: ``queue, route, value``.

    ``bindings`` maps a queue to the routing keys it is bound to. A message goes
    to each queue bound to exactly its key; an unbound message goes nowhere.
    """
    queues = {}
    for queue, keys in bindings.items():
        for key in keys:
            queues.setdefault(key, []).append(queue)
    bound = F.map_from_arrays(
        F.array(*map(F.lit, queues)),
        F.array(*[F.array(*map(F.lit, names)) for names in queues.values()]),
    )
    delivered = F.explode(F.try_element_at(bound, F.col("route")))
    return messages.select(delivered.alias("queue"), "route", "value")


def write_queues(delivered: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per queue, JSON lines; also usable inside ``foreachBatch``."""
    delivered.select("queue", "value").write.mode(mode).partitionBy("queue").text(path)
