"""The command menu: what each message code asks for.

==== ==========================================
code meaning
==== ==========================================
0    index an article (see ``sinks.articles``)
1    match the author
2    near-duplicates
3    match the topic
4    match the url
5    count by a field
else print everything
==== ==========================================
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipyard.operators import neardup, search
from clipyard.session import materialize

# Command codes and the names of the count commands.
INDEX, MATCH_AUTHOR, NEAR_DUPLICATES, MATCH_TOPIC, MATCH_URL, COUNT = range(6)
COUNT_COMMANDS = {
    "Aggregate_url": "url",
    "Aggregate_topic": "topic",
    "Aggregate_date": "date",
    "Aggregate_author": "author",
}


def count_field(command: str) -> str:
    """Field of a count command; an unknown one counts authors."""
    return COUNT_COMMANDS.get(command, search.DEFAULT_AGGREGATION_FIELD)


def near_duplicates(docs: DataFrame, key: str = "doc_key", mode: str = "lsh", topic: str = "topic"):
    """Similar groups of a signed articles table, with the topic of each side."""
    groups = materialize(neardup.signature_groups(docs, key, mode), "groups")
    pairs = neardup.similar_groups(groups, mode)
    names = docs.select(key, topic)
    columns = pairs.columns
    for side in "ab":
        named = names.select(F.col(key).alias(f"rep_{side}"), F.col(topic).alias(f"topic_{side}"))
        pairs = pairs.join(named, f"rep_{side}")
    # A join puts its key first: the pair's own order is restored, topics behind.
    return pairs.select(*columns, "topic_a", "topic_b")


def run_command(
    articles: DataFrame, code: int, argument: str = "", key: str = "doc_key", mode: str = "lsh"
) -> DataFrame:
    """Answer a query command over a signed articles table.

    ``argument`` is the query text of a match and the command name of a count; ``mode`` is that of the
    near-duplicate search.
    """
    if code == INDEX:
        raise ValueError("code 0 carries an article: write it with sinks.articles")
    if code == MATCH_AUTHOR:
        return search.match(articles, "author", argument, key=key)
    if code == NEAR_DUPLICATES:
        return near_duplicates(articles, key, mode)
    if code == MATCH_TOPIC:
        return search.match(articles, "topic", argument, key=key)
    if code == MATCH_URL:
        return search.match(articles, "url", argument, key=key)
    if code == COUNT:
        return search.terms(articles, count_field(argument))
    return search.match_all(articles, key=key)
