"""Index messages: articles and commands as JSON text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipyard.functions.columns import with_once
from clipyard.schemas import ARTICLE_FIELDS, INDEX_MESSAGE

# Fixed value: the command code of a message that carries an article.
INDEX_ARTICLE = 0


def index_messages(messages: DataFrame, *keep: str, value: str = "value") -> DataFrame:
    """Decoded messages, batch or stream, with the columns in ``keep`` alongside.

    A missing text field is the empty string and a missing code means "index".
    Lines that are not JSON objects are dropped.
    """
    broken = T.StructField("_broken", T.StringType())
    schema = T.StructType([*INDEX_MESSAGE.fields, broken])
    message = F.from_json(value, schema, {"columnNameOfCorruptRecord": broken.name})
    decoded = with_once(messages, m=message)
    texts = [F.coalesce(f"m.{f}", F.lit("")).alias(f) for f in ARTICLE_FIELDS if f != "url"]
    return decoded.filter(F.col("m").isNotNull() & F.col("m._broken").isNull()).select(
        *keep,
        "m.url",
        *texts,
        F.coalesce("m.what_to_do", F.lit(INDEX_ARTICLE)).alias("what_to_do"),
    )


def articles_to_index(decoded: DataFrame) -> DataFrame:
    """The messages that carry an article."""
    return decoded.filter(F.col("what_to_do") == INDEX_ARTICLE).drop("what_to_do")
