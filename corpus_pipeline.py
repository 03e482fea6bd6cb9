"""A training corpus from raw documents, in five stages of the operators in ``clipyard.llm``.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``. Its result is written as Parquet
and read again as the next one's input, so a lost executor costs a stage at most. All
but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipyard.llm import decontaminate, pii, robust_outliers, sentencepiece_unigram, simhash
from clipyard.llm.queries import tokenizer_path
from clipyard.session import scratch_path, ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie far outside their group go."""
    ship_package(spark)
    return robust_outliers.judge(docs, carry=COLUMNS).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the SimHash operator with its contract's
    shingles of three words and at most three differing bits of 64, nothing beside."""
    ship_package(spark)
    return simhash.keep_one_of_each(docs.select(*COLUMNS), max_bits=simhash.MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), items)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    masked = pii.mask_pii(pii.find_pii(docs.select(*COLUMNS)))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars")).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as lists of SentencePiece ids."""
    ship_package(spark)
    path = tokenizer_path("piece_bpe_32k.model")
    encoded = sentencepiece_unigram.encode_documents(docs.select(*COLUMNS), path)
    return encoded.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("bigint").alias("n_pieces"), "ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", pieces),
]

#: Estimation in steps, components and Viterbi search are beyond SQL; tests/llm compares
#: the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
