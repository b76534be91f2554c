"""From documents to training sequences: quality, near-duplicates, personal data, mixture, packing.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and read again as
the next one's documents. All but the last return the columns of ``documents``. Null and empty texts
fail the quality rules and go there; every later stage handles them too, as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelake.llm import minhash, mixing, packing, pii, quality
from cratelake.llm.queries import table
from cratelake.llm.ship import ship
from cratelake.llm.store import stored

PERCENT = 80  # similarity, in percent, from which documents are near-duplicates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    ship(spark)
    return minhash.one_each(docs, PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as its target takes them."""
    return mixing.draw(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document in a sequence, its token ids as bytes."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixture", mixture),
    ("packing", sequences),
]

# The trees of the first stage and the tokenizer of the last have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
