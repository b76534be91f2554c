"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratelake.llm import alignment, chunks, langid, lexical, minhash, mixing, neighbours, ngrams, packing, pii, quality, toxicity, urls
from cratelake.llm.ship import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(n: int):
    """The contracts' folds: a remainder of the checksum of the id as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host, good``: a page shows the document its path ends in the number of; that one's labels count.

    Good is of good quality and not toxic. Pages without a labelled document are left out.
    """
    url = F.col("url")
    number = F.regexp_extract(urls.path_of(url), r"/([0-9]{1,18})(\.html)?/?$", 1).try_cast("long")
    shown = pages.select(urls.host_of(url).alias("host"), number.alias("doc_id"))
    good = labels.groupBy("doc_id").agg(
        ((F.min("quality") == 1) & (F.max(F.coalesce("toxic", F.lit(0))) == 0)).cast("int").alias("good")
    )
    return shown.join(good, "doc_id").select("host", "good")


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, page_outcomes(pages, table(spark, sf_dir, "labels")))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(_fold(4) == 2, F.lit(False))
    filters = langid.learn(docs.where(~held).select("doc_id", "text", "lang"))
    return langid.predict(docs, filters, {"held_out": held})


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(_fold(5) == 0, F.lit(False))
    model = toxicity.learn(docs.where(~held), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(docs, model, {"held_out": held})
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeats(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op11_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(_fold(3) == 1, F.lit(False))
    model = ngrams.train(docs.where(~held), table(spark, sf_dir, "labels"), "quality")
    scored = ngrams.score(docs, model, {"held_out": held})
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    "op1_urls": op1_urls,
    "op2_langid": op2_langid,
    "op3_minhash": op3_minhash,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_chunks": op7_chunks,
    "op8_pii": op8_pii,
    "op9_packing": op9_packing,
    "op10_neighbours": op10_neighbours,
    "op11_ngrams": op11_ngrams,
    "op12_alignment": op12_alignment,
    "op13_lexical": op13_lexical,
}
