"""Mixing sources to target weights: whole epochs first, then documents by exponential keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratelake.llm.prefix import running_total
from cratelake.llm.store import stored

# Fixed values of the contract: words, weights in turn, the mix and the cap as parts of the sizes.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_QUALITY = 0.05
FEW_SOURCES = 10_000  # up to so many, counted first, sources are broadcast to the documents
SEED = "mix"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def size_of(words: Column) -> Column:
    return F.size(words).cast("long")


def quality_of(text: Column, words: Column) -> Column:
    """Weight of a document: three shares multiplied, each near 1 for running prose.

    Words among words and symbols; distinct words against four times the root of all, as texts that go on
    to say something have at least; and what is not capital letters.
    """
    size = F.size(words)
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    prose = (size + 1) / (size + 1 + F.coalesce(symbols, F.lit(0)))
    news = F.least(F.lit(1.0), (F.size(F.array_distinct(words)) + 1) / (4 * F.sqrt(size + 1)))
    calm = 1 - F.coalesce(capitals, F.lit(0)) / (F.coalesce(F.length(text), F.lit(0)) + 1)
    return F.greatest(prose * news * calm, F.lit(LEAST_QUALITY))


def key_of(doc_id: Column, text: Column, quality: Column, seed: str = SEED) -> Column:
    """An exponential number with rate ``quality``; its uniform source is a digest of id and text."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    uniform = (F.conv(F.substring(F.md5(told.cast("binary")), 1, 13), 16, 10).cast("long") + 0.5) / 2.0**52
    return -F.log(uniform) / quality


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_rank, source_size, source_before, target`` from ``sizes(source, source_size)``.

    Sources by code point, null last. Sources whose share exceeds the cap are those with the least
    cap per weight; taking them off in that order, what is left per weight rises as long as the
    next one is capped, so its maximum is the level of all others. One row per source is
    sorted, never documents.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    upto = rank.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = CAP * F.col("source_size")
    ranked = (
        sizes.withColumn("source_rank", F.row_number().over(rank))
        .withColumn("source_before", F.coalesce(F.sum("source_size").over(upto), F.lit(0)))
        .withColumn("_weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.col("source_rank") - 1, F.lit(len(WEIGHTS))) + 1))
        .withColumn("_ratio", cap / F.col("_weight"))
    )
    off = Window.orderBy("_ratio", "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    left = SHARE * F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(off), F.lit(0))
    rest = F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(off), F.lit(0))
    levelled = ranked.withColumn("_level", left / rest).withColumn("_capped", F.col("_ratio") <= F.col("_level"))
    level = F.max("_level").over(every)
    return levelled.withColumn(
        "target", F.when(F.col("_capped"), cap.cast("double")).otherwise(F.col("_weight") * level)
    ).select("source", "source_rank", "source_size", "source_before", "target")


def _key() -> Column:
    """The key of a row of ``doc_id, text, words``."""
    return key_of(F.col("doc_id"), F.col("text"), quality_of(F.col("text"), F.col("words")))


def _ranked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents in drawing order with the words before them in their source; and the sources."""
    rows = stored(
        docs.select("doc_id", "source", "text", words_of(F.col("text")).alias("words"))
        .select("doc_id", "source", size_of(F.col("words")).alias("size"), _key().alias("key")),
        "sizes",
    )
    sources = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    joined = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    joined = joined.withColumn("_id", F.coalesce("doc_id", F.lit(-1)))
    order = ["source_rank", "key", "_id", "size"]
    before = running_total(joined, order, "size", "_all_before")
    return before.withColumn("before", F.col("_all_before") - F.col("source_before")).drop("_all_before"), sources


def _epochs() -> tuple[Column, Column]:
    """Whole passes over a source, and the words that the pass begun after them takes."""
    goal = F.round(F.col("target")).cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    return whole, goal - whole * F.col("source_size")


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row of ``docs(doc_id, text, source)``.

    A source's target is filled by whole epochs; the words still missing come from its documents
    in the order of their keys, the last one in part. So a source's taken words miss its target by
    less than one word. A key is a function of doc_id and text: runs agree, and documents with
    few symbols among their words tend to come first.

    Keys are range-sorted over all sources at once, so a source of any size is spread over
    tasks. Null and empty texts have size 0 and take 0. A null source is a source; a null doc_id is
    kept. Rows equal in all three columns share one place in the order, and which of them is cut is
    open, which the result does not show. Other columns are not read; an empty table gives an empty
    result.
    """
    rows, _ = _ranked(docs)
    whole, rest = _epochs()
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return rows.select("doc_id", "size", "source_size", "target", (whole * F.col("size") + part).alias("taken"))


def draw(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as it takes them, whole, all columns kept, whatever their names.

    Sources are counted first. Few are broadcast; many are joined by a shuffle, with the same rows.

    The document at which a source's target falls is taken once more if that leaves the source nearer
    to its target. Documents are not moved: each source's last key is found on narrow rows, and a
    document's key is worked out again and compared with it. Only rows equal in id and text share a key and go
    together; without ids, different texts do not. Null and empty texts have no words and are taken as often as
    their source is taken whole. A null source is a source; an empty table gives an empty result.
    """
    rows, sources = _ranked(docs)
    _, rest = _epochs()
    last = rows.where((F.col("before") + F.col("size") / 2 <= rest) & (F.col("size") > 0) & (rest > 0)).groupBy(
        "source_rank"
    ).agg(F.max("key").alias("last"))
    plan = sources.join(last, "source_rank", "left").select(
        F.col("source").alias("own"), _epochs()[0].alias("whole"), "last"
    )
    if sources.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES:
        plan = F.broadcast(plan)
    given = docs.select(F.struct("*").alias("given")).select(
        "given", *[F.col(f"given.{x}").alias(x) for x in ("doc_id", "source", "text")],
        words_of(F.col("given.text")).alias("words"),
    ).select("given", "source", _key().alias("key"))
    copies = F.col("whole") + F.when(F.col("key") <= F.col("last"), 1).otherwise(0)
    return (
        given.join(plan, F.col("source").eqNullSafe(F.col("own")))
        .select("given", copies.alias("copies")).where("copies > 0")
        .select("given", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
        .select("given.*")
    )
