"""Near-duplicates by b-bit MinHash: bands propose, packed low bits estimate, full sets decide."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratelake.llm.components import components
from cratelake.llm.store import stored
from cratelake.llm.text import LOWER, SHINGLE, Words, flat, map_slices, mix, shingles

BAND_ROWS = 6
MISS = 1e-6  # chance that no band of a pair at the threshold agrees
BITS = 2  # low bits kept of each minimum
MINIMA = 1024  # of a signature
PER_LONG = 64 // BITS
SIGMAS = 4  # how far below the threshold an estimate may lie before the pair is left out
HUBS = 2
SIGNED_ROWS = 1_000  # short texts whose minima are held at a time

_U = np.uint64


def band_count(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log1p(-threshold ** BAND_ROWS))


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles, their number and the set's 64-bit name per document; words per document."""
    data, offsets = flat(column)
    words = Words(LOWER[data], offsets)
    values, counts = shingles(words)
    names = np.zeros(len(counts), np.uint64)
    some = counts > 0
    if some.any():
        begins = (np.cumsum(counts) - counts)[some]
        total = np.add.reduceat(mix(values), begins)
        turned = np.add.reduceat(mix(~values), begins)
        names[some] = mix(total ^ mix(turned ^ counts[some].astype(np.uint64)))
    return values, counts, names, words.counts


def _minima(values: np.ndarray, counts: np.ndarray, many: int, seed: int) -> np.ndarray:
    """The least value of each set, empty ones left out, under each of ``many`` hash functions."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(1, 2**63, many, dtype=np.uint64) * _U(2) + _U(1)
    turn = rng.integers(1, 2**63, many, dtype=np.uint64)
    some = np.flatnonzero(counts)
    minima = np.zeros((many, len(some)), np.uint64)
    if len(some):
        begins = (np.cumsum(counts) - counts)[some]
        room = np.empty_like(values)
        for i in range(many):
            np.bitwise_xor(values, turn[i], out=room)
            np.multiply(room, factor[i], out=room)
            np.minimum.reduceat(room, begins, out=minima[i])
    return minima


def _lists(rows: np.ndarray, filled: np.ndarray) -> pa.Array:
    """A list for each document: the next column of ``rows``, or nothing if it is not ``filled``."""
    ends = np.concatenate([[0], np.cumsum(np.where(filled, len(rows), 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(rows.T.reshape(-1).view(np.int64)))


def digest_of(text: Column) -> Column:
    """A text's 96-bit name, of two hash functions, which with the doc_id tells rows apart unless both are equal."""
    return F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"))


def sketch(docs: DataFrame, bands: int) -> DataFrame:
    """``doc_id, digest, n_shingles, cls, bands``: each row's text's name, size of its set, the set's name, a hash per band.

    Documents with the same set of shingles have the same ``cls``; it is null for an empty set.
    """
    def sketched(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, counts, names, _ = _sets(batch.column("text"))
        minima = _minima(values, counts, bands * BAND_ROWS, 1)
        band = np.zeros((bands, minima.shape[1]), np.uint64)
        for i, row in enumerate(minima):
            band[i // BAND_ROWS] = mix(band[i // BAND_ROWS] ^ row) + _U(i)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()), batch.column("digest"), pa.array(counts.astype(np.int64)),
                pa.array(names.view(np.int64), mask=counts == 0), _lists(band, counts > 0),
            ],
            names=["doc_id", "digest", "n_shingles", "cls", "bands"],
        )

    return map_slices(
        docs.select("doc_id", digest_of(F.col("text")).alias("digest"), "text"), sketched,
        "doc_id long, digest struct<a:long,b:int>, n_shingles long, cls long, bands array<long>",
    )


def signatures(texts: DataFrame) -> DataFrame:
    """``cls, n_shingles, sig`` of ``texts(cls, text)``: low bits of minima, packed into longs."""
    def signed(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, counts, names, _ = _sets(batch.column("text"))
        low = mix(_minima(values, counts, MINIMA, 2)) & _U(2**BITS - 1)
        packed = np.zeros((MINIMA // PER_LONG, low.shape[1]), np.uint64)
        for i, row in enumerate(low):
            packed[i // PER_LONG] |= row << _U(BITS * (i % PER_LONG))
        fine = (names.view(np.int64) == batch.column("cls").to_numpy()) & (counts > 0)
        return pa.RecordBatch.from_arrays(
            [batch.column("cls"), pa.array(counts.astype(np.int64)), _lists(packed, counts > 0)],
            names=["cls", "n_shingles", "sig"],
        ).filter(pa.array(fine))

    return map_slices(texts, signed, "cls long, n_shingles long, sig array<long>", rows=SIGNED_ROWS)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from equal cells of two packed signatures, less those equal by chance."""
    ones = sum(1 << (BITS * i) for i in range(PER_LONG))
    differ = F.lit(0)
    for i in range(MINIMA // PER_LONG):
        x = a.getItem(i).bitwiseXOR(b.getItem(i))
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(ones)))
    chance = 2.0**-BITS
    return ((F.lit(1.0) - differ / MINIMA) - chance) / (1 - chance)


def _close(a_n: Column, b_n: Column, percent: int) -> Column:
    """Sets whose sizes alone do not rule the link out."""
    return F.least(a_n, b_n) * 100 >= F.greatest(a_n, b_n) * percent


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the threshold; each task compares texts it got."""
    first = texts.select(F.col("cls").alias("a"), F.col("text").alias("text"))
    second = texts.select(F.col("cls").alias("b"), F.col("text").alias("other"))

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        sides = []
        for name in ("text", "other"):
            values, counts, names, _ = _sets(batch.column(name))
            sides.append((np.split(values, np.cumsum(counts)[:-1]), names.view(np.int64)))
        a, b = (batch.column(x).to_numpy(zero_copy_only=False) for x in "ab")
        keep = (sides[0][1] == a) & (sides[1][1] == b)
        for i in np.flatnonzero(keep):
            x, y = sides[0][0][i], sides[1][0][i]
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
        return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return map_slices(
        pairs.join(first, "a").join(second, "b").select("a", "b", "text", "other"), compare,
        "a long, b long",
    )


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text)``.

    Documents whose sets of distinct five-word shingles have a similarity of ``percent`` or more
    are linked, and ``component_id`` is the smallest doc_id that links reach.

    Null or empty texts, and texts of white space, have no shingle and are linked with nothing;
    their component is their doc_id. A null doc_id never names a component: its row takes the
    smallest doc_id it reaches, or null. Repeated rows count as copies. Other columns are not
    read. An empty table gives an empty result. Sets are named by 64-bit hashes.
    """
    rows, named = grouped(docs, percent)
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    owner = named.join(smallest, "label").select("cls", "component_id")
    return rows.select("doc_id", "n_shingles", "cls").join(owner, "cls", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def grouped(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, digest, n_shingles, cls`` of every row, and ``cls, doc_id, label`` of every set: its component.

    Rows with equal sets are one class, found by a minimum per set, and only classes go on.
    In each bucket of each band members are compared with two hubs, never with each other:
    what agrees is merged at once. Then the buckets that still hold two components or more
    are searched in full for pairs across components, with the packed signatures as part of
    the join's condition. So a link is missed only if no band agrees (one in a million at the
    threshold) or its estimate is off by four standard deviations, and only if no other path
    joins its ends. Every link is confirmed on the full sets of both texts. A class's text is that of
    its first row by doc_id and digest, fetched by both, so that rows without an id are told apart.
    """
    threshold = percent / 100
    bands = band_count(threshold)
    rows = stored(sketch(docs, bands), "sketch")
    known = rows.where("n_shingles > 0")
    classes = stored(
        known.select("cls", "bands").dropDuplicates(["cls"])
        .join(known.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.min(_place()).alias("place")), "cls"),
        "classes",
    )
    placed = classes.select("cls", F.explode("bands").alias("bucket"))
    turns = [0x5DEECE66D * (2 * i + 1) * 0x9E3779B1 % 2**62 for i in range(HUBS)]
    groups = placed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"),
        *[F.min(F.col("cls").bitwiseXOR(F.lit(t))).alias(f"hub{i}") for i, t in enumerate(turns)],
    ).where("size > 1")
    shared = stored(
        placed.join(groups, "bucket").select(
            "bucket", "cls",
            F.array(*[F.col(f"hub{i}").bitwiseXOR(F.lit(t)) for i, t in enumerate(turns)]).alias("hubs"),
        ),
        "shared",
    )
    needed = shared.select("cls").distinct()
    texts = stored(
        classes.join(needed, "cls", "left_semi").select(
            "cls", F.col("place.doc_id").alias("own"), F.col("place.digest").alias("own_digest"))
        .join(
            docs.select("doc_id", digest_of(F.col("text")).alias("digest"), "text"),
            F.col("own").eqNullSafe(F.col("doc_id")) & (F.col("own_digest") == F.col("digest")),
        )
        .select("cls", "text").dropDuplicates(["cls", "text"]),
        "texts",
    )
    marks = stored(signatures(texts).dropDuplicates(["cls"]), "marks")

    def side(name: str) -> DataFrame:
        return marks.select(
            F.col("cls").alias(name), F.col("n_shingles").alias(f"{name}_n"),
            F.col("sig").alias(f"{name}_sig"),
        )

    spokes = (
        shared.select("cls", F.explode("hubs").alias("hub")).where("cls <> hub")
        .select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()
        .join(side("a"), "a").join(side("b"), "b")
        .where(_close(F.col("a_n"), F.col("b_n"), percent)
               & (estimate(F.col("a_sig"), F.col("b_sig")) >= threshold - 0.02))
        .select("a", "b")
    )
    found = stored(_confirmed(spokes, texts, percent), "found")
    label = components(found).select(F.col("node").alias("cls"), "label")
    labelled = shared.select("bucket", "cls").join(label, "cls", "left").select(
        "bucket", "cls", F.coalesce("label", "cls").alias("label")
    )
    labelled = stored(labelled, "labelled")
    still = labelled.groupBy("bucket").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    ).where("low <> high").select("bucket")
    ahead = labelled.join(still, "bucket", "left_semi").join(marks, "cls").join(classes.select("cls", "bands"), "cls")
    ahead = stored(ahead.select("bucket", "label", "cls", "n_shingles", "sig", "bands"), "ahead")
    chance = threshold + (1 - threshold) / 2**BITS
    slack = SIGMAS * math.sqrt(chance * (1 - chance) / MINIMA) / (1 - 2.0**-BITS)
    x, y = ahead.alias("x"), ahead.alias("y")
    across = (
        x.join(
            y,
            (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.label") < F.col("y.label"))
            & _close(F.col("x.n_shingles"), F.col("y.n_shingles"), percent)
            & (estimate(F.col("x.sig"), F.col("y.sig")) >= threshold - slack)
            # Of the buckets that both are in, only the first gives the pair.
            & (F.array_intersect(F.col("x.bands"), F.col("y.bands"))[0] == F.col("x.bucket")),
        )
        .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
    )
    rest = stored(_confirmed(across, texts, percent), "rest")
    if not rest.isEmpty():
        label = components(found.union(rest)).select(F.col("node").alias("cls"), "label")
    named = classes.select("cls", "doc_id").join(label, "cls", "left").select(
        "cls", "doc_id", F.coalesce("label", "cls").alias("label")
    )
    return rows, stored(named, "named")


def _place() -> Column:
    """Order of rows: by doc_id, null last, then by digest."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")


def one_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: its first by doc_id, null last, then by text digest.

    Every row is judged by its own text, so rows that share a doc_id, or have none, stay if their
    texts are in no common group. Of rows equal in doc_id and text one stays, the least of all columns. Rows without
    a word are in no group and all stay. Columns may have any names; an empty table gives an empty result.
    """
    rows, named = grouped(docs, percent)
    known = rows.where("n_shingles > 0")
    # First rows are found class by class, so that a group's copies are not gathered by its label.
    sets = stored(named.select("cls", "label").join(known.groupBy("cls").agg(F.min(_place()).alias("first")), "cls"), "sets")
    best = sets.groupBy("label").agg(F.min("first").alias("best"))
    first = sets.join(best, "label").select("cls", F.col("best.doc_id").alias("own"), F.col("best.digest").alias("own_digest"))
    stays = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("own_digest"))
    gone = known.join(stored(first, "first"), "cls").where(~stays).select("doc_id", "digest").distinct()
    twice = stored(known.groupBy("doc_id", "digest").count().where("count > 1").select("doc_id", "digest"), "twice")
    given = docs.select(F.struct("*").alias("given")).select(
        "given", F.col("given.doc_id").alias("id"), digest_of(F.col("given.text")).alias("name")
    )

    def same(other: DataFrame) -> Column:
        return given["id"].eqNullSafe(other["doc_id"]) & (given["name"] == other["digest"])

    left = given.join(gone, same(gone), "left_anti")
    if twice.isEmpty():
        return left.select("given.*")
    # A group is worked out before its shuffle, a row per task, so it may be a large part of the table.
    again = left.join(twice, same(twice), "left_semi").groupBy("id", "name").agg(F.min("given").alias("given"))
    return left.join(twice, same(twice), "left_anti").select("given.*").union(again.select("given.*"))
