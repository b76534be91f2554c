"""Nearest neighbours by p-stable hashing: each table is probed bucket by bucket, likeliest first."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cratelake.llm.store import stored
from cratelake.llm.text import mix

TABLES = 3
PROJECTIONS = 3
WIDTH = 1.5  # of a bucket, in standard deviations of a projection
PROBES = 14  # buckets a query visits in each table, of 3**PROJECTIONS
FIT_ROWS = 2_000  # vectors the scale is taken from, at most
BLOCK = 4_096  # vectors, and queries, that one task compares at a time, about

_U = np.uint64


@dataclass
class Index:
    """Projections of every table; ``scale`` makes a bucket's width one."""

    tables: int
    projections: int
    probes: int
    scale: float

    def places(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Projections in bucket widths, the table's shift added."""
        rng = np.random.default_rng([table, vectors.shape[1]])
        lines = rng.standard_normal((vectors.shape[1], self.projections))
        return vectors @ lines / self.scale + rng.random(self.projections)

    @staticmethod
    def names(cells: np.ndarray, dimension: int) -> np.ndarray:
        """A bucket's 64-bit name from its cell, and from the vectors' dimension."""
        name = np.full(cells.shape[:-1], dimension, np.uint64)
        for i in range(cells.shape[-1]):
            name = mix(name ^ cells[..., i].astype(np.int64).view(np.uint64))
        return name.view(np.int64)

    def probed(self, places: np.ndarray, dimension: int) -> np.ndarray:
        """Names of the buckets to visit, likeliest first.

        A neighbour lies in the cell a step aside the less likely the farther that cell's border
        is; squared distances to the crossed borders add up to the score of a set of steps.
        """
        cell = np.floor(places).astype(np.int64)
        inside = places - cell
        steps = np.array(list(itertools.product((-1, 0, 1), repeat=self.projections)))
        border = np.stack([inside**2, np.zeros_like(inside), (1 - inside) ** 2], -1)
        cost = sum(border[:, i][:, steps[:, i] + 1] for i in range(self.projections))
        best = np.argsort(cost, 1, kind="stable")[:, :self.probes]
        return self.names(cell[:, None] + steps[best], dimension)


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and vectors, by dimension."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    begins = np.cumsum(sizes) - sizes
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out.append((rows, flat[begins[rows][:, None] + np.arange(d)]))
    return out


def usable(vectors: DataFrame, name: str = "embedding") -> DataFrame:
    """Rows with an id and a vector that is not null, empty, zero, or with a null or non-finite part."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.where(
        F.col("vec_id").isNotNull() & F.col(name).isNotNull()
        & F.coalesce(F.forall(name, fine) & F.exists(name, lambda x: x != 0), F.lit(False))
    )


def fit(vectors: DataFrame) -> Index:
    """Bucket width from the spread of at most ``FIT_ROWS`` vectors, chosen by a hash."""
    rows = vectors.select("embedding").orderBy(F.xxhash64("embedding")).limit(FIT_ROWS).toArrow()
    parts = _matrix(rows["embedding"].combine_chunks()) if len(rows) else []
    spread = [((x - x.mean(0)) ** 2).sum(1).mean() for _, x in parts if len(x) > 1]
    scale = float(np.sqrt(np.mean(spread))) if spread else 1.0
    return Index(TABLES, PROJECTIONS, PROBES, WIDTH * (scale or 1.0))


def _hashed(classes: DataFrame, index: Index, probe: bool) -> DataFrame:
    """A row per table and bucket of each vector: its own bucket, or those it probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _matrix(batch.column("embedding")):
                taken = batch.take(pa.array(rows))
                for table in range(index.tables):
                    places = index.places(x, table)
                    if probe:
                        names = index.probed(places, x.shape[1])
                    else:
                        names = index.names(np.floor(places).astype(np.int64), x.shape[1])[:, None]
                    many = names.shape[1]
                    at = pa.array(np.repeat(np.arange(len(x)), many))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), table, np.int32)), pa.array(names.reshape(-1)),
                         *(c.take(at) for c in taken.columns)],
                        names=["tab", "bucket", *taken.schema.names],
                    )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"tab int, bucket long, {kinds}")


def _compare(limit: int):
    """The nearest ``limit`` classes to each query within one block, by exact distance."""
    def run(keys: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if len(left) and len(right):
            x = np.stack(left["embedding"].to_numpy(zero_copy_only=False)).astype(np.float64)
            y = np.stack(right["embedding"].to_numpy(zero_copy_only=False)).astype(np.float64)
            cls, first = left["cls"].to_numpy(), left["first"].to_numpy()
            query = right["query"].to_numpy()
            norm = (x**2).sum(1)
            for low in range(0, len(y), 256):
                part = y[low:low + 256]
                near = norm[None] - 2 * part @ x.T + (part**2).sum(1)[:, None]
                top = min(limit, len(x)) - 1
                # What rounding could have moved stays in until distances are exact.
                bar = np.partition(near, top, 1)[:, top] + 1e-9 * (norm.max() + 1)
                for i, row in enumerate(near):
                    at = np.flatnonzero(row <= bar[i])
                    exact = np.sqrt(((x[at] - part[i]) ** 2).sum(1))
                    best = np.lexsort((first[at], exact))[:limit]
                    out[0].extend([query[low + i]] * len(best))
                    out[1].extend(cls[at[best]])
                    out[2].extend(first[at[best]])
                    out[3].extend(exact[best])
        return pa.table({
            "query": pa.array(out[0], pa.int64()), "cls": pa.array(out[1], pa.int64()),
            "first": pa.array(out[2], pa.int64()), "score": pa.array(out[3], pa.float64()),
        })

    return run


def _search(index_rows: DataFrame, probes: DataFrame, limit: int) -> DataFrame:
    """The nearest classes found in the buckets ``probes`` names, at most ``limit`` a query."""
    where = ["tab", "bucket"]
    n = index_rows.groupBy(*where).agg(F.count(F.lit(1)).alias("n"))
    q = probes.groupBy(*where).agg(F.count(F.lit(1)).alias("q"))
    sizes = n.join(q, where).select(
        *where, F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"), F.ceil(F.col("q") / BLOCK).cast("int").alias("qparts")
    )
    sizes = stored(sizes, "sizes")
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = (
        index_rows.join(sizes, where)
        .withColumn("part", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("parts")).cast("int"))
        .select(*where, "part", spread("qparts").alias("qpart"), "cls", "first", "embedding")
    )
    right = (
        probes.join(sizes, where)
        .withColumn("qpart", F.pmod(F.xxhash64("query", F.lit(2)), F.col("qparts")).cast("int"))
        .select(*where, spread("parts").alias("part"), "qpart", "query", "embedding")
    )
    block = [*where, "part", "qpart"]
    found = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(
        _compare(limit), "query long, cls long, first long, score double"
    )
    rank = Window.partitionBy("query").orderBy("score", "first", "cls")
    return (
        found.distinct().withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= limit).drop("_rank")
    )


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, index: Index | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of ``vectors`` found for each of ``queries``.

    Both have ``vec_id`` and ``embedding``. A query's own vec_id is no candidate for it. ``score``
    is the Euclidean distance of the original vectors in double precision; equal ones go by smaller
    vec_id. Vectors that are null, empty, zero or hold a null or non-finite part take no part,
    nor do rows without an id; vectors of different length are never compared.

    Equal vectors are one class that keeps its ``k + 1`` smallest ids, which is all that ties can
    ask for; so a vector that very many rows share is compared once. Queries with equal
    vectors search once. Each table has every class in one bucket. Buckets and the queries that
    probe them are dealt out in blocks of bounded size and compared there; only the best of a
    block go on. A query with fewer than ``k`` rows found visits all buckets of one table, so it gets all
    candidates there are, if these are fewer. Repeated rows (same id and vector) count once.
    Other columns are not read; empty tables give an empty result.
    """
    clean = usable(vectors.select("vec_id", "embedding")).distinct()
    asked = usable(queries.select("vec_id", "embedding")).distinct()
    index = index or fit(clean)
    limit = k + 1
    rank = Window.partitionBy("embedding").orderBy("vec_id")
    classes = stored(
        clean.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= limit)
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.xxhash64("embedding").alias("cls"), F.col("ids")[0].alias("first"), "ids", "embedding"),
        "classes",
    )
    wanted = stored(asked.select("vec_id", F.xxhash64("embedding").alias("query"), "embedding"), "queries")
    distinct = wanted.select("query", "embedding").dropDuplicates(["query"])
    placed = stored(_hashed(classes.select("cls", "first", "embedding"), index, False), "placed")
    probes = stored(_hashed(distinct, index, True), "probes")
    found = stored(_search(placed, probes, limit), "found")
    ids = classes.select("cls", "ids")

    def listed(found: DataFrame) -> DataFrame:
        near = found.join(ids, "cls").select("query", "score", F.explode("ids").alias("vec_id"))
        order = Window.partitionBy("query").orderBy("score", "vec_id")
        near = near.distinct().withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit)
        own = wanted.select("query", F.col("vec_id").alias("query_id"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return (
            own.join(near.drop("_rank"), "query").where("query_id <> vec_id")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "query")
        )

    first = stored(listed(found), "first")
    short = (
        wanted.join(first.groupBy(F.col("query_id").alias("vec_id")).count(), "vec_id", "left")
        .where(F.coalesce("count", F.lit(0)) < k).select("query", "embedding").dropDuplicates(["query"])
    )
    short = stored(short, "short")
    if short.isEmpty():
        return first.drop("query")
    length = F.size("embedding").alias("length")
    buckets = placed.where("tab = 0").select("tab", "bucket", length).distinct()
    every = short.select("query", "embedding", length).join(buckets, "length").select("tab", "bucket", "query", "embedding")
    every = stored(every, "every")
    again = listed(_search(placed.where("tab = 0"), every, limit))
    again = again.join(short.select("query"), "query", "left_semi")
    kept = first.join(short.select("query"), "query", "left_anti")
    return kept.select(*first.columns).union(again.select(*first.columns)).drop("query")
