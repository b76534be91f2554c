"""Ranked lexical search over an inverted index in document shards, by Block-Max MaxScore.

A shard holds the postings of a bounded stretch of text: per term a compressed list in blocks, the
highest impact of each block and of the list. A query meets a shard's lists from the highest bound
down; once those left cannot lift an unseen document into the best, they only refine candidates,
and a candidate that the maxima of its blocks cannot lift is dropped before any of them is unpacked.
Shards keep heaps, which are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cratelake.llm.store import stored
from cratelake.llm.text import LOWER, Words, flat, slices

SHARD_BYTES = 8 << 20  # text of a shard, at least; a longer text is a shard's last one
BLOCK = 128  # postings
QUERY_TERMS = 200_000  # distinct terms of the queries that are taken together
MOST_TASKS = 20_000  # for the search of a block of queries; each has as many shards as it must
FEW_TERMS = 1_000_000  # distinct terms up to this many are broadcast to find their lists

# Fixed values of the contract: what parts terms, and the letters that are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_GAP = np.ones(256, bool)
_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_BLOCKS = np.dtype([("last", "<u4"), ("at", "<u4"), ("top", "<i8")])
_INDEX = "shard long, term string, df long, top long, blocks binary, payload binary"


def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, the highest bit set but in a number's last; and where each number begins."""
    sizes = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        more = values >> bits > 0
        if not more.any():
            break
        sizes += more
    begins = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(begins[-1], np.uint8)
    for k in range(int(sizes.max(initial=0))):
        some = sizes > k
        out[begins[:-1][some] + k] = (values[some] >> (7 * k)) & 127 | np.where(sizes[some] > k + 1, 128, 0)
    return out, begins


def unpack_numbers(packed: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(packed < 128)
    if len(ends) == len(packed):
        return packed.astype(np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    shift = 7 * (np.arange(len(packed)) - np.repeat(starts, ends - starts + 1))
    return np.add.reduceat((packed & 127).astype(np.int64) << shift, starts)


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def norms(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Each document's m for its number of terms; in unbounded numbers where 64 bits would not do."""
    if 90 * int(n.max(initial=0)) * n_docs < 1 << 63:
        return 10 + (90 * n * n_docs) // max(n_terms, 1)
    return np.array([10 + (90 * int(x) * n_docs) // n_terms for x in n], np.int64)


def _terms(column: pa.Array) -> Words:
    data, offsets = flat(column)
    return Words(LOWER[data], offsets, _GAP)


def statistics(docs: DataFrame) -> tuple[int, int]:
    """How many texts have a term, and how many terms all have."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        for batch in batches:
            for part in slices(batch, "text"):
                counts = _terms(part.column("text")).counts
                n_docs, n_terms = n_docs + int((counts > 0).sum()), n_terms + int(counts.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n_docs]), pa.array([n_terms])], names=["n_docs", "n_terms"])

    found = docs.select("text").mapInArrow(count, "n_docs long, n_terms long").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    return found[0] or 0, found[1] or 0


def invert(shard: int, doc_ids: pa.Array, column: pa.Array, n_docs: int, n_terms: int) -> pa.RecordBatch:
    """The rows of a shard: one per term in order, and first one without a term for its documents."""
    words = _terms(column)
    size, m = len(words.counts), norms(words.counts, n_docs, n_terms)
    lengths = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    body = words.data[~_GAP[words.data]]
    spelled = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words.starts), [None, pa.py_buffer(lengths.astype(np.int64)), pa.py_buffer(body)]
    ).dictionary_encode()
    names = spelled.dictionary
    order = np.asarray(pc.sort_indices(names)).astype(np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    keys = place[spelled.indices.to_numpy().astype(np.int64)] * size + words.documents()
    keys.sort()
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    tf = np.diff(np.append(heads, len(keys)))
    term, doc = np.divmod(keys[heads], max(size, 1))
    first = np.searchsorted(term, np.arange(len(order) + 1))  # each list's first posting
    f = impacts(tf, m[doc])
    at_head = np.zeros(len(doc), bool)
    at_head[first[:-1]] = True
    gaps = np.diff(doc, prepend=-1) - 1
    gaps[at_head] = doc[at_head]
    packed, begins = pack_numbers(np.stack([gaps, tf - 1], 1).ravel())
    begins = begins[::2]
    within = np.arange(len(doc)) - np.repeat(first[:-1], np.diff(first))
    starts = np.flatnonzero(within % BLOCK == 0)
    blocks = np.zeros(len(starts), _BLOCKS)
    if len(starts):
        blocks["last"] = doc[np.append(starts[1:], len(doc)) - 1]
        blocks["at"] = begins[starts] - begins[first[term[starts]]]
        blocks["top"] = np.maximum.reduceat(f, starts)
    tops = np.maximum.reduceat(f, first[:-1]) if len(order) else f
    own = np.searchsorted(starts, first) * _BLOCKS.itemsize
    valid = np.asarray(doc_ids.is_valid())
    ids = doc_ids.cast(pa.int64()).fill_null(0).to_numpy()
    about = [ids.astype("<i8").tobytes() + m.astype("<i8").tobytes() + valid.astype(np.uint8).tobytes()]
    lists = lambda where, buffer: pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(order), [None, pa.py_buffer(where.astype(np.int64)), pa.py_buffer(buffer)]
    ).cast(pa.binary())
    join = lambda head, rest: pa.concat_arrays([head, rest])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(order) + 1, shard)),
            join(pa.array([""]), names.take(pa.array(order)).cast(pa.binary()).cast(pa.string())),
            join(pa.array([size], pa.int64()), pa.array(np.diff(first).astype(np.int64))),
            join(pa.array([0], pa.int64()), pa.array(tops.astype(np.int64))),
            join(pa.array([b""], pa.binary()), lists(own, blocks)),
            join(pa.array(about, pa.binary()), lists(begins[first], packed)),
        ],
        names=["shard", "term", "df", "top", "blocks", "payload"],
    )


@dataclass(frozen=True)
class Index:
    """The stored lists and the two numbers all scores need."""

    table: DataFrame
    n_docs: int
    n_terms: int
    n_shards: int


def build(docs: DataFrame) -> Index:
    """Index of every row's whole text; shards are cut and inverted where the rows lie, without a shuffle."""
    n_docs, n_terms = statistics(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, size = TaskContext.get().partitionId() << 32, [], 0

        def closed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            ids, text = (table[x].chunk(0) for x in ("doc_id", "text"))
            return invert(shard, ids, text, n_docs, n_terms)

        for batch in batches:
            for part in slices(batch, "text"):
                held.append(part)
                size += part.column("text").nbytes
                if size >= SHARD_BYTES:
                    yield closed()
                    shard, held, size = shard + 1, [], 0
        if held:
            yield closed()

    table = stored(docs.select("doc_id", "text").mapInArrow(run, _INDEX), "lists")
    return Index(table, n_docs, n_terms, table.where("term = ''").count())


class PostingList:
    """One term's postings in a shard."""

    def __init__(self, weight: int, df: int, top: int, blocks: bytes, payload: bytes):
        self.weight, self.bound, self.df = weight, weight * top, df
        self.blocks = np.frombuffer(blocks, _BLOCKS)
        self.payload = np.frombuffer(payload, np.uint8)

    def read(self, m: np.ndarray, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents and weighted impacts of all blocks, or of those numbered in ``some``."""
        if some is None or len(some) == len(self.blocks):
            some, packed = np.arange(len(self.blocks)), self.payload
        else:
            ends = np.append(self.blocks["at"][1:], len(self.payload))
            packed = np.concatenate([self.payload[self.blocks["at"][b]:ends[b]] for b in some])
        pairs = unpack_numbers(packed).reshape(-1, 2)
        sizes = np.minimum(BLOCK, self.df - BLOCK * some)
        before = np.where(some > 0, self.blocks["last"][some - 1].astype(np.int64), -1)
        docs = np.cumsum(pairs[:, 0] + 1)
        first = np.cumsum(sizes) - sizes
        docs += np.repeat(before - np.concatenate([[0], docs[first[1:] - 1]]), sizes)
        return docs, self.weight * impacts(pairs[:, 1] + 1, m[docs])

    def blocks_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block each document would be in, and the most it can add there; none adds nothing."""
        at = np.searchsorted(self.blocks["last"], docs)
        inside = at < len(self.blocks)
        return np.where(inside, at, -1), np.where(inside, self.weight * self.blocks["top"][np.minimum(at, len(self.blocks) - 1)], 0)


def best_of_shard(lists: list[PostingList], m: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores of the shard that hold all its ``k`` best, ties of the last included.

    Nothing below ``least``, the score a document needs to matter elsewhere, has to be found.
    """
    lists = sorted(lists, key=lambda x: -x.bound)
    left = np.append(np.cumsum([x.bound for x in lists][::-1])[::-1], 0)  # what lists i and on can add
    total = np.zeros(len(m), np.int64)
    least, top = max(least, 1), 0
    for i, own in enumerate(lists):
        if left[i] < least:
            break
        docs, added = own.read(m)
        total[docs] += added
        top = max(top, int(total[docs].max()))
        if k < len(m) and top > max(least, left[i + 1]):  # otherwise the k-th best says nothing yet
            least = max(least, int(np.partition(total, len(m) - k)[len(m) - k]))
    else:
        i = len(lists)
    found = np.flatnonzero((total > 0) & (total + left[i] >= least))
    rest = lists[i:]
    where = [x.blocks_of(found) for x in rest]
    hope = sum((most for _, most in where), np.zeros(len(found), np.int64))
    alive = total[found] + hope >= least
    for own, (at, most) in zip(rest, where):
        hope = hope - most
        needed = np.unique(at[alive & (at >= 0)])
        if len(needed):
            docs, added = own.read(m, needed)
            total[docs] += added
        if alive.sum() > k:
            least = max(least, int(np.partition(total[found[alive]], -k)[-k]))
        alive &= total[found] + hope >= least
    return found[alive], total[found[alive]]


class Heap:
    """The ``k`` best of one query so far: highest score, then lowest id, ids that are null last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def least(self) -> int:
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> None:
        if len(scores) > self.k:
            order = np.lexsort((ids, ~valid, -scores))[:self.k]
            scores, ids, valid = scores[order], ids[order], valid[order]
        new = [(-s, not v, i) for s, i, v in zip(scores.tolist(), ids.tolist(), valid.tolist())]
        self.rows = sorted(self.rows + new)[:self.k]


def _search_block(lists: DataFrame, tasks: int, queries: list[tuple[str, list[str], list[int]]], k: int) -> DataFrame:
    """``query, doc_id, score``: the best of each task's shards for each of the given queries.

    The work follows the shards, not the bytes of their lists, so the number of tasks is set.
    """
    shared = lists.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = [Heap(k) for _ in shared.value]

        def close(rows: dict[str, tuple]) -> None:
            size, _, _, about = rows.pop("")
            ids, m = np.frombuffer(about, "<i8", 2 * size).reshape(2, size)
            valid = np.frombuffer(about, np.uint8, size, 16 * size) > 0
            for heap, (_, terms, weights) in zip(heaps, shared.value):
                own = [PostingList(w, *rows[t]) for t, w in zip(terms, weights) if t in rows]
                if own:
                    docs, scores = best_of_shard(own, m, k, heap.least())
                    heap.add(scores, ids[docs], valid[docs])

        rows, shard = {}, None
        for batch in batches:
            for at, term, *row in zip(*(batch.column(x).to_pylist() for x in ("shard", "term", "df", "top", "blocks", "payload"))):
                if at != shard and rows:
                    close(rows)
                    rows = {}
                shard = at
                rows[term] = tuple(row)
        if rows:
            close(rows)
        out = [(q, None if null else i, -s) for (q, _, _), heap in zip(shared.value, heaps) for s, null, i in heap.rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[j] for x in out], pa.int64() if j else pa.string()) for j in range(3)], names=["query", "doc_id", "score"]
        )

    return lists.repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(run, "query string, doc_id long, score long")


def _weighted(index: Index, queries: DataFrame) -> DataFrame:
    """``query, item_id, term, weight`` of every query's distinct terms that the index has."""
    lower = F.translate("text", UPPER, LOW)
    asked = (
        queries.select("item_id", F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term")).distinct()
        .withColumn("query", F.to_json(F.struct("item_id")))
    )
    terms = asked.select("term").distinct()
    df = index.table.select("term", "df").join(_listed(terms), "term").groupBy("term").agg(F.sum("df").alias("df"))
    # In doubles, as the contract has it.
    ratio = F.lit(2.0 * index.n_docs + 2.0) / (2.0 * F.col("df") + 1.0)
    return asked.join(df, "term").select(
        "query", "item_id", "term", F.floor(1000.0 * F.log(ratio)).cast("long").alias("weight")
    ).where("weight > 0")


def _listed(terms: DataFrame) -> DataFrame:
    few = terms.limit(FEW_TERMS + 1).count() <= FEW_TERMS
    return F.broadcast(terms) if few else terms


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each of ``queries(item_id, text)``.

    Only scores above 0 count; equal ones go by doc_id, null last. Rows that share an item_id are one
    query of all their terms; a query without a known term has no row. Repeated documents are ranked each. Null,
    empty and termless texts match nothing. An empty index or query table gives an empty result.

    Queries are taken in blocks of a bounded number of terms, each against all shards; a block is broadcast, and only its
    terms' lists are read and moved, all lists of a shard to one task. A task keeps one heap per query over its shards.
    """
    spark: SparkSession = queries.sparkSession
    weighted = stored(_weighted(index, queries), "asked")
    blocks = max(1, -(-weighted.count() // QUERY_TERMS))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks))
    found = spark.createDataFrame([], "query string, doc_id long, score long")
    for b in range(blocks):
        own = weighted.where(block == b)
        given = own.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms")).toArrow()
        listed = [
            (q, [x["term"] for x in terms], [x["weight"] for x in terms])
            for q, terms in zip(given["query"].to_pylist(), given["terms"].to_pylist())
        ]
        if listed:
            needed = _listed(own.select("term").distinct().unionByName(spark.createDataFrame([("",)], "term string")))
            lists = index.table.join(needed, "term", "left_semi")
            found = found.unionByName(_search_block(lists, max(1, min(index.n_shards, MOST_TASKS)), listed, k))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    named = weighted.select("query", "item_id").distinct()
    return best.join(named, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
