"""Repeated passages by content-defined chunks: a gear hash cuts, digests of chunks find copies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cratelake.llm.text import SPACE, Words, flat, map_slices, mix, powers

SPACING = 24  # bytes between cut candidates, on average
NEAREST = 8  # a candidate this close behind another is none
BARE = 128  # a stretch without a cut of more bytes is cut by its own content
STRIDE = 64  # bytes between such cuts, at least
LONGEST = 1024
WINDOW = 16  # bytes the gear hash sees
LEAST_WORDS = 20  # of a run of repeated chunks that counts as a passage

_U = np.uint64
_GEAR = np.random.default_rng(11).integers(0, 2**16, 256, dtype=np.uint16)
_BASE = 0xD6E8FEB86659FD93
_BYTE = np.random.default_rng(12).integers(1, 2**63, 256, dtype=np.uint64)


def _bare(gear: np.ndarray) -> list[int]:
    """Cuts of a stretch without candidates: where its least recurring hash is, ``STRIDE`` apart.

    In a run of one repeated word that is always at the same letter, so that equal runs get equal
    chunks wherever they begin and however long they are. Without a recurring hash the least one
    cuts. Parts that are still long are cut the same way.
    """
    out, todo = [], [(0, len(gear))]
    while todo:
        low, high = todo.pop()
        inner = gear[low + WINDOW:high - 1]
        values, counts = np.unique(inner, return_counts=True)
        value = values[counts > 1].min() if (counts > 1).any() else values[0]
        places = np.flatnonzero(inner == value) + low + WINDOW
        ends, at = [low], 0
        while at < len(places):
            ends.append(int(places[at]))
            at = int(np.searchsorted(places, places[at] + STRIDE))
        out.extend(ends[1:])
        ends.append(high)
        todo.extend((x, y) for x, y in zip(ends, ends[1:]) if y - x > BARE)
    return out


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin, document starts included.

    The gear hash doubles at each byte, so in 16 bits it depends on the last 16 bytes only; it
    is built by doubling window sizes. A place is a candidate by these bytes alone, and stays one
    unless another candidate lies less than ``NEAREST`` before it. So cuts inside a
    passage are the same wherever it stands, but for its first bytes.
    """
    gear = _GEAR[data]
    size = 1
    while size < WINDOW:
        gear[size:] += gear[:-size] << np.uint16(size)
        size *= 2
    at = np.flatnonzero(gear < 65536 // SPACING) + 1
    document = np.searchsorted(offsets, at, "right") - 1
    inside = (at - offsets[document] >= WINDOW) & (at < len(data))
    at = at[inside]
    at = at[np.diff(at, prepend=-NEAREST) >= NEAREST]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins = np.union1d(heads, at)
    ends = np.append(begins[1:], len(data))
    bare = np.flatnonzero(ends - begins > BARE)
    if len(bare):
        begins = np.union1d(begins, np.concatenate([begins[i] + np.array(_bare(gear[begins[i]:ends[i]])) for i in bare]))
    ends = np.append(begins[1:], len(data))
    long = np.flatnonzero(ends - begins > LONGEST)
    if len(long):
        more = [np.arange(begins[i] + LONGEST, ends[i], LONGEST) for i in long]
        begins = np.union1d(begins, np.concatenate(more))
    return begins


def chunked(docs: DataFrame) -> DataFrame:
    """``doc_id, idx, start, length, n_words, digest`` of every chunk; places in characters."""
    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = flat(batch.column("text"))
        begins = cuts(data, offsets)
        ends = np.append(begins[1:], len(data))
        owner = np.searchsorted(offsets, begins, "right") - 1
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=total[1:])
        turned = powers(pow(_BASE, -1, 2**64), len(data) + 1)[begins]
        digest = mix(mix((total[ends] - total[begins]) * turned) ^ (ends - begins).astype(np.uint64))
        places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        words = np.concatenate([[0], np.cumsum(np.bincount(Words(data, offsets, SPACE).starts, minlength=len(data)))])
        first = np.searchsorted(owner, owner, "left")
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(owner)),
                pa.array((np.arange(len(owner)) - first).astype(np.int32)),
                pa.array(places[begins] - places[offsets[owner]]),
                pa.array((places[ends] - places[begins]).astype(np.int32)),
                pa.array((words[ends] - words[begins]).astype(np.int32)),
                pa.array(digest.view(np.int64)),
            ],
            names=["doc_id", "idx", "start", "length", "n_words", "digest"],
        )

    return map_slices(
        docs.where("doc_id is not null").select("doc_id", "text"), cut,
        "doc_id long, idx int, start long, length int, n_words int, digest long",
    )


def repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id, start, end, n_words, first_doc_id, kept``: a row per passage that other documents have.

    A run is of neighbouring chunks whose digests occur in two documents or more, of
    ``least_words`` words or more in all. The smallest doc_id that has a chunk owns it. A run is
    told in a row per stretch whose chunks are all the document's own or all others': ``kept`` says
    that they are its own and stay, so that each repeated chunk stays in its owner. A stretch of others'
    can have fewer words than ``least_words``; one of its own that has stays too, without a row.
    ``start`` and ``end`` count characters, ``first_doc_id`` is the smallest owner in the stretch.

    Only the digest's smallest and largest doc_id are gathered, which is a partial aggregate
    before the shuffle; the chunks then join them on the digest, where a chunk that very
    many documents share is split by size at run time. What goes on is repeated chunks only.

    Null and empty texts have no chunk. Rows with a null doc_id take no part. Rows that repeat a doc_id
    and its text are one document; if their texts differ, chunks are told apart by place only.
    Other columns are not read. An empty table gives an empty result.
    """
    parts = chunked(docs)
    held = parts.groupBy("digest").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    ).where("low < high").select("digest", "low")
    shared = parts.join(held, "digest").select("doc_id", "idx", "start", "length", "n_words", "low").distinct()
    order = Window.partitionBy("doc_id").orderBy("idx", "start", "length", "low")
    own = F.col("low") == F.col("doc_id")
    runs = shared.withColumn("own", own).withColumn("run", F.col("idx") - F.row_number().over(order))
    turned = runs.withColumn("turn", (F.col("own") != F.lag("own", 1, False).over(order)).cast("int"))
    stretches = turned.withColumn("stretch", F.sum("turn").over(order)).groupBy("doc_id", "run", "own", "stretch").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("length")).alias("end"),
        F.sum("n_words").alias("n_words"), F.min("low").alias("first_doc_id"),
    )
    return (
        stretches.withColumn("in_run", F.sum("n_words").over(Window.partitionBy("doc_id", "run")))
        .where(F.when(F.col("own"), F.col("n_words")).otherwise(F.col("in_run")) >= least_words)
        .select("doc_id", "start", "end", "n_words", "first_doc_id", F.col("own").alias("kept"))
    )


def deduplicate(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the passages of ``found`` (from ``repeats``) that are not kept.

    Columns and rows stay; texts without such a passage, and null ones, are unchanged.
    """
    cut = found.where("not kept").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cut")
    )
    names = docs.columns
    joined = docs.join(cut, "doc_id", "left").select(*names, "_cut")
    place = names.index("text")

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, spans in enumerate(batch.column("_cut").to_pylist()):
                if spans and texts[i] is not None:
                    ends = [0, *(s["end"] for s in spans)]
                    begins = [*(s["start"] for s in spans), len(texts[i])]
                    texts[i] = "".join(texts[i][a:b] for a, b in zip(ends, begins))
            columns = [batch.column(x) for x in names]
            columns[place] = pa.array(texts, batch.column("text").type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(shorten, docs.schema)
