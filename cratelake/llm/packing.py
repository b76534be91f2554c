"""Packing along a Hilbert curve: neighbouring documents share sequences, cut without gaps."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cratelake.llm.prefix import running_total
from cratelake.llm.store import stored
from cratelake.llm.text import LOWER, Words, flat, give_back, mix, slices
from cratelake.llm.tokens import ByteLevel, Memo, byte_level, joined, pieces

LENGTH = 2048
END = 1  # id after each document
DIMENSIONS = 4
ORDER = 10  # bits per dimension
OUT_ROWS = 2_000
TOKEN_BYTES = 4 << 20  # of text tokenized at a time; the more, the fewer pieces are met again

_U = np.uint64


def hilbert(points: np.ndarray, bits: int = ORDER) -> np.ndarray:
    """Place on the Hilbert curve of each row of whole numbers below ``2**bits``.

    From the highest bit down, what lower bits mean is turned by the bits above (an exchange
    with the first axis, or its reversal); the turned axes are then read as a Gray code.
    """
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        below = _U((1 << level) - 1)
        for i in range(n):
            on = (x[i] >> _U(level)) & _U(1) == 1
            swap = np.where(on, _U(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(on, below, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> _U(level)) & _U(1) == 1, _U((1 << level) - 1), _U(0))
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << _U(1)) | ((x[i] >> _U(level)) & _U(1))
    return key


def curve_keys(column: pa.Array) -> np.ndarray:
    """Hilbert keys of texts: words hashed to signs, summed per dimension, squashed to a grid."""
    data, offsets = flat(column)
    words = Words(LOWER[data], offsets)
    hashes = mix(words.hashes() ^ _U(5))
    grid = np.zeros((len(words.counts), DIMENSIONS), np.int64)
    root = np.sqrt(np.maximum(words.counts, 1))
    for d in range(DIMENSIONS):
        sign = 1 - 2 * ((hashes >> _U(d)) & _U(1)).astype(np.int64)
        total = np.concatenate([[0], np.cumsum(sign)])
        share = 1 / (1 + np.exp(-(total[words.first[1:]] - total[words.first[:-1]]) / root))
        grid[:, d] = np.minimum(share * (1 << ORDER), (1 << ORDER) - 1)
    return hilbert(grid)


@functools.lru_cache(1)
def encoder(vocabulary: str | None) -> Memo:
    """Ids of pieces of text as bytes, by the vocabulary's ``tokenizers`` file, kept per Python worker.

    A special token's string in a text is that token, as the file has it.
    """
    return Memo(byte_level(vocabulary).packed_ids)


def tokenized(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``uid, doc_id, key, n, ids``: token ids of each row's text with the end id, two bytes each, or four for large vocabularies."""
    def coded(part: pa.RecordBatch, uid: int, model: ByteLevel, encode: Memo) -> pa.RecordBatch:
        end, width = np.array([END], model.width).tobytes(), np.dtype(model.width).itemsize
        found, first = pieces(*flat(part.column("text")), model.inner)
        distinct = found.dictionary_encode()
        values = [*encode(distinct.dictionary.to_pylist()), end]
        count = len(part)
        codes = np.insert(distinct.indices.to_numpy().astype(np.int64), first[1:], len(values) - 1)
        body, begins = joined(values, codes)
        at = begins[first + np.arange(count + 1)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(uid, uid + count)), part.column("doc_id").cast(pa.int64()),
                pa.array(np.concatenate([curve_keys(x.column("text")) for x in slices(part, "text")]).astype(np.int64)),
                pa.array(np.diff(at) // width),
                pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), count, [None, pa.py_buffer(at), pa.py_buffer(body)]).cast(pa.binary()),
            ],
            names=["uid", "doc_id", "key", "n", "ids"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, encode = byte_level(vocabulary), encoder(vocabulary)
        uid = TaskContext.get().partitionId() << 40
        encode.clear()  # what a worker keeps between tasks would stay through later stages
        for batch in batches:
            for part in slices(batch, "text", TOKEN_BYTES):
                yield coded(part, uid, model, encode)
                uid += len(part)
            give_back()
        encode.clear()
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, "uid long, doc_id long, key long, n long, ids binary")


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: a row per piece of a document.

    Documents follow the Hilbert curve of their hashed vectors, and their tokens, with the end id
    after each, are one stream that is cut every ``length`` tokens. So every sequence but the
    last is full. ``ids`` are little-endian 32-bit numbers, ``start`` the document's ids before
    the piece, ``offset`` the piece's place in its sequence.

    Texts are tokenized once and stored; the curve is settled on three narrow columns, and the
    ids then move once. Null and empty texts are the end id alone. Repeated rows are packed
    each; a null doc_id is kept. Other columns are not read. An empty table gives an empty result.
    """
    rows = stored(tokenized(docs, vocabulary), "tokens")
    at = running_total(rows.select("uid", "key", "n"), ["key", "uid"], "n", "at").select("uid", "at")
    placed = rows.join(at, "uid").select("doc_id", "n", "ids", "at")

    width = byte_level(vocabulary).width

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), OUT_ROWS):
                part = batch.slice(low, OUT_ROWS)
                out: list[list] = [[] for _ in range(7)]
                for doc, n, ids, at in zip(*(part.column(x).to_pylist() for x in ("doc_id", "n", "ids", "at"))):
                    ids = np.frombuffer(ids, width).astype("<u4").tobytes()
                    begin = 0
                    while begin < n:
                        sequence, offset = divmod(at + begin, length)
                        end = min(n, begin + length - offset)
                        for column, value in zip(out, (doc, begin, end - begin, ids[4 * begin:4 * end], n, sequence, offset)):
                            column.append(value)
                        begin = end
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(out, kinds)],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )
            give_back()

    return placed.mapInArrow(
        cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
