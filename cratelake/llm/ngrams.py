"""Logistic regression on hashed word n-grams: follow-the-regularised-leader fits, sparse dot products score.

A document is its word 1- and 2-grams and the 1- to 3-grams of its words' shapes, hashed to slots.
Training shards run the leader each on their own rows; the shards' sums are then added, which gives
the leader of all their linearised losses at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratelake.llm.text import LOWER, Words, flat, map_slices, mix

TRAIN_ROWS = 20_000  # labelled documents the model is fitted on, at most about
SHARD_ROWS = 1_000  # labelled documents of one shard, at least
SHARDS = 8
EPOCHS = 3
SLOTS = 1 << 20  # the bias has the slot after the last
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.01  # rate, its start, and the two penalties
FIXED = float(1 << 32)  # sums are whole numbers of this part, so that their order does not matter

_U = np.uint64
# Kinds of bytes for a word's shape: other, lower case, upper case, digit, closing point, symbol.
_KIND = np.zeros(256, np.uint64)
_KIND[[*range(97, 123), *range(128, 256)]] = 1
_KIND[[*range(65, 91)]] = 2
_KIND[[*range(48, 58)]] = 3
_KIND[[*b".,;:!?"]] = 4
_KIND[[*b"#*$%&|<>@^~=_+{}[]\\/"]] = 5


def _shapes(words: Words, hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Kinds of the first and the last two bytes, length up to 15, and whether the word repeats the one before."""
    first, last = words.starts, words.ends - 1
    again = np.zeros(len(hashes), np.uint64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    size = np.minimum(words.ends - words.starts, 15).astype(np.uint64)
    kinds = _KIND[words.data[first]] * _U(36) + _KIND[words.data[np.maximum(last - 1, first)]] * _U(6) + _KIND[words.data[last]]
    return mix((kinds * _U(16) + size) * _U(2) + again)


def _grams(tokens: np.ndarray, owner: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Document and slot of each run of ``size`` tokens of one document, as one number."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    total = np.full(n, salt, np.uint64)
    for i in range(size):
        total = mix(total + tokens[i:i + n])
    whole = owner[:n] == owner[size - 1:]
    return (owner[:n][whole] << 20) | (total[whole] & _U(SLOTS - 1)).astype(np.int64)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and values of every text, and where each text's begin; a text's values have length one.

    A slot's value is the log of one more than its n-grams' number. Null is empty and has none.
    """
    data, offsets = flat(column)
    words = Words(data, offsets)
    lower = Words(LOWER[data], offsets).hashes()
    owner = words.documents()
    shape = _shapes(words, lower, owner)
    keys = np.concatenate([
        _grams(tokens, owner, size, 10 * kind + size)
        for kind, tokens, sizes in ((1, lower, (1, 2)), (2, shape, (1, 2, 3))) for size in sizes
    ])
    keys.sort()
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    keys, counts = keys[heads], np.diff(np.append(heads, len(keys)))
    docs = keys >> 20
    values = np.log1p(counts)
    length = np.sqrt(np.bincount(docs, values**2, len(words.counts)))
    first = np.searchsorted(docs, np.arange(len(words.counts) + 1))
    return (keys & (SLOTS - 1)).astype(np.int32), (values / length[docs]).astype(np.float32), first


def _weights(z: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The leader's weights for summed gradients ``z`` and roots of summed squares."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + root) / ALPHA + L2))


def follow(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """``z`` and the roots of the summed squares after the leader has seen ``rows`` in order ``epochs`` times.

    A row is its distinct slots, their values and its label.
    """
    z, n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for _ in range(epochs):
        for slots, values, label in rows:
            own, root = z[slots], np.sqrt(n[slots])
            w = _weights(own, root)
            error = 1 / (1 + np.exp(-np.clip(w @ values, -30, 30))) - label
            gradient = error * values
            more = n[slots] + gradient**2
            z[slots] = own + gradient - (np.sqrt(more) - root) / ALPHA * w
            n[slots] = more
    return z, np.sqrt(n)


@dataclass(frozen=True)
class Model:
    """A weight per slot and the bias; without labels all are 0."""

    weights: np.ndarray

    def score(self, slots: np.ndarray, values: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of each text, from its sparse dot product."""
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        total = np.bincount(owner, self.weights[slots] * values, len(first) - 1) + self.weights[SLOTS]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS, shards: int = SHARDS) -> Model:
    """Model for ``labels(doc_id, <label>)``, fitted on about ``rows`` labelled documents at most.

    Which ones a hash of doc_id settles, so runs agree; with so few, the labels are broadcast. Null
    labels and ids are left out, of several labels or texts of an id the least counts. Each of
    ``shards`` groups, fewer if they would be small, is fitted in a task; the driver gets the added
    sums, a row per used slot.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(label).cast("double").alias("label")
    )
    total = known.count()
    share = min(1.0, rows / max(total, 1))
    shards = max(1, min(shards, int(total * share) // SHARD_ROWS))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)
    sample = (
        docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    )

    def sparse(batch: pa.RecordBatch) -> pa.RecordBatch:
        slots, values, first = features(batch.column("text"))
        listed = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(x)) for x in (slots, values)]
        return pa.RecordBatch.from_arrays(
            [batch.column("shard"), batch.column("turn"), batch.column("label"), *listed],
            names=["shard", "turn", "label", "slots", "vals"],
        )

    turn = F.xxhash64("doc_id", F.lit(2))
    rows_of = map_slices(
        sample.select(F.pmod(turn, F.lit(shards)).cast("int").alias("shard"), turn.alias("turn"), "label", "text"),
        sparse, "shard int, turn long, label double, slots array<int>, vals array<float>",
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).sort_by("turn")
        given = []
        for slots, values, y in zip(table["slots"], table["vals"], table["label"].to_numpy()):
            slots, values = slots.values.to_numpy(), values.values.to_numpy().astype(float)
            given.append((np.append(slots, SLOTS), np.append(values, 1.0), float(y)))
        z, root = follow(given)
        at = np.flatnonzero(root)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), *(pa.array(np.rint(x[at] * FIXED).astype(np.int64)) for x in (z, root))],
            names=["slot", "z", "root"],
        )

    added = rows_of.groupBy("shard").applyInArrow(fit, "slot long, z long, root long").groupBy("slot").agg(
        F.sum("z").alias("z"), F.sum("root").alias("root")
    )
    kept = added.where((F.abs("z") > L1 * FIXED) | (F.col("slot") == SLOTS)).toArrow()
    weights = np.zeros(SLOTS + 1)
    z, root = (kept[x].to_numpy() / FIXED for x in ("z", "root"))
    weights[kept["slot"].to_numpy()] = _weights(z, root)
    return Model(weights)


def score(docs: DataFrame, model: Model, extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, the columns of ``extra`` and ``score``, the probability of label 1, of every row's whole text.

    Null, empty and wordless texts get the bias's probability. Repeated rows get equal scores, a
    null doc_id is kept, other columns are not read, an empty table gives an empty result. Without a labelled
    document every score is one half. A text of any length is a slice of its own at most.
    """
    given = docs.select("doc_id", *[c.alias(k) for k, c in (extra or {}).items()], "text")
    keep = [x for x in given.columns if x != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        result = shared.value.score(*features(batch.column("text")))
        return pa.RecordBatch.from_arrays([*(batch.column(x) for x in keep), pa.array(result)], names=[*keep, "score"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.select(*keep).schema)
    return map_slices(given, scored, f"{kinds}, score double")
