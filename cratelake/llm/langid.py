"""Language by n-gram filters: one Bloom filter per language, sliced so that a probe reads all."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratelake.llm.store import stored
from cratelake.llm.text import LOWER, SLICE_BYTES, flat, mix, slices

PER_LANGUAGE = 3_000  # documents a language is learned from, about
GRAMS = 20_000  # a language keeps n-grams that make up at least one in so many of its own
GRAM = 4  # bytes
SLOTS = 1 << 21
PROBES = 3
LANGUAGES = 64  # bits of a slice; more languages have further tables

_U = np.uint64
_PLAIN = LOWER.copy()
_PLAIN[[b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)]] = 32
UNKNOWN = "und"


def _grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of lower-cased bytes with a letter in them, and the document of each.

    Characters of ASCII that are no letters count as blanks, runs of blanks as one, and each
    text stands between two blanks.
    """
    data, offsets = flat(column)
    n = len(offsets) - 1
    wide = np.full(len(data) + 2 * n, 32, np.uint8)
    owner = np.repeat(np.arange(n), np.diff(offsets) + 2)
    heads = offsets[:-1] + 2 * np.arange(n)
    inner = np.ones(len(wide), bool)
    inner[heads] = inner[offsets[1:] + 2 * np.arange(n) + 1] = False
    wide[inner] = _PLAIN[data]
    # É and its like are two bytes; their lower case differs in the second.
    second = (wide[1:] >= 0x80) & (wide[1:] < 0x9F) & (wide[:-1] == 0xC3) & (wide[1:] != 0x97)
    wide[1:][second] += 32
    blank = wide == 32
    keep = np.ones(len(wide), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[heads] = True
    wide, owner = wide[keep], owner[keep]
    size = max(0, len(wide) - GRAM + 1)
    gram = np.zeros(size, np.uint64)
    for i in range(GRAM):
        gram |= wide[i:i + size].astype(np.uint64) << _U(8 * i)
    fine = owner[:size] == owner[len(owner) - size:]
    return gram[fine], owner[:size][fine]


def _slots(gram: np.ndarray) -> list[np.ndarray]:
    one, two = mix(gram), mix(~gram) | _U(1)
    return [((one + _U(i) * two) & _U(SLOTS - 1)).astype(np.int64) for i in range(PROBES)]


class Filters:
    """The learned filters: in each of ``tables``, ``table[slot]`` has a bit for each of its languages.

    A table holds up to ``LANGUAGES`` languages, in the order of ``names``.
    """

    def __init__(self, names: list[str], grams: list[np.ndarray]):
        self.names = names
        self.tables, self.chances = [], []
        for at in range(0, len(names), LANGUAGES):
            group = grams[at:at + LANGUAGES]
            kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(group) <= np.iinfo(t).bits)
            table = np.zeros(SLOTS, kind)
            for bit, own in enumerate(group):
                for slot in _slots(own):
                    table[slot] |= kind(1 << bit)
            filled = [np.count_nonzero(table & kind(1 << i)) / SLOTS for i in range(len(group))]
            self.tables.append(table)
            self.chances.append(np.array(filled) ** PROBES)

    def _parts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The shares of each table's languages in turn, a row per text."""
        gram, owner = _grams(column)
        first, *more = _slots(gram)
        n = len(column)
        total = np.maximum(np.bincount(owner, minlength=n), 1)
        for table, chance in zip(self.tables, self.chances):
            found = table[first]
            for slot in more:
                found &= table[slot]
            kind = table.dtype.type
            hits = np.stack(
                [np.bincount(owner[(found & kind(1 << i)) > 0], minlength=n) for i in range(len(chance))], 1
            )
            yield np.clip((hits / total[:, None] - chance) / (1 - chance), 0, 1)

    def shares(self, column: pa.Array) -> np.ndarray:
        """The part of each text's n-grams each language has, less false positives."""
        return np.concatenate(list(self._parts(column)), 1)

    def best(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text the first language with the largest share, that share, and the sum of all.

        One table's shares at a time are in memory.
        """
        n = len(column)
        best, most, total = np.zeros(n, np.int64), np.full(n, -1.0), np.zeros(n)
        for i, share in enumerate(self._parts(column)):
            ahead = share.max(1) > most
            best = np.where(ahead, i * LANGUAGES + share.argmax(1), best)
            most = np.maximum(most, share.max(1))
            total += share.sum(1)
        return best, most, total


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Filters:
    """Filters from ``docs(doc_id, text, lang)``; rows without lang or text are left out.

    A language with more documents is learned from a share of them, chosen by a hash of the
    doc_id, so that about ``per_language`` are read. N-grams are counted in the tasks and summed by
    Spark; at most ``GRAMS`` of a language pass the bar, and only those reach the driver.
    Every language is learned, however many there are; a table of 64 takes 16 MB.
    """
    known = docs.where("lang is not null and text is not null")
    sizes = known.groupBy("lang").count().collect()
    if not sizes:
        return Filters([], [])
    shares = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, per_language / r["count"]))])
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    sample = known.withColumn("_share", shares[F.col("lang")]).where(turn < F.col("_share"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 * SLICE_BYTES):
                codes = part.column("lang").dictionary_encode()
                gram, owner = _grams(part.column("text"))
                # Four bytes of gram leave room for the language above them.
                key, n = np.unique(gram | (codes.indices.to_numpy().astype(np.uint64)[owner] << _U(32)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [codes.dictionary.take(pa.array((key >> _U(32)).astype(np.int64))),
                     pa.array((key & _U(2**32 - 1)).astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )

    counted = stored(
        sample.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")),
        "grams",
    )
    total = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    rows = (
        counted.join(F.broadcast(total), "lang").where(F.col("n") * GRAMS >= F.col("total"))
        .select("lang", "gram").toArrow()
    )
    names = sorted(x["lang"] for x in sizes)
    code = np.searchsorted(np.array(names, object), rows["lang"].to_numpy(zero_copy_only=False))
    gram = rows["gram"].to_numpy().astype(np.uint64)[np.argsort(code, kind="stable")]
    return Filters(names, np.split(gram, np.cumsum(np.bincount(code, minlength=len(names)))[:-1]))


def predict(docs: DataFrame, filters: Filters, extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, the columns of ``extra``, ``lang_pred`` and ``score`` of every row's whole text.

    The language with the largest corrected share of n-grams wins, the first by name if equal;
    ``score`` is its part of all languages' shares. Null texts and texts without a letter are
    ``und`` with score 0, and so is every text if nothing could be learned. A text none of whose
    n-grams is known gets the first language with score 0. Repeated rows get equal answers; a
    null doc_id is kept. An empty table gives an empty result; other columns are not read.
    """
    given = docs.select(
        "doc_id", *[c.alias(k) for k, c in (extra or {}).items()],
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"), "text",
    )
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    keep = [x for x in given.columns if x not in ("_letters", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        names = np.array([*filters.names, UNKNOWN])
        for batch in batches:
            for part in slices(batch, "text"):
                known = part.column("_letters").to_numpy(zero_copy_only=False)
                best = np.full(len(known), len(filters.names))
                score = np.zeros(len(known))
                if filters.names:
                    first, most, total = filters.best(part.column("text"))
                    best = np.where(known, first, best)
                    score = np.where(known, most / np.maximum(total, 1e-12), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in keep), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                    names=[*keep, "lang_pred", "score"],
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.select(*keep).schema)
    return given.mapInArrow(run, f"{kinds}, lang_pred string, score double")
