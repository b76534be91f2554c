"""Tokens of one vocabulary against tokens of another: groups between the places where both end.

Such places are found by dividing: near the middle of a stretch a common end is looked up by
bisection, and both halves are divided again; what lies between without one is a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratelake.llm.store import stored
from cratelake.llm.text import flat, map_slices
from cratelake.llm.tokens import Memo, byte_level, joined, pieces, word_pieces

COUNT_ROWS = 4_000  # documents whose links are counted at a time


def common_ends(a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the ends that rising ``a`` and ``b`` share, in order.

    Stretch n is ``a[first_a[n]:first_a[n + 1]]`` and the same of ``b``. All stretches are divided together: where
    the middle end of ``a`` is none of ``b``, its neighbours are looked up in rings of doubling width.
    """
    lo, hi, low, high = first_a[:-1], first_a[1:], first_b[:-1], first_b[1:]
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(lo):
        middle = (lo + hi) // 2
        cut, at = np.full(len(lo), -1), np.zeros(len(lo), np.int64)
        open_, ring = np.flatnonzero((lo < hi) & (low < high)), np.zeros(1, np.int64)
        width = 1
        while len(open_):
            i = middle[open_, None] + ring
            inside = (i >= lo[open_, None]) & (i < hi[open_, None])
            i = np.where(inside, i, middle[open_, None])
            j = np.searchsorted(b, a[i])
            hit = inside & (b[np.minimum(j, len(b) - 1)] == a[i])
            some, which = hit.any(1), hit.argmax(1)
            rows = np.flatnonzero(some)
            cut[open_[rows]], at[open_[rows]] = i[rows, which[rows]], j[rows, which[rows]]
            rest = open_[~some]
            open_ = rest[np.maximum(middle[rest] - lo[rest], hi[rest] - 1 - middle[rest]) >= width]
            steps = np.arange(width, 2 * width)
            ring, width = np.stack([steps, -steps], 1).ravel(), 2 * width
        done = cut >= 0
        lo, hi, low, high, cut, at = (x[done] for x in (lo, hi, low, high, cut, at))
        found_a.append(cut)
        found_b.append(at)
        lo, hi = np.concatenate([lo, cut + 1]), np.concatenate([cut, hi])
        low, high = np.concatenate([low, at + 1]), np.concatenate([at, high])
    i, j = np.concatenate(found_a), np.concatenate(found_b)
    order = np.argsort(i)
    return i[order], j[order]


class Tokens:
    """Token ids of pieces one after the other, and where their bytes end."""

    def __init__(self, ids: list[list[int]], table: list[bytes], sizes: np.ndarray):
        self.ids = np.fromiter((i for x in ids for i in x), np.int64)
        self.first = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        self.ends = np.cumsum(sizes[self.ids])
        text, begins = joined(table, self.ids)
        self.text, self.begins = text, begins[self.first]

    def spells(self, n: int, piece: bytes) -> bool:
        return self.text[self.begins[n]:self.begins[n + 1]] == piece


class Aligner:
    """Groups of pieces of text; each distinct piece is encoded and divided once.

    Of a piece: whether both vocabularies give its bytes, the tokens and groups it has, the groups as
    text with a closing semicolon, and the linked ids of each group as one number.
    """

    def __init__(self, a: str | None, b: str | None):
        self.a, self.b = byte_level(a, plain=True), word_pieces(b)
        self.inner = self.a.inner and self.b.inner
        self.bytes_a, self.bytes_b = self.a.token_bytes(), self.b.token_bytes()
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        many = max(len(self.bytes_a), len(self.bytes_b))
        self.many = many
        self.shown = pa.array([f"{i}{mark}" for mark in ",|;" for i in range(many)], pa.large_binary())
        self.memo = Memo(self._align)

    def _align(self, found: list[bytes]) -> list[tuple[bool, int, int, int, bytes, bytes]]:
        texts = [x.decode() for x in found]
        ids_a, ids_b = self.a.ids(texts), self.b.ids(texts)
        a, b = Tokens(ids_a, self.bytes_a, self.sizes_a), Tokens(ids_b, self.bytes_b, self.sizes_b)
        fine = [a.spells(n, x) and b.spells(n, x) for n, x in enumerate(found)]
        if not all(fine):
            given = iter(self._align([x for x, ok in zip(found, fine) if ok]) if any(fine) else [])
            return [next(given) if ok else (False, 0, 0, 0, b"", b"") for ok in fine]
        i, j = common_ends(a.ends, b.ends, a.first, b.first)
        links = a.ids[i] * self.b.size + b.ids[j]
        # Tokens in the order they are shown: a group's of ``a``, then its of ``b``.
        in_a, in_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        group_a, group_b = np.repeat(np.arange(len(i)), in_a), np.repeat(np.arange(len(i)), in_b)
        marked = np.zeros(len(a.ids) + len(b.ids), np.int64)
        marks_a, marks_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
        marks_a[i], marks_b[j] = 1, 2
        marked[np.arange(len(a.ids)) + (np.cumsum(in_b) - in_b)[group_a]] = a.ids + self.many * marks_a
        marked[np.arange(len(b.ids)) + np.cumsum(in_a)[group_b]] = b.ids + self.many * marks_b
        taken = self.shown.take(pa.array(marked))
        text = memoryview(taken.buffers()[2]) if len(taken) else memoryview(b"")
        at = np.frombuffer(taken.buffers()[1], np.int64)[a.first + b.first].tolist() if len(taken) else [0] * (len(found) + 1)
        cuts = np.searchsorted(i, a.first).tolist()
        return [
            (True, n_a, n_b, to - since, bytes(text[low:high]), links[since:to].tobytes())
            for n_a, n_b, since, to, low, high in zip(
                np.diff(a.first).tolist(), np.diff(b.first).tolist(), cuts, cuts[1:], at, at[1:])
        ]

    def slice(self, column: pa.Array) -> dict[str, np.ndarray | tuple]:
        """Of every text: tokens, groups, the groups as text, and its links."""
        data, offsets = flat(column)
        some = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][some], 0x20)  # a blank before each text that is not empty
        offsets = offsets + np.concatenate([[0], np.cumsum(some)])
        found, first = pieces(data, offsets, self.inner, self.b.points)
        coded = found.dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        known = self.memo(coded.dictionary.to_pylist())
        fine, n_a, n_b, groups, shown, links = zip(*known) if known else [()] * 6
        total = lambda values: _sums(np.array(values, np.int64)[codes], first)
        good = some & (total([not x for x in fine]) == 0)
        text, at = joined(list(shown), codes)
        pairs, begins = joined(list(links), codes)
        return {
            "n_a": total(n_a) * good, "n_b": total(n_b) * good, "n_groups": total(groups) * good,
            "groups": [bytes(text[at[i]:at[j] - 1]) if ok else b"" for i, j, ok in zip(first, first[1:], good)],
            "links": (np.frombuffer(pairs, np.int64), begins[first] // 8, good),
        }


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[first[1:]] - upto[first[:-1]]


@lru_cache(2)
def aligner(a: str | None, b: str | None) -> Aligner:
    return Aligner(a, b)


def groups(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, groups`` of every row: its groups as ``a1,a2|b1;a3|b2,b3``.

    ``a`` and ``b`` are the files of a byte-level BPE and of a sentencepiece model. Null and empty texts, and
    texts that either vocabulary does not give back byte by byte, have no tokens. A null or repeated doc_id is
    a row like any other; other columns are not read; an empty table gives an empty result.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = aligner(a, b).slice(batch.column("text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), *(pa.array(made[x]) for x in ("n_a", "n_b", "n_groups")),
             pa.array(made["groups"], pa.binary()).cast(pa.string())],
            names=["doc_id", "n_a", "n_b", "n_groups", "groups"],
        )

    return map_slices(docs.select("doc_id", "text"), run, "doc_id long, n_a long, n_b long, n_groups long, groups string")


def _linked(docs: DataFrame, a: str | None, b: str | None) -> DataFrame:
    """Each row's numbers, the digest of its groups, its distinct links and how often it has each."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = aligner(a, b).slice(batch.column("text"))
        links, first, good = made["links"]
        codes, times = [], []
        for i, j, ok in zip(first, first[1:], good):
            code, n = np.unique(links[i:j] if ok else links[:0], return_counts=True)
            codes.append(code.astype("<u4").tobytes() if small else code.tobytes())
            times.append(n.astype("<u4").tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), *(pa.array(made[x]) for x in ("n_a", "n_b", "n_groups")),
             pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in made["groups"]]),
             pa.array(codes, pa.binary()), pa.array(times, pa.binary())],
            names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "codes", "times"],
        )

    small = _small(a, b)
    return map_slices(
        docs.select("doc_id", "text"), run,
        "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, codes binary, times binary",
    )


def _small(a: str | None, b: str | None) -> bool:
    return byte_level(a, plain=True).size * word_pieces(b).size < 1 << 32


def _flat_links(batch: pa.RecordBatch, small: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows' links, their numbers, and the row of each."""
    codes = b"".join(batch.column("codes").to_pylist())
    times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
    sizes = np.array([len(x) // 4 for x in batch.column("times").to_pylist()], np.int64)
    codes = np.frombuffer(codes, "<u4" if small else "<i8").astype(np.int64)
    return codes, times, np.repeat(np.arange(len(sizes)), sizes)


def link_counts(linked: DataFrame, small: bool) -> DataFrame:
    """``code, n``: how often each id pair is linked in the whole table."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), COUNT_ROWS):
                codes, times, _ = _flat_links(batch.slice(low, COUNT_ROWS), small)
                some, at = np.unique(codes, return_inverse=True)
                n = np.bincount(at, times, len(some)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n)], names=["code", "n"])

    return linked.select("codes", "times").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def report(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A link is a token of ``a`` and one of ``b`` that end together, one per group. ``count_sum`` adds up
    how often the whole table links each link's ids, ``n_best`` counts the links that are the most frequent
    of their ``b`` id. Rows are treated as ``groups`` says; rows without tokens have zeros and an empty digest.

    Texts are tokenized once; what a row links is stored with its digest. Of two tokens that end
    together one's bytes end the other's, so the distinct pairs are no more than the two vocabularies
    have such endings, whatever the table's size (``possible_links``); their counts are broadcast.
    """
    spark, small, size = docs.sparkSession, _small(a, b), word_pieces(b).size
    linked = stored(_linked(docs, a, b), "linked")
    counted = link_counts(linked, small).toArrow().sort_by("code")
    codes, n = counted["code"].to_numpy(), counted["n"].to_numpy()
    highest = np.zeros(size, np.int64)
    np.maximum.at(highest, codes % size, n)
    shared = spark.sparkContext.broadcast((codes, n, n == highest[codes % size]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = shared.value
        for batch in batches:
            for low in range(0, len(batch), COUNT_ROWS):
                part = batch.slice(low, COUNT_ROWS)
                own, times, row = _flat_links(part, small)
                at = np.searchsorted(codes, own)
                sums = [np.zeros(len(part), np.int64) for _ in range(2)]
                if len(own):
                    for total, values in zip(sums, (times * best[at], times * n[at])):
                        np.add.at(total, row, values)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in ("doc_id", "n_a", "n_b", "n_groups")), part.column("n_groups"),
                     *map(pa.array, sums), part.column("groups_sha256")],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    return linked.mapInArrow(
        score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )


def possible_links(a: str | None = None, b: str | None = None) -> int:
    """Pairs of ids of which one's bytes end the other's."""
    left, right = byte_level(a, plain=True).token_bytes(), word_pieces(b).token_bytes()
    many: tuple[dict, dict] = ({}, {})
    for tokens, tally in zip((left, right), many):
        for x in filter(None, tokens):
            tally[x] = tally.get(x, 0) + 1
    total = sum(many[1].get(x[i:], 0) for x in left for i in range(len(x)))
    return total + sum(many[0].get(x[i:], 0) for x in right for i in range(1, len(x)))
