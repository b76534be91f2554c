"""Quality rules: document statistics, two fixed rules, and boosted trees over the statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratelake.llm.boosting import Trees, fit
from cratelake.llm.text import SHINGLE, Words, flat, map_slices, mix, windows

TRAIN_ROWS = 20_000  # labelled documents the trees are fitted on, at most
THRESHOLD = 0.5  # least probability of good quality to keep a document

# Fixed values of the contract: symbols, the least words, the share of repeated words in percent.
SYMBOLS = b"[#*$%&|<>]"[1:-1]
LEAST_WORDS = 10
MOST_REPEATED = 20

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_chars_all", "n_lines", "n_upper", "n_digits", "n_points", "n_distinct", "n_same_next", "n_shouted"]
# Each feature and the direction in which a document may only get better (1) or worse (-1).
FEATURES = {
    "log_words": 0, "chars_per_word": 0, "symbols_per_word": -1, "dup_lines_share": -1,
    "repeat_share": -1, "same_next_share": -1, "upper_share": 0, "digit_share": 0,
    "points_per_word": 0, "distinct_share": 0, "lines_per_word": 0, "shouted_share": 0,
}

_CLASS = np.zeros((256, 5), bool)
_CLASS[[*SYMBOLS], 0] = True
_CLASS[[*range(65, 91)], 1] = True
_CLASS[[*range(48, 58)], 2] = True
_CLASS[[*b".,;:!?"], 3] = True
_CLASS[[*range(0x80, 0xC0)], 4] = True  # bytes that go on a character


def _per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _lines(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lines, and lines with a word that equal an earlier line, of each text."""
    many, again = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            lines = text.split("\n")
            many[i] = len(lines)
            if len(set(lines)) < len(lines):
                held = [x for x in lines if x.strip(" \t\n\v\f\r")]
                again[i] = len(held) - len(set(held))
    return many, again


def _repeated(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Words that lie in a five-word window its document has twice or more."""
    covered = np.zeros(len(hashes), bool)
    values = windows(hashes)
    if not len(values):
        return covered
    whole = np.flatnonzero(owner[:len(values)] == owner[len(owner) - len(values):])
    keys = mix(values[whole] ^ mix(owner[whole].astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = whole[twice]
    for i in range(SHINGLE):
        covered[at + i] = True
    return covered


def _counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The contract's counts and the trees' further ones of every text; null is empty."""
    data, offsets = flat(column)
    words = Words(data, offsets)
    owner = words.documents()
    hashes = words.hashes()
    symbols, upper, digits, points, going = (_per_document(_CLASS[data, j], offsets) for j in range(5))
    lines, again = _lines(column.to_pylist())
    sizes = words.ends - words.starts
    inside = np.bincount(owner, sizes, len(words.counts)).astype(np.int64)
    next_same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]))
    capital = lambda at: data[at] - np.uint8(65) < 26
    shouted = capital(words.starts) & capital(words.ends - 1) & (sizes > 1)
    per = lambda at: np.bincount(at, minlength=len(words.counts))
    _, one = np.unique(mix(hashes ^ mix(owner.astype(np.uint64))), return_index=True)
    return {
        "n_words": words.counts, "word_chars": inside - going, "n_symbols": symbols,
        "n_dup_lines": again, "n_repeat_words": per(owner[_repeated(hashes, owner)]),
        "n_chars_all": np.diff(offsets) - going, "n_lines": lines, "n_upper": upper,
        "n_digits": digits, "n_points": points, "n_distinct": per(owner[one]),
        "n_same_next": per(owner[:-1][next_same]) if len(owner) else words.counts, "n_shouted": per(owner[shouted]),
    }


def _features(columns: dict[str, np.ndarray]) -> np.ndarray:
    c = {k: v.astype(float) for k, v in columns.items()}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["n_chars_all"], 1)
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words,
        c["n_dup_lines"] / np.maximum(c["n_lines"], 1), c["n_repeat_words"] / words,
        c["n_same_next"] / words, c["n_upper"] / chars, c["n_digits"] / chars,
        c["n_points"] / words, c["n_distinct"] / words, c["n_lines"] / words, c["n_shouted"] / words,
    ], 1)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Trees for ``labels(doc_id, quality)``, fitted on about ``rows`` labelled documents at most.

    Which ones is settled by a hash of doc_id, so runs agree; with so few, the labels are
    broadcast. Only the documents' counts reach the driver. Null labels and ids are left out, of
    several labels of a document the least counts.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").cast("int").alias("quality")
    )
    share = min(1.0, rows / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = _counts(batch.column("text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("quality"), *(pa.array(values[x].astype(np.int64)) for x in COUNTS + EXTRA)],
            names=["quality", *COUNTS, *EXTRA],
        )

    sample = map_slices(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text"), counted,
        "quality int, " + ", ".join(f"{x} long" for x in COUNTS + EXTRA),
    ).toArrow()
    columns = {x: sample[x].to_numpy() for x in COUNTS + EXTRA}
    y = sample["quality"].to_numpy().astype(float)
    x = _features(columns)
    order = np.lexsort(np.column_stack([x, y]).T)
    return fit(x[order], y[order], np.array([*FEATURES.values()]))


def _verdict(values: dict[str, np.ndarray], trees: Trees, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base rules failed, probability of good quality, kept."""
    failed = (values["n_words"] < LEAST_WORDS) | (100 * values["n_repeat_words"] > MOST_REPEATED * values["n_words"])
    p = 1 / (1 + np.exp(-trees.score(_features(values)))) if len(trees.roots) else np.ones(len(failed))
    return failed, p, ~failed & (p >= threshold)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the contract's counts, ``base_failed``, ``probability`` and ``kept`` of every row.

    A null text has no words; like every text of fewer than ten words it fails the base rule and
    is not kept. A null or repeated doc_id is a row like any other. Without labels, or with labels of
    one kind only, the base rules decide alone. Columns beside ``doc_id`` and ``text`` are not
    read. An empty table gives an empty result.
    """
    trees = train(docs, labels)

    def judged(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = _counts(batch.column("text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), *(pa.array(values[x].astype(np.int64)) for x in COUNTS),
             *map(pa.array, _verdict(values, trees, threshold))],
            names=["doc_id", *COUNTS, "base_failed", "probability", "kept"],
        )

    return map_slices(
        docs.select("doc_id", "text"), judged, ", ".join(f"{x} long" for x in ["doc_id", *COUNTS])
        + ", base_failed boolean, probability double, kept boolean",
    )


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns, whatever their names; judged where they lie."""
    trees = train(docs, labels)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = plain.columns[docs.columns.index("text")]

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(_verdict(_counts(batch.column(text)), trees, threshold)[2]))

    return map_slices(plain, kept, plain.schema, text).toDF(*docs.columns)
