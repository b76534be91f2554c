"""Toxic passages as maximal-scoring segments of token log-odds, weighed by extreme-value theory."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratelake.llm.text import LOWER, Words, flat, map_slices, mix, slices

TRAIN_ROWS = 20_000  # labelled documents used, at most about: half for the odds, half for calibration
SLOTS = 1 << 20
PRIOR = 2.0  # weight, in tokens, of the coarser level's odds
DRIFT = 2.0  # cost of a token, so that a segment ends where toxic tokens get sparse
FLOOR = 2.0  # least score of a segment that is looked at
ENOUGH = 20.0  # log evidence beyond which more does not count
PREFIXES = (4, 5, 6, 7)  # bytes; a token's odds lean on those of its prefixes, the longest first

_U = np.uint64
_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _folded(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the two-byte letters À to Þ."""
    out = LOWER[data]
    if len(out) > 1:
        second = (out[1:] >= 0x80) & (out[1:] < 0x9F) & (out[:-1] == 0xC3) & (out[1:] != 0x97)
        out[1:][second] += 32
    return out


def _tokens(column: pa.Array) -> tuple[Words, list[np.ndarray]]:
    """Tokens and, from the coarsest level to the token itself, each one's slots."""
    data, offsets = flat(column)
    words = Words(_folded(data), offsets, _GAP)
    levels = [
        words.hashes(np.minimum(words.ends, words.starts + size)) ^ _U(size) for size in PREFIXES
    ] + [words.hashes()]
    return words, [(mix(x) & _U(SLOTS - 1)).astype(np.int64) for x in levels]


@dataclass
class Odds:
    """Token counts of toxic and of other documents by slot, all levels in one table."""

    toxic: np.ndarray
    other: np.ndarray
    share: float  # of all tokens, those in toxic documents

    def scores(self, levels: list[np.ndarray]) -> np.ndarray:
        """Log-odds of each token: at every level a Dirichlet prior whose mean is the level above."""
        up = down = np.ones(len(levels[0]))
        for slot in levels:
            t, o = self.toxic[slot], self.other[slot]
            n = t + o
            up = (t + PRIOR * up) / (n * self.share + PRIOR)
            down = (o + PRIOR * down) / (n * (1 - self.share) + PRIOR)
        return np.log(up / down) - DRIFT


@dataclass
class Model:
    """Odds, the law of chance maxima (rate and log of K), and the logistic map to a probability."""

    odds: Odds | None
    rate: float = 1.0
    log_k: float = 0.0
    bias: float = -6.0
    slope: float = 1.0


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(start, end, score)``, in one pass.

    Each candidate keeps the sum before it and the sum at its end. A new positive score looks
    back for the last candidate that began lower; if that one ended lower too, they merge with all
    between, and the search goes on. Every candidate is merged away once at most.
    """
    kept: list[list] = []  # start, end, sum before, sum at the end, last candidate that began lower
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        new = [i, i + 1, before, total, -1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= new[2]:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= new[3]:
                new[4] = j
                kept.append(new)
                break
            new[0], new[2] = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, hi - lo) for a, b, lo, hi, _ in kept]


def _runs(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the runs of one sign, and where each begins."""
    turn = np.flatnonzero(np.diff(scores > 0)) + 1
    begins = np.concatenate([[0], turn])
    return np.add.reduceat(scores, begins), begins


def passages(docs: DataFrame, odds: Odds, keep: list[str]) -> DataFrame:
    """Columns ``keep``, ``n_tokens``, ``best`` and ``passages`` of each row of ``docs``.

    ``passages`` lists the maximal segments that score ``FLOOR`` or more: first character,
    end and score, in order. ``best`` is the largest segment score, 0 without any.
    """
    shared = docs.sparkSession.sparkContext.broadcast(odds)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, levels = _tokens(batch.column("text"))
        scores = shared.value.scores(levels)
        places = np.cumsum((words.data & 0xC0) != 0x80)  # characters up to each byte
        best, found = np.zeros(len(words.counts)), [[] for _ in words.counts]
        hope = np.concatenate([[0], np.cumsum(np.maximum(scores, 0))])
        hope = hope[words.first[1:]] - hope[words.first[:-1]]
        for d in np.flatnonzero(hope > 0):
            lo = words.first[d]
            own = scores[lo:words.first[d + 1]]
            total = np.cumsum(own)
            best[d] = (total - np.minimum(np.minimum.accumulate(total) , 0)).max() if hope[d] < FLOOR else 0
            if hope[d] < FLOOR:
                continue
            sums, begins = _runs(own)
            ends = np.append(begins[1:], len(own))
            for a, b, score in segments(sums.tolist()):
                best[d] = max(best[d], score)
                if score >= FLOOR:
                    first, last = words.starts[lo + begins[a]], words.ends[lo + ends[b - 1] - 1]
                    base = words.offsets[d]
                    begin = places[base - 1] if base else 0
                    found[d].append((int(places[first] - 1 - begin), int(places[last - 1] - begin), float(score)))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        listed = [[{"start": a, "end": b, "score": s} for a, b, s in x] for x in found]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(x) for x in keep), pa.array(words.counts.astype(np.int64)), pa.array(best), pa.array(listed, kind)],
            names=[*keep, "n_tokens", "best", "passages"],
        )

    chosen = docs.select(*keep, "text")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.select(*keep).schema)
    return map_slices(
        chosen, scan,
        f"{kinds}, n_tokens long, best double, passages array<struct<start:long,end:long,score:double>>",
    )


def evidence(model: Model) -> Column:
    """How far a document's passages exceed what chance gives a text of its length, added up.

    Chance maxima of m tokens follow exp(-K m exp(-rate s)); a passage's excess over the centre of
    that law is its log evidence. Without a passage beyond it, the best segment's, which is negative.
    """
    centre = F.lit(model.log_k) + F.log(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double"))
    gain = F.aggregate(
        "passages", F.lit(0.0),
        lambda total, p: total + F.greatest(F.lit(0.0), p["score"] * model.rate - centre),
    )
    return F.when(gain > 0, F.least(gain, F.lit(ENOUGH))).otherwise(F.least(F.lit(0.0), F.col("best") * model.rate - centre))


def _count(sample: DataFrame) -> Odds | None:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, levels = _tokens(part.column("text"))
                toxic = part.column("toxic").to_numpy()[words.documents()] > 0
                tally = np.zeros((2, SLOTS), np.int32)
                for slot in levels:
                    tally[0] += np.bincount(slot[toxic], minlength=SLOTS).astype(np.int32)
                    tally[1] += np.bincount(slot[~toxic], minlength=SLOTS).astype(np.int32)
                at = np.flatnonzero(tally.any(0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at), pa.array(tally[0, at].astype(np.int64)), pa.array(tally[1, at].astype(np.int64))],
                    names=["slot", "t", "o"],
                )

    rows = sample.select("text", "toxic").mapInArrow(count, "slot long, t long, o long").groupBy("slot").agg(
        F.sum("t").cast("int").alias("t"), F.sum("o").cast("int").alias("o")
    ).toArrow()
    odds = Odds(np.zeros(SLOTS, np.float32), np.zeros(SLOTS, np.float32), 0.5)
    odds.toxic[rows["slot"].to_numpy()] = rows["t"].to_numpy()
    odds.other[rows["slot"].to_numpy()] = rows["o"].to_numpy()
    t, o = float(odds.toxic.sum()), float(odds.other.sum())
    if not t or not o:
        return None
    odds.share = t / (t + o)
    return odds


def _chance(best: np.ndarray, tokens: np.ndarray) -> tuple[float, float]:
    """Rate and log K of the Gumbel law, by quartiles of clean documents' largest scores.

    Rate times score less the log of length follows that law about log K, whatever the length;
    so the rate is the one that gives it the law's distance between quartiles.
    """
    some = best > 0
    if some.sum() < 10:
        return 1.0, 0.0
    s, m = best[some], np.log(np.maximum(tokens[some], 1))
    low, middle, high = (-math.log(-math.log(q)) for q in (0.25, 0.5, 0.75))
    rates = np.geomspace(0.2, 5, 200)
    spread = [np.subtract(*np.quantile(r * s - m, [0.75, 0.25])) for r in rates]
    rate = float(rates[np.abs(np.array(spread) - (high - low)).argmin()])
    return rate, float(np.median(rate * s - m) - middle)


def _logistic(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope of a probability in ``z``, by Newton steps with a small ridge."""
    x = np.stack([np.ones(len(z)), z], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2) * 0.1
        step = np.linalg.solve(hess, x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), max(float(w[1]), 0.0)


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; nulls are left out.

    At most about ``rows`` labelled documents are used, chosen and halved by a hash of doc_id:
    one half gives the token odds, the other the law of chance and the calibration. With so few,
    the labels are broadcast; token counts are summed by Spark into a table of fixed size.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    share = min(1.0, rows / max(total, 1))
    chosen = known.where(turn < share * 1_000_000)
    sample = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))
    odds = _count(sample.where(half == 0))
    if odds is None:
        return Model(None)
    seen = passages(sample.where(half == 1).select("text", "toxic"), odds, ["toxic"])
    table = seen.select("toxic", "n_tokens", "best", F.col("passages.score").alias("scores")).toArrow()
    toxic = table["toxic"].to_numpy().astype(float) > 0
    best, tokens = table["best"].to_numpy(), table["n_tokens"].to_numpy()
    rate, log_k = _chance(best[~toxic], tokens[~toxic])
    centre = log_k + np.log(np.maximum(tokens, 1))
    gain = np.array([
        np.maximum(0, np.array(x.as_py() or [0.0]) * rate - c).sum() for x, c in zip(table["scores"], centre)
    ])
    z = np.where(gain > 0, np.minimum(gain, ENOUGH), np.minimum(0, best * rate - centre))
    bias, slope = _logistic(z, toxic.astype(float)) if len(z) else (-6.0, 1.0)
    return Model(odds, rate, log_k, bias, slope)


def score(docs: DataFrame, model: Model, extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, the columns of ``extra``, ``passages`` and ``score`` of every row's whole text.

    ``score`` is the probability of a toxic document. Null and empty texts have no passage and get
    the score of no evidence; without a usable model every score is that. Repeated rows get equal
    scores, a null doc_id is kept, other columns are not read, an empty table gives an empty result.
    """
    given = docs.select("doc_id", *[c.alias(k) for k, c in (extra or {}).items()], "text")
    keep = [x for x in given.columns if x != "text"]
    if model.odds is None:
        found = given.select(
            *keep, F.lit(0).cast("long").alias("n_tokens"), F.lit(0.0).alias("best"),
            F.expr("cast(array() as array<struct<start:long,end:long,score:double>>)").alias("passages"),
        )
    else:
        found = passages(given, model.odds, keep)
    z = F.lit(model.bias) + F.lit(model.slope) * evidence(model)
    return found.select(*keep, "passages", (1 / (1 + F.exp(-z))).alias("score"))
