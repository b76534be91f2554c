"""The n-gram classifier: features and leader against plain Python, held-out accuracy, odd rows."""

import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from cratelake.llm import ngrams
from cratelake.llm.queries import QUERIES
from tests.llm import brute


def test_values_are_log_counts_of_distinct_grams():
    texts = ["The cat the CAT sat", None, "", "one", " \n ", "x y " * 400, "é ü é"]
    slots, values, first = ngrams.features(pa.array(texts))
    for text, a, b in zip(texts, first, first[1:]):
        w = brute.WORD.findall((text or "").translate(brute.LOWER))
        raw = brute.WORD.findall(text or "")
        shape = [(x[0].isupper(), x[-1].isupper(), len(x.encode()), i and w[i] == w[i - 1]) for i, x in enumerate(raw)]
        counts = {}
        for kind, tokens, sizes in (("w", w, (1, 2)), ("s", shape, (1, 2, 3))):
            for n in sizes:
                for i in range(len(tokens) - n + 1):
                    gram = (kind, n, *tokens[i:i + n])
                    counts[gram] = counts.get(gram, 0) + 1
        length = math.sqrt(sum(math.log1p(c)**2 for c in counts.values()))
        want = sorted(math.log1p(c) / length for c in counts.values())
        assert len(set(slots[a:b])) == b - a
        assert np.allclose(sorted(values[a:b]), want, rtol=1e-6)


def test_leader_is_the_textbook_one():
    rng = random.Random(3)
    rows = []
    for _ in range(60):
        slots = sorted(rng.sample(range(50), 5))
        rows.append((np.array([*slots, ngrams.SLOTS]), np.array([rng.random() for _ in slots] + [1.0]), float(slots[0] < 10)))
    z, n = {}, {}
    for _ in range(ngrams.EPOCHS):
        for slots, values, y in rows:
            w = {}
            for i in slots.tolist():
                zi = z.get(i, 0.0)
                w[i] = 0.0 if abs(zi) <= ngrams.L1 else -(zi - math.copysign(ngrams.L1, zi)) / (
                    (ngrams.BETA + math.sqrt(n.get(i, 0.0))) / ngrams.ALPHA + ngrams.L2)
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(slots.tolist(), values))))
            for i, v in zip(slots.tolist(), values):
                g, old = (p - y) * v, n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / ngrams.ALPHA * w[i]
                n[i] = old + g * g
    got, root = ngrams.follow(rows)
    assert np.allclose([got[i] for i in z], [z[i] for i in z])
    assert np.allclose([root[i] for i in z], [math.sqrt(n[i]) for i in z])
    assert np.count_nonzero(got) == len(z)


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op11_ngrams"](spark, sf).collect()}
    con = duckdb.connect()
    ids = [i for i, in con.execute(f"SELECT doc_id FROM '{sf}/documents.parquet'").fetchall()]
    assert sorted(rows) == sorted(ids)
    seen = {0: [], 1: []}
    for i, quality in con.execute(f"SELECT doc_id, quality FROM '{sf}/labels.parquet' WHERE quality IS NOT NULL").fetchall():
        r = rows[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        if r["held_out"]:
            seen[quality].append(r["score"])
    wins = np.mean([(a > b) + (a == b) / 2 for a in seen[1] for b in seen[0]])
    assert wins >= 0.98
    assert np.mean([x >= 0.5 for x in seen[1]]) >= 0.97 and np.mean([x < 0.5 for x in seen[0]]) >= 0.9


def test_odd_rows(docs, labels):
    good = [f"plain words number {i} stand in this line" for i in range(40)]
    bad = [f"SHOUT{i}!! SHOUT{i}!! NOISE!! ###" for i in range(40)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    known = labels(*[(i, int(i < 40), 0, "t") for i in range(80)], (None, 1, 0, "t"), (200, None, 0, "t"), (0, 1, 0, "t"))
    odd = [(300, None), (301, ""), (302, " \n"), (None, good[0]), (0, good[0]), (303, "word " * 200_000), (304, "\x00é▁")]
    table = docs(*rows, *odd)
    model = ngrams.train(docs(*rows, (0, bad[0]), (201, None)), known, "quality")
    got = [(r["doc_id"], r["score"]) for r in ngrams.score(table, model).collect()]
    assert len(got) == len(rows) + len(odd)
    by_id = {i: s for i, s in got if i is not None and i}
    assert by_id[300] == by_id[301] == by_id[302]
    assert all(by_id[i] > 0.5 for i in range(1, 40)) and all(by_id[i] < 0.5 for i in range(40, 80))
    assert len({s for i, s in got if i == 0 or i is None}) == 1
    assert ngrams.score(table.limit(0), model).count() == 0
    blank = ngrams.train(table.limit(0), known, "quality")
    assert {r["score"] for r in ngrams.score(table, blank).collect()} == {0.5}
    again = ngrams.train(docs(*reversed(rows), (0, bad[0])).repartition(5), known, "quality")
    assert np.array_equal(again.weights, model.weights)


@pytest.mark.parametrize("shards", [1, 4])
def test_shards_agree_on_the_verdict(docs, labels, shards, monkeypatch):
    monkeypatch.setattr(ngrams, "SHARD_ROWS", 10)
    rows = [(i, ("good fine text here " if i % 2 else "BAD!! BAD!! ## ") + str(i)) for i in range(120)]
    table = docs(*rows)
    model = ngrams.train(table, labels(*[(i, i % 2, 0, "t") for i in range(120)]), "quality", shards=shards)
    assert all((r["score"] > 0.5) == (r["doc_id"] % 2 == 1) for r in ngrams.score(table, model).collect())
