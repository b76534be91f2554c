"""Ranked search against scoring every document, its lists' packing, and what it leaves packed."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cratelake.llm import lexical
from tests.llm import brute

WORD = re.compile(lexical.TERM)


def terms(text):
    return WORD.findall((text or "").translate(brute.LOWER))


def ranked(rows, queries, k=10):
    """``rows`` of doc_id and text, ``queries`` of item_id to text; all documents scored."""
    counts = [(i, Counter(terms(t))) for i, t in rows]
    n_docs = sum(bool(c) for _, c in counts)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in queries:
        scored = []
        for i, c in counts:
            n = sum(c.values())
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * (10 + (90 * n * n_docs) // n_terms)))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(index, queries, k=10):
    return sorted((tuple(r) for r in lexical.search(index, queries, k).collect()), key=str)


def test_numbers_round_trip():
    values = np.array([0, 1, 127, 128, 16_383, 16_384, 1 << 21, (1 << 40) + 5, 3])
    packed, begins = lexical.pack_numbers(values)
    assert lexical.unpack_numbers(packed).tolist() == values.tolist()
    assert [len(packed[a:b]) for a, b in zip(begins, begins[1:])] == [1, 1, 1, 2, 2, 3, 4, 6, 1]
    assert not len(lexical.unpack_numbers(lexical.pack_numbers(values[:0])[0]))


def corpus(n, seed):
    """Zipfian words, so that some lists span many blocks, texts of one to hundreds of words, copies."""
    rng = random.Random(seed)
    vocabulary = [f"W{i}" if i % 7 else f"é{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights, k=int(rng.paretovariate(0.7)) % 400 + 1))) for i in range(n)]
    return rows + [(n + i, rows[i % 40][1]) for i in range(200)]


def test_lists_unpack_to_the_postings():
    rows = corpus(1_500, 1)
    texts = [t for _, t in rows]
    counts = [Counter(terms(t)) for t in texts]
    n_terms = sum(sum(c.values()) for c in counts)
    shard = lexical.invert(7, pa.array([i for i, _ in rows]), pa.array(texts), len(rows), n_terms).to_pylist()
    m = lexical.norms(np.array([sum(c.values()) for c in counts]), len(rows), n_terms)
    listed = {r["term"]: r for r in shard}
    assert len(listed) == len(shard) and set(listed) == {"", *(t for c in counts for t in c)}
    for term, r in listed.items():
        if not term:
            continue
        want = [(d, c[term]) for d, c in enumerate(counts) if c[term]]
        own = lexical.PostingList(3, r["df"], r["top"], r["blocks"], r["payload"])
        docs, added = own.read(m)
        assert docs.tolist() == [d for d, _ in want] and r["df"] == len(want)
        assert added.tolist() == [3 * (10**9 * tf // (1000 * tf + 8 * int(m[d]))) for d, tf in want]
        assert added.max() == own.bound
        some = np.arange(1, len(own.blocks), 2)
        if len(some):
            a, b = own.read(m, some)
            inside = np.isin(np.arange(len(docs)) // lexical.BLOCK, some)
            assert a.tolist() == docs[inside].tolist() and b.tolist() == added[inside].tolist()


def test_search_equals_scoring_everything(docs, spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_BYTES", 20_000)
    rows = corpus(1_500, 2)
    rng = random.Random(5)
    queries = [(q, " ".join(rng.choices([t for _, x in rows[:300] for t in x.split()], k=rng.randrange(1, 30)))) for q in range(60)]
    index = lexical.build(docs(*rows).repartition(8))
    assert index.table.where("term = ''").count() > 6
    asked = spark.createDataFrame(queries, "item_id long, text string")
    assert found(index, asked) == ranked(rows, queries)
    monkeypatch.setattr(lexical, "QUERY_TERMS", 40)
    assert found(index, asked, k=3) == ranked(rows, queries, 3)


def test_odd_rows(docs, spark):
    rows = [
        (1, None), (2, ""), (3, "?! ... \x7f"), (4, "Ünïcode ÜNÏCODE x-y_z"), (5, "a\x00b \x1ca"), (6, "the the the"), (7, "the"),
        (7, "the"), (None, "the"), (None, "the other"), (8, "long " * 200_000 + "needle"), (9, "日本語 テキスト"), (10, "THE needle"),
    ]
    queries = [(1, "the"), (2, "needle in long"), (3, None), (4, ""), (5, "absent"), (6, "ünïcode 日本語 b"), (None, "other"),
               (7, "x y"), (7, "Z the"), (8, "..!")]
    index = lexical.build(docs(*rows))
    asked = spark.createDataFrame([(i, t, 0, 0) for i, t in queries], "item_id int, text string, query int, term int")
    merged = [(i, t) for i, t in queries if i != 7] + [(7, "x y Z the")]
    assert found(index, asked) == ranked(rows, merged)
    assert found(index, asked.limit(0)) == []
    assert found(lexical.build(docs(*rows).limit(0)), asked) == []
    assert found(lexical.build(docs((1, None), (2, "!"))), asked) == []


def test_ties_go_by_id(docs, spark):
    rows = [(i, "same words here") for i in range(400, 0, -1)] + [(1_000, "other")]
    index = lexical.build(docs(*rows).repartition(4))
    got = found(index, spark.createDataFrame([(1, "same here")], "item_id long, text string"))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 11))


def test_block_maxima_keep_lists_packed(monkeypatch):
    """With a rare word and a very common one, few blocks of the common one's list are unpacked."""
    rng = random.Random(4)
    texts = [" ".join(["common"] + [f"x{rng.randrange(90)}" for _ in range(rng.randrange(5, 60))]) for _ in range(8_000)]
    for i in range(100, 160):
        texts[i] += " rare" * (1 + i % 3)
    counts = [Counter(t.split()) for t in texts]
    n_terms = sum(sum(c.values()) for c in counts)
    shard = lexical.invert(0, pa.array(range(len(texts))), pa.array(texts), len(texts), n_terms).to_pylist()
    m = lexical.norms(np.array([sum(c.values()) for c in counts]), len(texts), n_terms)
    rows = {r["term"]: (r["df"], r["top"], r["blocks"], r["payload"]) for r in shard}
    lists = [lexical.PostingList(w, *rows[t]) for t, w in (("rare", 5_000), ("common", 1), ("x3", 300), ("x4", 300))]
    read = []
    monkeypatch.setattr(lexical, "unpack_numbers", lambda x, old=lexical.unpack_numbers: (read.append(len(x)), old(x))[1])
    docs, scores = lexical.best_of_shard(lists, m, 10, 1)
    want = np.zeros(len(texts), np.int64)
    for own in lists:
        at, added = own.read(m)
        want[at] += added
    best = np.sort(want)[::-1][:10]
    assert np.sort(scores)[::-1][:10].tolist() == best.tolist()
    assert all(want[d] == s for d, s in zip(docs, scores))
    whole = sum(len(x.payload) for x in lists)
    assert sum(read[:-4]) < whole / 10


@pytest.mark.parametrize("least", [1, 10**12])
def test_what_cannot_matter_elsewhere_is_left_out(least):
    rows = corpus(300, 9)
    texts = [t for _, t in rows]
    counts = [Counter(terms(t)) for t in texts]
    n_terms = sum(sum(c.values()) for c in counts)
    shard = lexical.invert(0, pa.array(range(len(texts))), pa.array(texts), len(texts), n_terms).to_pylist()
    m = lexical.norms(np.array([sum(c.values()) for c in counts]), len(texts), n_terms)
    lists = [lexical.PostingList(100, r["df"], r["top"], r["blocks"], r["payload"]) for r in shard[1:8]]
    docs, scores = lexical.best_of_shard(lists, m, 10, least)
    assert (scores >= least).all() and (len(docs) > 0) == (least == 1)
