"""URLs, mixing, personal data, packing, neighbours, and the pipeline."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cratelake.llm import minhash, mixing, neighbours, packing, pii, quality, urls
from cratelake.llm.queries import QUERIES
from cratelake.llm.ship import ship
from tests.llm import brute


def test_url_parts_and_rules(spark):
    given = [
        (1, "http://A.Example.ORG/es/x?q#f"), (2, "https://example.org/en/12"), (3, "x://b.example.org/en/2"),
        (4, "http://q.com/fr/1"), (5, "http://com/de/"), (6, "http://notcom/de/"), (7, None), (8, "nothing"), (9, ""),
        (10, "http://h.org?x=/a"), (11, "a://b://c/d"), (12, "http://"), (13, "http://q.com/fr/1"), (None, "http://q.net#/x"),
    ]
    pages = spark.createDataFrame([(i, u, "h", 1, "r") for i, u in given], "page_id long, url string, host string, n int, rule string")
    none = spark.createDataFrame([], "host string, good int")
    got = {r["page_id"]: tuple(r)[1:] for r in urls.judge(pages, none).collect()}
    assert got == {
        1: ("a.example.org", "/es/x", "example.org/es/", "block"), 2: ("example.org", "/en/12", "example.org/en/1", "block"),
        3: ("b.example.org", "/en/2", "org/", "allow"), 4: ("q.com", "/fr/1", "com/fr/", "allow"),
        5: ("com", "/de/", "com/de/", "block"), 6: ("notcom", "/de/", None, "allow"), 7: ("", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("h.org", "", None, "allow"),
        11: ("b:", "//c/d", None, "allow"), 12: ("", "", None, "allow"), 13: ("q.com", "/fr/1", "com/fr/", "allow"),
        None: ("q.net", "", None, "allow"),
    }
    assert urls.judge(pages.limit(0), none).count() == 0


def test_url_reputation_shrinks(spark):
    hosts = [("bad.spam.net", 0, 40), ("one.spam.net", 0, 1), ("new.spam.net", None, 1)]
    hosts += [(f"h{i}.fine{i}.net", 1, 20) for i in range(20)]
    outcomes = spark.createDataFrame([(h, g) for h, g, n in hosts for _ in range(n)], "host string, good int")
    pages = spark.createDataFrame([(i, f"http://{h}/a") for i, (h, _, _) in enumerate(hosts)], "page_id long, url string")
    verdict = {r["host"]: r["verdict"] for r in urls.judge(pages, outcomes).collect()}
    assert verdict["bad.spam.net"] == "block" and verdict["h3.fine3.net"] == "allow"
    mean = {r["host"]: r["mean"] for r in urls.reputations(
        outcomes.groupBy("host").agg(F.sum("good").alias("g"), F.count("good").alias("n")).fillna(0)).collect()}
    assert mean["bad.spam.net"] < mean["one.spam.net"] <= mean["new.spam.net"] < mean["h3.fine3.net"]


def test_mixing(docs):
    sizes = {"a": [5, 0, 9, 40], "b": [3] * 30, "é": [100], None: [7, 8, 1], "z": [0]}
    rows = [(100 * k + i, " ".join(["w"] * n), None, s) for k, (s, v) in enumerate(sizes.items()) for i, n in enumerate(v)]
    rows += [(None, "x y", None, "a"), (None, "x y", None, "a"), (900, None, None, "b"), (901, "é\xa0ü\x85x", None, "b")]
    got = mixing.mix(docs(*rows)).collect()
    assert len(got) == len(rows)
    total = sum(r["size"] for r in got)
    own = {g["source_size"]: g["target"] for g in got}
    # The shares by hand: what a source has too much goes to the others by weight until none has.
    size_of = {s: sum(len(brute.WORD.findall(t or "")) for _, t, _, x in rows if x == s) for s in sizes}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * total
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 2 * size_of[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * size_of[s]
        left, free = left - sum(target[s] for s in over), free - over
    for s in order:
        assert own[size_of[s]] == pytest.approx(target[s])
    taken = Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source_size"]] += r["taken"]
    assert all(abs(taken[s] - own[s]) <= 1 for s in own)
    assert sorted(map(repr, mixing.mix(docs(*rows[::-1])).collect())) == sorted(map(repr, got))
    assert mixing.mix(docs().limit(0)).count() == 0
    drawn = mixing.draw(docs(*rows))
    assert drawn.schema == docs(*rows).schema
    words = defaultdict(int)
    for r in drawn.collect():
        words[r["source"]] += len(brute.WORD.findall(r["text"] or ""))
    largest = {s: max((len(brute.WORD.findall(t or "")) for _, t, _, x in rows if x == s)) for s in sizes}
    assert all(abs(words[s] - target[s]) <= largest[s] for s in order)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            v = m.group()
            d = [int(c) for c in v if c.isdecimal()]
            fine = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in v.split(".")),
                "card": lambda: 13 <= len(d) <= 19 and (sum(d[::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])) % 10 == 0,
                "phone": lambda: 9 <= len(d) <= 15,
            }[kind]()
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


def test_personal_data(docs):
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111 1111 1111 1112", "4111  1111 1111 1111", "1 4111111111111111", "0000000000000"]
    texts = [
        "mail a@b.c_d@e.f and x.y+z@q-1.co.uk. a@b @c.d é@é.fr", "a@b.c@d.e%f@g.h", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.3.0255 1.2.3",
        *cards, " ".join(cards), "+1 (555) 123-4567 +12 +1-2-3-4-5-6-7-8-9 +49 30 1234567890123", "", None, "é\U0001F600 a@b.cd",
        "a" * 60_000 + "@x.y", "1" * 60_000, "a@" + "b." * 30_000 + "c", "+1" + " 2" * 30_000, "1." * 30_000, "a@b.c " * 1500,
        "IBAN GB82 WEST 1234 5698 7654 32 or GB83 WEST 1234 5698 7654 32", "ssn 123-45-6789", "123-45-6789 alone",
    ]
    df = docs(*enumerate(texts), (0, texts[0]), (None, texts[0]))
    got = pii.report(df).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = texts[r["doc_id"] or 0]
        want = base_spans(text)
        have = [tuple(s.split(":")) for s in r["spans"].split(",") if s]
        assert [(k, int(a), int(b)) for k, a, b in have if k in BASE] == want
        assert [r[f"n_{k}"] for k in BASE] == [sum(w[0] == k for w in want) for k in BASE]
    more = {r["doc_id"]: [s for s in r["spans"].split(",") if s.startswith(("iban", "ssn"))] for r in got}
    assert more[len(texts) - 3] == ["iban:5:32"] and more[len(texts) - 2] == ["ssn:4:15"] and not more[len(texts) - 1]
    assert pii.report(df.limit(0)).count() == 0
    masked = pii.mask(docs((1, "to a@b.c, 4111 1111 1111 1111!"), (2, None), (3, "none"), (4, "é a@b.c")))
    assert {r["doc_id"]: r["text"] for r in masked.collect()} == {1: "to <email>, <card>!", 2: None, 3: "none", 4: "é <email>"}
    assert masked.dtypes == docs().dtypes


def test_packing(docs, spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    texts |= {-1: None, -2: "", -3: "  \n\n\t x ", -4: "\u00e9\U0001F600\r\n'Ll we'LL 12ab", -5: "ab " * 20_000}
    df = docs(*texts.items(), (-1, None))
    pieces = packing.pack(df).collect()
    by, at = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[p["doc_id"]].append(p)
        at[p["sequence_id"]].append(p)
    for i, text in texts.items():
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 1] * (2 if i == -1 else 1)
        own = sorted(by[i], key=lambda p: (p["start"], p["sequence_id"]))
        assert b"".join(p["ids"] for p in own) == np.array(ids, "<u4").tobytes()
        assert all(p["length"] * 4 == len(p["ids"]) for p in own)
    for n, own in at.items():
        own.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == list(np.cumsum([0, *(p["length"] for p in own)])[:-1])
        assert n == max(at) or sum(p["length"] for p in own) == packing.LENGTH
    assert sorted(at) == list(range(max(at) + 1))
    assert packing.pack(df.limit(0)).count() == 0


def test_packing_special_tokens_and_long_runs(docs):
    texts = {1: "a<|endoftext|>b", 2: " " * 2_000_000, 3: "<|endoftext|>" * 3}
    got = defaultdict(bytes)
    for p in sorted(packing.pack(docs(*texts.items())).collect(), key=lambda p: (p["doc_id"], p["start"])):
        got[p["doc_id"]] += p["ids"]
    got = {i: np.frombuffer(x, "<u4").tolist() for i, x in got.items()}
    assert got == {1: [64, 50256, 65, 1], 2: [220] * 2_000_000 + [1], 3: [50256] * 3 + [1]}


def test_hilbert_walks_to_neighbours():
    side = np.arange(16)
    grid = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3)
    order = packing.hilbert(grid, 4)
    assert sorted(order) == list(range(16**3))
    walk = grid[np.argsort(order)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def nearest_by_force(rows, queries, k=10):
    out = {}
    rows = {(i, tuple(v)) for i, v in rows}
    for q, v in queries:
        found = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, x in rows if i != q and len(x) == len(v))
        out[q] = found[:k]
    return out


def test_neighbours_edges(spark, docs):
    rng = np.random.default_rng(4)
    same = rng.standard_normal(6).astype("f4").tolist()
    rows = [(i, rng.standard_normal(6).astype("f4").tolist()) for i in range(60)]
    rows += [(100 + i, same) for i in range(30)] + [(0, rows[0][1])]
    few = [(200, [1.0, 0.0]), (201, [0.5, 0.0]), (300, [1.0, 0.0])]
    bad = [(400, None), (500, []), (600, [0.0] * 6), (700, [float("nan")] * 6), (800, [float("inf")] + [1.0] * 5), (900, [None] + [1.0] * 5), (None, same)]
    schema = "vec_id long, embedding array<float>, rank int, score double, cls long"
    df = spark.createDataFrame([(i, v, 1, 1.0, 1) for i, v in rows + few + bad], schema)
    got = defaultdict(list)
    for r in neighbours.nearest(df, df.where("vec_id % 100 = 0")).collect():
        got[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    want = nearest_by_force(rows + few, [x for x in rows + few if x[0] % 100 == 0])
    assert set(got) == {q for q, v in want.items() if v}
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
        assert len(found) == len(want[q])
        assert [s for _, s, _ in found] == sorted(s for _, s, _ in found)
    # With few or equal vectors nothing is left to chance.
    assert [i for _, _, i in got[100]] == list(range(101, 111))
    for q in (200, 300):
        assert [(i, s) for _, s, i in got[q]] == [(i, s) for s, i in want[q]]
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


def test_neighbours_recall(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = nearest_by_force(rows, [x for x in rows if x[0] % 100 == 0])
    got = defaultdict(dict)
    for r in QUERIES["op10_neighbours"](spark, sf).collect():
        got[r["query_id"]][r["vec_id"]] = r["score"]
    hits = [i in got[q] for q, found in want.items() for _, i in found]
    assert np.mean(hits) >= 0.9
    assert all(got[q][i] == s for q, found in want.items() for s, i in found if i in got[q])


def test_pipeline(spark, sf):
    """Each stage against the brute-force version of its decision."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "personal data", "mixture", "packing"]
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, sf), "test")
        assert docs.columns == columns
        old = {r["doc_id"]: r for r in before.collect()}
        new = docs.collect()
        assert {r["doc_id"] for r in new} <= set(old)
        if name == "quality rules":
            judged = {r["doc_id"]: r["kept"] for r in QUERIES["op4_quality"](spark, sf).collect()}
            assert {r["doc_id"] for r in new} == {i for i, k in judged.items() if k}
        if name == "near-duplicates":
            want = brute.near_duplicates([(i, r["text"]) for i, r in old.items()], corpus_pipeline.PERCENT)
            assert sorted(r["doc_id"] for r in new) == sorted(i for i, (_, c) in want.items() if c == i)
        if name == "personal data":
            assert len(new) == len(old)
            for r in new:
                assert (r["text"] == old[r["doc_id"]]["text"]) == (not base_spans(old[r["doc_id"]]["text"]))
                assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        if name == "mixture":
            mixed = {r["doc_id"]: r for r in mixing.mix(before).collect()}
            copies = Counter(r["doc_id"] for r in new)
            assert all(copies[i] in (r["taken"] // max(r["size"], 1), -(-r["taken"] // max(r["size"], 1))) for i, r in mixed.items())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    ends = sum(p["start"] + p["length"] == p["doc_tokens"] for p in pieces)
    assert ends == docs.count()
    assert corpus_pipeline.run(spark, sf).count() == len(pieces)


HIDDEN = ["_spans", "_cut", "_hits_email", "email", "given", "spans", "cut", "_copies", "_copy", "_whole", "_last", "key", "words", "whole",
          "last", "own", "copies", "copy", "_turn", "a.b", "a`b"]


def test_stages_keep_columns_of_any_name(spark, labels):
    ship(spark)
    text = "write to ann.lee@example.com or call +44 20 7946 0958, please; the rest of this page is plain prose about boats"
    rows = [(i, t, "en", s, 1, *range(len(HIDDEN))) for i, (t, s) in enumerate([(text, "a"), (None, "a"), ("", None), ("some words here", None)])]
    names = ", ".join(f"`{x.replace('`', '``')}` int" for x in HIDDEN)
    df = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")
    for stage in (lambda d: quality.keep(d, labels()), lambda d: minhash.one_each(d, 80), pii.mask, mixing.draw):
        out = stage(df)
        assert out.columns == df.columns
        assert {tuple(r)[5:] for r in out.collect()} <= {tuple(range(len(HIDDEN)))}
        assert stage(df.limit(0)).count() == 0
    assert "<email>" in [r["text"] for r in pii.mask(df).collect() if r["doc_id"] == 0][0]
    assert [r["_spans"] for r in pii.find(df, "found").collect()] == [0] * 4


def test_mixture_is_exact_without_ids(docs):
    rows = [(None, " ".join(f"w{i}x{j}" for j in range(20 + i % 7)), None, s) for s in "abc" for i in range(100)]
    table = docs(*rows)
    goal = {r["source_size"]: r["target"] for r in mixing.mix(table).collect()}
    drawn = {}
    for r in mixing.draw(table).collect():
        drawn[r["source"]] = drawn.get(r["source"], 0) + len(r["text"].split())
    sizes = {s: sum(len(t.split()) for _, t, _, x in rows if x == s) for s in "abc"}
    targets = sorted(r["target"] for r in mixing.mix(table).select("target").distinct().collect())
    assert len(goal) == 1 and sorted(drawn) == ["a", "b", "c"] and len(targets) >= 2
    for s, words in drawn.items():
        assert min(abs(words - t) for t in targets) <= 27 and words <= 2 * sizes[s]
