"""Quality, language, toxicity, near-duplicates and repeated passages."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cratelake.llm import boosting, chunks, components, langid, minhash, quality, toxicity
from cratelake.llm.queries import QUERIES
from tests.llm import brute

LONG = " ".join(f"w{i % 5000}x{i}" for i in range(60_000))


@pytest.fixture(scope="module")
def tables(sf):
    con = duckdb.connect()
    return {
        t: con.execute(f"SELECT * FROM '{sf}/{t}.parquet'").fetchall() for t in ("documents", "labels")
    }


def words(n, seed=0):
    r = random.Random(seed)
    return [f"{r.choice('bcdfg')}{r.choice('aeiou')}{r.randrange(10_000)}" for _ in range(n)]


def test_quality_counts(spark, sf, tables):
    rows = {r["doc_id"]: r for r in QUERIES["op4_quality"](spark, sf).collect()}
    assert len(rows) == len(tables["documents"])
    good = dict((i, q) for i, q, _ in tables["labels"])
    right = total = 0
    for i, text, *_ in tables["documents"]:
        r = rows[i]
        n, chars, symbols, lines, repeated = brute.statistics(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeated)
        assert r["base_failed"] == (n < 10 or 100 * repeated > 20 * n)
        assert not (r["base_failed"] and r["kept"])
        if i in good and not r["base_failed"]:
            total, right = total + 1, right + (r["kept"] == (good[i] == 1))
    assert right >= 0.9 * total


def test_quality_edges(docs, labels, spark):
    cases = [None, "", " \n\t ", "é" * 40, "a b c d e f g h i j k", "a b c d e\n" * 3, LONG, "x\n\nx\n \nx", "a\x0bb\x0cc\xa0d\x85e"]
    df = docs(*[(i, t) for i, t in enumerate(cases)], (4, cases[4]), (None, cases[4]))
    got = quality.judge(df, labels((4, None, 0, "t"), (None, 1, 0, "t"))).collect()
    assert len(got) == len(cases) + 2
    for r in got:
        if r["doc_id"] is not None:
            assert tuple(r[x] for x in quality.COUNTS) == brute.statistics(cases[r["doc_id"]])
    assert quality.judge(df.limit(0), labels()).count() == 0
    kept = quality.keep(df, labels())
    assert kept.schema == df.schema
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 4), (False, 4), (False, 6), (True, 0)]


def test_trees_are_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = (rng.random(2000) < 0.2 + 0.6 * (x[:, 0] > 0.4) - 0.3 * np.sin(9 * x[:, 0]) * (x[:, 1] > 0.5)).astype(float)
    trees = boosting.fit(x, y, np.array([1, 0, -1]))
    line = np.linspace(0, 1, 200)
    for other in rng.random((20, 2)):
        up = trees.score(np.column_stack([line, np.full(200, other[0]), np.full(200, other[1])]))
        down = trees.score(np.column_stack([np.full(200, other[0]), np.full(200, other[1]), line]))
        assert (np.diff(up) >= -1e-12).all() and (np.diff(down) <= 1e-12).all()
    assert ((trees.score(x) > 0) == (y == 1)).mean() > 0.7
    assert not len(boosting.fit(x[:0], y[:0], np.zeros(3)).roots)
    assert not len(boosting.fit(x, y * 0, np.zeros(3)).roots)


def test_language_held_out(spark, sf, tables):
    rows = {r["doc_id"]: r for r in QUERIES["op2_langid"](spark, sf).collect()}
    assert len(rows) == len(tables["documents"])
    right = total = 0
    for i, text, lang, *_ in tables["documents"]:
        assert rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= rows[i]["score"] <= 1
        if rows[i]["held_out"] and lang:
            total, right = total + 1, right + (rows[i]["lang_pred"] == lang)
    assert right >= 0.97 * total


def test_language_edges(docs):
    train = docs(*[(i, "the cat and the dog", "en") for i in range(5)], *[(9 + i, "der Hund und die Katze ÄÖ", "de") for i in range(5)],
                 (50, None, "en"), (51, "text", None))
    filters = langid.learn(train)
    assert filters.names == ["de", "en"]
    ask = docs((1, "THE DOG"), (2, None), (3, ""), (4, "12 !! 3"), (5, "qqqq"), (None, "und der äö"), (1, "THE DOG"), (7, "the cat " * 50_000))
    got = sorted((r["doc_id"] or 0, r["lang_pred"], r["score"] > 0) for r in langid.predict(ask, filters).collect())
    assert got == [(0, "de", True), (1, "en", True), (1, "en", True), (2, "und", False), (3, "und", False), (4, "und", False), (5, "de", False), (7, "en", True)]
    assert langid.predict(ask.limit(0), filters).count() == 0
    none = langid.learn(train.limit(0))
    assert {r["lang_pred"] for r in langid.predict(ask, none).collect()} == {"und"}


def test_more_languages_than_a_table_has_bits(docs):
    own = {f"l{k:03}": " ".join(words(12, 7000 + k)) for k in range(130)}
    rows = [(2 * k + i, text, lang) for k, (lang, text) in enumerate(own.items()) for i in range(1 + (k < 64))]
    filters = langid.learn(docs(*rows))
    assert filters.names == sorted(own)
    got = {r["doc_id"]: r for r in langid.predict(docs(*rows), filters).collect()}
    assert all(got[i]["lang_pred"] == lang and 0 < got[i]["score"] <= 1 for i, _, lang in rows)
    column = docs(*rows).select("text").toArrow()["text"].combine_chunks()
    shares = filters.shares(column)
    best, most, total = filters.best(column)
    assert shares.shape == (len(rows), 130) and (best == shares.argmax(1)).all() and (most == shares.max(1)).all()
    assert np.allclose(total, shares.sum(1))


def test_language_filters_hold_every_gram(docs):
    filters = langid.learn(docs(*[(i, "alpha beta gamma", "xx") for i in range(3)]))
    assert filters.shares(docs((1, "gamma alpha")).select("text").toArrow()["text"].combine_chunks())[0, 0] > 0.7


def test_toxicity_held_out(spark, tables):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    toxic = dict(con.execute(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    rows = QUERIES["op5_toxicity"](spark, sf).collect()
    assert len(rows) == con.execute(f"SELECT count(*) FROM '{sf}/documents.parquet'").fetchone()[0]
    scores = [(r["score"], toxic[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.5)
    pairs = [(a > b) + (a == b) / 2 for a, y in scores if y for b, z in scores if not z]
    assert np.mean(pairs) > 0.75


def test_toxicity_edges(docs, labels):
    plain = [" ".join(words(60, i)) for i in range(80)]
    bad = [x + " vile rotten vile" for x in plain[:40]]
    df = docs(*[(i, t) for i, t in enumerate(plain + bad)])
    marks = labels(*[(i, 1, int(i >= 80), "t") for i in range(120)], (None, 1, 1, "t"), (3, 1, None, "t"))
    model = toxicity.learn(df, marks)
    ask = docs((1, "Éa VILE rotten vile mess"), (2, " ".join(words(50, 999))), (3, None), (4, ""), (None, "vile"), (2, " ".join(words(50, 999))),
               (6, LONG + " vile rotten vile rotten"))
    got = toxicity.score(ask, model).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 7 and by[1]["score"] > 0.5 > by[2]["score"] and by[3]["score"] == by[4]["score"] < 0.5
    first = by[1]["passages"][0]
    assert "Éa VILE rotten vile mess"[first["start"]:first["end"]] == "VILE rotten vile"
    assert by[6]["passages"]
    assert toxicity.score(ask.limit(0), model).count() == 0
    assert all(r["score"] < 0.5 and r["passages"] == [] for r in toxicity.score(ask, toxicity.learn(df, labels())).collect())


def test_segments_are_the_maximal_ones():
    def slow(s, at=0):
        """The best segment, then the same left and right of it."""
        best = max(((sum(s[a:b]), a, b) for a in range(len(s)) for b in range(a + 1, len(s) + 1)), default=(0, 0, 0), key=lambda x: (x[0], -x[2] + x[1]))
        if best[0] <= 0:
            return []
        _, a, b = best
        return slow(s[:a], at) + [(at + a, at + b, best[0])] + slow(s[b:], at + b)

    r = random.Random(1)
    for _ in range(300):
        s = [r.choice([-7.3, -3.1, -1.7, 2.2, 4.9, 1.3]) + r.random() / 100 for _ in range(r.randrange(12))]
        got = toxicity.segments(s)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in slow(s)]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(docs, percent):
    rows, r = [], random.Random(3)
    for g in range(12):
        base = words(r.randrange(8, 120), g)
        for _ in range(r.randrange(1, 9)):
            text = list(base)
            for _ in range(r.randrange(4)):
                text[r.randrange(len(text))] = f"new{r.random()}"
            rows.append(" ".join(text))
            base = text if r.random() < 0.3 else base
    rows += [rows[0]] * 5 + [rows[0].upper(), None, "", "  \n", "one two", "ONE\ttwo", LONG, LONG + " end"]
    r.shuffle(rows)
    pairs = list(enumerate(rows))
    want = brute.near_duplicates(pairs, percent)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in minhash.near_duplicates(docs(*pairs), percent).collect()}
    assert got == want
    kept = minhash.one_each(docs(*pairs), percent)
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(i for i, (_, c) in want.items() if c == i)


def test_near_duplicates_edges(docs):
    text = " ".join(words(30))
    got = minhash.near_duplicates(docs((None, text), (7, text), (7, text), (3, None), (3, ""), (None, "")), 85).collect()
    assert sorted(((x["doc_id"] or -1), x["component_id"]) for x in got if x["n_shingles"]) == [(-1, 7), (7, 7), (7, 7)]
    assert all(x["component_id"] == x["doc_id"] for x in got if not x["n_shingles"])
    assert minhash.near_duplicates(docs().limit(0), 85).count() == 0
    left = minhash.one_each(docs((7, text), (7, text), (None, text), (9, text)), 85).collect()
    assert [x["doc_id"] for x in left] == [7]


def test_one_each_judges_rows_by_their_own_text(docs):
    x, y, z = (" ".join(words(40, seed)) for seed in (1, 2, 3))
    left = lambda *rows: sorted(((r["doc_id"] or -1), r["text"]) for r in minhash.one_each(docs(*rows), 80).collect())
    assert left((1, x), (1, y), (1, z)) == sorted([(1, x), (1, y), (1, z)])
    assert left((5, z), (5, y), (3, z)) == sorted([(3, z), (5, y)])
    assert left(*[(None, x)] * 5, (None, y)) == sorted([(-1, x), (-1, y)])
    rows = minhash.one_each(docs((2, x), (None, x), (2, x), (2, None), (2, None), (None, "")), 80).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in rows) == sorted([("2", x), ("2", "None"), ("2", "None"), ("None", "")])


@pytest.mark.parametrize("seed", range(2))
def test_one_each_equals_brute_force_with_any_ids(docs, seed):
    r = random.Random(seed)
    texts, rows = [words(60, 100 + i) for i in range(12)], []
    for _ in range(160):
        text = list(r.choice(texts))
        for _ in range(r.choice((0, 0, 1, 2, 12))):
            text[r.randrange(len(text))] = f"new{r.random()}"
        rows.append((r.choice((None, 1, 2, 3, r.randrange(100))), r.choice((" ".join(text), " ".join(text), None, "", "Two words"))))
    rows += r.choices(rows, k=60)
    component = {n: c for n, (_, c) in brute.near_duplicates([(n, t) for n, (_, t) in enumerate(rows)], 80).items()}
    told = docs(*rows).where("text is not null").select("text", minhash.digest_of(F.col("text")).alias("digest"))
    digest = {r["text"]: tuple(r["digest"]) for r in told.distinct().collect()}
    groups = {}
    for n, (i, t) in enumerate(rows):
        if brute.shingles(t):
            groups.setdefault(component[n], []).append((i is None, i or 0, digest[t], i, t))
    want = [min(x)[3:] for x in groups.values()] + [(i, t) for i, t in rows if not brute.shingles(t)]
    got = [(x["doc_id"], x["text"]) for x in minhash.one_each(docs(*rows), 80).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_one_each_keeps_columns_of_any_name(spark):
    names = ["doc_id", "text", "_turn", "a.b", "given", "id", "name", "digest", "label", "first"]
    text = " ".join(words(30))
    rows = [(i, text if i < 3 else text[::-1], 7, i, 8, 9, 10, 11, 12, 13) for i in (2, 1, 1, 3)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` {'string' if n == 'text' else 'int'}" for n in names))
    left = minhash.one_each(df, 80)
    assert left.columns == names
    assert sorted(tuple(x)[2:] for x in left.collect()) == [(7, 1, 8, 9, 10, 11, 12, 13), (7, 3, 8, 9, 10, 11, 12, 13)]
    assert minhash.one_each(df.limit(0), 80).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (103, 103)] + [(500, 500 + i) for i in range(1, 60)]
    names = {n: hash((n, "x")) for a, b in links for n in (a, b)}
    frame = spark.createDataFrame([(names[a], names[b]) for a, b in links], "a long, b long")
    label = {r["node"]: r["label"] for r in components.components(frame).collect()}
    groups = [range(41), range(100, 103), range(500, 560)]
    assert [len({label[names[n]] for n in g}) for g in groups] == [1, 1, 1]
    assert len({label[names[g[0]]] for g in groups}) == 3
    assert components.components(frame.limit(0)).count() == 0


def test_repeated_passages(docs):
    passage = " ".join(words(70, 5))
    own = [" ".join(words(n, 100 + n)) for n in (0, 3, 40, 200, 7, 90)]
    rows = [(i, f"{a} {passage} {' '.join(words(60, 900 + i))}") for i, a in enumerate(own)]
    clean = [(50 + i, " ".join(words(150, 2000 + i))) for i in range(6)]
    run = "na " * 300
    more = [(80, None), (81, ""), (None, passage), (82, run + "x1"), (83, "éé " + run), (84, LONG), (0, rows[0][1])]
    df = docs(*rows, *clean, *more)
    found = chunks.repeats(df).collect()
    assert {r["doc_id"] for r in found} == {0, 1, 2, 3, 4, 5, 82, 83}
    texts = {i: t for i, t in rows + more if t and i is not None}
    for r in found:
        if r["doc_id"] < 50:
            assert texts[r["doc_id"]][r["start"]:r["end"]].strip() in passage
            assert r["first_doc_id"] == 0 and r["kept"] == (r["doc_id"] == 0)
    short = chunks.deduplicate(df, chunks.repeats(df))
    after = [(r["doc_id"], r["text"]) for r in short.collect()]
    assert short.schema == df.schema and len(after) == df.count()
    assert all(len(t) < len(texts[i]) - 200 for i, t in after if i in (1, 2, 3, 4, 5))
    assert all(t == dict(clean)[i] for i, t in after if i in dict(clean))
    assert chunks.repeats(df.limit(0)).count() == 0


def test_copies_that_quote_a_third_document_stay_once(docs):
    quote, left, right = " ".join(words(60, 1)), " ".join(words(80, 2)), " ".join(words(80, 3))
    copy = f"{left} {quote} {right}"
    df = docs((1, f"{' '.join(words(50, 4))} {quote} {' '.join(words(50, 5))}"), (3, copy), (5, copy))
    found = chunks.repeats(df).collect()
    assert [sorted({r["kept"] for r in found if r["doc_id"] == i}) for i in (1, 3, 5)] == [[True], [False, True], [False]]
    assert all(r["kept"] == (r["first_doc_id"] == r["doc_id"]) for r in found)
    after = {r["doc_id"]: r["text"] for r in chunks.deduplicate(df, chunks.repeats(df)).collect()}
    assert after[5] == ""
    everything = " ".join(after.values())
    assert all(everything.count(w) == 1 for w in set(words(80, 2)[:-8] + words(80, 3)[8:]) - set(words(60, 1)))
    assert sum(map(len, after.values())) < len(df.where("doc_id = 1").first()["text"]) + len(left) + len(right) + 200


def test_chunks_cover_every_text(docs):
    texts = ["", "short", "no cut " + "z" * 5000, LONG, "aé" * 3000]
    parts = chunks.chunked(docs(*enumerate(texts), (9, None))).orderBy("doc_id", "idx").collect()
    for i, text in enumerate(texts):
        own = [p for p in parts if p["doc_id"] == i]
        assert [p["start"] for p in own] == list(np.cumsum([0, *(p["length"] for p in own)])[:-1])
        assert sum(p["length"] for p in own) == len(text)
        assert sum(p["n_words"] for p in own) == len(brute.WORD.findall(text))
