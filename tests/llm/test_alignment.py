"""Alignment of two vocabularies' tokens, and token ids by pieces, against plain code."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from cratelake.llm import alignment, tokens
from cratelake.llm.queries import QUERIES

ODD = [
    None, "", " ", "\n", "  a", "a  b ", "\n\na", "a\nb\t c", "\x00a\x00", "ﬁ ﷺ Å", "é é", "a▁b", "▁", "x ▁ y",
    "<s> <unk> <0x41> </s>", "a<|endoftext|>b <|endoftext|> c", "\xa0x　y", "\r\n x \r\n", "日本語 の テキスト\n中文", "👍🏽 👨‍👩‍👧 ok",
    "it's we'll I'd 'tis", "x" * 5_000, "ab" * 3_000 + " cd", " " * 3_000, "1 22 333\n4444 ٣٤", "“quote” – dash…", " a   b\x85 c",
    "a\x1c b \x1fc", "tab\tb \t c", "end ", "end\n",
]


def plain(texts):
    """The contract word by word: groups of each text, or none."""
    a, b = tokens.byte_level(None, True), tokens.word_pieces(None)
    bytes_a, bytes_b = a.token_bytes(), b.token_bytes()
    rows = []
    for text in texts:
        if not text:
            rows.append(None)
            continue
        left = a.model.encode(" " + text, add_special_tokens=False).ids
        right = b.model.encode(text)
        want = (" " + text).encode()
        if b"".join(bytes_a[i] for i in left) != want or b"".join(bytes_b[i] for i in right) != want:
            rows.append(None)
            continue
        ends = [np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in ((bytes_a, left), (bytes_b, right))]
        both = sorted(set(ends[0]) & set(ends[1]))
        out, i, j = [], 0, 0
        for end in both:
            to, upto = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            out.append((left[i:to], right[j:upto]))
            i, j = to, upto
        rows.append(out)
    return rows


def shown(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def summary(rows):
    count = Counter((a[-1], b[-1]) for x in rows if x for a, b in x)
    highest = Counter()
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    for x in rows:
        links = [(a[-1], b[-1]) for a, b in x or []]
        yield (
            sum(len(a) for a, _ in x or []), sum(len(b) for _, b in x or []), len(links), len(links),
            sum(count[p] == highest[p[1]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(shown(x).encode()).hexdigest() if x else "",
        )


def random_texts(n, seed):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "a", "the", "The", "é", "ß", "日", "。", "1", "23", ".", "!!", "'s", "'", "\xa0", "　",
             "👍", "▁", "\x00", "\x1c", "\x85", "<|endoftext|>", "​", " ", "_", "Ωμέγα", "न", "﻿", "–", "”", "İ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(n)]


def test_pieces_keep_every_byte_and_every_id():
    texts = random_texts(10_000, 1) + [x or "" for x in ODD]
    column = pa.array(texts)
    from cratelake.llm.text import flat

    data, offsets = flat(column)
    found, first = tokens.pieces(data, offsets)
    listed = found.to_pylist()
    assert [b"".join(listed[i:j]).decode() for i, j in zip(first, first[1:])] == texts
    for plain_text in (False, True):
        model = tokens.byte_level(None, plain_text)
        by_piece = model.ids([x.decode() for x in listed])
        assert [np.frombuffer(x, model.width).tolist() for x in model.packed_ids(listed)] == by_piece
        for text, i, j in zip(texts, first, first[1:]):
            assert sum(by_piece[i:j], []) == model.model.encode(text, add_special_tokens=False).ids, repr(text)


def test_groups_of_random_texts(docs):
    texts = random_texts(4_000, 2) + ODD
    rows = plain(texts)
    got = {r["doc_id"]: r for r in alignment.groups(docs(*enumerate(texts))).collect()}
    assert len(got) == len(texts)
    for i, x in enumerate(rows):
        assert got[i]["groups"] == shown(x or []), repr(texts[i])
        assert got[i]["n_groups"] == len(x or [])


def test_report_of_odd_rows(docs):
    texts = ODD + ["a b", "a b"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (3, "x")]
    want = list(summary(plain([t for _, t in rows])))
    got = alignment.report(docs(*rows)).collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    key = lambda x: (x[0] is None, *map(str, x))
    assert sorted(((r["doc_id"], *(r[x] for x in names)) for r in got), key=key) == sorted(
        ((i, *w) for (i, _), w in zip(rows, want)), key=key)
    assert alignment.report(docs(*rows).limit(0)).count() == 0
    assert alignment.report(docs((1, None), (2, ""))).agg({"count_sum": "sum"}).first()[0] == 0


def test_report_of_the_table(spark, sf):
    given = duckdb.connect().execute(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    want = {i: w for (i, _), w in zip(given, summary(plain([t for _, t in given])))}
    got = QUERIES["op12_alignment"](spark, sf).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(given)


@pytest.mark.parametrize("seed", range(3))
def test_common_ends(seed):
    rng = np.random.default_rng(seed)
    a, b, first, want, base = [], [], [[0], [0]], [], 0
    for n in (0, 1, 2, 7, 300, 3, 0, 40):
        own = [np.sort(rng.choice(3 * n + 1, n, replace=False)) + base for _ in range(2)]
        want += [(len(a) + int(np.flatnonzero(own[0] == x)[0]), len(b) + int(np.flatnonzero(own[1] == x)[0])) for x in np.intersect1d(*own)]
        a, b, base = [*a, *own[0]], [*b, *own[1]], base + 3 * n + 2
        first[0].append(len(a))
        first[1].append(len(b))
    i, j = alignment.common_ends(*(np.array(x, np.int64) for x in (a, b, *first)))
    assert list(zip(i.tolist(), j.tolist())) == want
    even, ends = np.arange(0, 400_000, 2), np.array([0, 200_000])
    assert not len(alignment.common_ends(even, even + 1, ends, ends)[0])


def test_links_are_bounded_by_the_vocabularies():
    assert alignment.possible_links() < 1_000_000


def test_long_text_without_blanks(docs):
    text = "".join(chr(0x4E00 + i * i % 5_000) for i in range(60_000))
    got = alignment.report(docs((1, text))).first()
    want = next(iter(summary(plain([text]))))
    assert tuple(got)[1:] == want
