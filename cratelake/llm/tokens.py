"""Token ids of whole texts, each distinct piece of text encoded once.

Texts are cut at single blanks and line breaks, and before points that follow a letter. No token of the
vocabularies used here crosses such a place, so the ids of a text are those of its pieces in order;
vocabularies for which that cannot be told from their files get whole texts as pieces.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa

MEMO_PIECES = 400_000  # pieces a worker remembers, and the bytes of the longest of them
MEMO_BYTES = 128

# Bytes that surely belong to no white space of any definition: visible ASCII, and the lead bytes of
# characters outside the blocks that hold white space.
_FIRM = np.zeros(256, bool)
_FIRM[0x21:0x7F] = True
_FIRM[0xC3:0xF5] = True
_FIRM[[0xE1, 0xE2, 0xE3, 0xEF]] = False
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PLAIN = re.compile(rb" ?[\x21-\x7E\x80-\xC1\xC3-\xE0\xE4-\xEE\xF0-\xFF]+")  # firm characters only
JOINED_PIECES = 64
POINTS = b".,;:!?"
_POINT = np.zeros(256, bool)
_POINT[[*POINTS]] = True
LATIN = "".join(map(chr, (*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))))


def pieces(data: np.ndarray, offsets: np.ndarray, inner: bool = True, points: bool = True) -> tuple[pa.Array, np.ndarray]:
    """The pieces of flat texts as bytes, and which is each text's first; an empty text has none.

    Texts are cut before a single blank, on both sides of a single line break, and with ``points`` between a
    Latin letter and a point after it. Without ``inner`` every text is one piece.
    """
    heads = offsets[:-1][np.diff(offsets) > 0]
    starts = heads
    if inner and len(data):
        edge = np.zeros(len(data) + 1, bool)
        at = np.flatnonzero((data == 0x20) | (data == 0x0A))
        at = at[(at > 0) & (at < len(data) - 1)]
        at = at[_FIRM[data[at + 1]]]
        lead = at - 1
        for _ in range(3):  # back over the bytes that go on a character
            lead = np.where((data[lead] & 0xC0) == 0x80, np.maximum(lead - 1, 0), lead)
        at = at[_FIRM[data[lead]]]
        edge[at] = True
        edge[at + 1] = data[at] == 0x0A
        edge[np.concatenate([heads[heads > 0] - 1, heads])] = False  # what follows there is another text's
        if points:
            at = np.flatnonzero(_POINT[data])
            at = at[at > 0]
            last, before = data[at - 1], data[np.maximum(at - 2, 0)]
            edge[at] |= _LETTER[last] | ((before == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7))
        edge[heads] = True
        starts = np.flatnonzero(edge[:len(data)])
    ends = np.append(starts, len(data)).astype(np.int64)
    body = pa.py_buffer(np.ascontiguousarray(data))
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), body])
    return found, np.searchsorted(starts, offsets)


class Memo:
    """What ``make`` gives for distinct pieces; short ones are remembered from call to call.

    Pieces that were asked for since half of the room was filled stay when it is filled again.
    """

    def __init__(self, make: Callable[[list[bytes]], list]):
        self.make = make
        self.new: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}

    def clear(self) -> None:
        self.new, self.old = {}, {}

    def __call__(self, found: list[bytes]) -> list:
        values = list(map(self.new.get, found))
        lacking = [i for i, value in enumerate(values) if value is None]
        unknown = [i for i in lacking if found[i] not in self.old]
        for i, value in zip(unknown, self.make([found[i] for i in unknown]) if unknown else []):
            values[i] = value
        for i in lacking:
            if values[i] is None:
                values[i] = self.old[found[i]]
            if len(found[i]) <= MEMO_BYTES:
                self.new[found[i]] = values[i]
        if len(self.new) > MEMO_PIECES // 2:
            self.new, self.old = {}, self.new
        return values


def joined(values: list[bytes], codes: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """``values[codes]`` one after the other, and where each begins."""
    if not len(codes):
        return memoryview(b""), np.zeros(1, np.int64)
    taken = pa.array(values, pa.large_binary()).take(pa.array(codes, pa.int64()))
    begins = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(taken) + 1]
    body = taken.buffers()[2]
    return memoryview(body).cast("B") if body else memoryview(b""), begins


class ByteLevel:
    """A byte-level BPE from its ``tokenizers`` file.

    ``plain`` makes the strings of special tokens ordinary text; otherwise they are those tokens.
    """

    def __init__(self, path: str, plain: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = plain
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        before = given.get("pre_tokenizer") or {}
        special = [x["content"] for x in given.get("added_tokens", [])]
        self.inner = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not given.get("normalizer") and given["model"]["type"] == "BPE"
            and not any(" " in x or "\n" in x for x in special)
            and not any(x.get(k) for x in given.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word"))
        )
        line = self.model.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self.size = self.model.get_vocab_size()
        self.width = "<u2" if max(self.model.get_vocab().values()) < 1 << 16 else "<u4"

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def packed_ids(self, found: list[bytes]) -> list[bytes]:
        """The ids of pieces as bytes. Pieces without white space but a first blank are encoded many at a time, with line
        breaks between them: no token crosses these, and their id comes from nothing else."""
        out: list[bytes | None] = [None] * len(found)
        plain = [i for i, x in enumerate(found) if _PLAIN.fullmatch(x)] if self.inner and self.line is not None else []
        lines = [
            b"\n".join([found[i] for i in plain[low:low + JOINED_PIECES]] + [b""]).decode()
            for low in range(0, len(plain), JOINED_PIECES)
        ]
        for low in range(0, len(lines), 256):
            encoded = self.model.encode_batch_fast(lines[low:low + 256], add_special_tokens=False)
            ids = np.array([i for x in encoded for i in x.ids], self.width)
            ends = np.flatnonzero(ids == self.line)
            body, size, some = ids.tobytes(), ids.itemsize, plain[low * JOINED_PIECES:(low + 256) * JOINED_PIECES]
            for i, a, b in zip(some, [0, *((ends[:-1] + 1) * size).tolist()], (ends * size).tolist()):
                out[i] = body[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self.ids([found[i].decode() for i in rest]) if rest else []):
            out[i] = np.array(x, self.width).tobytes()
        return out

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id; visible characters stand for themselves, the rest for 256 and on."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        out = [b""] * (max(self.model.get_vocab().values()) + 1)
        for token, i in self.model.get_vocab().items():
            out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        return out


class WordPieces:
    """A sentencepiece model with byte fallback, which puts a blank before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(self.size)]
        self.blank = self.model.piece_to_id("▁")
        self.inner = (
            not any("\n" in x or "▁" in x.lstrip("▁") for x in names)
            and len(self.model.encode("\n")) == 2 and self.model.encode("  a ")[-1:] == [self.blank]
        )
        across = {x + chr(p) for x in LATIN for p in POINTS}
        self.points = not any(name[i:i + 2] in across for name in names for i in range(len(name) - 1))

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of pieces of texts.

        The model's own blank stands for the piece's first. A piece without one is encoded after a line break,
        and blank and line break are taken away again.
        """
        given = self.model.encode([x[1:] if x[0] == " " else "\n" + x for x in texts], num_threads=1)
        return [ids if text[0] == " " else ids[2:] for text, ids in zip(texts, given)]

    def token_bytes(self) -> list[bytes]:
        out = []
        for i in range(self.size):
            name = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                out.append(bytes([int(name[3:5], 16)]))
            else:
                out.append(b"" if self.model.is_control(i) else name.replace("▁", " ").encode())
        return out


def public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(4)
def byte_level(path: str | None = None, plain: bool = False) -> ByteLevel:
    """Loaded once per Python worker; by default the vocabulary of 50,257 ids."""
    return ByteLevel(path or public("byte_bpe_50k.json"), plain)


@functools.lru_cache(4)
def word_pieces(path: str | None = None) -> WordPieces:
    return WordPieces(path or public("piece_bpe_32k.model"))
