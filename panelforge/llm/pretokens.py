"""Pre-tokens of many texts at once, for the byte-pair operators.

Texts whose characters are all in ``PLAIN`` (Latin letters, digits, usual
punctuation) are split by array operations on their UTF-8 bytes; others go
through the tokenizer library's own steps, text by text.
"""

from __future__ import annotations

import re
import sys
import types

import numpy as np
import pyarrow as pa

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3

#: Any character beyond those whose class and lower case are in the tables.
ODD = re.compile("[^\x00-įı-ɏ‐-‧€]")

#: Text of at most so many bytes is split at once (one longer text is alone).
PART_BYTES = 2_000_000


def _class_table() -> np.ndarray:
    """Class of each code point below U+20B0 that ``ODD`` lets through."""
    table = np.full(0x20B0, OTHER, np.uint8)
    for cp in range(0x250):
        c = chr(cp)
        if c.isalpha():
            table[cp] = LETTER
        elif c.isnumeric():
            table[cp] = NUMBER
        elif c.isspace() and not 0x1C <= cp <= 0x1F:
            table[cp] = SPACE
    return table


_TABLE = _class_table()


def byte_alphabet() -> dict[str, int]:
    """Characters by which byte-level vocabularies write bytes: printable
    Latin-1 stands for itself, the other bytes for code points from 256 on."""
    shown = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def worker_state(name: str) -> types.ModuleType:
    """A place that lasts as long as the Python worker, across tasks."""
    return sys.modules.setdefault(f"_corpus_{name}", types.ModuleType(f"_corpus_{name}"))


def byte_classes(b: np.ndarray) -> np.ndarray:
    """Class of the character that each byte belongs to."""
    cls = _TABLE[np.where(b < 0x80, b, 0)]
    two = np.flatnonzero((b >= 0xC0) & (b < 0xE0))
    if len(two):
        cls[two] = cls[two + 1] = _TABLE[((b[two] & 0x1F).astype(np.int32) << 6) | (b[two + 1] & 0x3F)]
    three = np.flatnonzero(b >= 0xE0)
    if len(three):
        cls[three] = cls[three + 1] = cls[three + 2] = OTHER
    return cls


def split_bytes(b: np.ndarray, ends: np.ndarray, spaces_lead: bool) -> np.ndarray:
    """Where pre-tokens begin in the bytes of texts that end at ``ends``
    (ascending; empty texts allowed).

    Runs of letters, of numbers and of other characters are pre-tokens, and
    an apostrophe with s, t, re, ve, m, ll or d is one if it begins one.
    ``spaces_lead``: a space before a run belongs to it and the white space
    before that is a pre-token; else each run of white space is one and each
    number stands alone.
    """
    n = len(b)
    cls = byte_classes(b)
    start = np.empty(n + 1, bool)
    start[0] = start[n] = True
    start[1:n] = cls[1:] != cls[:-1]
    text_start = np.zeros(n + 1, bool)
    text_start[0] = text_start[n] = True
    text_start[ends] = True
    start |= text_start
    lead = (b & 0xC0) != 0x80
    if spaces_lead:
        # first bytes after white space inside a text, and the last space before them
        after = np.flatnonzero((cls[1:] != SPACE) & (cls[:-1] == SPACE) & ~text_start[1:n]) + 1
        last = after - 1
        last = np.where(lead[last], last, last - 1)
        start[last] = True
        start[after[b[last] == 0x20]] = False
    else:
        start[:n] |= (cls == NUMBER) & lead
    q = np.flatnonzero(b[: n - 1] == 0x27)
    q = q[start[q] & (cls[q + 1] == LETTER) & ~text_start[q + 1]]
    if len(q):
        text_end = ends[np.searchsorted(ends, q, "right")]
        x = b[q + 1]
        y = np.where(q + 2 < text_end, b[np.minimum(q + 2, n - 1)], 0)
        one = np.isin(x, np.frombuffer(b"stmd", np.uint8))
        two = ((x == ord("r")) & (y == ord("e"))) | ((x == ord("v")) & (y == ord("e"))) | ((x == ord("l")) & (y == ord("l")))
        q, size = q[one | two], np.where(one, 2, 3)[one | two]
        start[q + 1] = False
        start[q + size] = True
    return np.flatnonzero(start[:n])


def dictionary(texts: pa.Array, spaces_lead: bool) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """For plain texts: where each text's pre-tokens end, the number of each
    pre-token in the list of distinct ones, and that list."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(len(texts), np.int64), np.empty(0, np.int32), []
    b = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    ends = offsets[1:] - offsets[0]
    begin = split_bytes(b, ends, spaces_lead)
    marks = np.append(begin, len(b)).astype(np.int32)
    pieces = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(marks), pa.py_buffer(b)])
    coded = pieces.dictionary_encode()
    return np.searchsorted(begin, ends, "left"), coded.indices.to_numpy(), _as_bytes(coded.dictionary)


def _as_bytes(a: pa.Array) -> list[bytes]:
    at = np.frombuffer(a.buffers()[1], np.int32)[: len(a) + 1].tolist()
    raw = a.buffers()[2].to_pybytes()
    return [raw[x:y] for x, y in zip(at, at[1:], strict=False)]


def parts(lengths: np.ndarray, most: int = PART_BYTES):
    """Ranges of places whose lengths add up to ``most`` at most (or one place)."""
    at, total = 0, 0
    for i, x in enumerate(lengths):
        if total and total + x > most:
            yield at, i
            at, total = i, 0
        total += int(x)
    if at < len(lengths):
        yield at, len(lengths)


class Cache:
    """Pre-token to value. The newest ``limit`` to ``2 * limit`` entries stay:
    a full half is set aside, and dropped when the next one is full; what is
    used meanwhile moves on."""

    def __init__(self, limit: int = 60_000):
        self.limit, self.new, self.old = limit, {}, {}

    def values_of(self, keys: list[bytes], make) -> list:
        """Values of ``keys``; ``make`` gives those of a list of unknown ones."""
        new, old = self.new, self.old
        out = [new.get(k) for k in keys]
        missing = [i for i, v in enumerate(out) if v is None]
        unknown = []
        for i in missing:
            v = out[i] = old.get(keys[i])
            if v is None:
                unknown.append(i)
            else:
                new[keys[i]] = v
        for i, v in zip(unknown, make([keys[i] for i in unknown]), strict=True):
            out[i] = new[keys[i]] = v
        if len(new) > self.limit:
            self.new, self.old = {}, new
        return out
