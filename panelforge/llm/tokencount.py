"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a pre-token form a linked list; a heap holds its adjacent
pairs by rank (the leftmost first among equals). The lowest pair is popped,
merged into its left symbol, and the two pairs beside it are pushed, until
the heap is empty. The count is the number of initial symbols less the number
of merges; no identifiers are made.

Texts are normalised and split as the tokenizer file says, row by row without
a shuffle; counts of distinct pre-tokens are kept per Python worker, in a
bounded cache. Special strings inside texts count as one token each, as the
library does by default.

Defined results: a null or empty text has 0 tokens and 0 bytes; repeated rows
are counted each; further columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens

LIMIT = 2048


def tokens_after_merging(symbols: list[str], rank: dict[tuple[str, str], int]) -> int:
    """Initial symbols less merges."""
    n = len(symbols)
    symbol = list(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 1) for i in range(n - 1) if (r := rank.get((symbol[i], symbol[i + 1]))) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        r, i, j = heapq.heappop(heap)
        if symbol[i] is None or after[i] != j or rank.get((symbol[i], symbol[j])) != r:
            continue  # one of the two has changed since
        symbol[i], symbol[j] = symbol[i] + symbol[j], None
        k = after[i] = after[j]
        merges += 1
        if k < n:
            before[k] = i
            if (s := rank.get((symbol[i], symbol[k]))) is not None:
                heapq.heappush(heap, (s, i, k))
        if (h := before[i]) >= 0 and (s := rank.get((symbol[h], symbol[i]))) is not None:
            heapq.heappush(heap, (s, h, i))
    return n - merges


class Counter:
    """Counts tokens of texts by the tokenizer file at ``path`` (byte-pair
    model over byte-level pre-tokens with an end-of-word mark)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.end = model["end_of_word_suffix"] or ""
        self.letters = {b: c for c, b in pretokens.byte_alphabet().items()}
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))))
        self.cache, self.shown = pretokens.Cache(), pretokens.Cache()

    @classmethod
    def of(cls, path: str) -> Counter:
        known = vars(pretokens.worker_state("counters"))
        if path not in known:
            known[path] = cls(path)
        return known[path]

    def of_shown(self, word: str) -> int:
        """Tokens of a pre-token written in the byte alphabet."""
        return tokens_after_merging([*word[:-1], word[-1] + self.end], self.rank)

    def _of_bytes(self, words: list[bytes]) -> list[int]:
        show = self.letters
        # white space is dropped between pre-tokens
        return [0 if w.decode()[0].isspace() and not 0x1C <= w[0] <= 0x1F else self.of_shown("".join([show[b] for b in w])) for w in words]

    def _odd(self, text: str) -> int:
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return sum(self.shown.values_of([p for p, _ in pieces], lambda new: [self.of_shown(w) for w in new]))

    def count(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        plain, rows = [], []
        for i, t in enumerate(texts):
            if "<" in t and self.special.search(t):
                parts = self.special.split(t)
                total[i] += len(parts) - 1
            else:
                parts = [t]
            for p in parts:
                if not p:
                    continue
                low = None if not p.isascii() and pretokens.ODD.search(p) else p.lower()
                if low is None or (not low.isascii() and pretokens.ODD.search(low)):
                    total[i] += self._odd(p)
                else:
                    plain.append(low)
                    rows.append(i)
        for a, b in pretokens.parts(np.array([len(t) for t in plain], np.int64)):
            ends, codes, words = pretokens.dictionary(pa.array(plain[a:b], pa.string()), False)
            each = np.array(self.cache.values_of(words, self._of_bytes), np.int64)
            upto = np.concatenate(([0], np.cumsum(each[codes])))
            marks = upto[np.concatenate(([0], ends))]
            np.add.at(total, np.array(rows[a:b]), np.diff(marks))
        return total


def _count_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.of(path)
        for b in batches:
            step = 1000
            for k in range(0, b.num_rows, step):
                part = b.slice(k, step)
                n = counter.count([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"]
                )

    return run


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(_count_batches(tokenizer), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
