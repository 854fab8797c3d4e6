"""Best-fit packing by the sum of squares.

A document's tokens (ids of a byte-level tokenizer, then an end id) are cut
into pieces of at most ``capacity`` tokens: only longer documents are cut,
and only their first piece may be shorter than ``capacity``. Pieces are
placed into sequences of ``capacity`` tokens: with N(g) the number of open
sequences that have a gap of g tokens, a piece of s tokens goes where the sum
of N(g)^2 becomes smallest: into a gap g (then N(g) falls and N(g - s) rises),
or into a new sequence. The smaller gap wins a tie, and a new sequence only
if it is strictly better.

Tokens are counted in the tasks that read the texts; only one small row for
each piece is shuffled. Pieces are dealt by a hash to shards of about
``shard_rows`` and packed per shard, the longest first; sequences
that stay less full than ``full`` are dealt again as pieces, to fewer shards,
and packed once more. No shard grows with the input.

Defined results: a null or empty text is its end id alone; repeated rows are
packed each; further columns are ignored; an empty table gives an empty
result. Special strings inside texts are treated as the tokenizer library
does by default.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens
from .common import shared

CAPACITY = 2048
END_ID = 0
SHARD_ROWS = 50_000
#: Texts that go to a Python worker at once.
ARROW_ROWS = 2000
#: Sequences at least so full are left as they are after the first round.
FULL = 0.998


# ---- tokens


class Encoder:
    """Token ids of texts as bytes (unsigned 32-bit, little-endian).

    The ids are those of the tokenizer file under the ``tokenizers`` library.
    Distinct pre-tokens of plain texts are merged by ``tiktoken``, which
    follows the same ranks several times faster and is given the vocabulary of
    the same file; texts with special strings or unusual characters go whole
    through ``tokenizers``.
    """

    def __init__(self, path: str):
        import json

        import public_tokenizers
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        alphabet = pretokens.byte_alphabet()
        ranks = {
            bytes(alphabet[c] for c in piece): i
            for piece, i in spec["model"]["vocab"].items()
            if piece not in self.special
        }
        del spec
        self.merger = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.cache = pretokens.Cache()

    @cached_property
    def tokenizer(self):
        """The library's own, loaded when a text needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @classmethod
    def of(cls, path: str) -> Encoder:
        known = vars(pretokens.worker_state("encoders"))
        if path not in known:
            known[path] = cls(path)
        return known[path]

    def _merged(self, words: list[bytes]) -> list[bytes]:
        encode = self.merger.encode_ordinary
        return [array("I", encode(w.decode())).tobytes() for w in words]

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def plain(self, text: str) -> bool:
        return (text.isascii() or not pretokens.ODD.search(text)) and not any(s in text for s in self.special)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain = [i for i, t in enumerate(texts) if t and self.plain(t)]
        for a, b in pretokens.parts(np.array([len(texts[i]) for i in plain], np.int64)):
            rows = plain[a:b]
            ends, codes, words = pretokens.dictionary(pa.array([texts[i] for i in rows], pa.string()), True)
            ids = self.cache.values_of(words, self._merged)
            placed = pa.array(ids, pa.binary()).take(pa.array(codes))
            at = np.frombuffer(placed.buffers()[1], np.int32)[np.concatenate(([0], ends))]
            data = placed.buffers()[2].to_pybytes()
            for k, i in enumerate(rows):
                out[i] = data[at[k] : at[k + 1]]
        odd = sorted(set(range(len(texts))) - set(plain))
        for i in odd:
            if texts[i]:
                out[i] = self._library([texts[i]])[0]
        return out


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens."""
    first = n % capacity or min(n, capacity)
    marks = [0, *range(first, n + 1, capacity)]
    return [(a, b - a) for a, b in zip(marks, marks[1:], strict=False)]


def _piece_batches(path: str, capacity: int, keep_ids: bool):
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for b in batches:
            texts = b.column("text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            for k, stop in pretokens.parts(sizes):  # bounds what is in memory beside the batch
                part = [t or "" for t in texts.slice(k, stop - k).to_pylist()]
                rows, cols = [], ([], [], [], [], [])
                for i, ids in enumerate(encoder.encode(part)):
                    ids += end
                    for p, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                        raw = ids[4 * start : 4 * (start + n)]
                        rows.append(k + i)
                        for c, v in zip(cols, (p, start, n, zlib.crc32(raw), raw if keep_ids else b""), strict=True):
                            c.append(v)
                data = [b.column("doc_id").take(pa.array(rows, pa.int64()))]
                data += [pa.array(cols[0], pa.int32())] + [pa.array(c, pa.int64()) for c in cols[1:4]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    flat = np.frombuffer(b"".join(cols[4]), "<u4").astype(np.int32)
                    at = np.concatenate(([0], np.cumsum([len(x) // 4 for x in cols[4]]))).astype(np.int32)
                    data.append(pa.ListArray.from_arrays(pa.array(at), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(data, names=names)
        pa.default_memory_pool().release_unused()  # the worker stays for other stages

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's pieces."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select("doc_id", "text").mapInArrow(_piece_batches(tokenizer, capacity, keep_ids), schema)


# ---- placing


def place(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each piece, in the order given, by the sum of squares."""
    count = np.zeros(capacity + 1, np.int64)  # N(g); closed sequences and unopened ones don't count
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), np.int64)
    opened = 0
    for i, s in enumerate(sizes.tolist()):
        # gaps s..capacity-1: change of the sum by moving one sequence from g to g - s
        change = 2 * (count[: capacity - s] - count[s:capacity]) + 2
        if s < capacity:
            change[0] = 1 - 2 * count[s]  # filled to the end: nothing rises
            change[count[s:capacity] == 0] = np.iinfo(np.int64).max
            g = int(change.argmin())
            best, fresh = int(change[g]), 2 * int(count[capacity - s]) + 1
        else:
            g, best, fresh = 0, 1, 0
        if best <= fresh:
            gap = s + g
            seq = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, seq, opened = capacity, opened, opened + 1
        if gap > s:
            open_at[gap - s].append(seq)
            count[gap - s] += 1
        out[i] = seq
    return out


def _pack_shard(capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # longest first; the rest of the order only makes results repeatable
        rows = rows.sort_values(["length", "ids_crc32", "doc_id", "piece"], ascending=[False, True, True, True], kind="stable")
        seq = place(rows["length"].to_numpy(), capacity)
        rows = rows.assign(sequence_id=key[0] * 2**32 + seq).sort_values("sequence_id", kind="stable")
        by = rows.groupby("sequence_id")["length"]
        return rows.assign(offset=by.cumsum() - rows["length"], filled=by.transform("sum")).drop(columns="shard")

    return run


def _pack_round(pieces_: DataFrame, shards: int, first_id: int, capacity: int) -> DataFrame:
    dealt = pieces_.withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(first_id)), F.lit(shards)) + F.lit(first_id)
    )
    schema = pieces_.schema.add("sequence_id", "long").add("offset", "long").add("filled", "long")
    return dealt.groupBy("shard").applyInPandas(_pack_shard(capacity), schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    shard_rows: int = SHARD_ROWS,
    full: float = FULL,
    keep_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids])."""
    cut_up = shared(pieces(docs, tokenizer, capacity, keep_ids), "pieces", arrow_rows=ARROW_ROWS)
    # the shards see small rows only; ids, if asked for, come back by a join
    slim = cut_up.drop("ids")
    n = slim.count()
    shards = max(1, -(-n // shard_rows))
    placed = shared(_pack_round(slim, shards, 0, capacity), "packed")
    if shards == 1:
        result = placed
    else:
        done = F.col("filled") >= full * capacity
        again = placed.filter(~done).drop("sequence_id", "offset", "filled")
        m = again.count()
        result = placed.filter(done).unionByName(_pack_round(again, max(1, -(-m // shard_rows)), shards, capacity))
    result = result.drop("filled")
    if not keep_ids:
        return result
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # rows that are alike in all of these have the same ids
    ids = cut_up.groupBy(*key).agg(F.first("ids").alias("ids"))
    a, b = result.alias("a"), ids.alias("b")
    same = F.lit(True)
    for c in key:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, same, "left").select("a.*", "b.ids")
