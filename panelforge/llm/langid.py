"""Language identification with string kernels.

The kernel of two texts is the number of distinct n-grams of 1 to ``ORDERS``
characters that both contain (presence, not counts), divided by the geometric
mean of the texts' own values. Texts are lower-cased and everything but
letters is a space. ``landmarks`` texts for each language span a Nyström
approximation of the kernel's feature space; in it, one ridge regression for
each language against the rest is solved. N-grams that no landmark contains
cannot add to a kernel value and are left out.

Fitting uses a bounded sample: at most ``sample`` labelled rows a language,
those with the smallest hashes of their id. Scoring reads whole texts in Arrow
batches: a batch becomes a 0/1 matrix of texts by n-grams, and one product
with the landmarks' matrix, folded with the regression weights, gives all
scores. No shuffle; the model is broadcast (landmark n-grams x languages).

Defined results: a null text or one without a letter is ``und`` with score 0,
and so is every text if no row is labelled; repeated rows are judged alike;
further columns are ignored; an empty table gives an empty result. Equal
scores go to the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import pretokens
from .common import shared, small

ORDERS = 3
SAMPLE = 300
LANDMARKS = 60
#: Labelled ids are counted by 2 ** SLICE_BITS slices of their hash: so many
#: counts of a language are added up in one place, and beside the sample one
#: slice of its ids is ranked.
SLICE_BITS = 10
RIDGE = 1e-2
UNKNOWN = "und"

_SLOT_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Characters, and texts, that are looked at together.
CHARS = 1_000_000
TEXTS = 256


def _letters() -> np.ndarray:
    """For each code point: its lower case if it is a letter, else a space (0 stays 0)."""
    state = vars(pretokens.worker_state("letters"))
    if "table" not in state:
        table = np.full(0x110000, 32, np.int64)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        table[0] = 0
        state["table"] = table
    return state["table"]


def gram_keys(codes: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n-grams that begin at each place: 21 bits a character. An
    n-gram with the end of a text in it has the key 0."""
    size = len(codes) - n + 1
    key, whole = codes[:size].copy(), codes[:size] != 0
    for k in range(1, n):
        key = (key << 21) | codes[k : size + k]
        whole &= codes[k : size + k] != 0
    return np.where(whole, key, 0)


class GramIndex:
    """Numbers of the n-grams in a sorted list, found through hashed slots."""

    def __init__(self, keys: np.ndarray):
        slots = self._slot(keys)
        order = np.argsort(slots, kind="stable")
        self.keys = keys[order]
        slots = slots[order]
        self.first = np.full(1 << _SLOT_BITS, -1, np.int32)
        at = np.flatnonzero(np.concatenate(([True], slots[1:] != slots[:-1]))) if len(keys) else np.empty(0, int)
        self.first[slots[at]] = at
        self.depth = int(np.diff(np.append(at, len(keys))).max()) if len(keys) else 0

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``keys`` that are known, their numbers)."""
        at = self.first[self._slot(keys)]
        left = np.flatnonzero(at >= 0)
        found = []
        for d in range(self.depth):
            number = at[left] + d
            inside = number < len(self.keys)
            left, number = left[inside], number[inside]
            same = self.keys[number] == keys[left]
            found.append((left[same], number[same]))
            left = left[~same]
        if not found:
            return np.empty(0, int), np.empty(0, int)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Normalised characters of the texts, a 0 after each, and whose each one is."""
    raw = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    return _letters()[raw], owner


def presence(texts: list[str], index: GramIndex, orders: int) -> tuple[np.ndarray, np.ndarray]:
    """(0/1 matrix of texts by known n-grams, whether each text has a letter)."""
    out = np.zeros((len(texts), len(index.keys)), np.float32)
    codes, owner = code_points(texts)
    letter = np.zeros(len(texts), bool)
    letter[owner[codes > 32]] = True
    for a in range(0, len(codes), CHARS):
        for n in range(1, orders + 1):
            part = codes[a : a + CHARS + n - 1]
            if len(part) >= n:
                where, number = index.find(gram_keys(part, n))
                out[owner[a + where], number] = 1
    return out, letter


class Model:
    """Scores = presence @ weights / norm + bias."""

    def __init__(self, langs: list[str], keys: np.ndarray, weights: np.ndarray, bias: np.ndarray, orders: int):
        self.langs, self.index, self.weights, self.bias, self.orders = langs, GramIndex(keys), weights, bias, orders

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        p, letter = presence(texts, self.index, self.orders)
        norm = np.sqrt(np.maximum(p.sum(axis=1), 1))
        scores = (p @ self.weights) / norm[:, None] + self.bias
        best = scores.argmax(axis=1)
        top = np.clip(scores[np.arange(len(texts)), best].astype(np.float64), 0, 1)
        langs = [self.langs[k] if ok else UNKNOWN for k, ok in zip(best, letter, strict=True)]
        return langs, np.where(letter, top, 0.0)


def fit(
    rows: list[tuple[str, str]], orders: int = ORDERS, landmarks: int = LANDMARKS, ridge: float = RIDGE
) -> tuple | None:
    """What ``Model`` takes; ``rows``: the bounded sample of (text, lang)."""
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return None
    marks = [t for k in langs for t in [t for t, lang in rows if lang == k][:landmarks]]
    codes, _ = code_points(marks)
    keys = np.empty(0, np.int64)
    for n in range(1, orders + 1):
        k = np.unique(gram_keys(codes, n)) if len(codes) >= n else np.empty(0, np.int64)
        chars = np.stack([(k >> (21 * i)) & 0x1FFFFF for i in range(n)]) if len(k) else np.empty((n, 0))
        # spaces alone say nothing
        keys = np.concatenate((keys, k[(chars > 32).any(axis=0)]))
    index = GramIndex(keys)

    def normalised(texts):
        p, _ = presence(texts, index, orders)
        return p / np.sqrt(np.maximum(p.sum(axis=1), 1))[:, None]

    basis = normalised(marks)
    value, vector = np.linalg.eigh((basis @ basis.T).astype(np.float64))
    keep = value > 1e-8 * max(value.max(), 1e-12)
    root = vector[:, keep] / np.sqrt(value[keep])  # K_mm ** -1/2
    blocks = [rows[k : k + TEXTS] for k in range(0, len(rows), TEXTS)]
    z = np.concatenate([(normalised([t for t, _ in b]) @ basis.T).astype(np.float64) @ root for b in blocks])
    y = np.array([[lang == k for k in langs] for _, lang in rows], np.float64)
    centre, mean = z.mean(axis=0), y.mean(axis=0)
    zc = z - centre
    w = np.linalg.solve(zc.T @ zc + ridge * len(rows) * np.eye(z.shape[1]), zc.T @ (y - mean))
    weights = (basis.T.astype(np.float64) @ (root @ w)).astype(np.float32)
    return langs, index.keys, weights, mean - centre @ w, orders


def training_sample(labelled: DataFrame, sample: int = SAMPLE) -> list[tuple[str, str]]:
    """At most ``sample`` rows (text, lang) of each language, by least hash of
    the id; of rows with the same id and language the least text."""
    some = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Ids only are ranked, then texts are looked up. Ids are counted by slices of
    # their hash; a language's ids beyond the slice in which its sample ends are
    # dropped before any ranking, so however many it has, few are ranked.
    h = F.xxhash64("doc_id")
    ids = some.select("doc_id", "lang", h.alias("h"), F.shiftright(h, 64 - SLICE_BITS).alias("part")).distinct()
    ids = shared(ids, "labelled-ids")
    counts = ids.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("part")) - F.col("n")
    last = counts.withColumn("before", before).filter(F.col("before") < sample).groupBy("lang").agg(F.max("part").alias("last"))
    ids = ids.join(small(shared(last, "slices")), "lang").filter(F.col("part") <= F.col("last"))
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = ids.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= sample).select(F.col("doc_id").alias("id"), "lang")
    texts = some.select("doc_id", "text", "lang").join(
        F.broadcast(chosen.withColumnRenamed("lang", "of")),
        (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("of")),
    )
    rows = texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["lang"], r["doc_id"], r["text"]))
    return [(r["text"], r["lang"]) for r in rows]


def _predict_batches(shared_model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared_model.value
        model = Model(*state) if state else None
        for b in batches:
            for k in range(0, b.num_rows, TEXTS):
                part = b.slice(k, TEXTS)
                texts = [t or "" for t in part.column("text").to_pylist()]
                langs, score = model.predict(texts) if model else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return run


def identify(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE, **options) -> DataFrame:
    """(doc_id, lang_pred, score) of each document; ``labelled`` has doc_id,
    text and lang of the rows to learn from."""
    model = docs.sparkSession.sparkContext.broadcast(fit(training_sample(labelled, sample), **options))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _predict_batches(model), f"doc_id {kind}, lang_pred string, score double"
    )


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def report(docs: DataFrame) -> DataFrame:
    """One row per document, learnt from the rows that aren't held out."""
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    found = identify(docs, docs.filter(~out).select("doc_id", "text", "lang"))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
