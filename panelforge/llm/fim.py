"""Fill-in-the-middle: documents cut into prefix, middle and suffix, and rearranged.

A text is a row of units: blanks with the run of other characters after them,
or blanks at the end. One ``fullmatch`` of ``(unit)*`` keeps every repetition
of the group, so ``match.ends(1)`` holds where each unit ends: its length is
the number of units, and both cuts are looked up in it. Nothing is iterated in
Python. The group and the star are possessive, so the match keeps no places to
go back to, however long the text is.

Where a text is cut, and whether and how it is rearranged, depends on a digest
of a seed and the ``doc_id`` alone: the same document always gets the same
form, on any cluster. ``restore`` rebuilds the text from output and form.

Defined results: a null or empty text has no units and form ``plain``; so has
a text that holds one of the marks. A null ``doc_id`` is digested as an empty
string. Rows are worked on one by one, so repeated rows get equal results;
further columns stay as they are (``name`` is new or replaces a column of that
name); an empty table gives an empty result. Of texts that aren't plain the
longest needs about 40 bytes of a worker's memory for each unit.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

SEED = 42
#: Percent of documents that are rearranged, and of those that put the suffix first.
FIM_PERCENT = 50
SPM_PERCENT = 80
# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

UNITS = regex.compile(r"((?>[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++))*+")

RESULT = "struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:string>"
_TYPES = pa.struct(
    [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)


def draws(doc_id: int | str | None, seed: int = SEED) -> list[int]:
    """Four numbers under 2**32 from the digest of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def rearranged(doc_id, text: str | None, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    text = text or ""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= fim_percent or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (first, last))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(
    docs: DataFrame, name: str = "fim", seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """The rows with the column ``name``: a struct of the number of units, the
    form, the lengths of prefix and middle in code points (null if plain) and
    the text as rearranged. Arrow batches, no shuffle."""

    @F.arrow_udf(RESULT)
    def cut(ids: pa.Array, texts: pa.Array) -> pa.Array:
        out = [rearranged(i.as_py(), t.as_py(), seed, fim_percent, spm_percent) for i, t in zip(ids, texts, strict=True)]
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _TYPES, strict=True)], fields=list(_TYPES)) if out else pa.array([], _TYPES)

    return docs.withColumn(name, cut(F.col("doc_id"), F.col("text")))


def _around(text: Column, mark: str, body) -> Column:
    """``body(before, after)`` of the first ``mark`` in ``text``."""
    return let(
        F.substring_index(text, mark, 1),
        lambda head: body(head, F.substr(text, F.char_length(head) + len(mark) + 1)),
    )


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. No text with a mark is
    rearranged, so the first place of each mark is the mark."""
    body = F.substr(output, F.lit(len(PREFIX) + 1))
    psm = _around(body, SUFFIX, lambda prefix, rest: _around(rest, MIDDLE, lambda suffix, middle: F.concat(prefix, middle, suffix)))
    spm = _around(body, PREFIX, lambda suffix, rest: _around(rest, MIDDLE, lambda prefix, middle: F.concat(prefix, middle, suffix)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: units, form, lengths, digests of the output and of the text rebuilt from it."""
    return transform(docs.select("doc_id", "text")).select(
        "doc_id",
        *[F.col(f"fim.{c}").alias(c) for c in ("n", "form", "prefix_chars", "middle_chars")],
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"),
    )
