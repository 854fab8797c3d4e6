"""WARC archives: writing, and reading by boundary-chain verification.

Writing: one record per page, uncompressed, each file by one task, through
Spark's text writer (the blank lines that end a record are its line
separator). Of pages with equal payloads of at least ``min_bytes`` bytes, the
one with the smallest page_id is a response, the others are revisits that
name it and carry no payload.

Reading: files are split freely between tasks. Each task cuts its part at the
record magic; every piece is a candidate record, also where the magic stands
inside a payload. From its header a candidate's successor is computed: where
the next record must begin. Pointer jumping from the start of each file
follows these successors, doubling the step each round, and only records that
are reached are kept; a magic inside a payload is not. To need few rounds,
a candidate first jumps to where its chain leaves its own split. A record
whose payload contains the magic is put together again from its pieces.

Only small rows (offsets, digests) are shuffled; payloads stay in the scan,
except those of records that contain the magic. Archives and tables lie in
the shared folder of the cluster.

Defined results: a null html is an empty payload; repeated rows each get a
record (all rows with the smallest page_id are responses); a null page_id is
written as an empty field, read back as null, and is the smallest only if all
are null; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared, shared_folder, small

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"
MIN_REVISIT_BYTES = 0


# ---- writing


def base32_sha1(c: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each five hex digits are four
    base-32 digits, written by the alphabet of RFC 4648."""
    h = F.sha1(c)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, bytes, refers_to): ``refers_to`` is null
    for responses."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("bytes"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    repeated = shared(
        rows.filter(F.col("bytes") >= min_bytes)
        .groupBy("digest", "bytes")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").drop("n"),
        "repeated",
    )
    # payloads are shuffled only if the table of repeated ones is too large to broadcast
    return rows.join(small(repeated), ["digest", "bytes"], "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    ).drop("first")


def utc_now() -> Column:
    """The time of the write, one for all its records, as the format wants it."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def record_text(r: dict[str, Column]) -> Column:
    """Header and payload of one record, without the blank lines at its end.
    ``r["date"]``, if there is one, is the record's time as text."""
    revisit = r["refers_to"].isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(r["payload"])
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    # a line break inside a url would end its field
    url = F.regexp_replace(text(r["url"]), r"[\x00-\x20\x7F]", "%20")
    return F.concat(
        F.lit(MAGIC),
        F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), F.lit("\r\n"),
        F.lit("WARC-Date: "), r.get("date", utc_now()), F.lit("\r\n"),
        F.lit("WARC-Record-ID: <urn:page:"), text(r["page_id"]), F.lit(">\r\n"),
        F.lit("WARC-Target-URI: "), url, F.lit("\r\n"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), text(r["refers_to"]), F.lit(">\r\n" + PROFILE))).otherwise(F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"), r["digest"], F.lit("\r\n"),
        F.lit("Content-Type: text/html\r\n"),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END),
        block,
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    rows = with_types(pages, min_bytes)
    rows.select(record_text({c: F.col(c) for c in rows.columns}).alias("value")).write.option("lineSep", END).text(path)


# ---- reading: candidates

_FIELDS = "file string, block long, seq long, at long, size long, next long, whole boolean, type string, page_id string, refers_to string, declared string, bytes long, digest string"


def parse_header(chunk: bytes) -> dict | None:
    """Fields of a candidate (what follows the magic); None if it has no
    header with a content length."""
    stop = chunk.find(b"\r\n\r\n")
    if stop < 0:
        return None
    out = {"head": stop + 4}
    for line in chunk[:stop].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        out[name.strip().lower()] = value.strip()
    length = out.get(b"content-length", b"")
    if not (length.isdigit() and len(length) < 19):
        return None
    out["length"] = int(length)
    return out


def _urn(value: bytes | None) -> str | None:
    inner = (value or b"").removeprefix(b"<urn:page:").removesuffix(b">").decode("utf-8", "replace")
    return inner or None


def payload_facts(payload: bytes) -> tuple[int, str]:
    return len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces of the splits, in file order inside each split. ``at``: offset of
    the magic from where the split's first piece begins; the first piece of a
    file is what stands before the first magic."""
    here, at, seq = None, 0, 0
    for b in batches:
        rows = []
        for file, block, chunk in zip(b["file"], b["block"], b["value"], strict=True):
            if (file, block) != here:
                here, at, seq = (file, block), 0, 0
            opening = block == 0 and seq == 0
            size = len(chunk) + (0 if opening else len(MAGIC))
            head = None if opening else parse_header(chunk)
            row = [file, block, seq, at, size, None, False, None, None, None, None, None, None]
            if head:
                end = head["head"] + head["length"]
                row[5] = at + len(MAGIC) + end + len(END)
                row[7] = head.get(b"warc-type", b"").decode("utf-8", "replace")
                row[8], row[9] = _urn(head.get(b"warc-record-id")), _urn(head.get(b"warc-refers-to"))
                row[10] = head.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:")
                if len(chunk) == end + len(END) and chunk.endswith(END.encode()):
                    row[6] = True
                    row[11], row[12] = payload_facts(chunk[head["head"] : end])
            rows.append(row)
            at, seq = at + size, seq + 1
        yield pd.DataFrame(rows, columns=[f.split()[0] for f in _FIELDS.split(", ")])


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the splits of the archives, cut at the magic."""
    return (
        spark.read.option("lineSep", MAGIC).text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("value").cast("binary").alias("value"),
        )
    )


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidate records with offsets in their files: ``at`` and ``next``."""
    return shared(pieces(spark, path).mapInPandas(_candidates, _FIELDS), "candidates")


def split_starts(found: DataFrame) -> DataFrame:
    """(file, block, base, size): where each split's first piece begins. The
    pieces of a file follow each other without a gap, so that is the sum of
    the sizes in the splits before."""
    sizes = found.groupBy("file", "block").agg(F.sum("size").alias("len"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("base", F.coalesce(F.sum("len").over(before), F.lit(0)))


# ---- reading: the chain


def _leave_split(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a split, where its chain first leaves the split
    (none if it breaks). One split's rows, bounded by the split's bytes."""
    rows = rows.sort_values("at")
    at, nxt = rows["at"].to_numpy(np.int64), rows["next"].to_numpy(np.float64)
    end = int(rows["stop"].iloc[0]) if len(rows) else 0
    known = {int(a): i for i, a in enumerate(at)}
    out = np.full(len(at), -1, np.int64)
    for i in range(len(at) - 1, -1, -1):  # successors lie further on
        if nxt[i] == nxt[i]:
            n = int(nxt[i])
            out[i] = n if n >= end else out[known[n]] if n in known else -1
    return pd.DataFrame({"file": key[0], "block": key[1], "at": at, "jump": out})


def _follow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a split that the chain passes from its entry on."""
    rows = rows.sort_values("at")
    at, nxt = rows["at"].tolist(), rows["next"].to_numpy(np.float64).tolist()
    want, kept = int(rows["entry"].iloc[0]), []
    for i, a in enumerate(at):
        if a == want:
            kept.append(i)
            want = int(nxt[i]) if nxt[i] == nxt[i] else -1
    return rows.iloc[kept][["file", "block", "at"]]


def reachable(placed: DataFrame) -> DataFrame:
    """(file, block, at) of the records on the chain from the start of each
    file. ``placed``: file, block, at, next, stop (end of the split) of all
    candidates."""
    jumps = placed.select("file", "block", "at", "next", "stop").groupBy("file", "block").applyInPandas(
        _leave_split, "file string, block long, at long, jump long"
    )
    jumps = shared(jumps.filter(F.col("jump") >= 0), "jumps")
    # only where some chain enters a split can the search go on
    entries = jumps.select("file", F.col("jump").alias("at")).distinct().union(
        placed.filter((F.col("block") == 0) & (F.col("at") == 0)).select("file", "at")
    ).distinct()
    step = shared(jumps.join(entries, ["file", "at"], "left_semi").select("file", "at", "jump"), "steps")
    reached = shared(entries.filter(F.col("at") == 0), "reached")
    while True:
        # reached: the first 2^k entries of each chain; step: 2^k entries on
        more = reached.join(step, ["file", "at"]).select("file", F.col("jump").alias("at"))
        grown = shared(reached.union(more).distinct(), "reached")
        further = step.select("file", F.col("at").alias("jump"), F.col("jump").alias("further"))
        step = shared(step.join(further, ["file", "jump"]).select("file", "at", F.col("further").alias("jump")), "steps")
        if step.isEmpty():
            reached = shared(grown.union(grown.join(step, ["file", "at"]).select("file", "jump")).distinct(), "reached")
            break
        reached = grown
    entry = placed.join(reached, ["file", "at"], "left_semi").select("file", "block", F.col("at").alias("entry"))
    # a chain enters a split once
    walked = placed.select("file", "block", "at", "next").join(entry, ["file", "block"])
    return walked.groupBy("file", "block").applyInPandas(_follow, "file string, block long, at long")


# ---- reading: records


def _joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A record put together from its pieces (one record, as large as it is)."""
    rows = rows.sort_values("at")
    first = rows["value"].iloc[0]
    whole = first + b"".join(MAGIC.encode() + v for v in rows["value"].iloc[1:])
    head = parse_header(first)
    end = head["head"] + head["length"]
    ok = len(whole) == end + len(END) and whole.endswith(END.encode())
    n, digest = payload_facts(whole[head["head"] : end])
    return pd.DataFrame({"file": [key[0]], "at": [key[1]], "bytes": [n if ok else -1], "digest": [digest]})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, type, page_id, refers_to, declared, bytes, digest) of each record that
    the chains reach. A broken chain or a record that doesn't end where its
    header says is an error, not a shorter result."""
    found = candidates(spark, path)
    starts = split_starts(found)
    placed = found.join(starts, ["file", "block"]).select(
        "file", "block", (F.col("base") + F.col("at")).alias("at"), (F.col("base") + F.col("next")).alias("next"),
        (F.col("base") + F.col("len")).alias("stop"), "size", "whole", "type", "page_id", "refers_to", "declared", "bytes", "digest",
        ((F.col("block") == 0) & (F.col("seq") == 0)).alias("opening"),
    )
    placed = shared(placed, "placed")
    pieces_ = placed.filter(~F.col("opening"))
    kept = shared(reachable(pieces_), "kept")
    records = pieces_.join(kept, ["file", "block", "at"])
    single = records.filter("whole").select("file", "at", "next", "type", "page_id", "refers_to", "declared", "bytes", "digest")
    torn = shared(records.filter("not whole").select("file", "at", "next", "type", "page_id", "refers_to", "declared"), "torn")
    result = single
    if not torn.isEmpty():
        # pieces between a record's start and its end belong to it
        owned = pieces_.select("file", "block", F.col("at").alias("piece")).join(
            small(torn.select("file", "at", "next")), "file"
        ).filter((F.col("piece") >= F.col("at")) & (F.col("piece") < F.col("next")))
        texts = _located_pieces(spark, path, starts)
        parts = texts.join(small(shared(owned, "owned")), ["file", "piece"]).select("file", "at", F.col("piece").alias("p"), "value")
        whole = parts.select("file", F.col("at").alias("record"), F.col("p").alias("at"), "value").groupBy("file", "record").applyInPandas(
            _joined, "file string, at long, bytes long, digest string"
        )
        result = result.unionByName(torn.join(whole, ["file", "at"]))
    ends = placed.groupBy("file").agg(F.max("stop").alias("end"))
    lasts = result.groupBy("file").agg(F.max("next").alias("last"), F.min("bytes").alias("least"))
    broken = F.raise_error(F.concat(F.lit("broken record chain in "), F.col("file")))
    checked = ends.join(lasts, "file", "left").select(
        "file",
        F.when((F.col("end") == 0) | ((F.col("last") == F.col("end")) & (F.col("least") >= 0)), F.lit(True)).otherwise(broken.cast("boolean")).alias("sound"),
    )
    return result.join(checked, "file").filter("sound").drop("sound", "next")


def _located_pieces(spark: SparkSession, path: str, starts: DataFrame) -> DataFrame:
    """(file, piece, value): the pieces' bytes with their offsets."""

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at = None, 0
        for b in batches:
            out = []
            for file, block, n in zip(b.column("file").to_pylist(), b.column("block").to_pylist(), b.column("n").to_pylist(), strict=True):
                if (file, block) != here:
                    here, at, first = (file, block), 0, block == 0
                out.append(at)
                at += n + (0 if first else len(MAGIC))
                first = False
            yield pa.RecordBatch.from_arrays(
                [b.column("file"), b.column("block"), pa.array(out, pa.int64()), b.column("value")],
                names=["file", "block", "piece", "value"],
            )

    cut = pieces(spark, path).withColumn("n", F.octet_length("value"))
    placed = cut.mapInArrow(offsets, "file string, block long, piece long, value binary")
    return placed.join(small(shared(starts, "starts")), ["file", "block"]).select(
        "file", (F.col("base") + F.col("piece")).alias("piece"), "value"
    )


def round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes the pages to archives in the shared folder, reads them back:
    (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    spark = pages.sparkSession
    path = shared_folder(spark, "warc")
    write_archives(pages, path, min_bytes)
    kind = pages.schema["page_id"].dataType
    records = shared(read_archives(spark, path), "records")
    # a revisit's payload is that of the response it names, of the digest it declares
    named = records.filter("type = 'response'").select(
        F.col("page_id").alias("refers_to"), F.col("digest").alias("declared"), "bytes"
    ).distinct()
    response = records.filter("type = 'response'").select("page_id", "bytes", "digest", "type", "refers_to")
    revisit = (
        records.filter("type = 'revisit'").drop("bytes", "digest").join(named, ["refers_to", "declared"])
        .select("page_id", "bytes", F.col("declared").alias("digest"), "type", "refers_to")
    )
    return response.unionByName(revisit).select(
        F.col("page_id").cast(kind).alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
