"""WARC archives: writing records in segments, reading and reassembling them.

A record's block is an HTTP response with chunked transfer framing.  A block
over ``SEGMENT`` bytes is cut: the first segment is the ``response`` record
with WARC-Segment-Number 1, the rest are ``continuation`` records that name it
in WARC-Segment-Origin-ID, the last of them with WARC-Segment-Total-Length.
Reading groups continuation records by origin, orders them by segment number,
verifies the total length and then decodes the framing.

Archives are written by Spark's text sink: a record ends with two line ends,
which is the sink's line separator, so a file is a plain sequence of records.
They are read as binary files.  A file has at most ``PER_FILE`` records of at
most about ``SEGMENT`` bytes each, which bounds what one task holds; only
records in segments are shuffled, by origin.

Defined results: a null html is an empty payload; rows with equal ids are
records of their own; a null id has the record id of its row and is never
referred to; an origin that lacks a segment or has another total length comes
back with ``status`` ``incomplete`` and no payload; broken framing gives
``status`` ``broken``; an empty table writes an archive without records.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fincrime.llm.common import shared_path, table, whole, written

SEGMENT = 32 * 1024
CHUNK = 4096
PER_FILE = 500
LEAST = 1000                 # bytes of payload from which an equal one is a revisit
END = "\r\n"
VERSION = "WARC/1.1"
HTTP = ("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Transfer-Encoding: chunked")


def _cuts(data: bytes, most: int) -> Iterator[bytes]:
    """Pieces of at most ``most`` bytes that end between code points."""
    i = 0
    while i < len(data):
        j = min(i + most, len(data))
        while j < len(data) and data[j] & 0xC0 == 0x80:
            j -= 1
        yield data[i:j]
        i = j


def chunked(payload: bytes, most: int = CHUNK) -> bytes:
    """Chunked transfer framing."""
    return b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in _cuts(payload, most)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload in chunked framing; None if the framing is broken."""
    out, i = [], 0
    while True:
        j = body.find(b"\r\n", i)
        if j < 0 or not re.fullmatch(rb"[0-9A-Fa-f]+", size := body[i:j].split(b";")[0].strip()):
            return None
        n = int(size, 16)
        if n == 0:
            return b"".join(out)
        if body[j + 2 + n:j + 4 + n] != b"\r\n":
            return None
        out.append(body[j + 2:j + 2 + n])
        i = j + 4 + n


def _record(fields: dict[str, object], block: bytes) -> str:
    head = END.join([VERSION, *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"])
    return f"{head}{END}{END}{block.decode()}"


def records(key: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, segment: int) -> Iterator[str]:
    """The records of one page, without the two line ends that close each."""
    http = END.join(HTTP).encode() + b"\r\n\r\n"
    common = {"WARC-Target-URI": re.sub(r"\s", "%20", url)} if url is not None else {}
    common["WARC-Payload-Digest"] = f"sha1:{digest}"
    if refers_to is not None:
        yield _record({"WARC-Type": "revisit", "WARC-Record-ID": f"<urn:page:{key}>", **common,
                       "WARC-Refers-To": f"<urn:page:{refers_to}>"}, http)
        return
    parts = list(_cuts(block := http + chunked(payload), segment))
    for n, part in enumerate(parts, 1):
        own = {"WARC-Type": "response" if n == 1 else "continuation",
               "WARC-Record-ID": f"<urn:page:{key}>" if n == 1 else f"<urn:page:{key}:{n}>",
               **(common if n == 1 else {})}
        if len(parts) > 1:
            own["WARC-Segment-Number"] = n
            if n > 1:
                own["WARC-Segment-Origin-ID"] = f"<urn:page:{key}>"
            if n == len(parts):
                own["WARC-Segment-Total-Length"] = len(block)
        yield _record(own, part)


def _writer(segment: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):           # a few pages at a time
                out = [r for row in b.slice(i, 64).to_pylist()
                       for r in records(row["key"], row["url"], row["html"].encode(), row["digest"],
                                        row["refers_to"], segment)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
    return write


def write(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", html: str = "html",
          segment: int = SEGMENT, per_file: int = PER_FILE) -> None:
    """Archives of ``pages`` under ``path``.  Of equal payloads of ``LEAST``
    bytes or more the one with the largest id is the response."""
    p = pages.select(F.col(id).alias("id"), F.col(url).cast("string").alias("url"), whole(html).alias("html"))
    p = p.select("*", F.sha1("html").alias("digest"))
    # payloads that occur more than once: few beside the pages; a row each
    twice = written(p.filter(F.octet_length("html") >= LEAST).groupBy("digest")
                     .agg(F.max("id").alias("last"), F.count("*").alias("n")).filter("n > 1 and last is not null")
                     .select(F.col("digest").alias("d"), "last"), "warc-equal")
    p = p.join(twice, p["digest"] == twice["d"], "left")
    refers = F.when(~F.col("id").eqNullSafe(F.col("last")) & F.col("last").isNotNull(), F.col("last").cast("string"))
    # the row's number keeps apart the records of rows with one id
    key = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit("/"), F.monotonically_increasing_id())
    p.select(key.alias("key"), "url", "html", "digest", refers.alias("refers_to")) \
     .mapInArrow(_writer(segment), "value string") \
     .write.option("lineSep", END * 2).option("maxRecordsPerFile", per_file).text(path)


SEGMENTS = ("id string, type string, digest string, refers_to string, origin string, number int, "
            "total long, last boolean, block binary")
FIELDS = [f.split()[0] for f in SEGMENTS.split(", ")]
DECODED = "id string, type string, refers_to string, digest string, status string, payload binary"


def parse(data: bytes) -> Iterator[dict]:
    """The records of one archive."""
    i = 0
    while i < len(data):
        j = data.index(b"\r\n\r\n", i)
        lines = data[i:j].decode().split("\r\n")
        h = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        n = int(h["content-length"])
        urn = lambda k: h[k][len("<urn:page:"):-1] if k in h else None
        number = int(h.get("warc-segment-number", 1))
        yield {"id": urn("warc-record-id"), "type": h["warc-type"], "digest": h.get("warc-payload-digest", "")[5:],
               "refers_to": urn("warc-refers-to"), "origin": urn("warc-segment-origin-id") or urn("warc-record-id"),
               "number": number if "warc-segment-number" in h else 0,
               "total": int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None,
               "last": "warc-segment-total-length" in h, "block": data[j + 4:j + 4 + n]}
        i = j + 4 + n + 4


def _parser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string()] * 5 + [pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
    for b in batches:
        for content in b.column(0):
            rows = list(parse(content.as_buffer().to_pybytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], t) for f, t in zip(FIELDS, types)], FIELDS)


def decoded(first: dict, block: bytes | None) -> tuple:
    """A row of DECODED from the first record and the whole block."""
    status, payload = "incomplete", None
    if block is not None:
        payload = b"" if first["type"] == "revisit" else unchunked(block[block.index(b"\r\n\r\n") + 4:])
        status = "broken" if payload is None else "ok"
        if status == "ok" and first["type"] != "revisit" and hashlib.sha1(payload).hexdigest() != first["digest"]:
            status = "broken"
    return first["id"], first["type"], first["refers_to"], first["digest"], status, payload


def _decoder(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [f.split()[0] for f in DECODED.split(", ")]
    for b in batches:
        yield pd.DataFrame([decoded(r, r["block"]) for r in b.to_dict("records")], columns=names)


def reassembled(group: pd.DataFrame) -> pd.DataFrame:
    """One record from the segments of one origin."""
    g = group.sort_values("number").to_dict("records")
    block = b"".join(r["block"] for r in g)
    whole_ = [r["number"] for r in g] == list(range(1, len(g) + 1)) and g[-1]["last"] and g[-1]["total"] == len(block)
    return pd.DataFrame([decoded(g[0], block if whole_ else None)], columns=[f.split()[0] for f in DECODED.split(", ")])


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row a record of the archives under ``path``, segments put together:
    DECODED.  Continuations without their first segment are ``incomplete``."""
    segments = spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parser, SEGMENTS)
    # the archives are in the shared folder already: parsing them twice costs less than another copy of all blocks
    alone = segments.filter("number = 0")
    parts = segments.filter("number > 0").groupBy("origin").applyInPandas(reassembled, DECODED)
    return alone.mapInPandas(_decoder, DECODED).unionByName(parts)


def op7(spark, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    r = read(spark, path)
    page = lambda c: F.regexp_extract(c, r"^(-?\d+)", 1).try_cast("long")
    r = written(r.select(page("id").alias("page_id"), "status", F.octet_length("payload").cast("long").alias("n"),
                         F.sha1("payload").alias("own"), F.col("digest"), F.col("type").alias("record_type"),
                         page("refers_to").alias("refers_to")), "warc-read")
    # a revisit has the payload of the response that it names; a row an id, also where rows repeat
    responses = written(r.filter("record_type = 'response'").join(
        r.filter("record_type = 'revisit'").select(F.col("refers_to").alias("page_id")).distinct(), "page_id", "left_semi")
        .select(F.col("page_id").alias("p"), F.col("n").alias("rn"), F.col("own").alias("r_own")).distinct(), "warc-named")
    j = r.join(responses, (r["refers_to"] == responses["p"]) & (r["digest"] == responses["r_own"]), "left")
    revisit = F.col("record_type") == "revisit"
    return j.select("page_id", F.when(revisit, F.col("rn")).otherwise(F.col("n")).alias("payload_bytes"),
                    F.when(revisit, F.col("r_own")).otherwise(F.col("own")).alias("payload_digest"),
                    "record_type", "refers_to", "status")
