"""WARC archives: writing, the monolithic gzip normaliser, and reading by offset index.

``write_monolithic`` writes archives whose whole file is one gzip stream.  ``normalise``
inflates each such stream once, from start to end, rewrites every record as a gzip member of
its own and writes a sidecar index of member offsets.  ``read_members`` then reads records
by that index.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklab.llm.common import sheltered
from tracklab.sources.staging import stage

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
# zlib level of the rewritten members.
LEVEL = 3
# Bytes of the stream that are handed to zlib or a file at a time.
PIECE = 1 << 20

INDEX = "file string, offset long, length long, record_id string, record_type string"
RECORD = ("file string, offset long, record_id string, record_type string, target_uri string, refers_to_id string, "
          "payload_digest string, payload_bytes long, payload binary")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a string's UTF-8 bytes, without user functions."""
    digest = F.sha1(payload)
    chars = []
    for i in range(8):  # five hex digits are 20 bits: four base32 characters
        bits = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            chars.append(F.substring(F.lit(BASE32), F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*chars)


@sheltered("_key", "_k", "_first")
def linked(df: DataFrame, record_id: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """``df`` with ``payload_bytes``, ``payload_digest`` and ``refers_to``.

    Of rows with equal payloads of at least ``min_bytes`` bytes the largest id is the
    response; the others refer to it.  Null payloads are empty.  Rows that share the largest
    id are all responses; rows without an id refer to the largest id of their payload.
    Payloads are grouped by SHA-256 and length.  Only groups of more than one row are joined
    back; a payload that many rows share is a skewed key, which adaptive execution splits.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = df.withColumns({
        "payload_bytes": F.octet_length(body).cast("long"), "payload_digest": base32_sha1(body),
        "_key": F.concat(F.sha2(body, 256), F.lit("-"), F.octet_length(body).cast("string")),
    })
    # Staged, so that both sides of the join are exchanged and a hot payload's rows can be split.
    first = stage(
        df.select(F.col(record_id).alias("_id"), body.alias("_body"))
        .filter(F.octet_length("_body") >= min_bytes)
        .select("_id", F.concat(F.sha2("_body", 256), F.lit("-"), F.octet_length("_body").cast("string")).alias("_k"))
        .groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_first"))
        .filter("_n > 1").select("_k", "_first"), "warc-repeated")
    out = rows.join(first, F.col("_key") == F.col("_k"), "left")
    refers = F.when(~F.col(record_id).eqNullSafe(F.col("_first")), F.col("_first"))
    return out.withColumn("refers_to", refers).drop("_key", "_k", "_first")


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def record_uri(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">"))


def records(df: DataFrame, record_id: str = "page_id", uri: str = "url", payload: str = "html") -> DataFrame:
    """One column ``record``: a WARC/1.1 record per row of a ``linked`` table, without its end.

    Responses hold an HTTP response with the payload, revisits only its header, whose
    Content-Length is that of the payload left out.  Control characters of a URI are blanks.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, body))
    address = F.regexp_replace(F.coalesce(F.col(uri), F.lit("")), r"[\x00-\x1F\x7F]", " ")
    kind = F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    extra = F.when(revisit, F.concat(
        _line("WARC-Refers-To", record_uri(F.col("refers_to"))),
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
    )).otherwise(F.lit(""))
    return df.select(F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", record_uri(F.col(record_id))),
        _line("WARC-Target-URI", address), F.lit(f"WARC-Date: {DATE}\r\n"),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))), extra,
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block,
    ).alias("record"))


def write_monolithic(recs: DataFrame, path: str) -> None:
    """Archives under ``path``, one per task, each a single gzip stream over all its records."""
    recs.write.option("compression", "gzip").option("lineSep", END).text(path)


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def split_records(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """Whole records, end included, of a stream that comes in pieces; holds one record at a time."""
    held, have, need, end = [], 0, 0, END.encode()
    for piece in pieces:
        held.append(piece)
        have += len(piece)
        while have >= need:
            data = b"".join(held)
            if not need:
                if (at := data.find(end)) < 0:
                    held = [data]
                    break
                need = at + 4 + int(_headers(data[:at])["content-length"]) + 4
                held = [data]
                continue
            yield data[:need]
            rest = data[need:]
            held, have, need = [rest], len(rest), 0
    if b"".join(held).strip():
        raise ValueError("an archive ends inside a record")


class _MemberFile:
    """A gzip file of one member per record; it appears under its name only when complete."""

    def __init__(self, folder: str, name: str):
        self.fs, base = pafs.FileSystem.from_uri(folder)
        self.path, self.name, self.offset = f"{base}/{name}", name, 0
        self.part = f"{base}/.{name}.{uuid.uuid4().hex}"
        self.fs.create_dir(base, recursive=True)
        self.out = self.fs.open_output_stream(self.part, compression=None)

    def add(self, record: bytes) -> dict:
        z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        n = 0
        for i in range(0, len(record), PIECE):
            n += self.out.write(z.compress(record[i:i + PIECE])) or 0
        self.out.write(z.flush())
        size, start = self.out.tell() - self.offset, self.offset
        self.offset += size
        head = _headers(record[: record.find(b"\r\n\r\n")])
        return {"file": self.name, "offset": start, "length": size,
                "record_id": head.get("warc-record-id"), "record_type": head.get("warc-type")}

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def _rewrite(folder: str):
    end = END.encode()

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                            ("record_id", pa.string()), ("record_type", pa.string())])

        def lines():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1))

        pending, source = lines(), None
        line = next(pending, None)
        while line is not None:
            source = line[0]

            def pieces():  # the stream of one file, with the separators that the reader took away
                nonlocal line
                while line is not None and line[0] == source:
                    yield line[1].as_py()
                    yield end
                    line = next(pending, None)

            name = os.path.basename(source).removesuffix(".gz").removesuffix(".txt") + ".warc.gz"
            target, rows = _MemberFile(folder, name), []
            for record in split_records(pieces()):
                rows.append(target.add(record))
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            target.close()
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return rewrite


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrites the monolithic archives of a folder as files of one gzip member per record.

    Spark's text source inflates each file once, as a stream split at every CR LF CR LF; the
    pieces are put together again by Content-Length, so payloads may hold any bytes.  A task
    holds one record, files are renamed when complete, and a repeated task writes the same
    file again.  The sidecar index is a Parquet table below ``target``; it is returned.
    Folders are reached through Spark for reading and through Arrow's file systems for
    members.  Archives without records give files without members.
    """
    lines = spark.read.option("lineSep", END).text(source)
    stream = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    index = stream.mapInArrow(_rewrite(f"{target}/members"), INDEX)
    index.write.parquet(f"{target}/index")
    return spark.read.schema(INDEX).parquet(f"{target}/index")


def parse(member: bytes) -> dict:
    """Fields of an inflated record; the digest and size of a response are taken anew from its payload."""
    at = member.find(b"\r\n\r\n")
    head = _headers(member[:at])
    block = member[at + 4: at + 4 + int(head["content-length"])]
    cut = block.find(b"\r\n\r\n")
    http = _headers(block[:cut])
    payload = block[cut + 4:]
    kind = head["warc-type"]
    if kind == "revisit":
        digest, size, payload = head["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"]), None
    else:
        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
    return {"record_id": head["warc-record-id"], "record_type": kind, "target_uri": head.get("warc-target-uri"),
            "refers_to_id": head.get("warc-refers-to"), "payload_digest": digest, "payload_bytes": size,
            "payload": payload}


def _read(folder: str, with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()),
                            ("record_type", pa.string()), ("target_uri", pa.string()),
                            ("refers_to_id", pa.string()), ("payload_digest", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        fs, base = pafs.FileSystem.from_uri(folder)
        name, handle = None, None
        for batch in batches:
            rows, held = [], 0
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if file != name:
                    if handle:
                        handle.close()
                    name, handle = file, fs.open_input_file(f"{base}/{file}")
                row = parse(zlib.decompress(handle.read_at(length, offset), 31))
                if not with_payload:
                    row["payload"] = None
                held += len(row["payload"] or b"")
                rows.append({"file": file, "offset": offset, **row})
                if held > 16 * PIECE:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if handle:
            handle.close()

    return read


def read_members(index: DataFrame, target: str, with_payload: bool = True) -> DataFrame:
    """Records of the members that ``index`` lists (all of it or any selection)."""
    return index.select("file", "offset", "length").mapInArrow(_read(f"{target}/members", with_payload), RECORD)
