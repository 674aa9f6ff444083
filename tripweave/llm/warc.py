"""WARC archives with one gzip member per record, from archives that are one member.

A whole-file gzip stream can only be read from its start. The normaliser inflates such a
stream once, in pieces of bounded size, finds the records in it by their Content-Length,
and writes each as a gzip member of its own; a sidecar index lists the offset and length
of every member, so that later readers fetch single records. Input that already has one
member per record passes the same way.

``write_monolithic`` archives pages: of records with equal payloads the one with the
largest id is a ``response``, the others are ``revisit`` records that refer to it and
carry no payload. Tasks write files of their own under names that are never used twice,
of about ``file_bytes`` each; the table of files that Spark commits decides which ones
count, so lost and repeated attempts leave no trace in the result.

A null payload is empty. A null url is written as an empty one, and characters that
cannot stand in a header are percent-encoded. A null id is archived without one and
comes back as null. Rows that repeat an id are records of their own; if such rows share
the largest id of a payload, all of them are responses. An empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm.runtime import land, partitions, ship

FILES = "path string, records long"
PIECE = 1 << 18
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _page_of(urn: str | None) -> int | None:
    if not urn or not urn.startswith("<urn:page:"):
        return None
    return int(urn.removeprefix("<urn:page:").removesuffix(">"))


def record(page_id, url, payload: bytes, response: int | None, is_response: bool) -> bytes:
    """One WARC record, as bytes."""
    head = {
        "WARC-Type": "response" if is_response else "revisit",
        "WARC-Record-ID": _urn(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url or "", safe=":/?#[]@!$&'()*+,;=%-._~"),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    block = HTTP + b"Content-Length: %d\r\n\r\n" % len(payload)
    if is_response:
        block += payload
    else:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["WARC-Refers-To"] = _urn(response)
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def headers(data: bytes) -> tuple[dict[str, str], int]:
    """The headers of the record that begins here, and where its block begins."""
    end = data.index(b"\r\n\r\n") + 4
    lines = bytes(data[:end]).decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record here: {lines[0][:40]!r}")
    pairs = (line.split(":", 1) for line in lines[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}, end


def _inflated(source) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, piece by piece."""
    stream = zlib.decompressobj(31)
    while data := source.read(PIECE):
        while data:
            out = stream.decompress(data, PIECE)
            if out:
                yield out
            if stream.eof:
                data = stream.unused_data
                stream = zlib.decompressobj(31)
                if not data:
                    break
            else:
                data = stream.unconsumed_tail
    if rest := stream.flush():
        yield rest


def _members(source) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """Every record of a gzip stream: its headers, and its compressed member piece by
    piece, so a record of any length needs little memory. Read one to its end before
    the next."""
    pieces = _inflated(source)
    held = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        if piece is not None:
            held.extend(piece)
        return piece is not None

    while True:
        while held[:2] == b"\r\n" or len(held) < 2:
            if held[:2] == b"\r\n":
                del held[:2]
            elif not more():
                return
        while b"\r\n\r\n" not in held:
            if not more():
                raise EOFError("a record's headers are cut off")
        head, begin = headers(held)
        length = begin + int(head["content-length"])

        def member(left: int) -> Iterator[bytes]:
            squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            while left:
                if not held and not more():
                    raise EOFError("a record's block is cut off")
                part = bytes(held[:left])
                del held[: len(part)]
                left -= len(part)
                yield squeeze.compress(part)
            yield squeeze.compress(b"\r\n\r\n") + squeeze.flush()

        yield head, member(length)


def normalise(source, target) -> list[list]:
    """Rewrite a gzip WARC stream with one member per record. Returns the index: offset,
    length, record id and type of every member."""
    index, at = [], 0
    for head, parts in _members(source):
        size = 0
        for part in parts:
            target.write(part)
            size += len(part)
        index.append([at, size, head.get("warc-record-id"), head.get("warc-type")])
        at += size
    return index


def write_monolithic(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    file_bytes: int = 16 << 20,
) -> DataFrame:
    """Archive pages as whole-file gzip streams. Returns the table of files."""
    spark = pages.sparkSession
    ship(spark)
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.xxhash64(payload).alias("mark"),
    )
    # Which payloads are equal is settled on rows without payloads: one small row per
    # payload that occurs more than once (partial counts fold hot ones), then one per
    # revisit. Both are written, so a hot payload is split when joined and a short list
    # of revisits spares the payloads a shuffle.
    narrow = rows.filter(F.octet_length("payload") >= min_bytes).select(
        "page_id", "mark", F.unhex(F.sha1("payload")).alias("same")
    )
    counted = narrow.groupBy("same").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
    kept = land(counted.filter("n > 1 and response is not null").drop("n"), "kept")
    later = narrow.join(kept, "same").filter(~F.col("page_id").eqNullSafe(F.col("response")))
    revisits = land(later.select("page_id", "mark", "response").distinct(), "revisits")
    own, other = rows.alias("own"), revisits.alias("other")
    same_row = (F.col("own.mark") == F.col("other.mark")) & F.col("own.page_id").eqNullSafe(
        F.col("other.page_id")
    )
    planned = own.join(other, same_row, "left").select(
        "own.page_id", "own.url", "own.payload", "other.response"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        path = file = squeeze = None
        size = count = 0

        def closed():
            file.write(squeeze.flush())
            file.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count])], ["path", "records"])

        for batch in batches:
            for page_id, url, text, response in zip(*(c.to_pylist() for c in batch.columns)):
                if file is None:
                    path, size, count = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    file = store.open_output_stream(path, compression=None)
                    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                first = response is None or response == page_id
                data = record(page_id, url, text.encode(), response, first)
                file.write(squeeze.compress(data))
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    yield closed()
                    file = None
        if file is not None:
            yield closed()

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    return land(planned.mapInArrow(write, FILES), "written")


def normalise_files(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite every file; beside each, ``.index.json`` lists its members. Returns the
    table of the new files."""
    spark = files.sparkSession
    ship(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                new = f"{root}/{uuid.uuid4().hex}.warc.gz"
                with store.open_input_file(path) as source:
                    with store.open_output_stream(new, compression=None) as target:
                        index = normalise(source, target)
                with store.open_output_stream(f"{new}.index.json", compression=None) as side:
                    side.write(json.dumps(index).encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([new]), pa.array([len(index)])], ["path", "records"]
                )

    spread = files.repartition(4 * partitions(spark), F.xxhash64("path"))
    return land(spread.mapInArrow(work, FILES), "normalised")


def read_record(member: bytes) -> tuple:
    """The result row of one gzip member. A response's digest is that of its payload as
    read; a revisit's are those it states."""
    data = zlib.decompress(member, 31)
    head, begin = headers(data)
    block = data[begin : begin + int(head["content-length"])]
    body = block.index(b"\r\n\r\n") + 4
    kind, page_id = head["warc-type"], _page_of(head.get("warc-record-id"))
    if kind == "response":
        payload = block[body:]
        return page_id, len(payload), digest(payload), kind, None
    fields = block[:body].decode("latin-1").lower().split("content-length:")
    stated = head["warc-payload-digest"].removeprefix("sha1:")
    return page_id, int(fields[1].split("\r\n")[0]), stated, kind, _page_of(head["warc-refers-to"])


def read_files(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """One row per record, read member by member through the sidecar indexes."""
    ship(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [part.split()[0] for part in RESULT.split(", ")]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_file(f"{path}.index.json") as side:
                    index = json.loads(side.readall())
                with store.open_input_file(path) as file:
                    rows = [read_record(file.read_at(size, at)) for at, size, *_ in index]
                columns = zip(*rows) if rows else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names
                )

    spread = files.repartition(4 * partitions(spark), F.xxhash64("path"))
    return spread.mapInArrow(work, RESULT)
