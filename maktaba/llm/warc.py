"""WARC files: writing captures with revisit records, reading archives, and transaction assembly.

Writing: each page gives a response record, a request record and a metadata record; the latter two name the response in
WARC-Concurrent-To. Of pages with equal payloads of at least `least_bytes` bytes the one with the largest id is stored,
the others become revisit records that name it in WARC-Refers-To and hold HTTP headers alone, as the standard's
identical-payload-digest profile asks. Each record is a gzip member of its own. A file is written under a name of its
task attempt, in the shared folder, and only files that a successful attempt reports are read.

Reading: archives are read a record at a time, the payload digest of each response is computed anew and compared with its
header. Assembly joins request, response or revisit, and metadata through the concurrent-to identifiers, and gives one
nested row per capture. Payloads stay in the archives by default: a row holds the file, offset and length of each record.

Pages are written once as packs in the shared folder; what is shuffled to find revisits are digests and ids, and the
archives are written from the packs.

Cases: a null payload is empty; rows with the same id, null included, have a capture and identifiers each (the first one's
hold the id alone, the others' also their place); a null id is smaller than all others; a null url is an empty target; an
empty table writes no archive; requests or metadata without a response give captures whose response is null; several
responses under one identifier, in archives of others, give a capture each; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import collecting, drop, filesystem, partitions, shared_dir, staged
from .packs import NO_ID, open_pack, write_packs

FILE_BYTES = 64 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, record_type string, target string, concurrent_to string, refers_to string, date string, content_type string, payload_digest string, payload_bytes long, digest_ok boolean, fields map<string,string>, path string, offset long, length long, payload binary"
NAMES = [x.split()[0] for x in RECORD.replace("map<string,string>", "map").split(", ")]


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_uri(page_id: int | None, kind: str, place: str = "") -> str:
    """The identifier of a page's record, which needs no lookup to refer to. place: of rows that repeat an id."""
    return f"<urn:capture:{'none' if page_id is None else page_id}:{place and place + ':'}{kind}>"


def _record(kind: str, uri: str, headers: list[tuple[str, str]], block: bytes, date: str) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", uri), ("WARC-Date", date), *headers, ("Content-Length", str(len(block)))]
    clean = "".join(f"{k}: {''.join(' ' if c in '\r\n' else c for c in v)}\r\n" for k, v in lines)
    press = zlib.compressobj(1, zlib.DEFLATED, 31)
    return press.compress(b"WARC/1.1\r\n" + clean.encode() + b"\r\n") + press.compress(block) + press.compress(b"\r\n\r\n") + press.flush()


def _capture(page_id: int | None, place: str, url: str, payload: bytes, refers_to: int | None, is_revisit: bool, date: str) -> list[bytes]:
    """The records of one page: response or revisit, request, metadata."""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    target, digest = ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{base32_digest(payload)}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    uri = record_uri(page_id, "revisit" if is_revisit else "response", place)
    if is_revisit:
        first = _record("revisit", uri, [target, digest, ("WARC-Refers-To", record_uri(refers_to, "response")), ("WARC-Profile", REVISIT_PROFILE), ("Content-Type", "application/http; msgtype=response")], http, date)
    else:
        first = _record("response", uri, [target, digest, ("Content-Type", "application/http; msgtype=response")], http + payload, date)
    path = rest[len(host) :].split("#", 1)[0] or "/"
    ask = f"GET {path if path[0] == '/' else '/' + path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    facts = ("" if page_id is None else f"page_id: {page_id}\r\n").encode()
    return [
        first,
        _record("request", record_uri(page_id, "request", place), [target, ("WARC-Concurrent-To", uri), ("Content-Type", "application/http; msgtype=request")], ask, date),
        _record("metadata", record_uri(page_id, "metadata", place), [target, ("WARC-Concurrent-To", uri), ("Content-Type", "application/warc-fields")], facts, date),
    ]


def mark_revisits(packs: DataFrame, *, least_bytes: int = 0) -> DataFrame:
    """pack and marks (place, repeats its id, revisit, refers_to) of the pages that don't hold the first record of both.

    Only digests and ids are shuffled. Groups of equal payloads and ids are aggregated before they move, and the joins with
    them keep a page to a row, so that Spark can cut a large group.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.column("pack").to_pylist():
                ids, _, offsets, data = open_pack(pack)
                found = [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])]
                arrays = [pa.array([pack] * len(ids)), pa.array(np.arange(len(ids))), pa.array(ids), pa.array(found, pa.binary()), pa.array(np.diff(offsets))]
                yield pa.RecordBatch.from_arrays(arrays, names=["pack", "place", "key", "digest", "n_bytes"])

    rows = staged(packs.select("pack").repartition(partitions(packs)).mapInArrow(digests, "pack string, place long, key long, digest binary, n_bytes long"), "digests")
    known = F.when(F.col("key") != NO_ID, F.col("key"))
    equal = rows.filter(F.col("n_bytes") >= least_bytes).groupBy("digest").agg(F.max(known).alias("refers_to"), F.count("*").alias("_n"))
    equal = equal.filter("_n > 1 and refers_to is not null").drop("_n")
    again = rows.groupBy("key").agg(F.min(F.struct("pack", "place")).alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    rows = rows.withColumn("_digest", F.when(F.col("n_bytes") >= least_bytes, F.col("digest")))
    rows = rows.join(equal.withColumnRenamed("digest", "_digest"), "_digest", "left").join(again, "key", "left")
    revisit = F.col("refers_to").isNotNull() & (F.col("refers_to") != F.col("key"))
    repeats = F.col("_first").isNotNull() & (F.col("_first") != F.struct("pack", "place"))
    marks = rows.select("pack", "place", F.coalesce(repeats, F.lit(False)).alias("repeats"), F.coalesce(revisit, F.lit(False)).alias("revisit"), "refers_to").filter("repeats or revisit")
    return marks.groupBy("pack").agg(F.collect_list(F.struct("place", "repeats", "revisit", "refers_to")).alias("marks"))


def write(pages: DataFrame, folder: str, *, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives below folder, and returns their manifest: path, n_records, n_bytes."""
    spark = pages.sparkSession

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        out, path, count, size = None, "", 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count]), pa.array([size])], names=["path", "n_records", "n_bytes"])

        for batch in batches:
            for pack, marks in zip(batch.column("pack").to_pylist(), batch.column("marks").to_pylist()):
                ids, known, offsets, data = open_pack(pack)
                said = {m["place"]: m for m in marks or []}
                for i, url in enumerate(open_pack(pack, 2).to_pylist()):
                    if out is None:
                        fs.create_dir(root, recursive=True)
                        path, count, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = fs.open_output_stream(f"{root}/{path.rsplit('/', 1)[1]}", compression=None)
                    m = said.get(i, {"repeats": False, "revisit": False, "refers_to": None})
                    place = f"{pack.rsplit('/', 1)[1]}-{i}" if m["repeats"] else ""
                    for record in _capture(int(ids[i]) if known[i] else None, place, url, data[offsets[i] : offsets[i + 1]].tobytes(), m["refers_to"], m["revisit"], date):
                        out.write(record)
                        count, size = count + 1, size + len(record)
                    if size >= FILE_BYTES:
                        yield close()
                        out = None
        if out is not None:
            yield close()

    with collecting() as made:
        packs = write_packs(pages, shared_dir(spark, "warc_packs"), id_column, payload_column, F.coalesce(F.col(url_column), F.lit("")))
        rows = packs.select("pack").join(mark_revisits(packs, least_bytes=least_bytes), "pack", "left").repartition(partitions(packs))
        manifest = staged(rows.mapInArrow(save, "path string, n_records long, n_bytes long"), "warc_manifest")
        drop(spark, made[:-1])
    return manifest


def records_of(stream) -> Iterator[tuple[int, int, bytes]]:
    """Offset, compressed length and content of each gzip member of a buffered stream, read in small steps: each member's end copies the rest of a step."""
    at, start, member, content, rest = 0, 0, zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(1 << 14)
        if not data:
            return
        content.append(member.decompress(data))
        rest = member.unused_data
        at += len(data) - len(rest)
        if member.eof:
            yield start, at - start, b"".join(content)
            start, member, content = at, zlib.decompressobj(31), []


def parse(content: bytes) -> dict:
    """The fields of one record. Responses' digests are computed from the payload; revisits' lengths stand in their HTTP headers."""
    head, _, rest = content.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        headers[k.strip().lower()] = v.strip()
    block = rest[: int(headers.get("content-length", 0))]
    kind = headers.get("warc-type", "")
    out = dict.fromkeys(NAMES) | {
        "record_id": headers.get("warc-record-id"), "record_type": kind, "target": headers.get("warc-target-uri"), "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to": headers.get("warc-refers-to"), "date": headers.get("warc-date"), "content_type": headers.get("content-type"), "fields": {},
    }
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        if kind == "response":
            out |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": base32_digest(payload)}
            out["digest_ok"] = stated is None or stated == out["payload_digest"]
        else:
            lengths = [int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            out |= {"payload_bytes": lengths[0] if lengths else None, "payload_digest": stated}
    elif kind == "metadata":
        out["fields"] = dict(x.split(": ", 1) for x in block.decode("utf-8", "replace").split("\r\n") if ": " in x)
    else:
        out |= {"payload": block, "payload_bytes": len(block)}
    return out


def read(manifest: DataFrame, *, payloads: bool = False) -> DataFrame:
    """One row per record of the archives (RECORD). Without payloads a response's payload is checked, then left where it is."""
    kinds = {"payload_bytes": pa.int64(), "offset": pa.int64(), "length": pa.int64(), "digest_ok": pa.bool_(), "fields": pa.map_(pa.string(), pa.string()), "payload": pa.binary()}

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        cells = {n: [r[n] for r in rows] for n in NAMES}
        cells["fields"] = [list(x.items()) for x in cells["fields"]]
        return pa.RecordBatch.from_arrays([pa.array(cells[n], kinds.get(n, pa.string())) for n in NAMES], names=NAMES)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, at = filesystem(path)
                rows, size = [], 0
                with fs.open_input_stream(at, compression=None, buffer_size=1 << 20) as f:
                    for offset, length, content in records_of(f):
                        row = parse(content) | {"path": path, "offset": offset, "length": length}
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        size += len(row["payload"] or b"") + 500
                        if size >= 4 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = manifest.select("path")
    return files.repartition(partitions(files)).mapInArrow(load, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response (or revisit), requests and metadata that are concurrent to it.

    Records meet under the identifier of the response in one aggregation, so the archives are read once.
    """
    record, kind = F.struct(*NAMES), F.col("record_type")
    main = kind.isin("response", "revisit")
    rows = records.select(F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("capture_id"), kind, record.alias("_record")).filter(main | F.col("capture_id").isNotNull())
    part = lambda of: F.collect_list(F.when(of, F.col("_record")))
    found = rows.groupBy("capture_id").agg(part(main).alias("_main"), part(kind == "request").alias("requests"), part(kind == "metadata").alias("metadata"))
    return found.select("capture_id", F.explode_outer("_main").alias("response"), "requests", "metadata")


def load_payload(path: str, offset: int, length: int) -> bytes:
    """The payload of one record, by its place in an archive."""
    fs, at = filesystem(path)
    with fs.open_input_file(at) as f:
        f.seek(offset)
        return parse(zlib.decompress(f.read(length), 31))["payload"] or b""


def write_and_read(pages: DataFrame, *, least_bytes: int = 0) -> DataFrame:
    """Captures of the archives that pages were written to, in a fresh shared folder."""
    spark: SparkSession = pages.sparkSession
    return assemble(read(write(pages, shared_dir(spark, "warc"), least_bytes=least_bytes)))
