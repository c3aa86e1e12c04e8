"""WARC archives: writing pages, normalising whole-file gzip to one member per record, and reading by index.

Many archives come as one gzip stream over the whole file, from which no record can be read alone.  The normaliser
inflates such a stream once, from front to back in bounded pieces, writes every record as a gzip member of its own and a
sidecar index beside it: one JSON line per record with its offset and length.  Readers then seek.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from aeroloom.llm import files, text as T

#: Uncompressed bytes after which a writer begins a new archive.
ROLL = 128 << 20
PIECE = 1 << 20
LEVEL = 1
#: Payloads below this size are never revisits.
LEAST_REVISIT = 100
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'page:{page_id}')}>"


def record(kind: str, page_id, url: str, digest: str, payload: bytes, refers_to=None) -> bytes:
    """One WARC/1.1 record.  A revisit has the HTTP head only; its headers name the record it refers to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"X-Page-ID: {'' if page_id is None else page_id}",
            f"WARC-Target-URI: {' '.join((url or '').split())}", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def inflate(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of one member or more, in bounded pieces."""
    engine = zlib.decompressobj(31)
    fresh, raw = True, b""
    while True:
        raw = raw or stream.read(PIECE)
        if not raw:
            break
        fresh = False
        out = engine.decompress(raw, PIECE)
        if out:
            yield bytes(out)
        raw = engine.unconsumed_tail
        if engine.eof:
            raw, engine, fresh = engine.unused_data, zlib.decompressobj(31), True
    if not fresh:
        rest = engine.flush()
        if rest:
            yield rest
        if not engine.eof:
            raise ValueError("the gzip stream ends early")


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated archive, as bytes; the content length says where one ends."""
    held = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        if piece is None:
            return False
        held.extend(piece)
        return True

    while True:
        while held[:2] == b"\r\n":
            del held[:2]
        if len(held) < 2 and more():
            continue
        if not held:
            return
        if not held.startswith(b"WARC/"[:len(held)]):
            raise ValueError("no WARC record where one should begin")
        looked = 0
        while (end := held.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(held) - 3)
            if not more():
                raise ValueError("a record's header ends early")
        size = end + 4 + int(headers(held[:end])["content-length"])
        while len(held) < size:
            if not more():
                raise ValueError("a record's block ends early")
        yield bytes(held[:size])
        del held[:size]


def headers(head: bytes | bytearray) -> dict[str, str]:
    """Header fields by lower-case name."""
    out = {}
    for line in bytes(head).decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def normalise(source: str, target: str) -> tuple[int, str]:
    """Rewrite an archive with one gzip member per record; returns the number of records and the index's place.

    Archive and index appear under their names when complete.  Works record by record: memory holds one of them.
    """
    index = target + ".idx"
    n = offset = 0
    with files.read_at(source) as stream, files.committed(target) as out, files.committed(index) as lines:
        for whole in split_records(inflate(stream)):
            head = headers(whole[:whole.index(b"\r\n\r\n")])
            engine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            member = engine.compress(whole + b"\r\n\r\n") + engine.flush()
            out.write(member)
            lines.write((json.dumps({"id": head.get("warc-record-id"), "type": head.get("warc-type"), "offset": offset, "length": len(member),
                                     "digest": head.get("warc-payload-digest")}) + "\n").encode())
            offset += len(member)
            n += 1
    return n, index


def read_members(archive: str, index: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and HTTP body of each record, found by the index, each member read alone."""
    with files.read_at(index) as f:
        entries = f.read().splitlines()
    with files.read_at(archive) as f:
        for line in entries:
            entry = json.loads(line)
            whole = zlib.decompress(f.read_at(entry["length"], entry["offset"]), 31)
            end = whole.index(b"\r\n\r\n")
            head = headers(whole[:end])
            block = whole[end + 4:end + 4 + int(head["content-length"])]
            yield head, block


def mark_revisits(pages: DataFrame) -> DataFrame:
    """Adds payload_bytes, payload_digest and refers_to (the smallest page_id with an equal payload; null for that one
    and for payloads below `LEAST_REVISIT` bytes).  A null html is empty; rows without a page_id are never referred to.
    """
    pages = pages.drop("payload", "payload_bytes", "payload_digest", "refers_to")
    rows = (pages.withColumn("payload", F.coalesce("html", F.lit("")).cast("binary"))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256)))
    key, first = T.free_name(rows.columns, "key"), T.free_name(rows.columns, "first")
    # Payloads too short to be referred to (empty and boilerplate pages among them) get keys of their own, which spread them.
    long_enough = F.col("payload_bytes") >= LEAST_REVISIT
    keyed = rows.withColumn(key, F.when(long_enough, F.col("payload_digest")).otherwise(F.concat(F.lit("short "), F.xxhash64("page_id", "url"))))
    # One row per digest that occurs twice, combined before the shuffle; the pages' own texts are not in it.
    firsts = (rows.where(long_enough).groupBy(F.col("payload_digest").alias(key))
              .agg(F.min("page_id").alias(first), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).where(F.col(first).isNotNull()).drop("n"))
    marked = keyed.join(firsts, key, "left")
    # A repeated page_id is one page twice: neither row refers to itself.
    return marked.withColumn("refers_to", F.when(F.col(first) != F.col("page_id"), F.col(first))
                             .when(F.col("page_id").isNull(), F.col(first))).drop(key, first)


def write_archives(marked: DataFrame, folder: str, roll: int = ROLL) -> DataFrame:
    """Write rows of `mark_revisits` to archives, each one gzip stream as a whole; returns a table of their places."""
    T.small_batches(marked.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, ctx, out, engine, size = [], None, None, None, 0

        def close():
            out.write(engine.flush())
            ctx.__exit__(None, None, None)

        for batch in batches:
            for page, url, payload, digest, first in zip(batch["page_id"], batch["url"], batch["payload"], batch["payload_digest"], batch["refers_to"]):
                if ctx is None:
                    uri = f"{folder}/{uuid.uuid4().hex}.warc.gz"  # a task that runs twice leaves an archive that no table names
                    ctx = files.committed(uri)
                    out, engine, size = ctx.__enter__(), zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
                    made.append(uri)
                again = not pd.isna(first)
                raw = record("revisit" if again else "response", None if pd.isna(page) else int(page), url, digest, bytes(payload), int(first) if again else None)
                out.write(engine.compress(raw))
                size += len(raw)
                if size >= roll:
                    close()
                    ctx = None
        if ctx is not None:
            close()
        yield pd.DataFrame({"uri": made})

    return files.written(marked.select("page_id", "url", "payload", "payload_digest", "refers_to").mapInPandas(write, "uri string"), "warc-list")


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Normalise every archive of a table with ``uri``; returns uri, archive, index and n_records."""
    n = files.parts(archives.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["uri"]:
                target = f"{folder}/{uri.rsplit('/', 1)[1]}"
                count, index = normalise(uri, target)
                yield pd.DataFrame({"uri": [uri], "archive": [target], "index": [index], "n_records": [count]})

    return files.written(archives.select("uri").repartition(n, "uri").mapInPandas(run, "uri string, archive string, index string, n_records long"), "warc-members")


def read_archives(members: DataFrame) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type and refers_to.

    Size and digest of a response are those of the bytes read; a revisit has them from its headers.  A response whose
    bytes do not match its digest ends the job with an error.
    """
    n = files.parts(members.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, index in zip(batch["archive"], batch["index"]):
                rows = []
                for head, block in read_members(archive, index):
                    end = block.index(b"\r\n\r\n")
                    body, stated = block[end + 4:], head["warc-payload-digest"].removeprefix("sha256:")
                    kind = head["warc-type"]
                    if kind == "response" and hashlib.sha256(body).hexdigest() != stated:
                        raise ValueError(f"{head['warc-record-id']} in {archive} does not match its digest")
                    rows.append((head["x-page-id"], head["warc-target-uri"], int(headers(block[:end])["content-length"]), stated, kind,
                                 head.get("x-refers-to-page")))
                    if len(rows) == 4096:
                        yield frame(rows)
                        rows = []
                if rows:
                    yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        for c in ("page_id", "refers_to"):
            out[c] = pd.array([int(v) if v else None for v in out[c]], "Int64")
        return out

    return (members.select("archive", "index").repartition(n, "archive")
            .mapInPandas(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"))
