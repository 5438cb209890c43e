"""WARC archives: written with one gzip member per record, read sequentially.

``write_archives`` gives each row one record.  Rows with equal payloads of at
least ``min_revisit`` bytes share one: the row with the smallest id is the
response, the others revisit it and store no payload.  ``read_archives`` reads
files as a stream: blocks of bytes go through incremental zlib decompression,
one member after the other; header lines give the record's length, that many
bytes are its block, and block and payload digests are computed as the bytes
pass.  A record's payload is held only if it is asked for.

A task writes its archives under names of its own and reports them in a
manifest, which Spark commits.  A lost or doubled task leaves files that no
manifest names, and they are never read.

Equal payloads are found by SHA-256: a grouped minimum, combined before the
shuffle, written, then joined to the pages.  Only payloads met twice are in it; the
written side has one row per payload, so Spark can split a payload that a third
of all pages have.

Defined cases: a null payload is empty; a null id is written as such and is
never the one referred to while its payload has another id, and is a response
where it has none; repeated rows (same id, same payload) as the response are
responses too.  Payloads of any length are streamed in pieces when read.  A
damaged record gives a row whose ``problem`` says what failed; reading goes on at
the next member where there is one.  An empty table gives no archives and no
rows.  Only the id, url and payload columns are read, whatever else is there.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import batch_rows, slices, table, written
from fundlake.session import shared_dir

MIN_REVISIT = 100
ROLL_BYTES = 256 << 20          # a task's next record starts a new file beyond this
READ_BYTES = 1 << 16
DATE = "2000-01-01T00:00:00Z"   # fixed, so that equal rows give equal archives
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"

RECORD = {"path": "string", "offset": "bigint", "type": "string", "id": "string", "url": "string", "refers_to": "string",
          "payload_bytes": "bigint", "payload_digest": "string", "problem": "string"}


def open_file(path: str, write: bool = False):
    """A byte stream of a file in a folder that all executors share: a local or
    mounted one, or any store Arrow knows by its address."""
    if re.match(r"file:|/", path):
        return open("/" + re.sub(r"^(file:)?/*", "", path), "wb" if write else "rb")
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(path)
    return store.open_output_stream(name) if write else store.open_input_stream(name)


# Writing

def record_name(page_id: str | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else 'id-' + quote(page_id, safe='')}:{digest}>"


def id_of(name: str | None) -> str | None:
    part = (name or "").split(":")[2:3]
    return unquote(part[0][3:]) if part and part[0].startswith("id-") else None


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One record, before compression.  ``refers_to``: the response's id for a
    revisit, whose block is the response's header alone, as the format has it."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_name(page_id, digest)), ("WARC-Date", DATE),
              ("WARC-Target-URI", None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~")),
              ("WARC-Refers-To", None if refers_to is None else record_name(refers_to, digest)),
              ("WARC-Profile", None if refers_to is None else PROFILE),
              ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"".join((b"WARC/1.1\r\n", lines.encode(), b"\r\n", block, b"\r\n\r\n"))


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def first_pages(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(digest, first_id) of the payloads that at least two rows have."""
    long_ones = pages.where(F.length("payload") >= min_revisit)
    return written(long_ones.groupBy("digest").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
                   .where("n > 1 and first_id is not null").select("digest", "first_id"), "warc-first")


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit: int = MIN_REVISIT, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """The manifest (path, records, bytes) of the archives written."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    revisit = (F.length("payload") >= min_revisit) & ~F.col("id").eqNullSafe(F.col("first_id"))
    typed = rows.join(first_pages(rows, min_revisit), "digest", "left").select(
        F.col("id").cast("string").alias("id"), "url", "payload", "digest",
        F.when(revisit, F.col("first_id").cast("string")).alias("refers_to"))
    folder = shared_dir(pages.sparkSession, "warc")
    pages.sparkSession._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(
        pages.sparkSession._jsc.hadoopConfiguration()).mkdirs(pages.sparkSession._jvm.org.apache.hadoop.fs.Path(folder))

    def run(batches):
        import pyarrow as pa
        out, path, records, size = None, None, 0, 0

        def told():
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

        for batch in slices(batches):
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    out, records, size = open_file(path, write=True), 0, 0
                size += out.write(member(record_bytes(page_id, url, payload, digest, refers_to)))
                records += 1
                if size >= roll_bytes:
                    out.close()
                    out = None
                    yield told()
        if out is not None:
            out.close()
            yield told()

    with batch_rows(pages.sparkSession):
        return written(typed.mapInArrow(run, "path string, records bigint, bytes bigint"), "warc-manifest")


# Reading

class Members:
    """The decompressed bytes of one gzip member after the other, of a stream."""

    def __init__(self, stream):
        self.stream, self.rest, self.at = stream, b"", 0

    def _more(self) -> bool:
        data = self.stream.read(READ_BYTES)
        self.rest += data
        return bool(data)

    def next(self) -> bool:
        """Begin the next member; False at the end of the file."""
        if not self.rest and not self._more():
            return False
        self.z, self.out, self.offset = zlib.decompressobj(31), b"", self.at
        return True

    def _fill(self) -> bool:
        """Decompress some more of the member; False at its end."""
        while not self.z.eof:
            if not self.rest and not self._more():
                raise ValueError("truncated member")
            before = len(self.rest)
            try:
                got = self.z.decompress(self.rest, READ_BYTES)
            except zlib.error as e:
                raise ValueError(f"damaged member: {e}") from None
            self.rest = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            self.at += before - len(self.rest)
            if got:
                self.out += got
                return True
        return False

    def line(self) -> bytes:
        while b"\r\n" not in self.out:
            if len(self.out) > READ_BYTES or not self._fill():
                raise ValueError("header without an end")
        one, self.out = self.out.split(b"\r\n", 1)
        return one

    def pieces(self, n: int):
        while n:
            if not self.out and not self._fill():
                raise ValueError("block shorter than its length")
            piece, self.out = self.out[:n], self.out[n:]
            n -= len(piece)
            yield piece

    def finish(self) -> None:
        while len(self.out) <= 4 and self._fill():
            pass
        if self.out != b"\r\n\r\n":
            raise ValueError("record not ended by two line breaks")

    def drain(self) -> bool:
        """Pass over the rest of the member; False if that can't be read."""
        try:
            while self._fill():
                self.out = b""
        except ValueError:
            return False
        return True

    def skip_damage(self) -> bool:
        """Go to the next member's start; False if there is none."""
        self.rest, self.at = self.rest[1:], self.at + 1
        while MAGIC not in self.rest:
            gone = max(0, len(self.rest) - 2)
            self.rest, self.at = self.rest[gone:], self.at + gone
            if not self._more():
                return False
        gone = self.rest.index(MAGIC)
        self.rest, self.at = self.rest[gone:], self.at + gone
        return True


def header_lines(m: Members) -> dict[str, str]:
    fields = {}
    while line := m.line():
        name, found, value = line.decode("utf-8", "replace").partition(":")
        if not found:
            raise ValueError("header line without a colon")
        fields[name.strip().lower()] = value.strip()
    return fields


def whole_number(text) -> int:
    if not re.fullmatch(r"[0-9]+", text or ""):
        raise ValueError("no content length")
    return int(text)


def digest_name(text: str | None) -> str | None:
    return None if text is None else text.rpartition(":")[2]


def read_record(m: Members, keep: bool) -> dict:
    """The record at the stream's place: its header, measured sizes and digests,
    and its payload if ``keep``."""
    if not m.line().startswith(b"WARC/"):
        raise ValueError("no WARC record")
    head = header_lines(m)
    pieces = m.pieces(whole_number(head.get("content-length")))
    block, payload, kept, size, http = hashlib.sha256(), hashlib.sha256(), [], 0, b""
    is_http = head.get("content-type", "").startswith("application/http")
    in_payload = not is_http
    for piece in pieces:
        block.update(piece)
        if not in_payload:
            http += piece
            end = http.find(b"\r\n\r\n")
            if end < 0:
                continue
            http, piece, in_payload = http[:end], http[end + 4:], True
        payload.update(piece)
        size += len(piece)
        if keep:
            kept.append(piece)
    m.finish()
    told = digest_name(head.get("warc-payload-digest"))
    problem = None
    if digest_name(head.get("warc-block-digest")) not in (None, block.hexdigest()):
        problem = "block digest differs"
    if head.get("warc-type") == "revisit":
        # No payload here: its length is the one that the stored HTTP header gives.
        length = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", http)
        size, digest = int(length[1]) if length else None, told
    else:
        digest = payload.hexdigest()
        if told not in (None, digest):
            problem = problem or "payload digest differs"
    return {"offset": m.offset, "type": head.get("warc-type"), "id": head.get("warc-record-id"),
            "url": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to"), "payload_bytes": size,
            "payload_digest": digest, "problem": problem, "payload": b"".join(kept) if keep else None}


def records(stream, keep: bool = False):
    """Every record of an archive, in order."""
    m = Members(stream)
    while m.next():
        try:
            yield read_record(m, keep)
        except ValueError as e:
            yield {"offset": m.offset, "problem": str(e)}
            if not m.drain() and not m.skip_damage():
                return


def read_archives(paths: DataFrame, path_col: str = "path", payload: bool = False) -> DataFrame:
    """One row per record of the archives named: path, offset, type, id, url,
    refers_to, payload_bytes, payload_digest, problem (null: all checks hold)
    and, on request, payload.  Each file is read by one task, as a stream."""
    columns = RECORD | ({"payload": "binary"} if payload else {})

    def run(batches):
        import pyarrow as pa
        types = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], types[t]) for c, t in columns.items()],
                                              list(columns))

        for b in batches:
            for path in b.column(0).to_pylist():
                held, size = [], 0
                with open_file(path) as stream:
                    for r in records(stream, payload):
                        held.append(r | {"path": path})
                        size += len(r.get("payload") or b"")
                        if len(held) >= 2048 or size > 8_000_000:
                            yield batch(held)
                            held, size = [], 0
                if held:
                    yield batch(held)

    files = paths.where(F.col(path_col).isNotNull()).select(F.col(path_col).alias("path"))
    return files.repartition(max(1, files.count()), "path").mapInArrow(
        run, ", ".join(f"{c} {t}" for c, t in columns.items()))


def page_id(name: Column, kind: str) -> Column:
    """The row id in a record name, as ``record_name`` wrote it."""
    part = F.split_part(name, F.lit(":"), F.lit(3))
    return F.when(F.startswith(part, F.lit("id-")), F.url_decode(F.substr(part, F.lit(4)))).cast(kind)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType.simpleString()
    read = read_archives(write_archives(pages))
    checked = F.when(F.col("problem").isNull(), F.col("type")).otherwise(F.raise_error(F.concat_ws(" ", "path", "offset", "problem")))
    return written(read.select(
        page_id(F.col("id"), kind).alias("page_id"), "payload_bytes", "payload_digest",
        checked.alias("record_type"), page_id(F.col("refers_to"), kind).alias("refers_to")), "warc-read")


QUERIES = {"op12_warc": op12_warc}

_ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= {MIN_REVISIT} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
ORACLES = {"op12_warc": _ORACLE}
