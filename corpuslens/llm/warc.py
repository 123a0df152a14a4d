"""WARC archives: written by tasks into the shared folder, read back record by record.

Each record is one gzip member. The reader inflates a member with an incremental zlib
object from chunks of a file stream, frames the record by its Content-Length, and checks
block and payload digests. Equal payloads of ``MIN_REVISIT`` bytes or more are stored
once: the record with the largest id is the response, the others are revisits that hold
the HTTP header only.

Defined cases: a null or empty html is an empty payload; a null url is an empty target;
rows that repeat the largest id of their payload are responses as well; a null id is
never the largest, and a payload that only rows without id hold has responses only.
Further columns of the pages are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.session import fresh_path, materialise

MIN_REVISIT = 1000
ARCHIVE_BYTES = 128 << 20
CHUNK = 1 << 16
SALTS = 32
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "stored_bytes long, verified boolean"
)


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def sha1_header(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    text = record.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def encode_record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member; ``refers_to`` makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join(url.split("\r")).replace("\n", "")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", sha1_header(hashlib.sha1(payload).digest())),
        ("WARC-Block-Digest", sha1_header(hashlib.sha1(block).digest())),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields[3:3] = [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def plan_records(pages: DataFrame) -> DataFrame:
    """Pages with their payload's ``refers_to``: the largest id among equal large payloads, else null.

    Only ids, sizes and digests are shuffled. The table of payloads that occur twice or
    more is copied once per salt, so a payload on a third of all pages is spread.
    """
    facts = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    large = F.octet_length("html") >= MIN_REVISIT
    ids = facts.filter(large).groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    shared = ids.filter("n > 1 and largest is not null").select(
        "digest", "largest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    shared = materialise(shared, "payloads")
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    joined = facts.withColumn("salt", salt).join(shared, ["digest", "salt"], "left")
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("largest"))
    return joined.select("page_id", "url", "html", F.when(other, F.col("largest")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write records to archives and return the manifest.

    Every attempt of a task writes files of its own; only those in the manifest, which
    Spark commits, are ever read, so a lost executor leaves no half archive in use.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = open_folder(folder)
        store.create_dir(base, recursive=True)
        out, done, records, size, name = None, [], 0, 0, ""
        for batch in batches:
            for page_id, url, html, refers_to in zip(batch.page_id, batch.url, batch.html, batch.refers_to):
                if out is None:
                    name, records, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(name, compression=None)
                member = encode_record(
                    None if pd.isna(page_id) else int(page_id), url, html.encode(), None if pd.isna(refers_to) else int(refers_to)
                )
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    done.append((name, records, size))
        if out is not None:
            out.close()
            done.append((name, records, size))
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    given = records.withColumns({c: F.col(c).cast("decimal(20,0)") for c in ("page_id", "refers_to")})
    return materialise(given.mapInPandas(run, MANIFEST), "archives")


class Member:
    """Reads one gzip member at a time from a stream of chunks."""

    def __init__(self, stream, chunk: int = CHUNK):
        self.stream, self.chunk, self.rest, self.inflater, self.ready = stream, chunk, b"", None, b""

    def next(self) -> bool:
        """Go to the next member; False at the end of the file."""
        self.rest = self.rest or self.stream.read(self.chunk)
        self.inflater, self.ready = zlib.decompressobj(31), b""
        return bool(self.rest)

    def more(self) -> bytes:
        """Further inflated bytes of this member; empty at its end."""
        while not self.inflater.eof:
            if not self.rest:
                self.rest = self.stream.read(self.chunk)
                if not self.rest:
                    raise EOFError("the archive ends inside a record")
            made = self.inflater.decompress(self.rest, self.chunk)
            self.rest = self.inflater.unconsumed_tail or self.inflater.unused_data
            if made:
                return made
        return b""

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with ``mark``."""
        while (at := self.ready.find(mark)) < 0:
            made = self.more()
            if not made:
                raise EOFError("a record has no end of its header")
            self.ready += made
        out, self.ready = self.ready[: at + len(mark)], self.ready[at + len(mark) :]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """Exactly ``n`` bytes, in chunks."""
        while n:
            part = self.ready or self.more()
            if not part:
                raise EOFError("a record is shorter than its Content-Length")
            yield part[:n]
            self.ready = part[n:]
            n -= len(part[:n])

    def finish(self) -> None:
        """The member must hold nothing but the two closing line ends."""
        while made := self.more():
            self.ready += made
        if self.ready != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:] if x)}


def read_archive(stream, with_payload: bool = False) -> Iterator[dict]:
    """The records of one archive in order; memory is bound by a chunk unless payloads are wanted."""
    member = Member(stream)
    while member.next():
        fields = header_fields(member.until(b"\r\n\r\n"))
        left = int(fields["content-length"])
        block, payload = hashlib.sha1(), hashlib.sha1()
        http = b""
        body: list[bytes] = []
        stored, in_body = 0, False
        for part in member.take(left):
            block.update(part)
            if not in_body:
                http += part
                if (at := http.find(b"\r\n\r\n")) < 0:
                    continue
                http, part, in_body = http[: at + 4], http[at + 4 :], True
            payload.update(part)
            stored += len(part)
            if with_payload:
                body.append(part)
        member.finish()
        revisit = fields["warc-type"] == "revisit"
        named = fields["warc-payload-digest"]
        whole = int(header_fields(http)["content-length"])
        good = fields["warc-block-digest"] == sha1_header(block.digest())
        good &= revisit or (named == sha1_header(payload.digest()) and whole == stored)
        yield {
            "page_id": page_of(fields["warc-record-id"]),
            "url": fields["warc-target-uri"],
            "record_type": fields["warc-type"],
            "refers_to": page_of(fields["warc-refers-to"]) if revisit else None,
            "payload_bytes": whole,
            "payload_digest": base64.b32decode(named.removeprefix("sha1:")).hex(),
            "stored_bytes": stored,
            "verified": good,
            **({"payload": b"".join(body)} if with_payload else {}),
        }


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False, rows: int = 256) -> DataFrame:
    """All records of the archives in the manifest, one task per archive or few.

    A record that breaks framing ends the job; one whose digest differs has ``verified``
    false. A revisit's digest and size are those of the payload it refers to.
    """
    schema = RECORDS + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = open_folder(folder)
        for batch in batches:
            for path in batch.path:
                with store.open_input_stream(path, compression=None) as stream:
                    held = []
                    for record in read_archive(stream, with_payload):
                        held.append(record)
                        if len(held) == rows:
                            yield _frame(held, names)
                            held = []
                    if held:
                        yield _frame(held, names)

    # One file each: the paths are dealt by the archives themselves, not by the manifest's few files.
    spread = manifest.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism * 4), "path")
    return spread.select("path").mapInPandas(run, schema)


def _frame(records: list[dict], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame.from_records(records, columns=names)
    for c in ("page_id", "refers_to"):
        frame[c] = pd.array([r[c] for r in records], "Int64")
    return frame


def round_trip(pages: DataFrame) -> DataFrame:
    """Write every page to archives in the shared folder and read the archives back."""
    folder = fresh_path(pages.sparkSession, "warc")
    return read_archives(write_archives(plan_records(pages), folder), folder)
