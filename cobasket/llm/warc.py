"""WARC archives: pages written as gzip members, one per record, and read back sequentially.

Writing: of pages with equal, not too small payloads, that with the smallest id becomes a response record and
the others revisit it. Every task streams its rows into archive files of its own in the shared folder and
returns their names, so files of lost or repeated attempts are never listed and never read.

Reading: one task per archive walks through its members with incremental decompression, frames each
record by its content length, and verifies block and payload digests; it holds one chunk at a time. Records of any type
and from any writer are read: HTTP heads are looked for where the content type says so, digests may be of any algorithm that
hashlib knows, in base 16 or 32, and may be missing, and ids that aren't pages of ours have no page number.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from cobasket.llm.arrow import pieces, texts
from cobasket.llm.storage import fresh_path, written
from cobasket.operators.lookup import look_up

CHUNK = 1 << 16
# An archive is closed once it holds so many compressed bytes.
ARCHIVE_BYTES = 1 << 30
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fixed value: records carry no time of crawling, so that archives don't change from run to run.
DATE = "1970-01-01T00:00:00Z"


def _record_id(page: int | None) -> str:
    return f"<urn:page:{'null' if page is None else page}>"


def _page_of(record_id: str) -> int | None:
    """The page of a record id of ours; ids of other forms have none."""
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", record_id)
    return int(found[1]) if found else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit has no payload; its length stands in an extension field."""
    body = payload if kind == "response" else b""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + body
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(page)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe="%:/?#[]@!$&'()*+,;=~")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields[2:2] = [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", REVISIT)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


class Damaged(ValueError):
    """An archive that can't be read on."""


class Members:
    """The gzip members of a stream, decompressed bit by bit."""

    def __init__(self, stream):
        self.stream, self.raw, self.unzip, self.plain = stream, b"", None, b""

    def next(self) -> bool:
        """Go to the next member; false at the end of the stream."""
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
        self.unzip, self.plain = zlib.decompressobj(31), b""
        return bool(self.raw)

    def _more(self) -> bool:
        """Decompress another chunk of this member; false at its end."""
        while not self.unzip.eof:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    raise Damaged("the archive ends within a record")
            try:
                got = self.unzip.decompress(self.raw, CHUNK)
            except zlib.error as e:
                raise Damaged(f"bad compression: {e}") from e
            self.raw = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail
            if got:
                self.plain += got
                return True
        return False

    def head(self) -> bytes:
        """Bytes up to and with the next empty line, however many."""
        read, seam = [self.plain], self.plain
        while (end := seam.find(b"\r\n\r\n")) < 0:
            self.plain = b""
            if not self._more():
                raise Damaged("no end of header")
            # The line may end across two chunks.
            read.append(self.plain)
            seam = seam[-3:] + self.plain
        tail = len(seam) - end - 4
        self.plain = seam[len(seam) - tail :]
        whole = b"".join(read)
        return whole[: len(whole) - tail]

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in chunks."""
        while size:
            if not self.plain and not self._more():
                raise Damaged("a record is shorter than its content length")
            part, self.plain = self.plain[:size], self.plain[size:]
            size -= len(part)
            yield part

    def rest(self) -> bytes:
        """What is left of this member, which should be little."""
        while len(self.plain) <= CHUNK and self._more():
            pass
        return self.plain

    def skip(self) -> bool:
        """Pass over what is left of a damaged member; false if the next one can't be found from there."""
        try:
            while self._more():
                self.plain = b""
        except Damaged:
            return False
        return True


def read_records(stream) -> Iterator[dict]:
    """Every record of an archive: its fields, ``payload_bytes`` and ``payload_digest`` as found, ``problem`` or None.

    Records whose digests don't match are reported, and broken framing gives a record that has only a problem; reading goes
    on with the next member either way. Broken compression, which hides where that is, ends the archive.
    """
    members = Members(stream)
    while members.next():
        try:
            found = _record_of(members)
        except Damaged as e:
            yield {"fields": {}, "payload_bytes": None, "payload_digest": None, "problem": str(e)}
            if not members.skip():
                return
        else:
            yield found


class Digest:
    """A labelled digest as records state it, and what the content gives."""

    def __init__(self, stated: str | None):
        name, _, value = (stated or "").partition(":")
        known = name.lower().replace("-", "") in {"md5", "sha1", "sha256", "sha512"}
        self.name = name.lower().replace("-", "") if known and value else None
        self.value = value.strip()
        self.hash = hashlib.new(self.name) if self.name else None

    def update(self, part: bytes) -> None:
        if self.hash:
            self.hash.update(part)

    def stated(self) -> bytes | None:
        """The stated digest, from base 16 or 32; null if it is neither."""
        if not self.hash:
            return None
        try:
            if len(self.value) == 2 * self.hash.digest_size:
                return bytes.fromhex(self.value)
            return base64.b32decode(self.value.upper() + "=" * (-len(self.value) % 8))
        except (ValueError, binascii.Error):
            return None

    def differs(self) -> bool:
        """Whether something is stated that the content doesn't give."""
        return self.hash is not None and self.stated() != self.hash.digest()


def _record_of(members: Members) -> dict:
    """The record in the member at hand."""
    lines = members.head().decode("utf-8", "replace").split("\r\n")
    pairs = (line.partition(":") for line in lines[1:])
    fields = {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}
    if not lines[0].startswith("WARC/") or not fields.get("content-length", "").isdigit():
        raise Damaged("not a WARC record")
    block, payload = Digest(fields.get("warc-block-digest")), Digest(fields.get("warc-payload-digest"))
    within = not fields.get("content-type", "").lower().startswith("application/http")
    digest, found, head = hashlib.sha256(), 0, b""
    for part in members.take(int(fields["content-length"])):
        block.update(part)
        if not within:
            head += part
            end = head.find(b"\r\n\r\n")
            if end < 0:
                continue
            within, part = True, head[end + 4 :]
        payload.update(part)
        digest.update(part)
        found += len(part)
    if members.rest() != b"\r\n\r\n":
        raise Damaged("no end of record where its content length puts it")
    problem = "block digest" if block.differs() else None
    shown = digest.hexdigest()
    if fields.get("warc-type") == "revisit":  # the payload lies elsewhere
        length = fields.get("x-payload-length", "")
        found = int(length) if length.isdigit() else None
        shown = stated.hex() if payload.name == "sha256" and (stated := payload.stated()) else None
    elif payload.differs():
        problem = problem or "payload digest"
    return {"fields": fields, "payload_bytes": found, "payload_digest": shown, "problem": problem}


def with_record_types(pages: DataFrame, smallest: int = 100) -> DataFrame:
    """Add ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` to (page_id, url, html).

    Equal payloads are told by their digest. Rows that share the smallest id are all responses; null ids come
    after all others. A payload that a large share of the pages has is split where its response is looked up.
    """
    sized = pages.withColumn("payload_bytes", F.octet_length("html").cast("long"))
    sized = sized.withColumn("payload_digest", F.sha2(F.col("html").cast("binary"), 256))
    firsts = sized.where(F.col("payload_bytes") >= smallest).groupBy("payload_digest").agg(F.min("page_id").alias("first"))
    found = look_up(sized, firsts, ["payload_digest"], "left")
    revisit = (F.col("payload_bytes") >= smallest) & ~F.col("page_id").eqNullSafe(F.col("first"))
    kind = F.when(revisit, "revisit").otherwise("response")
    return found.withColumn("record_type", kind).withColumn("refers_to", F.when(revisit, F.col("first"))).drop("first")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every row of ``with_record_types`` as a record into archives below ``folder``; returns their paths.

    The result is a table: (``path``, ``records``, ``bytes``).
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        out, name, records, size, done = None, "", 0, 0, []
        for batch in pieces(batches, "html"):
            columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "payload_digest", "record_type", "refers_to")]
            for html, page, url, digest, kind, first in zip(texts(batch, "html"), *columns, strict=True):
                if out is None:
                    # Records are compressed one by one, not the stream, as the name would make the file system do.
                    name, records, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                packed = record(page, url, html.encode("utf-8", "surrogatepass"), digest, kind, first)
                out.write(packed)
                records, size = records + 1, size + len(packed)
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", records, size))
        paths, counts, sizes = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["path", "records", "bytes"]
        )

    return written(pages.mapInArrow(write, "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of the archives in column ``path``: ids, sizes, digests, types and ``problem`` (null if sound).

    ``archives`` is read twice. Every archive is read by a task of its own.
    """
    schema = (
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string,"
        " record_id string, problem string"
    )

    def rows_of(path: str) -> Iterator[tuple]:
        system, place = fs.FileSystem.from_uri(path)
        with system.open_input_stream(place, compression=None) as stream:
            for found in read_records(stream):
                fields = found["fields"]
                yield (
                    _page_of(fields.get("warc-record-id", "")),
                    found["payload_bytes"],
                    found["payload_digest"],
                    fields.get("warc-type"),
                    _page_of(fields.get("warc-refers-to", "")),
                    fields.get("warc-target-uri"),
                    fields.get("warc-record-id"),
                    found["problem"] and f"{path}: {found['problem']}",
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(n, pa.int64() if k == "long" else pa.string()) for n, k in (c.split() for c in schema.split(","))])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held = []
                for row in rows_of(path):
                    held.append(row)
                    if len(held) == 10_000:
                        yield _batch(held, kinds)
                        held = []
                yield _batch(held, kinds)

    # A number of partitions, unlike a key alone, is kept: paths are few bytes, which would else be merged into one task.
    return archives.select("path").repartition(max(1, archives.count())).mapInArrow(read, schema)


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.types, strict=True)], schema=kinds)


def round_trip(spark: SparkSession, pages: DataFrame, smallest: int = 100) -> DataFrame:
    """Write all (page_id, url, html) as archives and return what reading these finds.

    Null html is an empty payload, a null url an empty one; null ids stay null; repeated rows are records each; long payloads
    are written and read whole, a chunk at a time when read; an empty table gives no rows; other columns aren't read.
    """
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    archives = write_archives(with_record_types(narrow, smallest), fresh_path(spark, "warc"))
    return read_archives(archives)
