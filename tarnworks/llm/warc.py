r"""WARC archives: a writer with revisit records, and a reader that salvages damaged archives.

The writer makes one record a page, each a gzip member of its own; a page whose payload another
page also has is a ``revisit`` of that one and holds the HTTP header alone. The reader takes the
bytes of an archive, gzip members, plain records or both in turn. A record is good when its version
line, header, length, end mark and digests hold. After a failed check it goes on behind the record
where its bounds are sure, and otherwise searches the next member or version line that starts a good
record. What lies between is quarantined: one ``gap`` row with its place, length and reason.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.core.io import materialize, table

#: Compressed bytes after which an archive ends; one record may be longer.
ARCHIVE_BYTES = 4 << 20
#: What a member may grow to, and how long a header may be.
MEMBER_BYTES, HEADER_BYTES = 1 << 30, 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """SHA-1 in bare upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{payload_digest}>"


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes | None, n_bytes: int, sha: str, keeper: int | None) -> bytes:
    """A page's record; without ``payload`` a revisit of page ``keeper``'s. ``sha`` is SHA-1 in hex."""
    said = base64.b32encode(bytes.fromhex(sha)).decode()
    own = record_id(page_id, said)
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else own[1:-1]
    headers = [("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{said}")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    if payload is None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(keeper, said)), ("Content-Type", "application/http; msgtype=response")]
        return record("revisit", headers, http)
    return record("response", [*headers, ("Content-Type", "application/http; msgtype=response")], http + payload)


# Reading.


class Damage(ValueError):
    """A failed check; ``after`` is where the damaged unit surely ends, if that is known, and
    ``found`` are the good records before the damage inside a member."""

    def __init__(self, reason: str, after: int | None = None, found: list | None = None):
        super().__init__(reason)
        self.reason, self.after, self.found = reason, after, found or []


@dataclass
class Record:
    offset: int
    length: int
    inside: int | None
    headers: dict[str, str] = field(repr=False)
    block: bytes = field(repr=False)

    @property
    def payload(self) -> bytes:
        """What follows the HTTP header of a response, otherwise the whole block."""
        if self.headers.get("content-type", "").startswith("application/http"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block

    def http_length(self) -> int | None:
        found = re.search(rb"\r\nContent-Length:[ \t]*(\d+)[ \t]*\r\n", self.block.partition(b"\r\n\r\n")[0] + b"\r\n", re.I)
        return int(found[1]) if found else None


@dataclass
class Gap:
    offset: int
    length: int
    inside: int | None
    reason: str


VERSION = re.compile(rb"WARC/[01]\.\d+\r\n")
START = re.compile(rb"\x1f\x8b\x08|WARC/[01]\.\d")


def _same(told: str, data: bytes) -> bool:
    """Whether a labelled digest holds; other labels than SHA-1 and MD5, SHA-256 are not checked."""
    label, _, value = told.partition(":")
    make = {"sha1": hashlib.sha1, "md5": hashlib.md5, "sha256": hashlib.sha256}.get(label.strip().lower().replace("-", ""))
    if make is None:
        return True
    raw = make(data)
    return value.strip().lower() in (raw.hexdigest(), base64.b32encode(raw.digest()).decode().lower(), base64.b32encode(raw.digest()).decode().lower().rstrip("="))


def plain_record(data: bytes, at: int) -> tuple[Record, int]:
    """The record that starts at ``at`` in plain bytes, and where it ends; raises ``Damage``."""
    version = VERSION.match(data, at)
    if version is None:
        raise Damage("no version line")
    end = data.find(b"\r\n\r\n", version.end() - 2, at + HEADER_BYTES)
    if end < 0:
        raise Damage("header without end")
    headers: dict[str, str] = {}
    last = None
    for line in data[version.end() : end].split(b"\r\n"):
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and last:
            headers[last] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        if not colon:
            raise Damage("header line without a colon")
        last = name.strip().lower()
        headers[last] = value.strip()
    told = headers.get("content-length", "")
    if not (told.isascii() and told.isdecimal()) or "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damage("header lacks length, type or id")
    stop = end + 4 + int(told)
    if stop + 4 > len(data):
        raise Damage("record is cut off")
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Damage("no end mark")
    found = Record(at, stop + 4 - at, None, headers, bytes(data[end + 4 : stop]))
    if not _same(headers.get("warc-block-digest", ""), found.block):
        raise Damage("block digest differs", stop + 4)
    if headers["warc-type"] in ("response", "resource") and "warc-truncated" not in headers and not _same(headers.get("warc-payload-digest", ""), found.payload):
        raise Damage("payload digest differs", stop + 4)
    return found, stop + 4


def _inner(raw: bytes, at: int, length: int) -> list[Record | Gap]:
    """Records and gaps of a member's bytes, placed at the member; ``inside`` is their own place."""
    out: list[Record | Gap] = []
    for x in salvage(raw, members=False):
        x.inside, x.offset = x.offset, at
        if isinstance(x, Record):
            x.length = length
        out.append(x)
    return out


def member(data: bytes, at: int) -> tuple[list[Record | Gap], int]:
    """Records of the gzip member at ``at`` and where it ends; raises ``Damage`` with the good
    records before the damaged bytes."""
    inflate, parts, size, fed = zlib.decompressobj(31), [], 0, at
    reason = None
    while not inflate.eof:
        piece = data[fed : fed + 65536]
        if not piece:
            reason = "member is cut off"
            break
        try:
            parts.append(inflate.decompress(piece, MEMBER_BYTES - size + 1))
        except zlib.error:
            reason = "member does not inflate"
            break
        size += len(parts[-1])
        fed += len(piece)
        if size > MEMBER_BYTES:
            reason = "member is too long"
            break
    raw = b"".join(parts)
    if reason:
        good = [x for x in _inner(raw, at, 0) if isinstance(x, Record) and "warc-block-digest" in x.headers]
        raise Damage(reason, None, good)
    stop = fed - len(inflate.unused_data)
    found = _inner(raw, at, stop - at)
    if not any(isinstance(x, Record) for x in found):
        raise Damage(found[0].reason if found else "empty member", stop)
    return found, stop


def _unit(data: bytes, at: int, members: bool) -> tuple[list[Record | Gap], int]:
    if members and data[at : at + 3] == b"\x1f\x8b\x08":
        return member(data, at)
    found, stop = plain_record(data, at)
    return [found], stop


def salvage(data: bytes, members: bool = True) -> Iterator[Record | Gap]:
    """All good records of an archive in order, and a ``Gap`` for every run of bytes without one."""
    at, ready = 0, None
    while at < len(data):
        try:
            found, stop = ready or _unit(data, at, members)
            ready = None
            yield from found
        except Damage as why:
            yield from why.found
            stop = why.after
            if stop is None:
                stop = len(data)
                for m in START.finditer(data, at + 1):
                    try:
                        ready = _unit(data, m.start(), members)
                        stop = m.start()
                        break
                    except Damage as other:
                        if other.found:  # a damaged member that still holds good records
                            stop = m.start()
                            break
            yield Gap(at, stop - at, None, why.reason)
        at = stop


READ = (
    "archive string, kind string, offset long, length long, inside long, record_type string, record_id string, refers_to string, "
    "target_uri string, payload_bytes long, payload_digest string, payload binary, reason string"
)
KINDS = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]


def read_archives(archives: DataFrame, archive: str = "archive", content: str = "content", payloads: bool = False) -> DataFrame:
    """A row for every good record and every quarantined gap of the archives.

    ``archives`` has a name and the bytes of each, as ``write_archives`` or Spark's ``binaryFile``
    reader (``path``, ``content``) gives them; null or empty bytes give no rows. ``kind`` is
    ``record`` or ``gap``; ``offset`` and ``length`` count the archive's bytes, ``inside`` those of
    an inflated member. A revisit's payload digest and length are those that it states; all others
    are computed. ``payload`` is filled where ``payloads`` is set. Record ids are as written.
    """

    def row(name: str, x: Record | Gap) -> tuple:
        if isinstance(x, Gap):
            return (name, "gap", x.offset, x.length, x.inside, *(None,) * 7, x.reason)
        h, kind = x.headers, x.headers["warc-type"]
        if kind == "revisit":
            payload, size, sha = None, x.http_length(), h.get("warc-payload-digest", "").partition(":")[2] or None
        else:
            payload = x.payload
            size, sha = len(payload), digest(payload)
        return (name, "record", x.offset, x.length, x.inside, kind, h["warc-record-id"], h.get("warc-refers-to"), h.get("warc-target-uri"), size, sha, payload if payloads else None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in READ.split(", ")]
        give = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), KINDS)], names=names)
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for x in salvage(data.as_py() or b""):
                    rows.append(row(name, x))
                    size += 200 + (len(rows[-1][-2] or b""))
                    if size > 8 << 20:
                        yield give(rows)
                        rows, size = [], 0
                if rows:
                    yield give(rows)

    return archives.select(F.col(archive).cast("string").alias("archive"), F.col(content).alias("content")).mapInArrow(run, READ)


def with_revisited(records: DataFrame) -> DataFrame:
    """Records read with payloads; a revisit has the payload of the record that it refers to (null
    where that is not among them)."""
    of = records.where("kind = 'record' AND record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("payload").alias("revisited")).dropDuplicates(["refers_to"])
    return records.join(of, "refers_to", "left").withColumn("payload", F.coalesce("payload", "revisited")).select(*records.columns)


# Writing.


def marked(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> DataFrame:
    """(page_id, url, html, n_bytes, sha, keeper): ``keeper`` is the page that a revisit refers to,
    null for a response; a revisit's html is null.

    Of pages with equal payloads of at least ``least`` bytes, the one with the largest id is the
    response; rows that repeat that id are responses too, and so are all where no id is known. A
    null id otherwise revisits. Payloads are equal when their SHA-1 is. Digests that more than a
    thousandth of the repeated rows share are at most a thousand: these are broadcast, so that no
    payload's rows meet in one task.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    d = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html")).withColumns({"sha": F.sha1("html"), "n_bytes": F.octet_length("html").cast("long")})
    same = d.where(F.col("n_bytes") >= least).groupBy("sha").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = materialize(same, "warc-equal")
    total = same.agg(F.sum("n")).first()[0] or 0
    hot = same.where(F.col("n") * 1000 > total).select("sha", F.col("largest").alias("hot"))
    rest = same.where(F.col("n") * 1000 <= total).select(F.col("sha").alias("key"), F.col("largest").alias("cold"))
    key = F.when(F.col("hot").isNull(), F.col("sha")).otherwise(F.concat("sha", F.lit("#"), F.pmod(F.xxhash64("page_id"), F.lit(4096)).cast("string")))
    d = d.join(F.broadcast(hot), "sha", "left").withColumn("key", key).join(rest, "key", "left").withColumn("largest", F.coalesce("hot", "cold"))
    keeper = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return d.withColumn("keeper", keeper).select("page_id", "url", F.when(F.col("keeper").isNull(), F.col("html")).alias("html"), "n_bytes", "sha", "keeper")


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, compress: bool = True) -> DataFrame:
    """(archive, content): the records of ``marked`` pages, each a gzip member (or plain), in
    archives that start with a ``warcinfo`` record and end after ``archive_bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        pack = (lambda x: gzip.compress(x, 6, mtime=0)) if compress else bytes
        parts, size = [], 0

        def done() -> pa.RecordBatch:
            name = f"pages-{part:05d}-{n:05d}.warc{'.gz' if compress else ''}"
            info = record("warcinfo", [("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([pack(info) + b"".join(parts)], pa.binary())], names=["archive", "content"])

        for batch in batches:
            ids, urls, htmls, sizes, shas, keepers = batch.columns
            for page_id, url, html, n_bytes, sha, keeper in zip(ids.to_pylist(), urls.to_pylist(), htmls, sizes.to_pylist(), shas.to_pylist(), keepers.to_pylist()):
                payload = html.as_py()
                parts.append(pack(page_record(page_id, url, None if payload is None else payload.encode(), n_bytes, sha, keeper)))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield done()
                    parts, size, n = [], 0, n + 1
        if parts:
            yield done()

    return pages.select("page_id", "url", "html", "n_bytes", "sha", "keeper").mapInArrow(run, "archive string, content binary")


def op11_warc_salvage(spark, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back by the salvage reader.

    Null html: an empty payload. Rows that repeat an id give a record each; a null id stays null.
    An empty table gives no rows.
    """
    archives = materialize(write_archives(marked(table(spark, sf_dir, "pages"))), "warc-archives")
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+):', 1) AS BIGINT)")
    return (
        read_archives(archives)
        .where("kind = 'record' AND record_type IN ('response', 'revisit')")
        .select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
    )


OP11_SQL = """
WITH d AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest
  FROM pages
), r AS (
  SELECT *, largest IS NOT NULL AND page_id IS DISTINCT FROM largest AS again FROM d
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
         (list_reduce(list_transform(range(5), lambda k: instr('0123456789abcdef', substr(h, CAST(5 * (i // 4) + k + 1 AS INTEGER), 1)) - 1),
                      lambda a, b: 16 * a + b) >> (15 - 5 * (i % 4))) & 31), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN largest END AS refers_to
FROM r
"""
