"""Operator 12: legacy web archives (ARC, versions 1 and 2) converted to WARC.

``parse_arc`` reads a version block, takes the names of the fields from it and then follows header
lines and declared lengths. ``convert`` synthesises the WARC identifier, timestamp, type and
digests of each record; ``with_revisits`` makes records of equal payloads revisit one of them.
``write_warc`` writes archives by Spark's text writer, whose line separator is the end of a WARC
record; ``read_warc`` reads them as streams of lines, a record at a time whatever the file's size.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadsift.llm.common import cut, map_batches, shared_checkpoints

# The fields of header lines in each version of the legacy format, the last being the length.
FIELDS = {
    b"1": ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    b"2": ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The HTTP header that carries a page's identifier through the archives.
PAGE_HEADER = "X-Page-Id"
DATE = "20000101000000"


@dataclass
class ArcRecord:
    offset: int
    fields: dict[str, str]
    block: bytes
    problem: str | None = None


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of one archive, its version block first; gzip members are unpacked.

    A header line that doesn't have the version's fields or a length, and a block that ends before
    its declared length, give a record with a problem; after such a line the next one is tried.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at, names = 0, FIELDS[b"1"]
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1  # between records
            continue
        stop = data.find(b"\n", at)
        line = data[at : stop if stop >= 0 else len(data)].rstrip(b"\r")
        is_version = line.startswith(b"filedesc://")
        if is_version:
            names = FIELDS.get(data[stop + 1 : data.find(b" ", stop + 1)], FIELDS[b"1"])
        parts = line.decode("latin-1").rsplit(" ", len(names) - 1)  # an address may hold spaces
        if stop < 0 or len(parts) != len(names) or not parts[-1].isdigit():
            yield ArcRecord(at, {"URL": parts[0]}, b"", "header line")
            at += len(line) + 1
            continue
        end = stop + 1 + int(parts[-1])
        yield ArcRecord(at, dict(zip(names, parts, strict=True)), data[stop + 1 : end], "truncated" if end > len(data) else None)
        at = end


def arc_bytes(name: str, version: int, records: Iterator[tuple[str, str, str, bytes]]) -> bytes:
    """An archive of (address, date, content type, block) rows."""
    names = FIELDS[str(version).encode()]
    out: list[bytes] = []
    at = 0

    def put(url: str, date: str, kind: str, block: bytes) -> None:
        nonlocal at
        told = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": kind, "Result-code": "200", "Checksum": "-", "Location": "-", "Offset": str(at), "Filename": name, "Archive-length": str(len(block))}
        out.append(" ".join(told[n] for n in names).encode() + b"\n" + block + b"\n")
        at += len(out[-1])

    put(f"filedesc://{name}", DATE, "text/plain", f"{version} 0 pages\n{' '.join(names)}\n".encode())
    for record in records:
        put(*record)
    return b"".join(out)


def _address(url: str | None) -> str:
    """An address without white space and control characters, which header lines can't hold, and that isn't a version block's."""
    return re.sub("^filedesc://", "filedesc%3A//", re.sub(r"[\x00-\x20\x7f-\U0010ffff]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "surrogatepass")), url or "")) or "unknown:"


def page_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(name, content) of legacy archives that hold one HTTP response for each page, a batch of rows each, versions 1 and 2 in turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def records(batch: pa.RecordBatch) -> Iterator[tuple[str, str, str, bytes]]:
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                html = html or b""
                own = "" if page is None else f"{PAGE_HEADER}: {page}\r\n"
                yield _address(url), DATE, "text/html", f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{own}Content-Length: {len(html)}\r\n\r\n".encode() + html

        for k, batch in enumerate(batches):
            name = f"pages-{part}-{k}.arc"
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([arc_bytes(name, 1 + (part + k) % 2, records(batch))], pa.binary())], ["name", "content"])

    return map_batches(pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").cast("binary").alias("html")), run, "name string, content binary")


def iso_date(date: str) -> str | None:
    """14 digits, or 12 without seconds, as WARC has dates; else null."""
    if not re.fullmatch(r"\d{12}(\d\d)?", date):
        return None
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


#: Columns of converted records, with their types.
RECORD = {"archive": pa.string(), "offset": pa.int64(), "problem": pa.string(), "type": pa.string(), "record_id": pa.string(), "date": pa.string(), "uri": pa.string(), "ip": pa.string(), "content_type": pa.string(),
          "head": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload_key": pa.binary(), "block_digest": pa.string(), "block": pa.binary()}
_SPARK = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}


def warc_fields(archive: str, record: ArcRecord) -> dict:
    """What a WARC record says in place of a legacy one.

    The version block is warcinfo, an HTTP message is a response whatever its address, all else (name
    lookups, files, HTTP without a head) a resource. The identifier derives from the address, date
    and block, so that a repeated conversion gives the same.
    """
    url, block = record.fields["URL"], record.block
    out = dict.fromkeys(RECORD) | {"archive": archive, "offset": record.offset, "problem": record.problem, "uri": url}
    if record.problem is None and (date := iso_date(record.fields["Archive-date"])) is None:
        out["problem"] = "date"
    if out["problem"]:
        return out
    kind, content_type, head, payload = "resource", record.fields["Content-type"], "", block
    if url.startswith("filedesc://"):
        kind, content_type = "warcinfo", "application/warc-fields"
        block = payload = f"software: roadsift\r\nformat: WARC File Format 1.1\r\ndescription: converted from {url[11:]}\r\n".encode()
    elif block.startswith(b"HTTP/") and (cut_at := block.find(END)) >= 0:
        kind, content_type = "response", "application/http; msgtype=response"
        head, payload = block[: cut_at + 4].decode("latin-1"), block[cut_at + 4 :]
    own = uuid.UUID(bytes=hashlib.sha256("\n".join((url, record.fields["Archive-date"], hashlib.sha256(block).hexdigest())).encode()).digest()[:16], version=5)
    digest = sha1_base32(payload)
    return out | {
        "type": kind, "record_id": f"<urn:uuid:{own}>", "date": date, "ip": record.fields["IP-address"], "content_type": content_type, "head": head, "payload_bytes": len(payload), "payload_digest": digest,
        "payload_key": hashlib.sha256(payload).digest() if kind == "response" else None, "block_digest": sha1_base32(block), "block": block,
    }


def convert(archives: DataFrame, blocks: bool = True) -> DataFrame:
    """The WARC fields of every record of legacy archives, given as (name, content), such as the binaryFile source has them. blocks=False leaves the blocks out."""
    names = [c for c in RECORD if blocks or c != "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = [warc_fields(name, r) for r in parse_arc(content or b"")]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], RECORD[c]) for c in names], names)

    return map_batches(archives.select("name", "content"), run, ", ".join(f"{c} {_SPARK[RECORD[c]]}" for c in names))


def page_of(head: Column) -> Column:
    """The page's identifier in an HTTP head; null where there is none."""
    return F.regexp_extract(head, rf"\r\n{PAGE_HEADER}: (-?[0-9]+)\r\n", 1).try_cast("long")


def with_revisits(archives: DataFrame, rank: Column, least_bytes: int = 0) -> DataFrame:
    """Converted records; of responses with equal payloads of at least least_bytes, the one with the greatest rank (a column of records, null least; on ties the greatest identifier) stays, the others
    become revisits: with its identifier as refers_to_id, and the HTTP head alone as block.

    The archives are read twice, as blocks don't fit beside each other: once for digests, once for
    records. A frequent payload's records can be split, as the chosen ones are dealt anew.
    """
    responses = convert(archives, blocks=False).filter((F.col("type") == "response") & (F.col("payload_bytes") >= least_bytes))
    chosen = responses.groupBy("payload_key").agg(F.max(F.struct(rank.alias("rank"), F.col("record_id").alias("id"))).alias("best"), F.count("*").alias("n")).filter("n > 1")
    chosen = chosen.select(F.base64("payload_key").alias("key"), F.col("best.id").alias("response_id"))
    is_revisit = F.col("response_id").isNotNull() & (F.col("record_id") != F.col("response_id"))
    out = convert(archives).withColumn("key", F.base64("payload_key")).join(chosen, "key", "left")
    return out.select(
        *(c for c in RECORD if c not in ("type", "block", "block_digest", "payload_key")), F.when(is_revisit, "revisit").otherwise(F.col("type")).alias("type"), F.when(is_revisit, F.col("response_id")).alias("refers_to_id"),
        F.when(is_revisit, F.lit(None)).otherwise(F.col("block_digest")).alias("block_digest"), F.when(is_revisit, F.col("head").cast("binary")).otherwise(F.col("block")).alias("block"),
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Write converted records without a problem as gzipped WARC files, one for each task; Spark's writer ends each record."""
    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    sha1 = lambda c: F.concat(F.lit("sha1:"), c)
    revisit = F.col("type") == "revisit"
    text = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("type")), line("WARC-Record-ID", F.col("record_id")), line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.when(F.col("type") != "warcinfo", F.col("uri"))),
        line("WARC-IP-Address", F.when(F.col("ip") != "0.0.0.0", F.col("ip"))), line("WARC-Profile", F.when(revisit, REVISIT_PROFILE)), line("WARC-Refers-To", F.col("refers_to_id")),
        line("WARC-Payload-Digest", F.when(F.col("head") != "", sha1("payload_digest"))), line("WARC-Block-Digest", sha1("block_digest")), line("Content-Type", F.col("content_type")),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"), F.col("block").cast("string"),
    )
    records.filter("problem IS NULL").select(text.alias("value")).write.option("lineSep", END.decode()).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


#: Columns of records read back, with their types.
READ = {"type": pa.string(), "record_id": pa.string(), "date": pa.string(), "uri": pa.string(), "refers_to_id": pa.string(), "content_type": pa.string(), "head": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "problem": pa.string(), "payload": pa.binary()}


def read_record(head: bytes, block: bytes) -> dict:
    told = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}
    out = dict.fromkeys(READ) | {"type": told["warc-type"], "record_id": told["warc-record-id"], "date": told["warc-date"], "uri": told.get("warc-target-uri"), "refers_to_id": told.get("warc-refers-to"), "content_type": told.get("content-type")}
    payload, digest = block, told.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if (out["content_type"] or "").startswith("application/http") and (at := block.find(END)) >= 0:
        out["head"], payload = block[: at + 4].decode("latin-1"), block[at + 4 :]
    if out["type"] == "revisit":  # the payload is the other record's; digest and length stand in the heads
        length = re.search(r"(?i)\r\ncontent-length: *(\d+)\r\n", out["head"] or "")
        return out | {"payload_bytes": int(length[1]) if length else None, "payload_digest": digest, "problem": None if digest else "no digest"}
    own = sha1_base32(payload)
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": own, "problem": None if digest in (None, own) else "digest"}


def read_stream(lines: Iterator[bytes]) -> Iterator[dict]:
    """Records from pieces of bytes, one after the other; a record is held at a time."""
    held, need = bytearray(), 1
    for piece in lines:
        held += piece
        at = 0
        while len(held) - at >= need:
            stop = held.find(END, at)
            if stop < 0:
                need = len(held) - at + 1
                break
            head = bytes(held[at:stop])
            length = re.search(rb"(?i)\r\ncontent-length: *(\d+)(?:\r\n|$)", head)
            if not head.startswith(b"WARC/") or not length:
                raise ValueError(f"no WARC head: {head[:80]!r}")
            first = stop + 4
            end = first + int(length[1])
            if len(held) < end + 4:
                need = end + 4 - at
                break
            if held[end : end + 4] != END:
                raise ValueError(f"a record of {int(length[1])} bytes doesn't end where it says: {head[:200]!r}")
            yield read_record(head, bytes(held[first:end]))
            at, need = end + 4, 1
        del held[:at]
    if held:
        raise ValueError(f"truncated record: {bytes(held[:80])!r}")


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of gzipped WARC files below a path; a digest that doesn't fit its payload is a problem, a broken frame an error. payloads=False leaves the payloads out."""
    names = [c for c in READ if payloads or c != "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        size = 0
        for row in read_stream(b"\n".join(b.column(0).to_pylist()) + b"\n" for b in batches if b.num_rows):
            out.append({c: row[c] for c in names})
            size += len(row["payload"] or b"") if payloads else 200
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist(out, pa.schema([(c, READ[c]) for c in names]))
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, pa.schema([(c, READ[c]) for c in names]))

    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"))
    return map_batches(lines, run, ", ".join(f"{c} {_SPARK[READ[c]]}" for c in names))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Pages through legacy archives and WARC files, read back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Of pages with equal html (null is empty) the one with the largest page_id is a response and the
    others revisit it. Null ids count as least. Rows with one id and one payload are the same record
    where their addresses agree too, and all are responses; with different addresses one of them is
    revisited by the others. Other columns are left out whatever their names. An empty table gives
    an empty result. The files are deleted once read.
    """
    spark = pages.sparkSession
    at = f"{shared_checkpoints(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(with_revisits(page_archives(pages), page_of(F.col("head"))), at)
    told = read_warc(spark, at, payloads=False).filter(F.col("type").isin("response", "revisit"))
    told = cut(told.select(page_of(F.col("head")).alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "record_id", "refers_to_id", F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem"))).alias("checked")))
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    responses = told.filter("record_type = 'response'").groupBy("record_id").agg(F.max("page_id").alias("refers_to")).select(F.reverse("record_id").alias("key"), "refers_to")
    return told.withColumn("key", F.reverse("refers_to_id")).join(responses, "key", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
