"""Web archives: writing WARC records and reading them back from byte blocks of any file.

Writing: records are strings made by expressions and written as text, one record a row. Of
records with equal payloads one is a response and the others refer to it as revisits.

Reading by boundary-chain verification: tasks read blocks of the archives, cut at the magic
that opens a record. Every magic is a candidate, and its header says where its successor
would begin. Magic inside payloads gives candidates too. Real records are those that the
chain of successors reaches from the start of a file; pointer jumping finds them in a number
of rounds that grows with the logarithm of the records in a file. A record whose payload
holds magic is put together again from its parts.

Defined results: a null or empty html is a payload of 0 bytes; a null url leaves the target
header out; line breaks in urls are percent-encoded; a null page_id is written without an id
and read back as null, and no record refers to it; of equal ids with equal payloads all are
responses where that id is the largest; repeated rows give repeated records; an empty table
gives no archive and no rows; other columns are ignored. A file whose chain breaks off gives
the records before the break.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_PARTS = ("file string, block long, place long, length long, total long, page_id long, record_type string, "
          "payload_bytes long, payload_digest string, refers_to long, url string")


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, as expressions: five hexadecimal digits make four of base 32."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def with_record_types(pages: DataFrame, keep, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, record_type, refers_to.

    Pages meet by digest only, without their payloads, and the largest id of a digest is a sum
    that is formed before the shuffle. The revisits found join back by id: their table has a
    known size, so the planner broadcasts it where it is small and shuffles otherwise.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"),
    )
    known = keep(rows.filter(F.octet_length("payload") >= least_bytes).select(
        "page_id", F.sha2("payload", 256).alias("digest")), "digests")
    largest = known.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    revisits = keep(
        known.join(largest, "digest").filter("refers_to IS NOT NULL AND NOT page_id <=> refers_to")
        .select("page_id", F.col("digest").alias("of"), "refers_to").distinct(), "revisits")
    rows = rows.withColumn("of", F.sha2("payload", 256))
    joined = rows.join(revisits, rows["page_id"].eqNullSafe(revisits["page_id"]) & (rows["of"] == revisits["of"]), "left")
    return joined.select(
        rows["page_id"], "url", "payload",
        F.when(revisits["refers_to"].isNull(), "response").otherwise("revisit").alias("record_type"), "refers_to")


def record_text(rows: DataFrame) -> DataFrame:
    """One column `value`: the whole record without its last line feed, which the writer adds."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(F.col("record_type") == "response", F.col("payload").cast("string")).otherwise("")
    block = F.concat(http, body)

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    url = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    return rows.select(F.concat(
        F.lit(MAGIC),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        header("WARC-Target-URI", url),
        header("WARC-Date", F.lit("2024-01-01T00:00:00Z")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block, F.lit("\r\n\r"),
    ).alias("value"))


def write_archives(pages: DataFrame, folder: str, keep, least_bytes: int = 0) -> None:
    """One archive per task, without a shuffle of payloads unless revisits are many."""
    record_text(with_record_types(pages, keep, least_bytes)).write.option("lineSep", "\n").text(folder)


def _number(text: bytes | None) -> int | None:
    return int(text) if text is not None and text.isdigit() and len(text) < 19 else None


def parse(part: bytes) -> dict | None:
    """Headers and payload of what follows a magic; None where that isn't a record's header.

    `total` is the record's length with its magic. The payload is complete only if `part`
    reaches that far.
    """
    end = part.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in part[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    length, kind = _number(fields.get(b"content-length")), fields.get(b"warc-type")
    if length is None or kind is None:
        return None
    block = part[end + 4 : end + 4 + length]
    split = block.find(b"\r\n\r\n")
    http = block[:split] if split >= 0 else b""
    said = next((_number(x.split(b":")[1].strip()) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    payload = block[split + 4 :] if split >= 0 else block
    ident = lambda v: int(v[10:-1]) if v and v.startswith(b"<urn:page:") and v[10:-1].lstrip(b"-").isdigit() else None
    digest = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("ascii", "replace")
    revisit = kind == b"revisit"
    return {
        "total": len(MAGIC) + end + 4 + length + len(RECORD_END), "page_id": ident(fields.get(b"warc-record-id")),
        "record_type": kind.decode("utf-8", "replace"), "payload": None if revisit else payload,
        "payload_bytes": said if revisit else len(payload),
        "payload_digest": digest if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode(),
        "refers_to": ident(fields.get(b"warc-refers-to")),
        "url": fields[b"warc-target-uri"].decode("utf-8", "replace") if b"warc-target-uri" in fields else None,
    }


def _parts(spark: SparkSession, folder: str, payload: bool) -> DataFrame:
    """What stands between magics, block by block: its place within the block, its length, its
    parsed header, and its bytes if asked for. Rows of a block come in order, so places add up
    in the scan."""
    lines = spark.read.option("lineSep", MAGIC).text(folder).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"))
    names = [x.split()[0] for x in _PARTS.split(", ")]
    schema = _PARTS + (", part binary, payload binary" if payload else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place = None, 0
        for batch in batches:
            out = []
            for file, block, value in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (file, block) != at:
                    at, place = (file, block), 0
                row = parse(value) or {}
                row |= {"file": file, "block": block, "place": place, "length": len(value), "part": value}
                out.append(row)
                place += len(value) + len(MAGIC)
            columns = names + (["part", "payload"] if payload else [])
            fields = pa.schema([(n, pa.binary() if n in ("part", "payload") else pa.string() if n in ("file", "record_type", "payload_digest", "url") else pa.int64()) for n in columns])
            yield pa.RecordBatch.from_pylist(out, schema=fields)

    return lines.mapInArrow(run, schema)


def reachable(links: DataFrame, keep) -> DataFrame:
    """Of links (file, start, next), the (file, start) that the chain from start 0 reaches.

    After round k the table holds the first 2**k records of each chain, and `jump` leads 2**k
    records ahead; both are written, so lineage does not grow with the rounds.
    """
    jump = keep(links.select("file", "start", "next"), "jump")
    found = keep(jump.filter("start = 0").select("file", "start"), "found")
    while True:
        ahead = found.join(jump, ["file", "start"]).select("file", F.col("next").alias("start"))
        there = links.select("file", "start")
        ahead = keep(ahead.join(there, ["file", "start"], "left_semi"), "ahead")
        if ahead.isEmpty():
            return found
        found = found.unionByName(ahead)
        second = jump.select("file", F.col("start").alias("next"), F.col("next").alias("then"))
        jump = keep(jump.join(second, ["file", "next"]).select("file", "start", F.col("then").alias("next")), "jump")


def read_archives(spark: SparkSession, folder: str, keep, payload: bool = True) -> DataFrame:
    """All records of the archives of a folder: file, start, page_id, url, record_type,
    payload_bytes, payload_digest, refers_to, and the payload (null for revisits) if asked for."""
    scan = keep(_parts(spark, folder, False), "parts")
    sizes = scan.groupBy("file", "block").agg(F.sum(F.col("length") + len(MAGIC)).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = keep(sizes.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")), "bases")
    start = F.col("base") + F.col("place") - len(MAGIC)  # of the magic before the part
    placed = keep(scan.join(bases, ["file", "block"]).withColumn("start", start).select(
        "file", "block", "place", "start", "length", "total"), "placed")
    links = placed.filter("start >= 0 AND total IS NOT NULL").select("file", "start", (F.col("start") + F.col("total")).alias("next"))
    real = keep(reachable(links, keep), "real")

    # every part belongs to the last real record before it; most records are one part
    marked = placed.join(real.withColumn("real", F.lit(True)), ["file", "start"], "left")
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    owned = marked.withColumn("owner", F.last(F.when(F.col("real"), F.col("start")), ignorenulls=True).over(upto))
    odd = keep(owned.filter("NOT (real AND total = length + {0}) OR real IS NULL".format(len(MAGIC)))
               .select("file", "block", "place", "start", "owner"), "odd")

    names = ["file", "page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    names += ["payload"] if payload else []
    parts = _parts(spark, folder, True) if payload else scan
    here = ["file", "block", "place"]
    whole = parts.join(odd.select(*here), here, "left_anti").select(*names)
    pieces = _parts(spark, folder, True).join(odd.filter("owner IS NOT NULL"), here)
    joined = pieces.groupBy("file", "owner").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", F.hex("part").alias("part")))),
                                 lambda x: x["part"]), MAGIC.encode().hex().upper()).alias("part"))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"file": f, **(parse(bytes.fromhex(p)) or {})} for f, p in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True)]
            fields = pa.schema([(n, pa.binary() if n == "payload" else pa.int64() if n in ("page_id", "payload_bytes", "refers_to") else pa.string()) for n in names])
            yield pa.RecordBatch.from_pylist(rows, schema=fields)

    several = joined.select("file", "part").mapInArrow(again, whole.schema)
    return whole.unionByName(several)
