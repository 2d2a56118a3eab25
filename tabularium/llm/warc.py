"""WARC archives, index first: shards of records, an index, and coalesced byte-range reads.

``write_archive`` gives every page a record and computes, before a byte is written, the offset
and length that it will have in its shard; the index (shard, offset, length, URL, digest, type)
is stored beside the shards. Shards are ordinary WARC 1.1 files without compression, written by
Spark's text writer whose line end is the record end, so lost tasks are repeated and only
committed files remain. ``read_records`` joins selected index rows to the files, merges the
sorted byte ranges of each file that lie close together, reads only those and parses them.

Of records with equal payloads of at least ``least`` bytes the one with the smallest page id is
a response, the others are revisits that refer to it and carry no payload; smaller payloads are
always responses. A null html is an empty payload, a null URL the URI ``about:blank``; white
space and control characters in URLs are percent-encoded. A null page id never is the response
of records with an id; revisits among records without ids refer to null. Rows that repeat a page id get a record each; of equal payloads under one
id, one stays a response. An empty table gives an empty archive and index.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.session import new_path

SHARD_BYTES = 16 << 20
SALTS = 16
MERGE_GAP = 64 << 10  # ranges closer than this are one read
MERGE_BYTES = 8 << 20  # a merged read is not extended beyond this
END = "\r\n\r\n"
DATE = "2026-01-01T00:00:00Z"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data):
    """SHA-1 of a binary column in upper-case base 32 without padding."""
    digest = F.sha1(data)
    letters = []
    for k in range(8):  # 20 bits are five hex digits and four letters
        value = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(ALPHABET), F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def _records(pages: DataFrame, least: int, shards: int) -> DataFrame:
    """Pages with payload facts, record type, the page a revisit refers to, and the shard.

    Payloads are dealt once, by a shard made of the digest and a salt of the page id, so that a
    hot payload meets in no single task; a row for each shared digest, without payload, goes to
    all of its salts and tells the first page there.
    """
    payload = F.coalesce("html", F.lit(""))
    url = F.coalesce("url", F.lit("about:blank"))
    for code in (*range(33), 127):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    same = ["payload_digest", "payload_bytes"]
    facts = pages.select(
        "page_id", url.alias("url"), payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(F.encode(payload, "UTF-8")).alias("payload_digest"),
        F.pmod(F.coalesce(F.col("page_id").cast("long"), F.lit(0)), F.lit(SALTS)).alias("salt"),
    )
    keys = [*same, "salt"]
    facts = facts.withColumns({"salt": F.col("salt").cast("long"), "first_id": F.lit(None).cast("long"), "mark": F.lit(0)})
    shared = facts.groupBy(*same).agg(F.min("page_id").cast("long").alias("first_id"), F.count("*").alias("copies")).where("copies > 1")
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    shared = shared.select(*same, "first_id", F.explode(salts).alias("salt"), F.lit(1).alias("mark"))
    every = facts.unionByName(shared, allowMissingColumns=True)
    shard = F.pmod(F.xxhash64(*keys), F.lit(shards))
    every = every.withColumn("shard", shard).repartition("shard")
    group = Window.partitionBy("shard", *keys)
    copy = F.row_number().over(Window.partitionBy("shard", *keys, "page_id").orderBy("url"))
    every = every.withColumns({"first_id": F.max("first_id").over(group), "known": F.max("mark").over(group)})
    every = every.where("mark = 0").withColumn("copy", copy)
    owns = F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("copy") == 1)
    # Records without an id have no order between salts: all of them share salt 0.
    revisit = (F.col("known") == 1) & ~owns & (F.col("payload_bytes") >= least)
    return every.select(
        "page_id", "url", "payload", *same, F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"), "copy", "shard",
    )


def _identity(page_id):
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _headers(records: DataFrame) -> DataFrame:
    """Adds ``head``, all of a record before the payload, and ``length``, all of its bytes."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    carried = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0)
    line = F.lit("\r\n")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"), line, F.lit("WARC-Record-ID: "), _identity(F.col("page_id")), line,
        F.lit("WARC-Target-URI: "), F.col("url"), line, F.lit(f"WARC-Date: {DATE}\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"), line,
        F.when(F.col("record_type") == "revisit", F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _identity(F.col("refers_to")), line)).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), (F.octet_length(http) + carried).cast("string"), F.lit("\r\n\r\n"), http,
    )
    return records.withColumn("head", head).withColumn("length", (F.octet_length("head") + carried + len(END)).cast("long"))


def write_archive(pages: DataFrame, path: str, least: int = 0, shard_bytes: int = SHARD_BYTES) -> None:
    """Write ``path``/index, then ``path``/records (one WARC file per shard folder)."""
    total = pages.agg(F.sum(F.octet_length(F.coalesce("html", F.lit(""))) + 600)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    order = ["page_id", "url", "payload_digest", "copy"]
    ready = _headers(_records(pages, least, shards))
    before = Window.partitionBy("shard").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    index = ready.select("shard", *order, "record_type", "length").withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    index.write.parquet(f"{path}/index")
    value = F.when(F.col("record_type") == "response", F.concat("head", "payload")).otherwise(F.col("head"))
    ready = ready.sortWithinPartitions("shard", *order).select("shard", value.alias("value"))
    ready.write.partitionBy("shard").option("lineSep", END).text(f"{path}/records")


def parse(record: bytes) -> dict[str, str | bytes]:
    """Header fields of one record, with its type line dropped, and the payload under ``""``."""
    head, _, block = record.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError(f"no record starts here: {record[:40]!r}")
    fields: dict = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, fields[""] = block.partition(b"\r\n\r\n")
    fields["http-length"] = http.decode().rpartition("Content-Length: ")[2].split("\r\n")[0]
    return fields


def merged(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Reads (start, stop, ranges inside) that cover sorted (offset, length) ranges."""
    inside: list[tuple[int, int]] = []
    for offset, length in ranges:
        if inside and (offset - stop > MERGE_GAP or offset + length - inside[0][0] > MERGE_BYTES):
            yield inside[0][0], stop, inside
            inside = []
        stop = max(stop, offset + length) if inside else offset + length
        inside.append((offset, length))
    if inside:
        yield inside[0][0], stop, inside


OUT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, offset long, length long"


def read_records(spark: SparkSession, path: str, where=None) -> DataFrame:
    """Facts of the records that ``where`` selects in the index, read from the archives."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt")
    files = files.load(f"{path}/records").select(F.col("path").alias("file"))
    files = files.withColumn("shard", F.regexp_extract("file", r"shard=(\d+)", 1).cast("long"))
    index = spark.read.parquet(f"{path}/index")
    index = index if where is None else index.where(where)
    wanted = index.select("shard", "offset", "length").join(files, "shard")
    wanted = wanted.repartition("file").sortWithinPartitions("file", "offset")

    def number(text: str) -> int | None:
        digits = text.removeprefix("<urn:page:").removesuffix(">")
        return None if digits == "none" else int(digits)

    def facts(offset: int, length: int, fields: dict) -> tuple:
        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        size = int(fields["http-length"])
        if kind == "response":
            found = base64.b32encode(hashlib.sha1(fields[""]).digest()).decode()
            if found != digest or len(fields[""]) != size:
                raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
        refers = number(fields["WARC-Refers-To"]) if kind == "revisit" else None
        return number(fields["WARC-Record-ID"]), size, digest, kind, refers, fields["WARC-Target-URI"], offset, length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in OUT.split(", ")])
        for batch in batches:
            by_file: dict[str, list] = {}
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                by_file.setdefault(file, []).append((offset, length))
            for file, ranges in by_file.items():
                store, name = fs.FileSystem.from_uri(file)
                with store.open_input_file(name) as source:
                    for start, stop, inside in merged(sorted(ranges)):
                        raw = source.read_at(stop - start, start)
                        rows = [facts(o, n, parse(raw[o - start : o - start + n])) for o, n in inside]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return wanted.select("file", "offset", "length").mapInArrow(run, OUT)


def archive(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the pages to a new archive in the shared folder and read every record back."""
    path = new_path(pages.sparkSession, "warc")
    write_archive(pages, path, least)
    return read_records(pages.sparkSession, path)
