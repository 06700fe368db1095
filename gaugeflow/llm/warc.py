"""WARC archives: writing pages with revisits, and a reader that salvages damaged files.

Writing is Spark's text writer, so commits, retries and remote stores work as for any
table. Its rows are bundles of records of about BUNDLE_BYTES, and a file has at most
BUNDLES_PER_FILE of them, so files are bounded by bytes, not by records. With gzip every
record is a member of its own. Reading checks every record: header, block length, record
end and the digests it declares. After a failed check it looks for the next gzip member or
version line whose record passes, recovers what follows, and logs the bytes between as
quarantined; of a damaged member, what was unpacked before the damage is looked at too.
"""

import gzip
import hashlib
import re
import zlib
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm.scale import counted_broadcast, mapped
from gaugeflow.session import written

# The record layout of WARC 1.0 and the profile of equal payloads.
VERSION = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
LEAST_SHARED_BYTES = 100
BUNDLE_BYTES, BUNDLES_PER_FILE = 16 << 20, 12
DATE = "1970-01-01T00:00:00Z"
ID = "urn:x-page:"

_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_GZIP = b"\x1f\x8b\x08"
# A member ends with the length of its contents, whose last byte is nearly always zero.
_EMPTY_MEMBER, _MEMBER_END = gzip.compress(b"", mtime=0), b"\0"
_INFLATE_BYTES = 1 << 16
_DIGESTS = {"sha256": hashlib.sha256, "sha1": hashlib.sha1, "md5": hashlib.md5}


def archive_records(
    pages: DataFrame, id_col="page_id", url_col="url", payload_col="html", date=DATE
) -> DataFrame:
    """One `record` text per row: a response, or a revisit of the response with the same payload.

    Of equal payloads of at least 100 bytes the rows with the smallest id are responses.
    Only digests and ids are grouped; a digest of any number of rows is one partial sum
    per task. Null payloads are empty; a null id counts as larger than any other.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        # A line end in a url would end the header.
        F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\x00-\x20\x7F]", "").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    sized = rows.select("id", "digest", F.octet_length("payload").alias("size"))
    shared = sized.where(F.col("size") >= LEAST_SHARED_BYTES).groupBy("digest")
    shared = shared.agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")
    shared = counted_broadcast(written(shared.select("digest", "first"), "payloads"), F.lit(64))
    joined = rows.join(shared, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))

    def name(column):
        return F.concat(F.lit(f"<{ID}"), F.coalesce(column.cast("string"), F.lit("")), F.lit(">"))

    def header(key, value):
        return F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(RECORD_END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload").cast("string")))
    refers = F.concat(
        header("WARC-Profile", F.lit(PROFILE)), header("WARC-Refers-To", name(F.col("first")))
    )
    head = F.concat(
        F.lit(VERSION),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", name(F.col("id"))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", F.col("url")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        header("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(F.col("block").cast("binary"), 256))),
        F.when(revisit, refers).otherwise(""),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    return joined.withColumn("block", block).select(F.concat(head, "block").alias("record"))


def bundles(records: DataFrame, compression=None) -> DataFrame:
    """Rows of whole records of about BUNDLE_BYTES, without the end that the writer puts after them."""
    end = RECORD_END.encode()

    def one_member(record):
        member = gzip.compress(record + end, compresslevel=6, mtime=0)
        return member if member.endswith(_MEMBER_END) else member + _EMPTY_MEMBER

    def joined(held):
        if compression:
            return b"".join(held)[: -len(_MEMBER_END)]
        return end.join(held)

    def bundle(batches):
        held, size = [], 0
        for batch in batches:
            for record in batch.column(0):
                data = record.as_buffer().to_pybytes()
                held.append(one_member(data) if compression else data)
                size += len(held[-1])
                if size > BUNDLE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([joined(held)], pa.binary())], names=["data"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([joined(held)], pa.binary())], names=["data"])

    return mapped(records.select(F.col("record").cast("binary")), bundle, "data binary")


def write_archives(pages: DataFrame, path, compression=None, **columns):
    """Archives of about BUNDLE_BYTES * BUNDLES_PER_FILE bytes in the folder `path`, plain or gzip.

    A longer record is a bundle of its own.
    """
    if compression not in (None, "gzip"):
        raise ValueError(f"unknown compression {compression!r}")
    rows = bundles(archive_records(pages, **columns), compression)
    # The text writer puts the bytes down as they are, and the separator behind each row.
    separator = _MEMBER_END.decode() if compression else RECORD_END
    writer = rows.select(F.col("data").cast("string").alias("value")).write.option("lineSep", separator)
    writer.option("maxRecordsPerFile", BUNDLES_PER_FILE).text(path)


def digest_matches(declared, data):
    """Whether bytes have the declared digest (hex or base32); unknown algorithms pass."""
    kind, _, value = declared.partition(":")
    make = _DIGESTS.get(kind.strip().lower().replace("-", ""))
    if make is None:
        return True
    found, value = make(data), value.strip()
    return value.lower() == found.hexdigest() or value.upper().rstrip("=") == b32encode(
        found.digest()
    ).decode().rstrip("=")


def parse_record(data, at):
    """The record that starts at `at` as (end, headers, block), or the reason why there is none."""
    version = _VERSION_LINE.match(data, at)
    if not version:
        return "no version line"
    headers, at = {}, version.end()
    while True:
        line_end = data.find(b"\r\n", at)
        if line_end < 0:
            return "cut header"
        if line_end == at:
            break
        # The first line that cannot belong to a header ends the search.
        key, colon, value = data[at:line_end].decode("utf-8", "replace").partition(":")
        if not colon:
            return "bad header"
        headers[key.strip().lower()], at = value.strip(), line_end + 2
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        return "bad length"
    first = line_end + 2
    last = first + int(size)
    if last > len(data):
        return "cut block"
    end = last + 4
    if data[last:end] != b"\r\n\r\n":
        return "no record end"
    block = data[first:last]
    if not digest_matches(headers.get("warc-block-digest", ""), block):
        return "block digest"
    payload = http_parts(block)[1]
    if headers.get("warc-type") == "response" and not digest_matches(
        headers.get("warc-payload-digest", ""), payload
    ):
        return "payload digest"
    return end, headers, block


def http_parts(block):
    """The length that HTTP headers declare (None without) and the payload behind them."""
    if not block.startswith(b"HTTP/"):
        return None, block
    head, _, payload = block.partition(b"\r\n\r\n")
    found = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
    return (int(found[1]) if found else None), payload


def inflate(data, at):
    """The gzip member at `at` as (end, bytes, None), or (None, bytes before the fault, reason)."""
    stream, view, parts = zlib.decompressobj(wbits=31), memoryview(data), []
    step = _INFLATE_BYTES
    while not stream.eof:
        if at >= len(data):
            return None, b"".join(parts), "cut member"
        piece, before = view[at : at + step], stream.copy()
        try:
            parts.append(stream.decompress(piece))
        except zlib.error:
            if step == 1:
                return None, b"".join(parts), "bad member"
            # What comes out before the fault is found in smaller steps.
            stream, step = before, step // 16
            continue
        at += len(piece)
    return at - len(stream.unused_data), b"".join(parts), None


class Marks:
    """Where the next gzip member or version line may begin; each mark is searched for once."""

    def __init__(self, data):
        self.data, self.next = data, {_GZIP: -1, b"WARC/1.": -1}

    def after(self, at, member=False):
        """The nearest mark from `at` on; with `member`, that of a member if there is one."""
        for mark, found in self.next.items():
            if found is not None and found < at:
                found = self.data.find(mark, at)
                self.next[mark] = found if found >= 0 else None
        if member and self.next[_GZIP] is not None:
            return self.next[_GZIP]
        return min((p for p in self.next.values() if p is not None), default=len(self.data))


def salvage(data):
    """Records (offset, end, headers, block, None) and gaps (offset, end, None, None, reason).

    Offsets are those in the file; records of one gzip member share the member's.
    Every byte belongs to a record, an intact member or a gap; records that were unpacked
    from a damaged member have its offset and no length, and lie in a gap.
    """
    at, lost, reason, marks = 0, None, None, Marks(data)
    while at < len(data):
        found, rescued, problem = [], [], None
        if data.startswith(_GZIP, at):
            end, inner, problem = inflate(data, at)
            inside = [r for r in salvage(inner)]
            if problem is None:
                found = [(at, end, *r[2:]) for r in inside]
                problem = None if found or not inner else "no record"
            else:
                rescued = [(at, at, *r[2:]) for r in inside if r[2] is not None]
        else:
            record = parse_record(data, at)
            problem = record if isinstance(record, str) else None
            if problem is None:
                end = record[0]
                found = [(at, *record, None)]
        if problem is None:
            if lost is not None:
                yield lost, at, None, None, reason
                lost = None
            yield from found
            at = end
            continue
        yield from rescued
        if lost is None:
            lost, reason = at, problem
        # What stands uncompressed in a member that has been looked at is not looked at again.
        at = marks.after(at + 1, member=bool(rescued))
    if lost is not None:
        yield lost, len(data), None, None, reason


def read_archives(spark: SparkSession, path, keep_payload=True) -> DataFrame:
    """Every record and every quarantined gap of the archives under `path`.

    Columns: file, offset, length, reason (null for records), record_id, record_type, url,
    refers_to, payload_digest (computed for a full payload, else as declared),
    payload_bytes, payload (null unless kept, or where a revisit leaves it out).
    A file is read in one task, so archives should be of the usual size, up to a
    gigabyte or so. An empty file has no rows.
    """
    kinds = (
        "file string, offset bigint, length bigint, reason string, record_id string, "
        "record_type string, url string, refers_to string, payload_digest string, "
        "payload_bytes bigint, payload binary"
    )
    names = [part.split()[0] for part in kinds.split(", ")]

    def rows_of(file, data):
        for offset, end, headers, block, reason in salvage(data):
            if headers is None:
                yield file, offset, end - offset, reason, *[None] * 7
                continue
            declared, payload = http_parts(block)
            kind = headers.get("warc-type")
            digest = headers.get("warc-payload-digest", "").partition(":")[2] or None
            size = declared if kind == "revisit" and declared is not None else len(payload)
            if kind != "revisit":
                digest = hashlib.sha256(payload).hexdigest()
            yield (
                file, offset, end - offset, None, headers.get("warc-record-id"), kind,
                headers.get("warc-target-uri"), headers.get("warc-refers-to"), digest, size,
                payload if keep_payload and kind != "revisit" else None,
            )

    def read(batches):
        numbers = ("offset", "length", "payload_bytes")
        fields = [(n, pa.int64() if n in numbers else pa.string()) for n in names[:-1]]
        schema = pa.schema([*fields, ("payload", pa.binary())])
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                held, size = [], 0
                for row in rows_of(file.as_py(), content.as_py()):
                    held.append(row)
                    size += len(row[-1] or b"")
                    if size > 8 << 20 or len(held) >= 10_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in held], schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in held], schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return mapped(files.select("path", "content"), read, kinds)


def page_id_of(record_id):
    """The number in a record name; null for other names."""
    return F.regexp_extract(record_id, f"^<{ID}(-?[0-9]+)>$", 1).try_cast("long")
