"""WARC archives, written the same from the same rows.

Records are range-sorted by page id; each task writes its range into gzip members, a record
each, and starts a new file when the compressed size of one is reached. Files carry
temporary names until they are whole, and a manifest, written last, names the files that
count. Every header and digest is made anew from the row.
"""

import base64
import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from widevec.llm.common import table, written
from widevec.llm.files import committed, located, make_folder, opened, read_all
from widevec.sources.scratch import scratch_path

# Compressed bytes at which a file is closed; a record is never split.
ROLL_BYTES = 64 * 1024 * 1024
LEVEL = 3
# The capture date of every record: a parameter, for the same bytes every time.
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 1 << 20


def base32_sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, digest):
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def one_line(value):
    return " ".join((value or "").split())


def record(page_id, url, payload, refers_to=None, date=DATE):
    """One record's bytes; a revisit has the HTTP head of its payload and no body."""
    digest = base32_sha1(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": one_line(url),
        "WARC-Page-ID": "" if page_id is None else page_id,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if revisit:
        fields["WARC-Profile"] = REVISIT_PROFILE
        fields["WARC-Refers-To"] = record_id(refers_to, digest)
        fields["WARC-Refers-To-Page-ID"] = refers_to
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value != "")
    return VERSION + lines.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


class _RollingFiles:
    """Gzip members into files that are closed at a size and renamed when whole."""

    def __init__(self, stem, roll_bytes):
        self.stem, self.roll_bytes, self.done, self.stream = stem, roll_bytes, [], None

    def add(self, content):
        if self.stream is None:
            self.name = f"{self.stem}-{len(self.done):05d}.warc.gz"
            self.system, self.place = located(self.name)
            self.temporary = f"{self.place}.{uuid.uuid4().hex}.tmp"
            self.stream = self.system.open_output_stream(self.temporary)
            self.records = self.size = 0
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = packer.compress(content) + packer.flush()
        self.stream.write(member)
        self.records += 1
        self.size += len(member)
        if self.size >= self.roll_bytes:
            self.close()

    def close(self):
        if self.stream is not None:
            self.stream.close()
            self.system.move(self.temporary, self.place)
            self.done.append((self.name.rpartition("/")[2], self.records, self.size))
            self.stream = None


def write_warc(pages, path, min_bytes=0, roll_bytes=ROLL_BYTES, date=DATE):
    """Write ``pages`` (page_id, url, html) as WARC files under ``path``, with a manifest.

    Of equal payloads of at least ``min_bytes`` bytes the row with the least page_id is the
    response and every other a revisit of it; rows that repeat id and payload revisit their
    own id. Null html is an empty payload, a null url is left out. Rows without a page_id
    come first; they revisit the least id that has their payload, and are responses, to which
    nothing refers, where no row with an id has it.

    Digests and least ids are found by one narrow aggregation; which row revisits which then
    travels with the pages through the only shuffle of payloads, a range sort.
    """
    make_folder(path)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    keys = written(
        rows.filter(F.octet_length("html") >= min_bytes).select(
            "page_id", F.unhex(F.sha1(F.col("html").cast("binary"))).alias("digest")
        ),
        "digests",
    )
    groups = keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    notes = keys.join(groups.filter("n > 1 AND refers_to IS NOT NULL").drop("n"), "digest").distinct()
    # A note comes just before the rows of its page; one page may have several payloads.
    noted = notes.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "digest", "refers_to")
    plain = rows.select("*", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("refers_to"))
    both = noted.unionByName(plain).repartitionByRange("page_id")
    both = both.sortWithinPartitions(F.col("page_id"), F.col("digest").isNull(), "digest", F.xxhash64("html", "url"))

    def write(batches):
        number = TaskContext.get().partitionId()
        files = _RollingFiles(f"{path}/part-{number:05d}", roll_bytes)
        current, known, answered = None, {}, set()
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "html", "digest", "refers_to")]
            for page_id, url, html, digest, refers_to in zip(*columns):
                if page_id != current:
                    current, known, answered = page_id, {}, set()
                if digest is not None:
                    known[digest] = refers_to
                    continue
                payload = html.encode("utf-8")
                own = hashlib.sha1(payload).digest() if known else None
                of = known.get(own)
                if of == page_id and own in known and own not in answered:
                    # The first row of the least id is the response itself.
                    answered.add(own)
                    of = None
                files.add(record(page_id, url, payload, of, date))
        files.close()
        if files.done:
            yield pa.RecordBatch.from_pydict(
                {
                    "part": [number] * len(files.done),
                    "name": [f[0] for f in files.done],
                    "records": [f[1] for f in files.done],
                    "bytes": [f[2] for f in files.done],
                },
                pa.schema([("part", pa.int32()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
            )

    # A row per file, whatever the number of pages.
    written_files = sorted(both.mapInArrow(write, "part int, name string, records long, bytes long").collect())
    listed = [{"name": f["name"], "records": f["records"], "bytes": f["bytes"]} for f in written_files]
    with committed(f"{path}/manifest.json") as out:
        out.write(json.dumps({"files": listed}).encode())


def _members(path):
    """The uncompressed gzip members of a file, one at a time."""
    with opened(path) as source:
        unpacker, parts, left = zlib.decompressobj(31), [], b""
        while True:
            content = left or source.read(READ_BYTES)
            if not content:
                return
            parts.append(unpacker.decompress(content))
            left = b""
            if unpacker.eof:
                yield b"".join(parts)
                left = unpacker.unused_data
                unpacker, parts = zlib.decompressobj(31), []


def parsed(member):
    """(headers by lower-case name, block) of one record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")[1:]
    headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
    return headers, rest[: int(headers["content-length"])]


READ_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"


def read_warc(spark, path):
    """A row per record of the manifest's files, a task per file. The digest of a response is
    taken from its payload and must be the one it states; a revisit has its head alone, so
    length and digest are those stated and html is null."""
    manifest = json.loads(read_all(f"{path}/manifest.json"))
    names = [f["name"] for f in manifest["files"]]
    kinds = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.string())]
    )

    def whole(value):
        return None if value is None else int(value)

    def read(batches):
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                for member in _members(f"{path}/{name}"):
                    headers, block = parsed(member)
                    if f"sha1:{base32_sha1(block)}" != headers["warc-block-digest"]:
                        raise ValueError(f"damaged record in {name}")
                    head, _, payload = block.partition(b"\r\n\r\n")
                    stated = headers["warc-payload-digest"].removeprefix("sha1:")
                    kind, html = headers["warc-type"], None
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    if kind == "response":
                        if base32_sha1(payload) != stated or len(payload) != size:
                            raise ValueError(f"damaged payload in {name}")
                        html = payload.decode("utf-8")
                    rows.append(
                        (whole(headers.get("warc-page-id")), headers.get("warc-target-uri"), size, stated, kind, whole(headers.get("warc-refers-to-page-id")), html)
                    )
                    held += len(block)
                    if held > 8 * READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds)

    listed = spark.createDataFrame([(n,) for n in names] or [("",)], "name string").limit(len(names))
    return listed.repartition(max(1, len(names))).mapInArrow(read, READ_SCHEMA)


def op10_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
