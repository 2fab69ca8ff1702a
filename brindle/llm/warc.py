"""WARC archives with deduplicated payloads, and a two-level capture index.

``write`` packs records into archives of about ``archive_mb``: a warcinfo record, then the HTTP message of each page, each record a gzip member of its own.
Each archive is one value for Spark's text writer (one row a file, whose name Spark gives; the byte after the last member is a zero, which gzip takes as padding).
So archives go to any store that Spark can write, under its commit protocol.  A payload that an earlier page has becomes a revisit record: of the pages with equal SHA-1
digests, that with the least id is the response.  ``read`` parses archives record by record and checks each response's digest.

``index`` sorts capture lines (reversed-host url key, page, archive, offset, length) by key and page into compressed blocks of ``lines`` lines, many to a file; the
sparse directory has the first and last of each block and its file, offset and length.  ``lookup`` (some urls) and ``captures`` (a table of pages) find blocks by binary search in the
directory, read only those ranges, each once, and give archive, offset and length of each capture; ``fetch`` and ``fetch_all`` read just these ranges, in order of archive and offset.
Workers get the directory in pieces of at most ``DIRECTORY_ROWS`` blocks, one after the other.

Defined cases: a null payload is empty (and empty ones are equal); rows that share the least id of a payload are all responses; a null url is stored as empty; a null id is stored without one
and takes part as larger than all others; a very long payload is one record, which one task holds; an empty table gives no archives, or such without records; only the three
columns named are read, so others may have any name.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import itertools
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, small_batches

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: Blocks whose places a worker holds at a time, some tens of MB.
DIRECTORY_ROWS = 200_000
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_PLACE = pa.schema([("first_key", pa.string()), ("first_page", pa.string()), ("last_key", pa.string()), ("last_page", pa.string()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())])
_PLACES = "first_key string, first_page string, last_key string, last_page string, file string, at long, size long"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, archive string, offset long, length long, intact boolean"


def _id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page {page_id}')}>"


def _member(head: list[bytes], body: bytes) -> bytes:
    head = [b"WARC/1.1", *head, b"Content-Length: %d" % len(body)]
    return gzip.compress(b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n", 6, mtime=0)


def _info(date: str, first: bytes) -> bytes:
    """The record at the head of an archive; ``first`` (the record after it) gives it an id of its own."""
    own = uuid.uuid5(_SPACE, hashlib.sha1(first).hexdigest())
    return _member([b"WARC-Type: warcinfo", b"WARC-Date: " + date.encode(), f"WARC-Record-ID: <urn:uuid:{own}>".encode(), b"Content-Type: application/warc-fields"], b"software: brindle\r\nformat: WARC File Format 1.1\r\n")


def _record(page_id, url: str, payload: bytes, sha1: bytes, refers_to, date: str) -> bytes:
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"), b"WARC-Date: " + date.encode(), b"WARC-Record-ID: " + _id(page_id).encode()]
    head += [b"WARC-Target-URI: " + clean.encode(), b"WARC-Payload-Digest: sha1:" + base64.b32encode(sha1), b"Content-Type: application/http;msgtype=response"]
    head += [] if page_id is None else [f"X-Page: {page_id}".encode()]
    if refers_to is not None:
        head += [b"WARC-Profile: " + _PROFILE.encode(), b"WARC-Refers-To: " + _id(refers_to).encode(), f"X-Refers-To-Page: {refers_to}".encode()]
    return _member(head, _HTTP % len(payload) + (payload if refers_to is None else b""))


def members(raw: bytes):
    """(offset, length, content) of each gzip member."""
    at, n = 0, len(raw)
    view = memoryview(raw)
    while at < n:
        if raw[at] == 0:
            at += 1
            continue
        d = zlib.decompressobj(31)
        parts, used = [], at
        while not d.eof and used < n:  # in steps, so that what follows a member is not copied each time
            step = view[used : used + 65536]
            parts.append(d.decompress(step))
            used += len(step)
        used -= len(d.unused_data)
        yield at, used - at, b"".join(parts)
        at = used


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(x.decode().split(": ", 1) if b": " in x else (x.decode().rstrip(":"), "") for x in head.split(b"\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def http(body: bytes) -> tuple[int, bytes]:
    """The length that an HTTP message gives, and the payload that is there."""
    head, _, payload = body.partition(b"\r\n\r\n")
    return int(head.rpartition(b"Content-Length: ")[2]), payload


_ROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("intact", pa.bool_())])


def _told(records, payloads: bool):
    """(archive, offset, length, content) of records -> batches of RECORD."""
    out, size = [], 0
    batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _ROW, strict=True)], schema=_ROW)
    for name, offset, length, content in records:
        h, body = parse(content)
        if h["WARC-Type"] not in ("response", "revisit"):
            continue
        said, body = http(body)
        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
        reply = h["WARC-Type"] == "response"
        if reply:
            own = base64.b32encode(hashlib.sha1(body).digest()).decode()
        number = lambda k: int(h[k]) if k in h else None  # noqa: B023, E731
        out.append((number("X-Page"), h["WARC-Target-URI"], h["WARC-Type"], len(body) if reply else said, own if reply else digest, number("X-Refers-To-Page"), body if reply and payloads else None, name, offset, length, own == digest if reply else None))
        size += len(body)
        if size > 4 << 20:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


def write(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", archive_mb: int = 16, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write the archives below path, which must not exist; date: of the capture."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).cast("string").alias("_url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("_body"))
    rows = rows.withColumn("_sha", F.unhex(F.sha1("_body")))
    # only payloads that several pages have; cut, so that the join can be a broadcast where the table is small, and Spark can split a payload with very many copies where it is not
    first = cut(rows.groupBy("_sha").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    rows = rows.join(first, "_sha", "left").select("_id", "_url", "_body", "_sha", F.when(F.col("_id").eqNullSafe(F.col("_first")), F.lit(None)).otherwise(F.col("_first")).alias("_to"))
    limit = archive_mb << 20

    def pack(batches):
        held, size = [], 0
        archive = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join([_info(date, held[0]), *held])], pa.binary())], ["_w"])
        for b in batches:
            for i, u, body, sha, to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(_record(i, u, body, sha, to, date))
                size += len(held[-1])
                if size >= limit:
                    yield archive()
                    held, size = [], 0
        if held:
            yield archive()

    archives = rows.mapInArrow(pack, "_w binary").select(F.col("_w").cast("string").alias("value"))
    archives.write.option("maxRecordsPerFile", 1).option("lineSep", "\0").text(path)


def read(spark: SparkSession, path: str, *, payloads: bool = True) -> DataFrame:
    """One row a record; payload is null for revisits and where payloads is False; intact: a response's digest is right."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")

    def run(batches):
        for b in batches:
            for name, raw in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                yield from _told(((name, *m) for m in members(raw.as_py())), payloads)

    return files.mapInArrow(run, RECORD)


def surt(url: F.Column) -> F.Column:
    """The url with its host reversed: http://a.example.org/x?y -> org,example,a)/x?y."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), "^[a-z][a-z0-9+.-]*://", "")
    host, tail = F.regexp_extract(rest, "^([^/?#]*)", 1), F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), F.when(tail == "", "/").otherwise(tail))


def _stored(url: F.Column) -> F.Column:
    """The url as a record has it."""
    return F.replace(F.replace(F.coalesce(url.cast("string"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _key(url: F.Column) -> F.Column:
    """The key of a stored url as a capture line has it."""
    return F.replace(surt(url), F.lit("\t"), F.lit("%09"))


def _page(page: F.Column) -> F.Column:
    return F.coalesce(page.cast("long").cast("string"), F.lit(""))


def index(records: DataFrame, path: str, *, lines: int = 3000, files: int | None = None, file_mb: int = 16) -> DataFrame:
    """Write the index of read()'s records below path: files of about file_mb of compressed blocks, and the directory, which comes back."""
    spark = records.sparkSession
    keyed = cut(records.select(_key(F.col("url")).alias("key"), _page(F.col("page_id")).alias("page"), "archive", "offset", "length"))  # cut, as the sort samples it first
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_lines = keyed.repartitionByRange(files, "key", "page").sortWithinPartitions("key", "page")

    def pack(batches):
        held: list[str] = []
        blocks, size = [], 0
        file = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join(blocks)], pa.binary())], ["_w"])
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append("\t".join("" if x is None else str(x).replace("\t", "%09").replace("\n", "%0A") for x in row))
                if len(held) == lines:
                    blocks.append(gzip.compress("\n".join(held).encode(), 6, mtime=0))
                    size += len(blocks[-1])
                    held = []
                    if size >= file_mb << 20:
                        yield file()
                        blocks, size = [], 0
        if held:
            blocks.append(gzip.compress("\n".join(held).encode(), 6, mtime=0))
        if blocks:
            yield file()

    sorted_lines.mapInArrow(pack, "_w binary").select(F.col("_w").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("lineSep", "\0").text(f"{path}/blocks")

    def places(batches):
        for b in batches:
            out = []
            for name, raw in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                for at, size, content in members(raw.as_py()):
                    first, last = content[: content.find(b"\n")] if b"\n" in content else content, content[content.rfind(b"\n") + 1 :]
                    out.append((*first.decode().split("\t")[:2], *last.decode().split("\t")[:2], name, at, size))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], f.type) for k, f in enumerate(_PLACE)], schema=_PLACE)

    made = spark.read.format("binaryFile").load(f"{path}/blocks").where("length > 0").select("path", "content").mapInArrow(places, _PLACES)
    made.write.parquet(f"{path}/directory")
    return spark.read.schema(_PLACES).parquet(f"{path}/directory")


_CAPTURE = pa.schema([("want", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_CAPTURES = "want string, archive string, offset long, length long"


def _placed(wanted: DataFrame, path: str) -> DataFrame:
    """wanted (key, page; without a page: all of the key) -> file, at, size of each block that may have it, and the wanted as ``want``."""
    spark = wanted.sparkSession
    directory = spark.read.schema(_PLACES).parquet(f"{path}/directory")
    rows = directory.count()
    if rows > DIRECTORY_ROWS:
        directory = directory.orderBy("first_key", "first_page", "last_key", "last_page")
        wanted = cut(wanted)
    source = directory.toLocalIterator()
    found = None
    for _ in range(max(1, -(-rows // DIRECTORY_ROWS))):
        piece = [((r["first_key"], r["first_page"]), (r["last_key"], r["last_page"]), r["file"], r["at"], r["size"]) for r in itertools.islice(source, DIRECTORY_ROWS)]
        sent = spark.sparkContext.broadcast(sorted(piece))

        def search(batches, sent=sent):
            entries = sent.value
            firsts = [e[0] for e in entries]
            for b in batches:
                out = []
                for key, page in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    low, high = (key, page or ""), (key, page) if page is not None else (key, "\U0010ffff")
                    k = bisect.bisect_right(firsts, high) - 1
                    while k >= 0 and entries[k][1] >= low:  # equal lines may go over several blocks
                        out.append((*entries[k][2:], key if page is None else f"{key}\t{page}"))
                        k -= 1
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], ["file", "at", "size", "want"])

        mine = wanted.mapInArrow(search, "file string, at long, size long, want string")
        if rows > DIRECTORY_ROWS:
            mine = cut(mine)
            sent.destroy()
        found = mine if found is None else found.unionByName(mine)
    return found


def _opened(placed: DataFrame, path: str, whole: bool) -> DataFrame:
    """The captures of what is wanted, from the blocks that may have it; whole: ``want`` has key and page, not the key alone."""
    spark = placed.sparkSession

    def lines_of(raw: bytes) -> dict[str, list[tuple[str, int, int]]]:
        held: dict[str, list[tuple[str, int, int]]] = {}
        for line in gzip.decompress(raw).decode().split("\n"):
            name, archive, offset, length = line.rsplit("\t", 3)
            held.setdefault(name if whole else name.rpartition("\t")[0], []).append((archive, int(offset), int(length)))
        return held

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], f.type) for k, f in enumerate(_CAPTURE)], schema=_CAPTURE)

    if _store(path) is None:
        per_file = placed.groupBy("file").agg(F.collect_list(F.struct("at", "size", "want")).alias("wants"))  # at most the lines of a file of file_mb, where what is wanted is there
        files = spark.read.format("binaryFile").load(f"{path}/blocks").select(F.col("path").alias("file"), "content").join(per_file, "file")

        def cut_out(batches):
            for b in batches:
                for raw, wants in zip(b.column("content"), b.column("wants").to_pylist(), strict=True):
                    raw, held, out = raw.as_py(), {}, []
                    for w in sorted(wants, key=lambda w: w["at"]):
                        if w["at"] not in held:
                            held = {w["at"]: lines_of(raw[w["at"] : w["at"] + w["size"]])}
                        out += [(w["want"], *x) for x in held[w["at"]].get(w["want"], ())]
                    yield batch(out)

        return files.mapInArrow(cut_out, _CAPTURES)

    def ranged(batches):
        name, file, at, held = None, None, None, {}
        for b in batches:
            out = []
            for own, start, size, want in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if own != name:
                    if file:
                        file.close()
                    store, place = _store(own)
                    name, file, at = own, store.open_input_file(place), None
                if start != at:
                    at, held = start, lines_of(file.read_at(size, start))
                out += [(want, *x) for x in held.get(want, ())]
            yield batch(out)
        if file:
            file.close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = cut(placed).repartitionByRange(parts, "file", "at", "want").sortWithinPartitions("file", "at")
    return ordered.select("file", "at", "size", "want").mapInArrow(ranged, _CAPTURES)


def captures(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """archive, offset, length of all captures of these pages (by url and id) in the index below path."""
    wanted = pages.select(_key(_stored(F.col(url_col))).alias("key"), _page(F.col(id_col)).alias("page")).distinct()
    return _opened(_placed(wanted, path), path, True).drop("want")


def lookup(spark: SparkSession, path: str, urls: list[str]) -> DataFrame:
    """url, archive, offset, length of the captures of these urls."""
    asked = spark.createDataFrame([(u,) for u in urls], "url string").select("url", _key(_stored(F.col("url"))).alias("key"))
    wanted = asked.select("key", F.lit(None).cast("string").alias("page")).distinct()
    return _opened(_placed(wanted, path), path, False).join(asked, F.col("want") == F.col("key")).select("url", "archive", "offset", "length")


def fetch(spark: SparkSession, archive: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Head and payload of one record, by a range read through Spark's file system."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(archive)
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(place)
    try:
        stream.seek(offset)
        raw = bytes(stream.readNBytes(length))
    finally:
        stream.close()
    head, body = parse(next(members(raw))[2])
    return head, http(body)[1]


def _store(path: str):
    """The file system and path with which a worker reads ranges, or None where only Spark reaches the store."""
    scheme, _, rest = path.partition(":")
    try:
        return (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(path)
    except (OSError, ValueError, ImportError):
        return None


def fetch_all(found: DataFrame, path: str, *, payloads: bool = True) -> DataFrame:
    """read()'s row of each of these captures (archive, offset, length) of the archives below path, by range reads in order of archive and offset.

    Where only Spark reaches the store, it hands over whole archives, and the ranges are taken from those.
    """
    spark = found.sparkSession
    if _store(path) is None:
        ranges = found.groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("ranges"))
        files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"), "content").join(ranges, "archive")

        def cut_out(batches):
            for b in batches:
                for name, raw, own in zip(b.column("archive").to_pylist(), b.column("content"), b.column("ranges").to_pylist(), strict=True):
                    raw = raw.as_py()
                    yield from _told(((name, r["offset"], r["length"], gzip.decompress(raw[r["offset"] : r["offset"] + r["length"]])) for r in own), payloads)

        return files.mapInArrow(cut_out, RECORD)

    def ranged(batches):
        name, file = None, None
        for b in batches:
            for archive, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if archive != name:
                    if file:
                        file.close()
                    store, at = _store(archive)
                    name, file = archive, store.open_input_file(at)
                yield archive, offset, length, gzip.decompress(file.read_at(length, offset))
        if file:
            file.close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = cut(found).repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")
    return ordered.mapInArrow(lambda batches: _told(ranged(batches), payloads), RECORD)
