"""WARC records in ZIP packages, written and read back record by record without extraction.

A package holds three stored members: the records, each compressed by itself; an index with a line per record, its
place and length; and a short description. A reader takes the end of the file, the central directory (with ZIP64
fields where sizes or places need them) and the index, and then reads only the byte ranges it wants. Packages are
written one after the other by each task and closed at a size limit, so a reader never holds more than one index.

Of records with equal payloads the one with the largest page id is a response, the others revisit it. A revisit keeps
the HTTP header of its page, and with it the length of the payload.

Defined results: a null payload is empty; a null id is written as an empty one, and is a revisit unless all its copies
have none; of repeated rows with the largest id each is a response; a null address is left out; an empty table gives no
package and no rows; other columns are not read. Packages of failed attempts are never listed, so nobody reads them.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import texts_of
from tripweave.session import scratch_path, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A package is closed beyond this size or number of records; one range of records is about so many bytes.
PACKAGE_BYTES = 256 << 20
PACKAGE_RECORDS = 100_000
RANGE_BYTES = 4 << 20
# Bytes of packages that a reading task gets on average at most.
TASK_BYTES = 64 << 20

# Member names, and the markers of the ZIP format.
RECORDS, INDEX, ABOUT = "archive/pages.warc.gz", "indexes/index.cdxj", "datapackage.json"
LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64, DESCRIPTOR = b"PK\x06\x06", b"PK\x06\x07", b"PK\x07\x08"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
STORED, SIZES_FOLLOW, UTF8_NAME, VERSION64, FIRST_DAY = 0, 1 << 3, 1 << 11, 45, 33
LONGEST_COMMENT = 0xFFFF
WARC_DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class PackageWriter:
    """A ZIP file of stored members, written front to back; ``zip64`` uses the large fields even for small files."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64 = out, zip64
        self.at = 0
        self.members: list[tuple[bytes, int, int, int]] = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        """Start a member whose size is not known yet: the sizes follow it, in 64 bits."""
        self.name, self.start, self.crc, self.size = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        head = (VERSION64, SIZES_FOLLOW | UTF8_NAME, STORED, 0, FIRST_DAY, 0, FULL32, FULL32, len(self.name), len(extra))
        self._put(LOCAL + struct.pack("<5H3I2H", *head) + self.name + extra)

    def write(self, data: bytes) -> int:
        """Append to the member; returns the place of ``data`` in it."""
        place = self.size
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self._put(data)
        return place

    def end(self) -> None:
        self._put(DESCRIPTOR + struct.pack("<IQQ", self.crc, self.size, self.size))
        self.members.append((self.name, self.start, self.crc, self.size))

    def close(self) -> None:
        directory = self.at
        for name, start, crc, size in self.members:
            large = self.zip64 or max(start, size) >= FULL32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, start) if large else b""
            size32, start32 = (FULL32, FULL32) if large else (size, start)
            head = (VERSION64, VERSION64, SIZES_FOLLOW | UTF8_NAME, STORED, 0, FIRST_DAY, crc, size32, size32)
            self._put(CENTRAL + struct.pack("<6H3I", *head) + struct.pack("<5H2I", len(name), len(extra), 0, 0, 0, 0, start32))
            self._put(name + extra)
        n, length = len(self.members), self.at - directory
        large = self.zip64 or n >= FULL16 or max(directory, length) >= FULL32
        if large:
            end64 = self.at
            self._put(END64 + struct.pack("<QHHIIQQQQ", 44, VERSION64, VERSION64, 0, 0, n, n, length, directory))
            self._put(LOCATOR64 + struct.pack("<IQI", 0, end64, 1))
        counts = (FULL16, FULL16, FULL32, FULL32) if large else (n, n, length, directory)
        self._put(END + struct.pack("<4H2IH", 0, 0, *counts, 0))
        self.out.close()


class PackageReader:
    """The members of a ZIP file, found through its directory; only the ranges asked for are read."""

    def __init__(self, source, size: int):
        self.source = source
        tail_at = max(0, size - LONGEST_COMMENT - 42)
        tail = self.range(tail_at, size - tail_at)
        end = tail.rfind(END)
        while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
            end = tail.rfind(END, 0, end)
        if end < 0:
            raise ValueError("no end of a central directory")
        n, length, directory = struct.unpack_from("<HII", tail, end + 10)
        if FULL16 == n or FULL32 in (length, directory):
            if tail[max(0, end - 20) : end][:4] != LOCATOR64:
                raise ValueError("no locator of a ZIP64 directory")
            end64 = self.range(struct.unpack_from("<Q", tail, end - 12)[0], 56)
            if end64[:4] != END64:
                raise ValueError("no end of a ZIP64 directory")
            n, length, directory = struct.unpack_from("<QQQ", end64, 32)
        self.members = self._members(self.range(directory, length), n)

    def range(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        data = self.source.read(length)
        if len(data) != length:
            raise ValueError("the file ends early")
        return data

    def _members(self, directory: bytes, n: int) -> dict[str, tuple[int, int, int, int]]:
        found, at = {}, 0
        for _ in range(n):
            if directory[at : at + 4] != CENTRAL:
                raise ValueError("not an entry of a central directory")
            method, _, _, crc, packed, size, names, extras, comments = struct.unpack_from("<3H3I3H", directory, at + 10)
            start = struct.unpack_from("<I", directory, at + 42)[0]
            name = directory[at + 46 : at + 46 + names].decode()
            extra = directory[at + 46 + names : at + 46 + names + extras]
            size, packed, start = self._large(extra, size, packed, start)
            found[name] = (method, crc, size if method == STORED else packed, start)
            at += 46 + names + extras + comments
        return found

    @staticmethod
    def _large(extra: bytes, size: int, packed: int, start: int) -> tuple[int, int, int]:
        """The 64-bit values of those fields that are full, in the order of the format."""
        at = 0
        while at + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                values = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
                return tuple(next(values) if v == FULL32 else v for v in (size, packed, start))
            at += 4 + length
        return size, packed, start

    def place(self, name: str) -> tuple[int, int]:
        """Where the bytes of a stored member begin in the file, and how many there are."""
        method, _, size, start = self.members[name]
        if method != STORED:
            raise ValueError(f"{name} is compressed as a whole and can't be read in ranges")
        head = self.range(start, 30)
        if head[:4] != LOCAL:
            raise ValueError("not a member")
        names, extras = struct.unpack_from("<HH", head, 26)
        return start + 30 + names + extras, size

    def read(self, name: str) -> bytes:
        data = self.range(*self.place(name))
        if zlib.crc32(data) != self.members[name][1]:
            raise ValueError(f"{name} is damaged")
        return data


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, payload_digest: str, refers_to) -> bytes:
    """One WARC record: a response, or a revisit of the page ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    fields.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    if url:
        fields.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    fields += [f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha1:{payload_digest}"]
    if revisit:
        fields += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of a record and of the HTTP header in it, and its payload; checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(fields["content-length"])]
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = [v for k, _, v in (h.partition(b": ") for h in http.split(b"\r\n")) if k.lower() == b"content-length"]
    number = lambda field: int(field[len("<urn:page:") : -1]) if len(field) > len("<urn:page:>") else None
    found = {
        "page_id": number(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "payload_bytes": int(lengths[0]),
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
        "refers_to": number(fields.get("warc-refers-to", "")),
        "payload": None,
    }
    if found["record_type"] == "response":
        if len(payload) != found["payload_bytes"] or digest(payload) != found["payload_digest"]:
            raise ValueError("a payload differs from its digest")
        found["payload"] = payload
    return found


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with digest and, for copies of a page with a larger id, that id."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
    )
    copied = rows.filter(F.octet_length("payload") >= min_bytes)
    original = copied.groupBy("sha1").agg(F.max("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1")
    # Stored, so that the join has a plain exchange on either side, whose hot payloads adaptive execution can split.
    original = stage(original, "originals")
    other = (F.octet_length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("original"))
    return rows.join(original, "sha1", "left").select(
        "page_id", "url", "payload", F.when(other, F.col("original")).alias("refers_to")
    )


def write_packages(pages: DataFrame, folder: str, min_bytes: int = 0, zip64: bool = False) -> DataFrame:
    """Write the pages into packages in a folder all executors reach; one row per finished package."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        package, index = None, []

        def finish() -> pa.RecordBatch:
            package.end()
            package.begin(INDEX)
            for line in index:
                package.write(line)
            package.end()
            package.begin(ABOUT)
            package.write(json.dumps({"profile": "data-package", "records": len(index)}).encode())
            package.end()
            package.close()
            return pa.RecordBatch.from_pydict(
                {"package": [name], "records": pa.array([len(index)], pa.int64()), "bytes": pa.array([package.at], pa.int64())}
            )

        for batch in batches:
            rest = [batch[i] for i in (0, 1, 3)]
            for i, payload in enumerate(texts_of(batch[2])):
                page_id, url, refers_to = (c[i].as_py() for c in rest)
                if package is None:
                    name, index = f"{uuid.uuid4().hex}.wacz", []
                    package = PackageWriter(system.open_output_stream(f"{root}/{name}"), zip64)
                    package.begin(RECORDS)
                own = digest(payload)
                press = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = press.compress(record(page_id, url, payload, own, refers_to)) + press.flush()
                place = package.write(data)
                line = {"url": url, "digest": own, "offset": place, "length": len(data), "id": page_id}
                index.append(json.dumps(line).encode() + b"\n")
                if package.size >= PACKAGE_BYTES or len(index) >= PACKAGE_RECORDS:
                    yield finish()
                    package = None
        if package is not None:
            yield finish()

    rows = with_originals(pages, min_bytes)
    return stage(rows.mapInArrow(write, "package string, records long, bytes long"), "packages")


def record_ranges(packages: DataFrame, folder: str) -> DataFrame:
    """Byte ranges of neighbouring records, from the directory and the index of each package."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch[0].to_pylist():
                path = f"{root}/{name}"
                with system.open_input_file(path) as source:
                    reader = PackageReader(source, source.size())
                    first, _ = reader.place(RECORDS)
                    lines = [json.loads(line) for line in reader.read(INDEX).splitlines()]
                starts, cuts = [], []
                for line in sorted(lines, key=lambda line: line["offset"]):
                    begin, end = first + line["offset"], first + line["offset"] + line["length"]
                    if not starts or end - starts[-1] > RANGE_BYTES:
                        starts.append(begin)
                        cuts.append([])
                    cuts[-1] += [begin - starts[-1], end - starts[-1]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "package": [name] * len(starts),
                        "start": pa.array(starts, pa.int64()),
                        "cuts": pa.array(cuts, pa.list_(pa.int64())),
                    }
                )

    named = packages.select("package").repartition(_tasks(packages), "package")
    return named.mapInArrow(locate, "package string, start long, cuts array<long>")


def _tasks(packages: DataFrame) -> int:
    """Tasks for reading: one per so many bytes, and enough to keep every core busy."""
    size = packages.agg(F.sum("bytes")).first()[0] or 0
    return max(packages.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def read_records(packages: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Every record of the packages, read range by range."""
    fields = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
    names = [f.split()[0] for f in fields.split(", ")] + ["payload"] * payloads

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                cuts = row["cuts"]
                with system.open_input_file(f"{root}/{row['package']}") as source:
                    source.seek(row["start"])
                    data = source.read(cuts[-1])
                pairs = zip(cuts[::2], cuts[1::2], strict=True)
                found = [parse(zlib.decompress(data[a:b], wbits=31)) for a, b in pairs]
                columns = {n: [f[n] for f in found] for n in names}
                for n, kind in (("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64())):
                    columns[n] = pa.array(columns[n], kind)
                for n in ("url", "record_type", "payload_digest"):
                    columns[n] = pa.array(columns[n], pa.string())
                if payloads:
                    columns["payload"] = pa.array(columns["payload"], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    ranges = record_ranges(packages, folder).repartition(_tasks(packages), "package", "start")
    return ranges.mapInArrow(read, fields + (", payload binary" if payloads else ""))


def package_folder(pages: DataFrame) -> str:
    """A new folder in the shared one, as an address that names its file system."""
    path = scratch_path(pages.sparkSession, "packages")
    return path if "://" in path or path.startswith(("file:", "/")) else f"/{path}"
