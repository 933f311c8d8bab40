"""WARC records in ZIP packages: writing, and range reads without extraction.

A package is a ZIP file with two stored members: ``archive/data.warc.gz``, one
gzip member per record, and ``indexes/index.cdx``, one line per record with its
offset and length. Packages end in ZIP64 directories, so neither their size nor
the number of members is bounded by the old format.

Reading needs three small ranges of a package first (its tail, its central
directory, each member's local header), then the index, and from there one range
per record. Indexes are read in the form written here and as CDXJ, stored or
packed; archives that no index names, or whose index has another form, are walked
record by record. Ranges are dealt to tasks by their bytes.

Packages of other writers: records of pages (response, revisit, resource) are
read, others (warcinfo, request, metadata and so on) are passed over. Their ids
stay texts (``record_id``, ``refers_to_id``), ``page_id`` and ``refers_to`` are
null. The payload of an HTTP response is what follows its headers, as stored;
transfer encodings are undone only where the record's digest is that of the
result. Digests may be base32 or hex; one that is no SHA-1, or is absent, is
computed from the payload, or is null for a revisit. A revisit whose response is
not among the records has a null length. A payload unlike its SHA-1, a gzip member
with several records, and a package that ends early fail the job.

Records with equal payloads of at least ``min_revisit`` bytes are written once:
the one with the largest page id is the response, the others are revisits that
refer to it. Which it is follows from narrow rows (id, digest, size); payloads are
shuffled once, to meet their verdict.

Packages lie in a folder that driver and executors share, and are opened through
``pyarrow.fs``, which knows local, HDFS and object-store addresses. A repeated
task writes packages of its own name; only those in the manifest, which Spark
commits, are read.

Defined cases: null html is an empty payload, a null url an empty address; a null
id counts as smaller than any other and is kept; rows that share the largest id
of a payload are all responses; rows repeated in full are repeated records; an
empty table gives no packages and an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm.common import tune
from broadsheet.session import materialise, scratch_path

MIN_REVISIT = 1000
PACKAGE_BYTES = 32 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"

# fixed: signatures and layouts of ZIP records
LOCAL, CENTRAL, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
END64, LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
LOCAL_FORM, CENTRAL_FORM, END_FORM = "<4s5H3I2H", "<4s6H3I5H2I", "<4s4H2IH"
END64_FORM, LOCATOR64_FORM = "<4sQ2H2I4Q", "<4sIQI"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF
DOS_DATE = (1980 - 1980) << 9 | 1 << 5 | 1

# ---- ZIP --------------------------------------------------------------------------------


def zip_package(members: list[tuple[str, bytes]]) -> bytes:
    """A ZIP file of stored members with ZIP64 fields throughout."""
    out, central, at = [], [], 0
    for name, data in members:
        raw, crc = name.encode(), zlib.crc32(data)
        extra = struct.pack("<2H2Q", 1, 16, len(data), len(data))
        head = struct.pack(LOCAL_FORM, LOCAL, 45, 0x800, 0, 0, DOS_DATE, crc, FULL32, FULL32, len(raw), len(extra))
        out += [head, raw, extra, data]
        extra = struct.pack("<2H3Q", 1, 24, len(data), len(data), at)
        central += [
            struct.pack(
                CENTRAL_FORM, CENTRAL, 45, 45, 0x800, 0, 0, DOS_DATE, crc, FULL32, FULL32, len(raw), len(extra), 0, 0, 0, 0, FULL32
            ),
            raw, extra,
        ]
        at += len(head) + len(raw) + struct.calcsize("<2H2Q") + len(data)
    directory = b"".join(central)
    n = len(members)
    end64 = struct.pack(END64_FORM, END64, 44, 45, 45, 0, 0, n, n, len(directory), at)
    locator = struct.pack(LOCATOR64_FORM, LOCATOR64, 0, at + len(directory), 1)
    end = struct.pack(END_FORM, END, FULL16, FULL16, FULL16, FULL16, FULL32, FULL32, 0)
    return b"".join([*out, directory, end64, locator, end])


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int  # as stored
    header: int  # offset of the local header


class Package:
    """A ZIP file read by ranges."""

    def __init__(self, file):
        self.file, self.size = file, file.size()

    def range(self, at: int, n: int) -> bytes:
        data = self.file.read_at(n, at)
        if len(data) < n:
            raise ValueError("the package ends early")
        return data

    def _directory(self) -> tuple[int, int, int]:
        """Offset, size and number of entries of the central directory."""
        tail_at = max(0, self.size - 65_536 - struct.calcsize(END_FORM))
        tail = self.range(tail_at, self.size - tail_at)
        size = struct.calcsize(END_FORM)

        def ends_file(at: int) -> bool:
            return at + size <= len(tail) and at + size + struct.unpack_from("<H", tail, at + size - 2)[0] == len(tail)

        at = tail.rfind(END)
        while at >= 0 and not ends_file(at):
            at = tail.rfind(END, 0, at)  # the signature also occurs in a comment
        if at < 0:
            raise ValueError("no end of a central directory")
        _, disk, first_disk, _, n, size, offset, _ = struct.unpack_from(END_FORM, tail, at)
        if FULL16 in (disk, first_disk, n) or FULL32 in (size, offset):
            spot = tail_at + at - struct.calcsize(LOCATOR64_FORM)
            sign, _, end64, _ = struct.unpack(LOCATOR64_FORM, self.range(spot, struct.calcsize(LOCATOR64_FORM)))
            if sign != LOCATOR64:
                raise ValueError("no ZIP64 locator")
            found = struct.unpack(END64_FORM, self.range(end64, struct.calcsize(END64_FORM)))
            if found[0] != END64:
                raise ValueError("no ZIP64 end of the central directory")
            n, size, offset = found[7], found[8], found[9]
        return offset, size, n

    def members(self) -> list[Member]:
        offset, size, n = self._directory()
        data, at, out = self.range(offset, size), 0, []
        for _ in range(n):
            f = struct.unpack_from(CENTRAL_FORM, data, at)
            if f[0] != CENTRAL:
                raise ValueError("the central directory is broken")
            method, stored, plain, n_name, n_extra, n_comment, header = f[4], f[8], f[9], f[10], f[11], f[12], f[16]
            at += struct.calcsize(CENTRAL_FORM)
            name, extra = data[at : at + n_name].decode(), data[at + n_name : at + n_name + n_extra]
            at += n_name + n_extra + n_comment
            if FULL32 in (stored, plain, header):
                wide = iter(_zip64_values(extra))
                plain = next(wide) if plain == FULL32 else plain
                stored = next(wide) if stored == FULL32 else stored
                header = next(wide) if header == FULL32 else header
            out.append(Member(name, method, stored, header))
        return out

    def _data_at(self, m: Member) -> int:
        f = struct.unpack(LOCAL_FORM, self.range(m.header, struct.calcsize(LOCAL_FORM)))
        if f[0] != LOCAL:
            raise ValueError("no local header where the directory says")
        return m.header + struct.calcsize(LOCAL_FORM) + f[9] + f[10]

    def start(self, m: Member) -> int:
        """Offset of a stored member's data."""
        if m.method:
            raise ValueError(f"{m.name} is compressed in the package, its records have no ranges")
        return self._data_at(m)

    def member(self, m: Member) -> bytes:
        """A small member's content, stored or deflated."""
        data = self.range(self._data_at(m), m.size)
        return zlib.decompress(data, -15) if m.method == 8 else data


def _zip64_values(extra: bytes) -> list[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            return list(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
        at += 4 + n
    raise ValueError("no ZIP64 field")


# ---- WARC -------------------------------------------------------------------------------------


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member: a response with its payload, or a revisit without."""
    body = b"" if revisit else payload
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Target-URI: {quote(url or '', safe=_URL_CHARS)}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}",
    ]
    if revisit:
        lines += [
            f"WARC-Refers-To: {_record_id(refers_to)}",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


# kept as they are in addresses; anything else is percent-encoded, the percent sign included
_URL_CHARS = "!#$&'()*+,/:;=?@[]~"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and payload of a decompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    n = int(fields["content-length"])
    if len(rest) < n or rest[n:].strip(b"\r\n"):
        raise ValueError("not one whole record")
    return fields, rest[:n]


def _open(path: str):
    fs, where = pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)
    return fs, where


# ---- writing ----------------------------------------------------------------------------------


def _package_rows(records: list[tuple[int | None, bytes]]) -> bytes:
    at, lines = 0, []
    for page_id, data in records:
        lines.append(f"{'' if page_id is None else page_id} {at} {len(data)}\n")
        at += len(data)
    return zip_package([(ARCHIVE, b"".join(d for _, d in records)), (INDEX, "".join(lines).encode())])


def _write(folder: str, package_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            fs, where = _open(folder)
            fs.create_dir(where, recursive=True)
            name = f"pages-{uuid.uuid4().hex}.wacz"
            with fs.open_output_stream(f"{where}/{name}") as f:
                f.write(_package_rows(held))
            return pa.RecordBatch.from_pydict({"package": [f"{folder}/{name}"], "records": [len(held)]})

        for b in batches:
            for page_id, url, html, digest, refers_to, revisit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = record(page_id, url, (html or "").encode(), digest, refers_to, revisit)
                held.append((page_id, data))
                size += len(data)
                if size >= package_bytes:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def write_packages(
    pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT, package_bytes: int = PACKAGE_BYTES
) -> DataFrame:
    """Write ``page_id, url, html`` as packages; the manifest ``package, records``."""
    tune(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    digest = F.sha1(F.col("html").cast("binary"))
    narrow = materialise(
        rows.select("page_id", digest.alias("digest"), F.octet_length("html").alias("size")), "page-digests"
    )
    shared = narrow.filter(F.col("size") >= min_revisit).groupBy("digest").agg(
        F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")
    )
    # pages whose payload others have as well, and whose response is another page
    revisits = narrow.join(shared.filter("n > 1 and response is not null"), "digest").filter(
        ~F.col("page_id").eqNullSafe(F.col("response"))
    )
    revisits = revisits.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "response").distinct()
    rows = rows.withColumn("digest", digest)
    same = (F.col("digest") == F.col("r_digest")) & F.col("page_id").eqNullSafe(F.col("r_id"))
    ready = rows.join(revisits, same, "left").select(
        "page_id", "url", F.when(F.col("response").isNull(), F.col("html")).alias("html"), "digest",
        F.col("response").alias("refers_to"), F.col("response").isNotNull().alias("revisit"),
    )
    return materialise(ready.mapInArrow(_write(folder, package_bytes), "package string, records long"), "manifest")


# ---- reading ----------------------------------------------------------------------------------

READ_BYTES = 16 << 20  # stored bytes per task aimed at
CHUNK_BYTES = 2 << 20  # neighbouring records that one task reads
HELD_BYTES = 32 << 20  # payloads in one batch of rows
PAGE_KINDS = ("response", "revisit", "resource")


def index_spans(data: bytes) -> dict[str, list[tuple[int, int]]] | None:
    """Offsets and lengths by archive name, from this module's index or CDXJ; None for another form."""
    spans: dict[str, list[tuple[int, int]]] = {}
    try:
        for line in data.decode().splitlines():
            if not line.strip() or line.startswith("!"):
                continue
            if line.endswith("}"):
                fields = json.loads(line[line.index("{") :])
                name, at, n = fields["filename"].rpartition("/")[2], fields["offset"], fields["length"]
            else:
                name = ARCHIVE.rpartition("/")[2]
                _, at, n = line.split(" ")
            spans.setdefault(name, []).append((int(at), int(n)))
    except (KeyError, ValueError, AttributeError, TypeError):
        return None
    return spans


def _indexed(package: Package, members: list[Member]) -> dict[str, list[tuple[int, int]]]:
    """Spans of the archives that indexes name; none if one of the indexes has another form."""
    spans: dict[str, list[tuple[int, int]]] = {}
    for m in members:
        if not re.fullmatch(r"indexes/.*\.cdxj?(\.gz)?", m.name):
            continue
        data = package.member(m)
        found = index_spans(gzip.decompress(data) if m.name.endswith(".gz") else data)
        if found is None:
            return {}
        for name, own in found.items():
            spans.setdefault(name, []).extend(own)
    return spans


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of all records of each package, from its indexes or by walking the archives."""
    for b in batches:
        for path in b.column(0).to_pylist():
            fs, where = _open(path)
            spans = []
            with fs.open_input_file(where) as f:
                package = Package(f)
                members = package.members()
                indexed = _indexed(package, members)
                for a in members:
                    if not a.name.startswith("archive/") or a.name.endswith("/"):
                        continue
                    start, own = package.start(a), indexed.get(a.name.rpartition("/")[2])
                    if own is None:
                        own = _walk(package, start, a.size) if a.name.endswith(".gz") else _walk_plain(package, start, a.size)
                    spans += sorted({(start + at, n) for at, n in own})
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path] * len(spans), pa.string()), pa.array([s for s, _ in spans], pa.int64()),
                    pa.array([n for _, n in spans], pa.int64()),
                ],
                ["package", "start", "size"],
            )


def _walk(package: Package, start: int, size: int, step: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Offsets and lengths of an archive's gzip members."""
    at, begun, unpacker = 0, 0, zlib.decompressobj(31)
    while at < size:
        data = package.range(start + at, min(step, size - at))
        at += len(data)
        while data:
            unpacker.decompress(data)
            data = unpacker.unused_data
            if unpacker.eof:
                end = at - len(data)
                yield begun, end - begun
                begun, unpacker = end, zlib.decompressobj(31)
    if begun < size:
        raise ValueError("the archive ends within a record")


def _walk_plain(package: Package, start: int, size: int, step: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """Offsets and lengths of the records of an archive without compression."""
    at = 0
    while at < size:
        head, end = b"", -1
        while end < 0:
            more = package.range(start + at + len(head), min(step, size - at - len(head)))
            if not more:
                raise ValueError("the archive ends within a record")
            head += more
            end = head.find(b"\r\n\r\n")
        length = re.search(rb"\r\ncontent-length:[ \t]*(\d+)", head[: end + 2], re.IGNORECASE)
        if length is None:
            raise ValueError("a record without a length")
        n = end + 4 + int(length[1]) + 4  # two line ends follow each record
        if at + n > size:
            raise ValueError("the archive ends within a record")
        yield at, n
        at += n


_RECORDS = (
    "page_id long, record_id string, url string, record_type string, refers_to long, refers_to_id string, digest string, payload binary"
)
_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]


def stated_sha1(field: str | None) -> str | None:
    """The SHA-1 that a digest field states, as lower-case hex."""
    kind, _, value = (field or "").partition(":")
    if kind.lower().replace("-", "") != "sha1":
        return None
    if re.fullmatch(r"[0-9A-Fa-f]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch(r"[A-Za-z2-7]{32}", value) else None


def _dechunked(body: bytes) -> bytes | None:
    """The content of a body in HTTP chunks; None if it is not in that form."""
    out, at = [], 0
    while True:
        size = re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r\n").match(body, at)
        if size is None:
            return None
        n, at = int(size[1], 16), size.end()
        if n == 0:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(body[at : at + n])
        at += n + 2


def page_record(data: bytes) -> tuple | None:
    """The columns of a record of a page, from its decompressed bytes; None for a record of another kind."""
    fields, body = parse_record(data)
    kind = fields.get("warc-type", "").lower()
    if kind not in PAGE_KINDS:
        return None
    stated = stated_sha1(fields.get("warc-payload-digest"))
    payload = None
    if kind != "revisit":
        payload = body
        if fields.get("content-type", "").lower().startswith("application/http"):
            payload = body.partition(b"\r\n\r\n")[2]
        digest = hashlib.sha1(payload).hexdigest()
        if stated not in (None, digest):
            payload = _dechunked(payload)
            if payload is None or hashlib.sha1(payload).hexdigest() != stated:
                raise ValueError(f"payload and digest differ in {fields.get('warc-record-id')}")
        stated = stated or digest
    own, uri = fields.get("warc-record-id"), fields.get("warc-target-uri", "")
    url = unquote(uri) if _OWN.fullmatch(own or "") else uri.removeprefix("<").removesuffix(">")
    to = fields.get("warc-refers-to")
    return _page(own), own, url, kind, _page(to), to, stated, payload


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, file = None, None

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), _KINDS, strict=True)],
            [c.split(" ")[0] for c in _RECORDS.split(", ")],
        )

    for b in batches:
        out, held = [], 0
        for path, start, size in zip(*(b.column(c).to_pylist() for c in ("package", "start", "size")), strict=True):
            if path != name:
                if file is not None:
                    file.close()
                fs, where = _open(path)
                name, file = path, fs.open_input_file(where)
            data = file.read_at(size, start)
            found = page_record(zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data)
            if found is not None:
                out.append(found)
                held += len(found[-1] or b"")
            if held >= HELD_BYTES:
                yield rows(out)
                out, held = [], 0
        if out:
            yield rows(out)
    if file is not None:
        file.close()


# ids that this module writes
_OWN = re.compile(r"<urn:page:(-?\d*)>")


def _page(record_id: str | None) -> int | None:
    found = _OWN.fullmatch(record_id or "")
    return int(found[1]) if found and found[1] else None


def read_records(packages: DataFrame) -> DataFrame:
    """Records of the packages in the column ``package``; a revisit has no payload of its own."""
    spark = packages.sparkSession
    tune(spark)
    spans = materialise(packages.select("package").mapInArrow(_locate, "package string, start long, size long"), "spans")
    stored = spans.agg(F.sum("size")).first()[0] or 0
    # small chunks of neighbouring records, so that tasks hold about equal bytes; adaptive execution does not join them
    chunk = F.floor(F.col("start") / CHUNK_BYTES)
    dealt = spans.repartition(max(1, -(-stored // READ_BYTES)), "package", chunk)
    return dealt.sortWithinPartitions("package", "start").mapInArrow(_read, _RECORDS)


def digests(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to``; a revisit has its response's payload."""
    return record_digests(records).drop("record_id", "refers_to_id")


def record_digests(records: DataFrame) -> DataFrame:
    """The columns of ``digests`` and the ids of the records, for packages of other writers."""
    size = F.octet_length("payload").cast("long").alias("size")
    rows = materialise(records.select("page_id", "record_id", size, "digest", "record_type", "refers_to", "refers_to_id"), "records")
    responses = rows.filter("record_type != 'revisit'").groupBy(F.col("record_id").alias("to"), F.col("digest").alias("to_digest"))
    sizes = responses.agg(F.max("size").alias("to_size"))
    same = (F.col("refers_to_id") == F.col("to")) & (F.col("digest") == F.col("to_digest"))
    return rows.join(sizes, same, "left").select(
        "page_id", F.coalesce("size", "to_size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", "refers_to", "record_id", "refers_to_id",
    )


def package_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "packages")
