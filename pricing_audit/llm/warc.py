"""WARC archives of pages: writing with revisit records, and a reader that salvages damaged files.

Writing: pages with the same payload (of at least ``MIN_REVISIT`` bytes) are stored once; the others
become revisit records that name it. Every record is a gzip member of its own (or plain), carries
SHA-256 digests of block and payload, and is written where its row lies.

Reading: a record counts when its member decodes, its header parses, its length is followed by the
record end, and its digests agree. When a check fails the reader searches for the next member that
decodes to a version line (or, in plain files, the next version line whose record passes), goes on
from there, and logs the bytes in between as a quarantined gap. Within a member that holds many records
the search goes on at the next version line, and of a member that breaks off or does not inflate to its
end the records before the damage are kept. Files and members are read in windows, so memory holds one
record, not the file.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import stage
from .common import ship_code, sized_join, whole_text
from .exact_stream import located
from .files import new_file, open_read, open_write

MIN_REVISIT = 100
FILE_BYTES = 64 << 20
WINDOW = 1 << 18
INFLATE_STEP = 1 << 20  # bytes inflated at a time
HELD = 1 << 22  # a member that inflates to more is inflated again instead of being held
MARKS = 32  # places of a large member from which inflating can go on
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/\d\.\d\r\n")
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space
FILES = "path string, records long, bytes long"
RECORDS = (
    "path string, offset long, length long, record_type string, record_id string, page_id long,"
    " url string, payload_bytes long, payload_digest string, refers_to long, payload binary,"
    " gap string"
)
_ARROW = pa.schema(
    [
        ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
        ("record_type", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()),
        ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("refers_to", pa.int64()), ("payload", pa.binary()), ("gap", pa.string()),
    ]
)


def _one_line(text: str) -> str:
    """Control characters percent-encoded, so that a value can't end its header line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(
    kind: str, record_id: str, payload: bytes, *, page_id: int | None = None, url: str | None = None,
    refers_to: str | None = None, refers_to_page: int | None = None, date: str = "2000-01-01T00:00:00Z",
) -> bytes:
    """One uncompressed record. A revisit keeps the HTTP header, whose Content-Length still tells
    the payload's size, and leaves the payload out."""
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % len(payload)
    )
    if kind == "response":
        block += payload
    head = [
        ("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else _one_line(url)),
        ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(payload).hexdigest()}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Profile", PROFILE if kind == "revisit" else None), ("WARC-Refers-To", refers_to),
        ("X-Page-ID", page_id), ("X-Refers-To-Page-ID", refers_to_page),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block)),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + END


def _id(file: str, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{file}#{row}')}>"


def write_archives(pages: DataFrame, folder: str, compress: bool = True) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); one row per finished file.

    A null html is an empty payload, a null page_id or url leaves its header out. Of equal payloads
    the smallest page_id is the response, null ids last; of repeated rows exactly one is. Empty input
    writes nothing. Other columns are not read.
    """
    ship_code(pages.sparkSession)
    rows = located(pages.select("page_id", "url", "html")).select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), whole_text("html").alias("html"),
        "__file", "__row",
    ).withColumn("digest", F.unhex(F.sha2("html", 256)))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "__file", "__row"))
    same = stage(
        rows.filter(F.octet_length("html") >= MIN_REVISIT)
        .groupBy(F.col("digest").alias("same")).agg(F.count("*").alias("n"), first.alias("first"))
        .filter("n > 1").select("same", "first"),
        "same-payload",
    )
    matched = sized_join(rows, same, [F.col("digest") == F.col("same")], "left").select(
        "page_id", "url", "html", "__file", "__row",
        F.expr("same is not null and not (first.__file = __file and first.__row = __row)").alias("again"),
        F.col("first.__file").alias("file0"), F.col("first.__row").alias("row0"),
        F.col("first.page_id").alias("page0"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done, n, size = None, [], 0, 0
        path = ""
        for batch in batches:
            for page_id, url, html, file, row, again, file0, row0, page0 in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                made = record(
                    "revisit" if again else "response", _id(file, row), html.encode(),
                    page_id=page_id, url=url,
                    refers_to=_id(file0, row0) if again else None,
                    refers_to_page=page0 if again else None,
                )
                if compress:
                    member = zlib.compressobj(6, zlib.DEFLATED, 31)
                    made = member.compress(made) + member.flush()
                if out is None:
                    path = new_file(folder, "pages", ".warc.gz" if compress else ".warc")
                    out = open_write(path)
                out.write(made)
                n, size = n + 1, size + len(made)
                if size >= FILE_BYTES:
                    out.close()
                    done.append((path, n, size))
                    out, n, size = None, 0, 0
        if out is not None:
            out.close()
            done.append((path, n, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            ["path", "records", "bytes"],
        )

    return stage(matched.mapInArrow(write, FILES), "archives")


class _Window:
    """Random access to a file through one buffered window."""

    def __init__(self, source):
        self._source, self.size = source, source.size()
        self._at, self._held = 0, b""
        self._looked, self._end = 1, 0

    def read(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if not (self._at <= at and at + n <= self._at + len(self._held)):
            self._at = at
            self._held = self._source.read_at(min(max(n, WINDOW), self.size - at), at)
        return self._held[at - self._at : at - self._at + n]

    def find(self, what: re.Pattern | bytes, at: int, overlap: int = 16) -> int:
        """Where ``what`` next begins at or behind ``at``; -1 if nowhere."""
        while at < self.size:
            part = self.read(at, WINDOW)
            if isinstance(what, bytes):
                hit = part.find(what)
            else:
                hit = m.start() if (m := what.search(part)) else -1
            if hit >= 0:
                return at + hit
            if at + len(part) >= self.size:
                return -1
            at += max(len(part) - overlap, 1)
        return -1

    def end(self, at: int) -> int:
        """Where ``END`` next begins at or behind ``at``; -1 if nowhere. One search serves all places up to
        its hit, so many false starts before one end cost no more than one."""
        if not (self._looked <= at and (self._end < 0 or at <= self._end)):
            self._looked, self._end = at, self.find(END, at, 3)
        return self._end


@dataclass
class Record:
    offset: int
    length: int
    head: dict[str, str]
    payload: bytes


class Damage(Exception):
    pass


def _header(text: bytes) -> dict[str, str]:
    lines = text.split(b"\r\n")
    if not VERSION.match(lines[0] + b"\r\n"):
        raise Damage("no version line")
    head = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header line")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdigit():
        raise Damage("content length")
    return head


def _checked(head: dict[str, str], block: bytes) -> bytes:
    """The payload of a block whose digests agree."""
    stated = head.get("warc-block-digest", "")
    if stated.startswith("sha256:") and stated[7:] != hashlib.sha256(block).hexdigest():
        raise Damage("block digest")
    payload = block
    if head.get("content-type", "").startswith("application/http"):
        top, _, payload = block.partition(END)
        length = re.search(rb"(?im)^content-length:\s*(\d+)", top)
        head["http-length"] = length[1].decode() if length else str(len(payload))
    stated = head.get("warc-payload-digest", "")
    if (
        head.get("warc-type") != "revisit" and stated.startswith("sha256:")
        and stated[7:] != hashlib.sha256(payload).hexdigest()
    ):
        raise Damage("payload digest")
    return payload


def _plain_record(window: _Window, at: int) -> Record:
    stop = window.end(at)
    if stop < 0:
        raise Damage("header end")
    if stop - at > WINDOW:  # what is no header shows before all of it is read
        version, *lines = window.read(at, WINDOW).split(b"\r\n")[:-1] or [None]
        if version is not None and not VERSION.match(version + b"\r\n"):
            raise Damage("no version line")
        if not all(b":" in line for line in lines):
            raise Damage("header line")
    head = _header(window.read(at, stop - at))
    begin, n = stop + len(END), int(head["content-length"])
    if begin + n + len(END) > window.size:
        raise Damage("cut short")
    block = window.read(begin, n)
    if window.read(begin + n, len(END)) != END:
        raise Damage("record end")
    return Record(at, begin + n + len(END) - at, head, _checked(head, block))


class _Bytes:
    def __init__(self, data: bytes):
        self._data = data

    def size(self) -> int:
        return len(self._data)

    def read_at(self, n: int, at: int) -> bytes:
        return self._data[at : at + n]


def _before_error(state, piece: bytes) -> bytes:
    """What ``piece`` inflates to up to the byte that is in error."""
    parts = []
    for step in (4096, 1):
        while True:
            last = state.copy()
            try:
                parts.append(state.decompress(piece, step))
            except zlib.error:
                state = last
                break
            piece = state.unconsumed_tail
    return b"".join(parts)


def _inflate(window: _Window, pos: int, state) -> Iterator[tuple[bytes, int]]:
    """The bytes inflated from ``pos`` on, part by part, and the place in the file reached with each.
    Damage is raised behind the last byte that could be had."""
    while not state.eof:
        piece = window.read(pos, WINDOW)
        last = state.copy()
        try:
            part = state.decompress(piece, INFLATE_STEP)
        except zlib.error as error:
            yield _before_error(last, piece), pos
            raise Damage(str(error)) from None
        if not piece and not part and not state.eof:
            raise Damage("cut short")
        pos += len(piece) - len(state.unused_data if state.eof else state.unconsumed_tail)
        yield part, pos


class _Inflated:
    """The inflated bytes of the member at ``at``, to be read through a window.

    A first pass finds their number, the member's length and what is wrong with it. Up to ``HELD`` bytes
    are kept; of more only states to go on from, ever wider apart, so memory is bounded.
    """

    def __init__(self, window: _Window, at: int):
        if window.read(at, len(MEMBER)) != MEMBER:
            raise Damage("no member")
        state = zlib.decompressobj(31)
        self._window, self._marks, apart = window, [(0, at, state.copy())], HELD
        self._total, self.error, pos, kept = 0, "", at, []
        try:
            for part, pos in _inflate(window, at, state):
                self._total += len(part)
                if self._total <= HELD:
                    kept.append(part)
                if self._total >= self._marks[-1][0] + apart and not state.eof:
                    self._marks.append((self._total, pos, state.copy()))
                    if len(self._marks) > MARKS:
                        self._marks, apart = self._marks[::2], 2 * apart
        except Damage as damage:
            self.error = str(damage)
        self.length = pos - at
        self._begin, self._part, self._rest = 0, b"".join(kept), iter(())
        if self._total > HELD:
            self._part, self._rest = b"", self._parts(self._marks[0])

    def _parts(self, mark: tuple) -> Iterator[bytes]:
        return (part for part, _ in _inflate(self._window, mark[1], mark[2].copy()))

    def _mark(self, at: int) -> tuple:
        return max((m for m in self._marks if m[0] <= at), key=lambda m: m[0])

    def size(self) -> int:
        return self._total

    def read_at(self, n: int, at: int) -> bytes:
        if self._total > HELD:
            mark = self._mark(at)
            if at < self._begin or mark[0] > self._begin + len(self._part):
                self._begin, self._part, self._rest = mark[0], b"", self._parts(mark)
        got = bytearray()
        while True:
            here = at + len(got) - self._begin
            got += self._part[here : here + n - len(got)]
            if len(got) == n:
                return bytes(got)
            self._begin += len(self._part)
            self._part = next(self._rest)

    def place(self, inner: int) -> int:
        """A place in the file close before the one where the first ``inner`` bytes are inflated."""
        reached, pos, state = self._mark(inner)
        state = state.copy()
        while reached < inner:
            piece = self._window.read(pos, 64)
            try:
                reached += len(state.decompress(piece))
            except zlib.error:
                break
            if not piece or reached >= inner:
                break
            pos += len(piece)
        return pos


def _plain_part(window: _Window, digests: bool) -> Iterator[Record | tuple[int, int, str]]:
    """The records of inflated bytes, and the gaps between them. With ``digests`` a record counts only
    if it states the digest of its block."""
    at, bad, why = 0, -1, ""
    while at < window.size:
        try:
            found = _plain_record(window, at)
            if digests and not found.head.get("warc-block-digest", "").startswith("sha256:"):
                raise Damage("no digest in a damaged member")
        except Damage as damage:
            if bad < 0:
                bad, why = at, str(damage)
            at = window.find(VERSION, at + 1)
            if at < 0:
                break
            continue
        if bad >= 0:
            yield bad, at - bad, why
            bad = -1
        at += found.length
        yield found
    if bad >= 0:
        yield bad, window.size - bad, why


def salvage(source) -> Iterator[Record | tuple[int, int, str]]:
    """The records of an archive, and (offset, length, reason) for every quarantined gap.

    ``source`` has size() and read_at(n, offset), as Arrow's input files do. Compressed and plain
    archives are told apart at each place, so damage at the very start does no harm. Empty files
    give nothing.

    Records and gaps within a member carry the member's place; the reason of such a gap ends with its
    place in the inflated bytes. A member that does not inflate to its end is one gap up to the next
    member or record, and its reason tells how many records were saved from it: those that state a block
    digest and agree with it. A member without any good record is a gap.
    """
    window = _Window(source)
    at, bad, why = 0, -1, ""
    while at < window.size:
        resume = at + 1
        try:
            if window.read(at, 2) != MEMBER[:2]:
                one = _plain_record(window, at)
                if bad >= 0:
                    yield bad, at - bad, why
                    bad = -1
                yield one
                at += one.length
                continue
            member = _Inflated(window, at)
            saved, early, end = 0, None, 0
            for found in _plain_part(_Window(member), bool(member.error)):
                if isinstance(found, tuple):
                    begin, length, reason = found
                    gap = at, member.length, f"{reason} (inflated bytes {begin} to {begin + length})"
                    if not saved:
                        early = gap if found[1] < member.size() else (at, member.length, reason)
                    elif not member.error:
                        yield gap
                    continue
                if not saved and bad >= 0:
                    yield bad, at - bad, why
                    bad = -1
                if not saved and early and not member.error:
                    yield early
                saved, end = saved + 1, found.offset + found.length
                found.offset, found.length = at, member.length
                yield found
            if member.error and saved:
                resume = max(resume, member.place(end))
                raise Damage(f"{member.error} ({saved} records saved)")
            if not saved:
                raise Damage(member.error or (early[2] if early else "empty member"))
            at += member.length
        except Damage as damage:
            if bad < 0:
                bad, why = at, str(damage)
            nexts = [p for p in (window.find(MEMBER, resume), window.find(VERSION, resume)) if p >= 0]
            at = min(nexts, default=window.size)
    if bad >= 0:
        yield bad, window.size - bad, why


def _number(value: str | None) -> int | None:
    if value is None or not re.fullmatch(r"-?[0-9]{1,19}", value):
        return None
    return n if -(1 << 63) <= (n := int(value)) < 1 << 63 else None


def read_archives(files: DataFrame, payloads: bool = True, complete: bool = False) -> DataFrame:
    """All records of the archives named by ``files.path``, and a row with ``gap`` set (its reason)
    and record_type null for every quarantined byte range.

    Digest and size are those of the full payload: computed for responses, taken from the checked
    headers for revisits. ``payloads=False`` leaves the payload column null. ``complete=True`` is for
    archives that must be whole: a gap, or another number of records than ``files.records``, is an error.
    """
    ship_code(files.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, stated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows, held, good = [], 0, 0
                with open_read(path) as source:
                    for found in salvage(source):
                        if isinstance(found, tuple):
                            at, length, why = found
                            if complete:
                                raise ValueError(f"{path}: {length} bytes at {at} can't be read: {why}")
                            rows.append({"path": path, "offset": at, "length": length, "gap": why})
                        else:
                            rows.append(_row(path, found, payloads))
                            good += 1
                            held += len(found.head.get("warc-target-uri", ""))
                            held += len(found.payload) if payloads else 0
                        if len(rows) >= 2000 or held >= 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _ARROW)
                            rows, held = [], 0
                if complete and good != stated:
                    raise ValueError(f"{path}: {good} records, not the {stated} written")
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

    paths = files.select("path", F.col("records") if complete else F.lit(None).cast("long").alias("records"))
    tasks = max(files.count(), 1)
    return paths.repartition(tasks).mapInArrow(read, RECORDS)


def _row(path: str, found: Record, payloads: bool) -> dict:
    head, payload = found.head, found.payload
    row = {
        "path": path, "offset": found.offset, "length": found.length,
        "record_type": head.get("warc-type"), "record_id": head.get("warc-record-id"),
        "page_id": _number(head.get("x-page-id")), "url": head.get("warc-target-uri"),
        "refers_to": _number(head.get("x-refers-to-page-id")),
    }
    if row["record_type"] == "revisit":
        row["payload_bytes"] = int(head.get("http-length", 0))
        row["payload_digest"] = head.get("warc-payload-digest", "").removeprefix("sha256:")
    else:
        row["payload_bytes"] = len(payload)
        row["payload_digest"] = hashlib.sha256(payload).hexdigest()
        row["payload"] = payload if payloads else None
    return row


def archive_table(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to new archives below the shared folder and read them back; one row per page.

    A record that can't be read back is an error, never a missing row. Nulls and repeated rows are taken
    as ``write_archives`` takes them; an empty table gives no rows.
    """
    folder = scratch_path(pages.sparkSession, "warc-data")
    return read_archives(write_archives(pages, folder), payloads=False, complete=True).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
