"""WARC archives: one gzip member a record, written and read through Spark's own file source.

Archives are written by the text sink as raw bytes. It puts a separator after each value; a gzip member ends with the
high byte of its length, which is zero below 16 MB, so that byte is the separator and the file is a plain
concatenation of members. A longer record is followed by an empty member, which does end with a zero.

They are read by the text source with the first bytes of a gzip header as the separator. Its tasks scan byte ranges for
that magic and own what starts inside their range. A piece is taken for a record only if its header decodes and the
text behind it starts like one; magic that compressed data hold by chance splits a member, so pieces are joined until
the member ends. Members cut by such magic at the end of a range are put together afterwards.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.llm.frames import split_by, stored
from tablegate.sources.shared import shared_folder

MAGIC = b"\x1f\x8b\x08"
#: Payloads shorter than this are always written out.
LEAST_BYTES = 0
_DATE = "2024-01-01T00:00:00Z"
_GZIP = 31
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page_of(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", re.sub(r"\s", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        *([] if refers_to is None else [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", _PROFILE)]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member that ends with a zero byte."""
    packer = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
    out = packer.compress(data) + packer.flush()
    return out if out[-1:] == b"\0" else out + member(b"")


@dataclass
class Record:
    fields: dict[str, str]
    http: dict[str, str]
    payload: bytes


def parse(data: bytes) -> Record:
    head, _, block = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = block[: int(fields["content-length"])].partition(b"\r\n\r\n")
    return Record(fields, _fields(http), payload)


def _fields(head: bytes) -> dict[str, str]:
    lines = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in lines}


class Joiner:
    """Puts pieces between magic together to members. ``lost`` holds pieces that continue something unseen."""

    def __init__(self) -> None:
        self.pieces: list[bytes] = []
        self.text: list[bytes] = []
        self.unpack = zlib.decompressobj(_GZIP)
        self.lost: list[bytes] = []

    def add(self, piece: bytes) -> bytes | None:
        """The text of the record that this piece ends, if it ends one."""
        fresh = not self.pieces
        try:
            text = self.unpack.decompress(MAGIC + piece)
            good = not fresh or not text or b"WARC/".startswith(text[:5]) or text.startswith(b"WARC/")
        except zlib.error:
            good = False
        if not good:
            self.lost += [*self.pieces, piece]
            self._reset()
            return None
        self.pieces.append(piece)
        self.text.append(text)
        if not self.unpack.eof:
            return None
        whole = b"".join(self.text)
        self._reset()
        return whole or None

    def _reset(self) -> None:
        self.pieces, self.text, self.unpack = [], [], zlib.decompressobj(_GZIP)


_COLUMNS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
_PARTS = "path string, block long, place long, starts boolean, piece binary"


def _row(data: bytes) -> tuple:
    """What is kept of a record. A payload that is there is digested anew."""
    r = parse(data)
    kind, stated = r.fields["warc-type"], r.fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and digest(r.payload) != stated:
        raise ValueError(f"{r.fields['warc-record-id']}: payload does not match its digest")
    size = len(r.payload) if kind == "response" else int(r.http["content-length"])
    refers = _page_of(r.fields.get("warc-refers-to"))
    return _page_of(r.fields["warc-record-id"]), size, stated, kind, refers, r.fields["warc-target-uri"]


def _batch(rows: list[tuple], parts: list[tuple]) -> pa.RecordBatch:
    named = [x.split() for x in f"{_COLUMNS}, {_PARTS}".split(", ")]
    kinds, names = [_ARROW[kind] for _, kind in named], [name for name, _ in named]
    every = [(*r, None, None, None, None, None) for r in rows] + [(None,) * 6 + p for p in parts]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in every], t) for k, t in enumerate(kinds)], names)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each byte range, and the pieces that belong to a record of another range."""
    at, joiner, parts = None, Joiner(), []

    def close() -> list[tuple]:
        if at is None:
            return []
        out = [(*at, k, False, p) for k, p in enumerate(joiner.lost)]
        return out + [(*at, len(out) + k, k == 0, p) for k, p in enumerate(joiner.pieces)]

    for batch in batches:
        rows, parts = [], []
        columns = (batch.column(k).to_pylist() for k in ("path", "block", "piece"))
        for path, block, piece in zip(*columns, strict=True):
            if (path, block) != at:
                parts += close()
                at, joiner = (path, block), Joiner()
                if block == 0:  # what stands before the first magic of a file
                    if piece:
                        raise ValueError(f"{path}: bytes that belong to no record")
                    continue
            if (text := joiner.add(piece)) is not None:
                rows.append(_row(text))
        yield _batch(rows, parts)
    yield _batch([], close())


def _mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records from the left-over pieces of each file, in order."""
    for file in split_by(batches, ["path"]):
        joiner, rows = Joiner(), []
        for starts, piece in zip(file.column("starts").to_pylist(), file.column("piece").to_pylist(), strict=True):
            if starts and joiner.pieces:
                raise ValueError(f"{file.column('path')[0]}: a record does not end")
            if (text := joiner.add(piece)) is not None:
                rows.append(_row(text))
        if joiner.pieces or joiner.lost:
            raise ValueError(f"{file.column('path')[0]}: bytes that belong to no record")
        yield _batch(rows, [])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    Raises if a record is cut off, matches no digest, or bytes belong to no record. An empty folder has no records.
    """
    separator = MAGIC.decode("latin-1")
    text = spark.read.option("lineSep", separator).option("encoding", "ISO-8859-1").text(path)
    where = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
    pieces = text.select(*where, F.col("value").cast("binary").alias("piece"))
    scanned = stored(pieces.mapInArrow(_scan, f"{_COLUMNS}, {_PARTS}"))
    left = scanned.where("path is not null").select("path", "block", "place", "starts", "piece")
    left = left.repartition("path").sortWithinPartitions("path", "block", "place")
    names = [x.split()[0] for x in _COLUMNS.split(", ")]
    mended = left.mapInArrow(_mend, f"{_COLUMNS}, {_PARTS}").select(*names)
    return scanned.where("path is null").select(*names).union(mended)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(k).to_pylist() for k in ("page_id", "url", "html", "refers_to")), strict=True)
        out = [member(record(i, url, (html or "").encode(), to))[:-1] for i, url, html, to in rows]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])


def write(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Pages (page_id, url, html) as archives in a new folder.

    Of pages with equal payloads of ``least_bytes`` or more, the one with the largest page_id is a response and the
    others revisit it. A null html is an empty payload. A page with a null page_id is always a response and revisited
    by none; of repeated rows with the largest page_id each is a response.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("key", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    known = pages.where((F.col("size") >= least_bytes) & F.col("page_id").isNotNull()).select("key", "size", "page_id")
    groups = known.groupBy("key", "size").agg(F.max("page_id").alias("response"), F.count("*").alias("copies"))
    groups = groups.where("copies > 1").drop("copies")
    refers_to = F.when(F.col("page_id") < F.col("response"), F.col("response")).alias("refers_to")
    rows = pages.join(groups, ["key", "size"], "left").select("page_id", "url", "html", refers_to)
    raw = rows.mapInArrow(_members, "member binary").select(F.col("member").cast("string").alias("value"))
    raw.write.option("lineSep", "\0").text(path)


def archived(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages written to archives in the shared folder and read back, one row for each page. See ``write``."""
    path = shared_folder(pages.sparkSession)
    write(pages, path, least_bytes)
    return read(pages.sparkSession, path)
