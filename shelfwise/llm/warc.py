"""WARC archives of Zstandard frames with a shared dictionary.

Each archive begins with a skippable frame that holds the dictionary, then has
one frame per record, so a record can be decoded alone.  Of pages with equal
payloads the one of the smallest id is a ``response`` record with the payload;
the others are ``revisit`` records that carry its headers and refer to it.
The reader loads the dictionary, decodes frame by frame and checks versions,
headers, lengths, digests and checksums.  Tasks write archives of bounded size;
the manifest, committed by Spark, names those that count.

The dictionary is trained on ``SAMPLES`` pages at most, ``SAMPLE_BYTES`` of
each; it only affects the size.

Defined results: a null payload is empty; a null URL has no target header, and
line ends in URLs are percent-encoded; pages equal in id and payload are all
responses or all revisits; if all ids of a payload are null, those pages are
responses; an empty table gives no archives.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import struct

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import run_dir

from . import common

SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 512, 16_384, 65_536
BYTES_PER_FILE = 64 << 20
MAX_BROADCAST_ROWS = 100_000
LEVEL = 6
#: fixed by the formats: a skippable frame's magic number and a frame's
DICTIONARY_FRAME, FRAME = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = 1 << 16


class WarcError(ValueError):
    """An archive that doesn't keep to its format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- dictionary --------------------------------------------------------------------
def train_dictionary(pages: DataFrame) -> bytes:
    """Dictionary from a bounded sample of pages (by hash of id and URL);
    empty if there is too little to train on."""
    import zstandard

    keys = common.hash_sample(pages.where("html <> ''").select("page_id", "url"), ["page_id", "url"], SAMPLES)
    keys = keys.distinct().withColumnsRenamed({"page_id": "_id", "url": "_url"})
    rows = (pages.where("html <> ''").join(F.broadcast(keys), F.col("page_id").eqNullSafe(F.col("_id")) & F.col("url").eqNullSafe(F.col("_url")))
            .groupBy("page_id", "url").agg(F.min(F.substring(F.col("html").cast("binary"), 1, SAMPLE_BYTES)).alias("s"))
            .orderBy("page_id", "url").select("s").collect())
    samples = [bytes(r.s) for r in rows]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8)), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


@functools.cache
def _compressor(dictionary: bytes):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True, write_content_size=True)


# --- records -----------------------------------------------------------------------
def _headers(fields: list[tuple[str, str | None]]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + _headers(
        [("Content-Length", str(len(payload)))]) + b"\r\n"
    block = http if revisit else http + payload
    target = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    name = hashlib.sha256(f"{page_id}\n{url}\n{revisit}\n".encode("utf-8", "surrogatepass") + payload).hexdigest()[:32]
    head = _headers([
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Profile", PROFILE if revisit else None), ("X-Page-ID", None if page_id is None else str(page_id)),
        ("X-Refers-To-Page-ID", str(refers_to) if revisit and refers_to is not None else None),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _parse_headers(data: bytes, at: int, what: str) -> tuple[dict[str, str], int]:
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise WarcError(f"{what} without end")
    fields: dict[str, str] = {}
    for line in data[at:end].split(b"\r\n") if end > at else []:
        key, colon, value = line.partition(b":")
        if not colon or not key or key != key.strip():
            raise WarcError(f"{what}: bad line {line[:60]!r}")
        fields[key.decode().lower()] = value.strip().decode("utf-8", "surrogatepass")
    return fields, end + 4


def _length(fields: dict[str, str], what: str) -> int:
    value = fields.get("content-length", "")
    if not value.isdigit():
        raise WarcError(f"{what} without length")
    return int(value)


def parse_record(data: bytes) -> dict:
    """Fields of one record, checked: type, headers, payload (None of a
    revisit), payload_bytes, payload_digest."""
    if not data.startswith(VERSION + b"\r\n"):
        raise WarcError("not a WARC record")
    head, at = _parse_headers(data, len(VERSION) + 2, "record header")
    for key in ("warc-type", "warc-record-id", "warc-date", "warc-payload-digest"):
        if key not in head:
            raise WarcError(f"record without {key}")
    if head["warc-type"] not in ("response", "revisit"):
        raise WarcError(f"unknown type {head['warc-type']}")
    size = _length(head, "record")
    if len(data) != at + size + 4 or data[at + size:] != b"\r\n\r\n":
        raise WarcError("record length doesn't match")
    block = data[at:at + size]
    status, _, _ = block.partition(b"\r\n")
    if not status.startswith(b"HTTP/"):
        raise WarcError("block is no HTTP response")
    http, body = _parse_headers(block, len(status) + 2, "HTTP header")
    payload_bytes, revisit = _length(http, "payload"), head["warc-type"] == "revisit"
    kind, _, check = head["warc-payload-digest"].partition(":")
    if kind != "sha1" or len(check) != 32:
        raise WarcError("unknown digest")
    payload = None if revisit else block[body:]
    if len(block) - body != (0 if revisit else payload_bytes):
        raise WarcError("payload length doesn't match")
    if payload is not None and digest(payload) != check:
        raise WarcError("payload digest doesn't match")
    number = lambda k: int(head[k]) if k in head else None
    return {"type": head["warc-type"], "headers": head, "page_id": number("x-page-id"), "payload": payload,
            "refers_to": number("x-refers-to-page-id"), "payload_bytes": payload_bytes, "payload_digest": check}


# --- archives ----------------------------------------------------------------------
def archive_chunks(records, dictionary: bytes):
    """Bytes of an archive: the dictionary's frame, then a frame per record."""
    if dictionary:
        yield struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary
    compress = _compressor(dictionary).compress
    for data in records:
        yield compress(data)


def read_archive(file):
    """Yield the checked records of an open archive, a frame at a time."""
    import zstandard

    known, held, first = None, file.read(8), True
    while held:
        if len(held) < 8:
            held += file.read(READ)
        if len(held) < 8:
            raise WarcError("archive is cut off")
        magic, size = struct.unpack_from("<II", held)
        if 0x184D2A50 <= magic <= 0x184D2A5F:  # skippable
            while len(held) < 8 + size and (more := file.read(max(READ, 8 + size - len(held)))):
                held += more
            if len(held) < 8 + size:
                raise WarcError("dictionary is cut off")
            if magic == DICTIONARY_FRAME:
                if not first:
                    raise WarcError("dictionary isn't first")
                body = held[8:8 + size]
                if body[:4] == struct.pack("<I", FRAME):  # it may be compressed itself
                    body = zstandard.ZstdDecompressor().decompress(body)
                known = zstandard.ZstdCompressionDict(body)
            held = held[8 + size:] or file.read(READ)
        elif magic == FRAME:
            one = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
            parts = []
            try:
                while not one.eof:
                    held = held or file.read(READ)
                    if not held:
                        raise WarcError("frame is cut off")
                    parts.append(one.decompress(held))
                    held = one.unused_data if one.eof else b""
            except zstandard.ZstdError as error:
                raise WarcError(f"damaged frame: {error}") from error
            yield parse_record(b"".join(parts))
            held = held or file.read(READ)
        else:
            raise WarcError(f"unknown frame {magic:#x}")
        first = False


MANIFEST = "file string, bytes long, records long"


def write_archives(pages: DataFrame, folder: str, date: str, bytes_per_file: int = BYTES_PER_FILE) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives below ``folder``;
    returns the stored manifest, one row per archive."""
    common.small_batches(pages.sparkSession)
    dictionary = train_dictionary(pages)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    keys = ["sha1", "n", "xx"]
    rows = rows.select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("n"), F.xxhash64("payload").alias("xx"))
    # only payloads that occur on several pages need a look-up
    repeated = (rows.groupBy(*keys).agg(F.min("page_id").alias("first"), F.count("*").alias("pages"))
                .where("pages > 1").drop("pages").withColumnsRenamed({k: f"_{k}" for k in keys}))
    repeated = common.broadcast_if_small(common.stored(repeated, "warc-repeated"), MAX_BROADCAST_ROWS)
    same = functools.reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys])
    rows = rows.join(repeated, same, "left").select(
        "page_id", "url", "payload", "first",
        (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"))

    def write(batches):
        pages_ = (x for rows in batches for x in zip(*(rows[c] for c in ("page_id", "url", "payload", "first", "revisit")), strict=True))
        for first in pages_:
            n = 0

            def some():
                nonlocal n
                size = 0
                for page_id, url, body, original, revisit in itertools.chain([first], pages_):
                    n += 1
                    size += len(body)
                    as_int = lambda x: None if pd.isna(x) else int(x)
                    yield record(as_int(page_id), url, body, as_int(original), bool(revisit), date)
                    if size >= bytes_per_file:
                        return
            name, size = common.write_file(folder, "pages.warc.zst", archive_chunks(some(), dictionary))
            yield pd.DataFrame({"file": [name], "bytes": [size], "records": [n]})

    return common.stored(rows.mapInPandas(write, MANIFEST), "warc-manifest")


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives of ``manifest``."""
    def read(batches):
        for rows in batches:
            for name, expected in zip(rows["file"], rows["records"], strict=True):
                files, path = common.shared_file_system(folder)
                with files.open_input_stream(f"{path}/{name}") as file:
                    found, n = read_archive(file), 0
                    while some := list(itertools.islice(found, 1000)):
                        n += len(some)
                        yield pd.DataFrame({
                            "page_id": pd.array([r["page_id"] for r in some], "Int64"),
                            "payload_bytes": [r["payload_bytes"] for r in some],
                            "payload_digest": [r["payload_digest"] for r in some],
                            "record_type": [r["type"] for r in some],
                            "refers_to": pd.array([r["refers_to"] for r in some], "Int64")})
                if n != expected:
                    raise WarcError(f"{name} has {n} records, not {expected}")

    return manifest.repartition(max(1, manifest.count()), "file").mapInPandas(read, RECORDS)


def archive_table(pages: DataFrame, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    folder = run_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, date), folder)
