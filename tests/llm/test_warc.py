"""Archives: round trips, revisits, and damage that must be noticed."""

import io
import struct

import pytest
import zstandard

from shelfwise.llm import warc

DATE = "2020-01-01T00:00:00Z"
PAYLOADS = [b"", b"<p>one</p>" * 50, "é🙂\r\n\r\nWARC/1.1\r\n".encode(), b"x" * 300_000]


def archive(dictionary=b"", payloads=PAYLOADS):
    records = [warc.record(i, f"http://h/{i}\r\nX: y", p, None, False, DATE) for i, p in enumerate(payloads)]
    return b"".join(warc.archive_chunks(records, dictionary))


def trained():
    samples = [f"<html><title>page {i}</title><body>{i * 7}</body></html>".encode() * 3 for i in range(400)]
    return zstandard.train_dictionary(2048, samples).as_bytes()


@pytest.mark.parametrize("dictionary", [b"", trained()])
def test_round_trip(dictionary):
    data = archive(dictionary)
    if dictionary:
        assert struct.unpack_from("<II", data) == (0x184D2A5D, len(dictionary))
    got = list(warc.read_archive(io.BytesIO(data)))
    assert [r["payload"] for r in got] == PAYLOADS and [r["page_id"] for r in got] == [0, 1, 2, 3]
    assert got[1]["headers"]["warc-target-uri"] == "http://h/1%0D%0AX: y"


def test_compressed_dictionary():
    d = trained()
    packed = zstandard.compress(d)
    data = struct.pack("<II", 0x184D2A5D, len(packed)) + packed + archive(d)[8 + len(d):]
    assert len(list(warc.read_archive(io.BytesIO(data)))) == len(PAYLOADS)


def frame(record):
    return zstandard.ZstdCompressor(write_checksum=True).compress(record)


def test_damage():
    good = warc.record(1, "u", b"hello", None, False, DATE)
    assert warc.parse_record(good)["payload"] == b"hello"
    for bad in (good[:-1], good + b"x", good.replace(b"hello", b"hellp"), good.replace(b"WARC/1.1", b"WARC/9.9"),
                good.replace(b"Content-Length: 5", b"Content-Length: 6"), good.replace(b"WARC-Date", b"WARC-Dote"),
                good.replace(b"WARC-Type: response", b"WARC-Type: odd"), good.replace(b"sha1:", b"md5x:"),
                good.replace(b"WARC-Date: ", b"WARC-Date ").replace(b"2020-01-01T00:00:00Z", b"now")):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(io.BytesIO(frame(bad))))
    whole = archive(trained())
    for cut in (3, 7, 100, len(whole) - 1, len(whole) - 100):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(io.BytesIO(whole[:cut])))
    flipped = bytearray(whole)
    flipped[-2] ^= 1
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(io.BytesIO(bytes(flipped))))


def plain(rows):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if i is not None and (p not in first or i < first[p]):
            first[p] = i
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        revisit = p in first and first[p] != i
        out.append((i, len(p), warc.digest(p), "revisit" if revisit else "response", first[p] if revisit else None))
    return out


@pytest.mark.parametrize("per_file", [1, 500, 1 << 26])
def test_table(spark, monkeypatch, per_file):
    rows = [(i, f"http://h/{i}", ["same", None, "", f"own {i} " * 20][i % 4]) for i in range(80)]
    rows += [(5, "http://h/5", None), (None, None, "same"), (None, "u", "lonely"), (-4, "u\nv", "same")]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, first int").repartition(3)
    folder = warc.run_dir(spark, "w")
    manifest = warc.write_archives(pages, folder, DATE, per_file)
    got = [tuple(x) for x in warc.read_archives(manifest, folder).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_empty(spark):
    assert warc.archive_table(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
