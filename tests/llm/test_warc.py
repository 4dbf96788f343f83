from __future__ import annotations

import base64
import hashlib
import io
import random
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from annofold.llm import warc
from annofold.llm.warc import archive_files, read_archives, with_referred, write_archives

DDL = "page_id long, url string, html string"
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def brute(rows, least=0):
    """The contract, row by row; of equal rows any may be the response."""
    told, first = [], {}
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = len(payload) >= least and payload in first
        told.append((page, len(payload), digest, "revisit" if again else "response", first[payload] if again else None))
        first.setdefault(payload, page)
    return sorted(told, key=repr)


def table(n=300, seed=1):
    rng = random.Random(seed)
    bodies = [None, "", " ", "é" * 40, "\r\n\r\nHTTP/1.1 200", "WARC/1.1\r\n\r\n", "x" * 300_000]
    bodies += [f"<html><head><title>{k}</title></head><body>{rng.random()} page number {k}</body></html>" * 3 for k in range(n // 2)]
    urls = [None, "", "http://a/b c", "http://a/\r\nX: y", "http://é/ü"]
    rows = [(k, rng.choice([*urls, f"http://h/{k}"]), rng.choice(bodies)) for k in range(n)]
    rows += [(n + k, f"http://hot/{k}", bodies[9]) for k in range(n // 2)]
    rng.shuffle(rows)
    return rows


def ran(df):
    return sorted((tuple(r) for r in with_referred(read_archives(df)).select(*COLUMNS).collect()), key=repr)


def test_round_trip(spark):
    rows = table()
    written = write_archives(spark.createDataFrame(rows, DDL).repartition(3))
    assert ran(written) == brute(rows)
    found = read_archives(written).collect()
    assert all(r.problem is None for r in found)
    html = {page: (h or "").encode() for page, _, h in rows}
    for r in found:
        assert r.record_type == "revisit" and r.payload is None or bytes(r.payload) == html[r.page_id]
    by_page = {r.page_id: r for r in found}
    assert by_page.keys() == html.keys()
    for page, url, _ in rows:
        said = by_page[page].target_uri
        assert (said is None) == (url is None) and "\n" not in (said or "") and "\r" not in (said or "")


def test_ties_nulls_and_small_payloads(spark):
    same = [(5, "u", "<p>a</p>"), (5, "v", "<p>a</p>"), (5, "u", "<p>a</p>"), (None, "u", "<p>a</p>"), (None, None, "<p>b</p>"), (None, None, "<p>b</p>"), (7, "w", None), (6, "w", "")]
    frame = spark.createDataFrame(same, DDL).repartition(4)
    assert ran(write_archives(frame)) == brute(same)
    assert ran(write_archives(frame, least=1)) == brute(same, 1)
    assert ran(write_archives(frame, least=9)) == brute(same, 9)


def test_clashing_names_empty_and_several_archives(spark, tmp_path):
    rows = table(60, 2)
    more = spark.createDataFrame(rows, DDL).withColumns({k: F.lit("x") for k in ("key", "mark", "first_page", "revisit", "times", "path", "copy_key")})
    written = write_archives(more, str(tmp_path / "a"), archive_bytes=2000, sample_bytes=2000)
    assert written.count() > 5 and written.agg(F.sum("records")).first()[0] == len(rows)
    assert ran(written) == brute(rows)
    assert ran(archive_files(spark, str(tmp_path / "a"))) == brute(rows)
    assert write_archives(more.limit(0)).count() == 0 and ran(written.limit(0)) == []


def test_form_of_an_archive(spark):
    rows = [(k, f"http://h/{k}", f"<html><body>text of page {k % 70}, and what all pages share: {'menu ' * 30}</body></html>") for k in range(200)]
    written = write_archives(spark.createDataFrame(rows, DDL).coalesce(1)).collect()
    assert len(written) == 1
    content = open(written[0].path.removeprefix("file://"), "rb").read()
    magic, size = struct.unpack("<II", content[:8])
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompressobj().decompress(content[8 : 8 + size]))
    assert dictionary.dict_id() != 0
    rest, n = content[8 + size :], 0
    while rest:
        assert zstandard.get_frame_parameters(rest).dict_id == dictionary.dict_id()
        frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        record = frame.decompress(rest)
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: ") and record.endswith(b"\r\n\r\n")
        rest, n = frame.unused_data, n + 1
    assert n == len(rows)
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(content[8 + size :])


def archive(*records, dictionary=None, raw=False):
    out = b""
    if dictionary:
        out = struct.pack("<II", warc.SKIPPABLE, len(dictionary)) + dictionary if raw else warc.dictionary_frame(dictionary)
    held = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor()
    return out + b"".join(held.compress(r) for r in records)


def good(page=1, payload=b"<p>body</p>"):
    return warc.build_record(page, "http://a/", payload, warc.record_id(page, "d"), None)


def test_problems_are_rows(spark, tmp_path):
    trained = warc.train_dictionary([f"<html>{k} and what all of them share, again and again".encode() * 20 for k in range(60)])
    assert trained
    long = good().replace(b"Content-Length: ", b"Content-Length: 1", 2)
    cases = {
        "whole": (archive(good(), good(2)), [None, None]),
        "dictionary": (archive(good(), good(2), dictionary=trained), [None, None]),
        "raw": (archive(good(), dictionary=trained, raw=True), [None]),
        "skipped": (archive(good()) + struct.pack("<II", 0x184D2A50, 3) + b"abc" + archive(good(2)), [None, None]),
        "empty": (b"", []),
        "two": (archive(good() + good(2), good(3)), ["stated length", None]),
        "length": (archive(long, good(2)), ["stated length", None]),
        "version": (archive(good().replace(b"WARC/1.1", b"WARC/9.1"), good(2)), ["version line", None]),
        "required": (archive(good().replace(b"WARC-Date", b"X-Date"), good(2)), ["no warc-date", None]),
        "field": (archive(good().replace(b"WARC-Date: ", b"WARC Date "), good(2)), ["not a header field", None]),
        "digest": (archive(good().replace(b"body", b"bodY"), good(2)), ["warc-block-digest", None]),
        "no end": (archive(b"WARC/1.1\r\nX: y", good(2)), ["no end", None]),
        "revisit": (archive(good().replace(b"Type: response", b"Type: revisit")), ["without warc-refers-to"]),
        "other": (archive(b"WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Record-ID: <a:b>\r\nWARC-Date: x\r\nFolded: a\r\n b\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"), [None]),
        "cut": (archive(good(), good(2))[:-6], [None, "cut off"]),
        "junk": (archive(good()) + b"not a frame at all", [None, "neither a frame"]),
        "short": (archive(good()) + b"abc", [None, "neither a frame"]),
        "head": (struct.pack("<II", warc.SKIPPABLE, 99) + b"x", ["dictionary's frame"]),
        "lost": (archive(good(), dictionary=trained)[8 + struct.unpack("<I", archive(good(), dictionary=trained)[4:8])[0] :], ["ictionary"]),
    }
    for name, (content, _) in cases.items():
        (tmp_path / f"{name}.warc.zst").write_bytes(content)
    by_name = {}
    for r in sorted(read_archives(archive_files(spark, str(tmp_path))).collect(), key=lambda r: r.frame):
        by_name.setdefault(r.path.rsplit("/", 1)[1].removesuffix(".warc.zst").replace("%20", " "), []).append(r.problem)
    for name, (_, want) in cases.items():
        told = by_name.get(name, [])
        assert len(told) == len(want), (name, told)
        for t, w in zip(told, want, strict=True):
            assert t is None and w is None or w is not None and w in t, (name, told)
    with pytest.raises(Exception, match="cut off"):
        with_referred(read_archives(archive_files(spark, str(tmp_path / "cut.warc.zst")))).collect()


def test_a_frame_longer_than_what_is_read_at_once():
    rng = random.Random(1)
    noise = bytes(rng.randrange(33, 127) for _ in range(400_000)) * 3
    records = [good(1, noise), good(2), good(3, noise[::-1])]
    got = list(warc.frames(io.BytesIO(archive(*records))))
    assert [c for _, c in got] == records


def test_a_revisit_of_nothing_fails(spark, tmp_path):
    record = warc.build_record(3, "u", b"x", "<a:b>", "<a:c>")
    (tmp_path / "r.warc.zst").write_bytes(archive(record))
    with pytest.raises(Exception, match="no such response"):
        with_referred(read_archives(archive_files(spark, str(tmp_path)))).collect()
