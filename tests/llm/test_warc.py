from __future__ import annotations

import base64
import glob
import hashlib

import zstandard

from lorekiln.llm import warc

SCHEMA = "page_id long, url string, html string, digest string"


def brute_force(rows, least=0):
    newest = {}
    for k, (page, _, html, _) in enumerate(rows):
        own = (page is not None, page or 0, k)
        newest[html or ""] = max(own, newest.get(html or "", own))
    out = []
    for k, (page, _, html, _) in enumerate(rows):
        data = (html or "").encode()
        named, response, at = newest[html or ""]
        revisit = len(data) >= least and k != at
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if revisit else "response", response if revisit and named else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a", "<p>same</p>", "d"), (7, "http://b", "<p>same</p>", "d"), (3, None, "<p>same</p>", "d"), (4, "http://c\r\nX: y", None, "d"), (5, "u", "", "d"),
    (6, "u", "ä\r\n\r\nWARC/1.1\r\n" * 3, "d"), (8, "u", "y" * 3_000_000, "d"), (9, "u", "twice", "d"), (9, "u", "twice", "d"), (None, "u", "twice", "d"), (None, "u", "nobody", "d"),
] + [(100 + k, f"http://host/{k}", f"<html><body>page {k} of the archive</body></html>" * 4, "d") for k in range(300)]


def found(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_round_trip(spark):
    for least in (0, 20):
        folder = warc.archive(spark.createDataFrame(ROWS, SCHEMA), least=least)
        assert found(warc.read_archives(spark, folder)) == brute_force(ROWS, least)


def test_files_are_frames_behind_a_dictionary(spark):
    folder = warc.archive(spark.createDataFrame(ROWS, SCHEMA).coalesce(1))
    files = glob.glob(folder.removeprefix("file://") + "/*/part-*")
    assert files
    for name in files:
        content = open(name, "rb").read()
        size = int.from_bytes(content[4:8], "little")
        assert content[:4] == bytes.fromhex("5d2a4d18")
        trained = zstandard.ZstdCompressionDict(content[8 : 8 + size])
        # Each record is a frame of its own: the first can be read without the others.
        first = zstandard.ZstdDecompressor(dict_data=trained).decompressobj().decompress(content[16 + size :])  # behind an empty frame
        assert first.startswith(b"WARC/1.1\r\n") and first.endswith(b"\r\n\r\n") and first.count(b"WARC-Record-ID") == 1


def test_long_partitions_are_several_archives(spark):
    folder = warc.archive(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), archive_bytes=3000)
    files = glob.glob(folder.removeprefix("file://") + "/*/part-*")
    assert len(files) > 5
    names = [head["WARC-Record-ID"] for name in files for head, _ in warc.records_of(open(name, "rb").read())]
    assert len(names) == len(set(names)) == len(ROWS)
    assert found(warc.read_archives(spark, folder)) == brute_force(ROWS)


def test_dictionary_helps():
    records = [f"<html><head><title>{k}</title></head><body class='main'>record {k * 7919}</body></html>".encode() * 2 for k in range(400)]
    trained = warc.build_dictionary(records)
    plain, helped = zstandard.ZstdCompressor(), zstandard.ZstdCompressor(dict_data=trained)
    assert sum(len(helped.compress(r)) for r in records) < 0.7 * sum(len(plain.compress(r)) for r in records)


def test_damage_is_found(spark):
    folder = warc.archive(spark.createDataFrame([(1, "u", "abc", "d")], SCHEMA))
    name = next(n for n in glob.glob(folder.removeprefix("file://") + "/*/part-*") if open(n, "rb").read())
    content = open(name, "rb").read()
    (head, block), = warc.records_of(content)
    assert head["WARC-Type"] == "response" and block.endswith(b"abc")


def test_empty_table(spark):
    assert found(warc.read_archives(spark, warc.archive(spark.createDataFrame([], SCHEMA)))) == []
