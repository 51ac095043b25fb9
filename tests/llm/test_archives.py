"""WARC records in ZIP archives."""
import gzip
import hashlib
import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from tidewell.llm import warc
from tidewell.llm.zipstore import members, read_range

SCHEMA = "page_id long, url string, html string, digest string, refers_to string, payload_bytes string"


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "a", "b", "c") for i, u, h in rows], SCHEMA)


def _expected(rows):
    first = {}
    for i, _, h in rows:
        first.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        ids = first[h or ""]
        known = [x for x in ids if x is not None]
        revisit = len(b) >= 100 and len(ids) > 1 and known and i != min(known)
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response",
                    min(known) if revisit else None))
    return sorted(map(str, out))


def test_records_survive_the_archives(spark):
    big, same = "é" * 300_000, "<p>" + "x" * 200 + "</p>"
    rows = [(1, "http://a/ b", same), (2, None, same), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"),
            (7, "u", big), (8, "u", big), (None, "u", same), (9, "u\nv", "WARC/1.1\r\n\r\n\r\n"), (2, "w", same), (1, "z", same)]
    rows += [(100 + i, f"http://h/{i}", f"<html>{i % 50}</html>" * 20) for i in range(300)]
    spec = warc.WarcSpec(archive_bytes=3000, run_bytes=1500)       # many archives and runs
    got = warc.round_trip(spark, _pages(spark, rows).repartition(4), spec)
    assert sorted(str(tuple(r)) for r in got.collect()) == _expected(rows)
    assert warc.round_trip(spark, _pages(spark, [])).count() == 0


def test_only_stored_members_are_read_by_ranges(spark, tmp):
    import os
    folder = tmp("zips")
    os.makedirs(folder)
    record = warc.encode_record(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), None, "2024-01-01T00:00:00Z")
    two = warc.encode_record(2, "u", b"again", hashlib.sha256(b"again").hexdigest(), None, "2024-01-01T00:00:00Z")
    with zipfile.ZipFile(f"{folder}/plain.wacz", "w") as z:        # no index: the archive is one run
        z.comment = b"a comment with PK\x05\x06 in it, and more text behind"
        z.writestr("archive/data.warc.gz", gzip.compress(record) + gzip.compress(two))
    paths = spark.createDataFrame([(f"{folder}/plain.wacz",)], "path string")
    assert sorted(r.page_id for r in warc.read_records(warc.record_runs(paths)).collect()) == [1, 2]
    with zipfile.ZipFile(f"{folder}/packed.wacz", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc.gz", gzip.compress(record))
    with pytest.raises(Exception, match="not stored"):
        warc.record_runs(spark.createDataFrame([(f"{folder}/packed.wacz",)], "path string")).collect()


def test_altered_payload_is_noticed():
    raw = warc.encode_record(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), None, "2024-01-01T00:00:00Z")
    assert warc.decode_record(raw)["payload"] == b"hello"
    with pytest.raises(ValueError, match="digest"):
        warc.decode_record(raw.replace(b"hello", b"jello"))


class _File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_zip64_directories_are_followed():
    data, name = b"stored bytes", b"archive/x"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 2**32 - 1, 2**32 - 1, len(name), 20) + name \
        + struct.pack("<HHQQ", 1, 16, len(data), len(data))
    extra = struct.pack("<HHH", 0x7777, 2, 9) + struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    central = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 2**32 - 1, 2**32 - 1,
                          len(name), len(extra), 0, 0, 0, 0, 2**32 - 1) + name + extra
    at = len(local) + len(data)
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(central), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 2**16 - 1, 2**16 - 1, 2**32 - 1, 2**32 - 1, 0)
    f = _File(local + data + central + end64 + locator + end)
    found = members(f)
    assert [(m.name, m.method, m.size) for m in found] == [("archive/x", 0, len(data))]
    assert read_range(f, found[0].start, found[0].size) == data
    with pytest.raises(ValueError):
        members(_File(b"no archive at all"))


def test_record_types_choose_the_smallest_id(spark):
    rows = [(5, "u", "y" * 150), (3, "u", "y" * 150), (4, "u", "y" * 99), (2, "u", "y" * 99)]
    got = {r.page_id: r.refers_to for r in warc.record_types(_pages(spark, rows)).collect()}
    assert got == {5: 3, 3: None, 4: None, 2: None}
    assert warc.record_types(_pages(spark, rows)).filter(F.col("html").isNull()).count() == 0
