"""WARC records in ZIP-packaged web archives: writing, and reading by ranges.

An archive is a ZIP of stored members: ``archive/data.warc.gz`` (one gzip member
a record) and ``indexes/index.cdxj`` (a line a record with offset and length).
Reading takes three steps, each a Spark stage: central directories and indexes
of all archives, runs of neighbouring records (``run_bytes`` each, dealt out
over the cluster), and one range read a run. Nothing is extracted; an archive
without an index is read as one run.

Archives go to a folder under the session's shared checkpoint folder. Names hold
a fresh id per attempt and the list of files is cut there, so a lost or repeated
task leaves at most an unlisted file.

Records: of pages with equal payloads of at least ``min_revisit`` bytes the one
with the smallest page_id is a response, the others revisit it; shorter payloads
are all responses. Defined cases: a null html is an empty payload; rows that
share the smallest page_id of a payload are all responses; a null page_id is
larger than any other, and if all are null all are responses; a null url is
written as empty; extra columns are ignored; no rows give no archive and an
empty result.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import uuid
import zipfile
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from ..sources.folders import qualified
from .cut import cut
from .zipstore import file_system, members, read_range


@dataclass(frozen=True)
class WarcSpec:
    min_revisit: int = 100
    archive_bytes: int = 32 << 20
    run_bytes: int = 4 << 20
    date: str = "2024-01-01T00:00:00Z"


def record_types(pages: DataFrame, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """page_id, url, html, digest and ``refers_to`` (null for responses)."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    p = pages.select(F.col("page_id").cast("long"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                     body.alias("html"), F.sha2(body.cast("binary"), 256).alias("digest"))
    shared = p.filter(F.octet_length("html") >= spec.min_revisit).groupBy("digest") \
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")) \
        .filter("n > 1").select("digest", "first_id")
    # only payloads that occur twice can match; a hot payload is split by the adaptive join
    later = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return p.join(shared, "digest", "left") \
        .select("page_id", "url", "html", "digest", F.when(later, F.col("first_id")).alias("refers_to"))


def _record_id(page_id, digest: str) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{digest[:16]}>"


def encode_record(page_id, url: str, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One record; a revisit keeps the HTTP head (with the payload's length) only."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", _record_id(page_id, digest)),
            ("WARC-Date", date),
            ("WARC-Target-URI", "".join(url.split())),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        head += [("WARC-Refers-To", _record_id(refers_to, digest)),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    block = http if refers_to is not None else http + payload
    head.append(("Content-Length", str(len(block))))
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def decode_record(raw: bytes) -> dict:
    """Headers, type and payload of one record; a response's digest is verified."""
    end = raw.index(b"\r\n\r\n")
    version, *lines = raw[:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    block = raw[end + 4:end + 4 + int(h["Content-Length"])]
    http_end = block.index(b"\r\n\r\n")
    http = dict(x.split(": ", 1) for x in block[:http_end].decode().split("\r\n")[1:])
    size, digest = int(http["Content-Length"]), h["WARC-Payload-Digest"].removeprefix("sha256:")
    payload = block[http_end + 4:] if h["WARC-Type"] == "response" else None
    if payload is not None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {h['WARC-Record-ID']} differs from its digest")
    return {"page_id": _page(h["WARC-Record-ID"]), "url": h["WARC-Target-URI"], "record_type": h["WARC-Type"],
            "payload_bytes": size, "payload_digest": digest,
            "refers_to": _page(h["WARC-Refers-To"]) if "WARC-Refers-To" in h else None, "payload": payload}


def _page(record_id: str) -> int | None:
    x = record_id.split(":")[2]
    return None if x == "null" else int(x)


def write_archives(records: DataFrame, folder: str, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Writes the records of ``record_types``; one row (path, records) per archive."""
    def run(batches):
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        warc, index = io.BytesIO(), []

        def close():
            name = f"{root}/pages-{uuid.uuid4().hex}.wacz"
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
                z.writestr("archive/data.warc.gz", warc.getvalue())
                z.writestr("indexes/index.cdxj", "".join(index))
            with fs.open_output_stream(name) as f:
                f.write(out.getbuffer())
            n = len(index)
            warc.seek(0)
            warc.truncate()
            index.clear()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n])], names=["path", "records"])

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, html, digest, refers = (batch.column(k)[i].as_py() for k in range(5))
                raw = gzip.compress(encode_record(page, url, html.encode(), digest, refers, spec.date), 1, mtime=0)
                line = {"url": "".join(url.split()), "digest": f"sha256:{digest}",
                        "offset": warc.tell(), "length": len(raw), "filename": "data.warc.gz"}
                index.append(f"{_record_id(page, digest)} {spec.date} {json.dumps(line)}\n")
                warc.write(raw)
                if warc.tell() >= spec.archive_bytes:
                    yield close()
        if index:
            yield close()

    return cut(records.select("page_id", "url", "html", "digest", "refers_to")
               .mapInArrow(run, "path string, records long"))


def record_runs(paths: DataFrame, spec: WarcSpec = WarcSpec(), root: str = "") -> DataFrame:
    """path, start, lengths: neighbouring records of about ``run_bytes``, from the indexes."""
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = file_system(_whole(path, root))
                out = []
                with fs.open_input_file(name) as f:
                    found = {m.name: m for m in members(f)}
                    data = [m for n, m in found.items() if n.startswith("archive/")]
                    lists = [m for n, m in found.items() if n.startswith("indexes/")]
                    for m in data + lists:
                        if m.method != 0:
                            raise ValueError(f"{m.name} in {path} is not stored")
                    places: dict[str, list] = {}
                    for m in lists:
                        for line in read_range(f, m.start, m.size).decode().splitlines():
                            entry = json.loads(line[line.index("{"):])
                            places.setdefault(entry["filename"], []).append((entry["offset"], entry["length"]))
                    for m in data:
                        known = sorted(places.get(m.name.rpartition("/")[2], [(0, m.size)] if m.size else []))
                        for offset, length in known:
                            if out and out[-1][0] + sum(out[-1][1]) == m.start + offset \
                                    and out[-1][2] + length <= spec.run_bytes:
                                out[-1][1].append(length)
                                out[-1][2] += length
                            else:
                                out.append([m.start + offset, [length], length])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(out), pa.string()), pa.array([x[0] for x in out], pa.int64()),
                     pa.array([x[1] for x in out], pa.list_(pa.int64()))], names=["path", "start", "lengths"])

    return paths.select("path").mapInArrow(run, "path string, start long, lengths array<long>")


def _whole(path: str, root: str) -> str:
    """A listed path with the scheme and host of the folder it was written to."""
    return path if "://" in path or not root else root + path


def read_records(runs: DataFrame, root: str = "") -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every record."""
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches):
        for batch in batches:
            for path, start, lengths in zip(*(batch.column(k).to_pylist() for k in range(3))):
                fs, name = file_system(_whole(path, root))
                with fs.open_input_file(name) as f:
                    raw = read_range(f, start, sum(lengths))
                rows, at = [], 0
                for n in lengths:
                    part = raw[at:at + n]
                    at += n
                    while part:  # one member if the index is there, all of them if not
                        d = zlib.decompressobj(31)
                        rows.append(decode_record(d.decompress(part) + d.flush()))
                        part = d.unused_data
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in zip(names, types)], names=names)

    n = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.repartition(n, "path", "start").mapInArrow(run, schema)


def round_trip(spark: SparkSession, pages: DataFrame, spec: WarcSpec = WarcSpec()) -> DataFrame:
    """Writes a record per page, reads the archives back: one row per page."""
    # a path without a scheme is Spark's default file system's, not each executor's own
    folder = qualified(spark, scratch(spark, "warc"))
    root = ""
    if "://" in folder and not folder.startswith("file:"):
        scheme, _, rest = folder.partition("://")
        root = f"{scheme}://{rest.partition('/')[0]}"
    written = write_archives(record_types(pages, spec), folder, spec)
    rows = read_records(record_runs(written, spec, root), root)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, strlen(h) as n, sha256(h) as digest from p),
g as (select digest, min(page_id) as first_id from d where n >= 100 group by digest having count(*) > 1)
select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
  case when first_id is not null and page_id is distinct from first_id then 'revisit' else 'response' end as record_type,
  cast(case when page_id is distinct from first_id then first_id end as bigint) as refers_to
from d left join g using (digest)"""
