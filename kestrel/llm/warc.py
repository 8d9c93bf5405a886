"""WARC archives: one gzip member per record, and a splittable reader.

``write_archives`` writes a record for each page.  Pages with equal payloads
of at least ``MIN_REVISIT_BYTES`` bytes share one ``response`` (that of the
smallest page_id); the others are ``revisit`` records that name it and hold
no payload.  The payload's length and SHA-256 stand in the headers of both.

``read_archives`` does not need an index.  Files are cut into byte ranges;
the task of a range looks for the gzip magic, accepts a candidate only if it
decodes to the start of a WARC header, and owns the records whose first byte
lies inside its range, reading past the end of the range to finish the last
one.  So each record is read by exactly one task, wherever ranges are cut.

File names carry the task attempt and only files in the stored manifest are
read, so retried or speculative tasks leave at most unused files.

Archives of other writers are read too: record types other than response and
revisit (warcinfo, request, metadata and so on) are passed over, as is anything that is no
record, and a response without a SHA-256 gets its own.

Damage is never silent.  A member that has decoded to ``WARC/1.`` is a record: if
the rest of it is cut off, does not decode or does not parse, the reader raises
:class:`DamagedRecord`, or with ``damaged="report"`` gives a row of record_type
``damaged`` with the file and place and goes on behind it.  A record whose very first bytes
are damaged cannot be told from other data; :func:`verified` finds it, by comparing
the records of each file with the manifest's number.

Defined results: a null html is an empty payload; rows with a null page_id
become revisits if an equal payload has a page_id, else responses; repeated
rows that share the smallest page_id are all responses; an empty table gives
no archives and no rows; control characters in a url are percent-encoded; a payload of
any length is one record, decoded whole by one task; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import open_in, open_out, stored, work_dir

MIN_REVISIT_BYTES = 100          # shorter payloads are always stored
FILE_BYTES = 64 << 20            # an archive is closed once it is this long
SPLIT_BYTES = 4 << 20            # byte range that is read on its own
TASK_BYTES = 4 << 20             # of all ranges that a reading task gets
READ_BYTES = 1 << 18
MAGIC = b"\x1f\x8b\x08"
OPENING = b"WARC/1."
RECORD_DATE = "2024-01-01T00:00:00Z"

RECORD_SCHEMA = ("page_id long, url string, record_type string, refers_to long, "
                 "payload_bytes long, payload_digest string, payload binary, path string, offset long")


class DamagedRecord(ValueError):
    """A record that starts as one and cannot be read to its end."""


def with_revisits(pages: DataFrame, id_col="page_id", url_col="url", html_col="html",
                  min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, payload_digest, payload_bytes, refers_to (null: response)."""
    page = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    page = page.withColumns({"payload_digest": F.sha2("payload", 256),
                             "payload_bytes": F.octet_length("payload").cast("long")})
    # pre-aggregated per digest before the shuffle, so hot payloads cost nothing
    first = (page.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
             .where("copies > 1 and first_id is not null"))
    # only (id, digest) pairs meet the digests; a hot digest is split by AQE
    revisit = (page.select("page_id", "payload_digest").join(first, "payload_digest")
               .where("not (page_id <=> first_id)")
               .groupBy("page_id", "payload_digest").agg(F.min("first_id").alias("refers_to")))
    return (page.alias("p").join(revisit.alias("r"), F.expr(
        "p.page_id <=> r.page_id and p.payload_digest = r.payload_digest"), "left")
        .select("p.*", "r.refers_to"))


def _record(page_id, url, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    name = lambda i: f"<urn:page:{'null' if i is None or pd.isna(i) else int(i)}>"
    revisit = refers_to is not None and not pd.isna(refers_to)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = [f"WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {RECORD_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {name(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write_archives(pages: DataFrame, out_dir: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records of ``with_revisits`` rows; returns the manifest
    (path, file_bytes, records), itself stored in ``out_dir``."""

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        stem = f"{out_dir}/archives/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, path, size, count, done = None, "", 0, 0, []
        for part in parts:
            for row in zip(part.page_id.array, part.url.array, part.payload.array,
                           part.payload_digest.array, part.payload_bytes.array,
                           part.refers_to.array):
                if out is None:
                    path = f"{stem}-{len(done):04d}.warc.gz"
                    out, size, count = open_out(path), 0, 0
                member = _record(*row)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    done.append((path, size, count))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, count))
        yield pd.DataFrame(done, columns=["path", "file_bytes", "records"])

    rows = pages.select("page_id", "url", "payload", "payload_digest", "payload_bytes", "refers_to")
    return stored(rows.mapInPandas(write, "path string, file_bytes long, records long"),
                  f"{out_dir}/manifest", files=4)


def _members(uri: str, start: int, end: int) -> Iterator[tuple[int, bytes | None]]:
    """(offset, decoded bytes) of the records whose first byte lies in [start, end); None
    instead of the bytes of a record that cannot be decoded to its end."""
    with open_in(uri) as file:
        at, held = start, b""                      # held: bytes from file offset `at`
        file.seek(start)
        while at < end:
            found = held.find(MAGIC)
            if found < 0:
                keep = held[-2:]                   # a magic may straddle two reads
                more = file.read(READ_BYTES)
                at += len(held) - len(keep)
                held = keep + more
                if not more:
                    return
                continue
            at, held = at + found, held[found:]
            if at >= end:
                return
            record, member, used, held = _decode(file, held)
            if record:
                yield at, member
            # no record, or a damaged one: go on one byte later
            step = used if member is not None else 1
            at, held = at + step, held[step:]


def _decode(file, held: bytes) -> tuple[bool, bytes | None, int, bytes]:
    """Decode the member at the start of ``held``, reading on as needed: (whether it starts as a
    record, decoded bytes or None, bytes it takes, all bytes held)."""
    unpack, out, fed, pieces, seen, record = zlib.decompressobj(31), [], 0, [held], 0, False
    try:
        chunk = held
        while True:
            # small bites first: most false candidates fail here, and an error hides
            # what its own bite has decoded
            bite = chunk if record else chunk[:16]
            out.append(unpack.decompress(bite))
            fed += len(bite)
            seen += len(out[-1])
            if not record and seen >= len(OPENING):
                record = b"".join(out)[:len(OPENING)] == OPENING
                if not record:
                    break
            if unpack.eof:
                return record, b"".join(out) if record else None, fed - len(unpack.unused_data), b"".join(pieces)
            chunk = chunk[len(bite):]
            if not chunk:
                chunk = file.read(READ_BYTES)
                if not chunk:
                    break
                pieces.append(chunk)
    except zlib.error:
        pass
    return record, None, 0, b"".join(pieces)


_PAGE = re.compile(r"<urn:page:(-?\d+)>")


def _parse(member: bytes) -> tuple | None:
    """The first seven columns of a response or revisit; None for other record types."""
    head, end, rest = member.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        fields[key.strip().lower()] = value.strip()
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        if not kind:
            raise DamagedRecord("a record without a type")
        return None
    length = int(fields["content-length"])
    if len(rest) < length:
        raise DamagedRecord(f"{fields.get('warc-record-id')} is shorter than its length says")
    block = rest[:length]
    http, payload = b"", block
    if block.startswith(b"HTTP/"):
        http, _, payload = block.partition(b"\r\n\r\n")
    said = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
    algorithm, _, digest = fields.get("warc-payload-digest", "").partition(":")
    own = algorithm.lower() == "sha256" and re.fullmatch("[0-9a-f]{64}", digest) is not None
    if kind == "response":
        actual = hashlib.sha256(payload).hexdigest()
        if own and digest != actual:
            raise DamagedRecord(f"payload of {fields.get('warc-record-id')} does not match its digest")
        size, digest = len(payload), actual
    else:
        size, digest = int(said[1]) if said else None, digest or None
    number = lambda s: int(m[1]) if (m := _PAGE.fullmatch(s or "")) else None
    return (number(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind,
            number(fields.get("warc-refers-to")), size, digest,
            payload if kind == "response" else None)


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, task_bytes: int = TASK_BYTES,
                  with_payload: bool = True, damaged: str = "raise") -> DataFrame:
    """Records (``RECORD_SCHEMA``) of the archives in ``manifest`` (path, file_bytes).
    ``damaged``: "raise", or "report" for a row of each record that cannot be read."""
    if damaged not in ("raise", "report"):
        raise ValueError(f"damaged must be 'raise' or 'report', not {damaged!r}")

    def record(uri: str, at: int, member: bytes | None) -> tuple | None:
        try:
            if member is None:
                raise DamagedRecord("a record that is cut off or does not decode")
            return _parse(member)
        except (ValueError, KeyError, TypeError) as error:
            if damaged == "raise":
                raise DamagedRecord(f"{uri} at byte {at}: {error}") from error
            return (None, None, "damaged", None, None, None, None)

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
        frame = lambda rows: pd.DataFrame(rows, columns=names).astype(
            {"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})
        for part in parts:
            for uri, start, end in zip(part.path, part.start, part.end):
                rows, held = [], 0
                for at, member in _members(uri, int(start), int(end)):
                    row = record(uri, at, member)
                    if row is not None:
                        rows.append((*(row if with_payload else (*row[:-1], None)), uri, at))
                        held += len(member or b"")
                    if held >= 8 << 20:
                        yield frame(rows)
                        rows, held = [], 0
                if rows:
                    yield frame(rows)

    splits = (manifest.where("file_bytes > 0")
              .select("path", "file_bytes", F.explode(F.sequence(
                  F.lit(0).cast("long"), F.col("file_bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
              .select("path", "start", F.least("file_bytes", F.col("start") + split_bytes).alias("end")))
    # by bytes, not by rows: small archives share a task, long ones have several
    tasks = 1 + (manifest.agg(F.sum("file_bytes")).first()[0] or 0) // task_bytes
    return splits.repartition(tasks).mapInPandas(scan, RECORD_SCHEMA)


def verified(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """``records``, after comparing their number in each file with the manifest's; both are
    read twice, so give stored ones.  One row per differing file reaches the driver."""
    found = records.groupBy("path").agg(F.count(F.lit(1)).alias("found"))
    lost = manifest.join(found, "path", "left").where(F.coalesce("found", F.lit(0)) != F.col("records"))
    if first := lost.select("path", "records", F.coalesce("found", F.lit(0)).alias("found")).first():
        raise DamagedRecord(f"{first.path} has {first.found} of {first.records} records")
    return records


def archived_pages(pages: DataFrame, out_dir: str | None = None) -> DataFrame:
    """Write the archives of ``pages`` and read the records back."""
    out_dir = out_dir or work_dir(pages.sparkSession, "warc")
    manifest = write_archives(with_revisits(pages), out_dir)
    records = stored(read_archives(manifest, with_payload=False).drop("payload", "url"), f"{out_dir}/records")
    return verified(records, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest,
       CASE WHEN octet_length(b) >= 100 AND page_id IS DISTINCT FROM f AND f IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(b) >= 100 AND page_id IS DISTINCT FROM f THEN f END AS refers_to
FROM (SELECT page_id, b, min(page_id) OVER (PARTITION BY b) AS f
      FROM (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages))
"""
