"""WARC archives with revisit resolution.

Headers (id, length, SHA-256 of the payload) are shuffled by digest; the smallest id of each payload of at
least ``LEAST`` bytes is the response and every other record is a revisit that refers to it. Tasks write the
records, one gzip member each, to archives in the shared folder; archives are read back record by record.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import byte_slices, scratch_path, written
from .storage import mapped, put

LEAST = 100
ARCHIVE_BYTES = 32 << 20  # an archive is closed when it has grown to this
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture


def resolve(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", least: int = LEAST) -> DataFrame:
    """(``id``, ``digest``, ``payload_bytes``, ``refers_to``): null ``refers_to`` for responses."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    heads = pages.select(F.col(id_col).alias("id"), F.sha2(payload.cast("binary"), 256).alias("digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    firsts = heads.where((F.col("payload_bytes") >= least) & F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("first"))
    met = heads.join(firsts, "digest", "left")
    return met.select("id", "digest", "payload_bytes", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def record_id(ident) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{ident}')}>"


def clean_header(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def id_header(ident) -> str:
    """An id as JSON text: on one line whatever it holds, and null apart from the empty string."""
    return json.dumps(None if ident is None else str(ident))


def make_record(ident, url: str | None, payload: bytes, digest: str, length: int, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has no block of its own."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(ident)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {clean_header(url or '')}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Page-ID: {id_header(ident)}", f"X-Payload-Length: {length}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {id_header(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(data) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive of gzip members."""
    view, at = memoryview(data), 0
    while at < len(view):
        member, out = zlib.decompressobj(31), io.BytesIO()
        while not member.eof:
            part = view[at : at + (1 << 16)]
            if not len(part):
                raise ValueError("the archive ends within a record")
            out.write(member.decompress(part))
            at += len(part) - len(member.unused_data)
        raw = out.getvalue()
        head, _, rest = raw.partition(b"\r\n\r\n")
        first, *lines = head.decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        yield headers, rest[: int(headers["Content-Length"])]


def write_archives(pages: DataFrame, resolved: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> list[str]:
    """Write the records of all pages to archives in ``folder``; their paths, a row for each ARCHIVE_BYTES.

    An archive's name comes from its first record and content, so a task that runs again writes the same file.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    full = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"), F.sha2(payload.cast("binary"), 256).alias("d"))
    same = F.col("page").eqNullSafe(F.col("id")) & (F.col("d") == F.col("digest"))
    rows = full.join(resolved.dropDuplicates(["id", "digest"]), same).select("page", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "digest", "payload_bytes", "refers_to")

    def write(batches):
        parts, size, seen = [], 0, hashlib.sha256()

        def close():
            nonlocal parts, size, seen
            path = f"{folder}/pages-{seen.hexdigest()[:24]}.warc.gz"
            put(path, parts)
            parts, size, seen = [], 0, hashlib.sha256()
            return pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

        for b in byte_slices(batches, 2):
            for row in b.to_pylist():
                raw = make_record(row["page"], row["url"], (row["payload"] or "").encode("utf-8"), row["digest"], row["payload_bytes"], row["refers_to"])
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(raw) + packer.flush()
                seen.update(member)
                parts.append(member)
                size += len(member)
                if size >= ARCHIVE_BYTES:
                    yield close()
        if parts:
            yield close()

    return [r["path"] for r in rows.mapInArrow(write, "path string").collect()]


def read_archives(spark, paths: list[str], id_type: T.DataType) -> DataFrame:
    """One row per record: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``url``, ``payload`` (null for revisits).

    A response's length and digest are taken from its block; both must agree with its headers.
    """
    schema = T.StructType([T.StructField("page_id", id_type), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", id_type), T.StructField("url", T.StringType()), T.StructField("payload", T.BinaryType())])
    arrow = to_arrow_schema(schema)
    plain = schema.simpleString().replace(f"page_id:{id_type.simpleString()}", "page_id:string").replace(f"refers_to:{id_type.simpleString()}", "refers_to:string")
    as_text = T._parse_datatype_string(plain)
    text_arrow = to_arrow_schema(as_text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows, size = [], 0
                for head, block in read_records(mapped(path)):
                    response = head["WARC-Type"] == "response"
                    digest = hashlib.sha256(block).hexdigest() if response else head["WARC-Payload-Digest"].removeprefix("sha256:")
                    length = len(block) if response else int(head["X-Payload-Length"])
                    if f"sha256:{digest}" != head["WARC-Payload-Digest"] or length != int(head["X-Payload-Length"]):
                        raise ValueError(f"record {head['WARC-Record-ID']} of {path} is damaged")
                    rows.append((json.loads(head["X-Page-ID"]), length, digest, head["WARC-Type"], json.loads(head.get("X-Refers-To-Page-ID", "null")), head["WARC-Target-URI"], block if response else None))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), text_arrow, strict=True)], schema=text_arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), text_arrow, strict=True)], schema=text_arrow)

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    out = listed.mapInArrow(read, as_text)
    return out.withColumns({"page_id": F.col("page_id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)}).select(*arrow.names)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write all pages to deduplicated archives and read these back: see :func:`read_archives`.

    A null payload or URL is an empty one. Payloads under LEAST bytes are always responses. A null id is
    kept; if its payload has another record with an id it is a revisit of that, else a response. Repeated rows are
    records of their own, and rows that repeat the smallest id are all responses. An empty table gives
    no archive and an empty result. Columns beside the three are not touched.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    paths = write_archives(pages, written(resolve(pages, id_col, payload_col), "headers"), folder, id_col, url_col, payload_col)
    return read_archives(spark, paths, pages.schema[id_col].dataType)
