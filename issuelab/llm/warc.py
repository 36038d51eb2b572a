"""WARC archives of pages, written and read as streams of chunk rows.

Writing: equal payloads are told by SHA-256 and length; of each group the record with the greatest id is a
``response``, the others ``revisit`` it (``lookup_join``: groups of copies are broadcast if they are few, else
the heaviest are matched apart). Payloads are cut into chunks in the JVM, so a Python worker sees rows of at most
``chunk_bytes`` and streams them into gzip members, one a record. A task starts a new archive at a record's end
once ``archive_bytes`` are written. Archives are named at random, and the manifest, a staged table, lists
those of the attempts that Spark has kept: what a lost or repeated task wrote is never read.

Reading: each archive is streamed by one task, inflated piece by piece, into the *chunk table*: a row per
record and chunk number with the bytes of that chunk, the bytes so far and the SHA-1 so far. The digest of a
record is the one on its last chunk. No worker holds a whole record, however long.

A record id is ``<urn:page:ID>``, a target URI the page's URL; CR, LF, percent and angle brackets in either are
percent-encoded. Revisits carry the HTTP header, with the length of the payload, and no payload.

Folders are opened with ``pyarrow.fs``, so they may be on any store that it knows and all executors share.

Defined results: null html is an empty payload; a null URL gives no target URI; a null id is less than all
others and reads back as null. Repeated rows are records of their own; rows that share a payload and the
greatest id are all responses. Payloads shorter than ``least_bytes`` are all responses. Other columns are
ignored. An empty table writes no archive and reads back as no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelab.operators.lookup import lookup_join
from issuelab.session import new_staging_path, stage


@dataclass(frozen=True)
class Archive:
    """``least_bytes``: payloads below it are never revisits. WARC-Date is ``date`` for all records."""

    chunk_bytes: int = 1 << 20
    archive_bytes: int = 256 << 20
    least_bytes: int = 0
    level: int = 6
    date: str = "1970-01-01T00:00:00Z"


#: Fixed value: the profile of revisits by equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = "path string, records bigint, bytes bigint"
_CHUNK = (
    "path string, record_no bigint, record_id string, chunk_no bigint, record_type string, target_uri string, "
    "refers_to string, declared_digest string, declared_bytes bigint, chunk binary, seen_bytes bigint, "
    "seen_digest string, last boolean"
)
#: Rows of about so many payload bytes go to the JVM at a time.
_BATCH = 4 << 20


def chunk_rows(pages: DataFrame, archive: Archive = Archive(), key: str = "page_id") -> DataFrame:
    """Rows to write: type, digest and length of each page's record, and one chunk of its payload a row, in order."""
    rows = pages.select(
        F.col(key).cast("string").alias("id"),
        F.col(key).alias("id_order"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("payload_key", F.concat(F.sha2("payload", 256), F.octet_length("payload").cast("string")))
    rows = rows.withColumn("n_bytes", F.octet_length("payload").cast("bigint"))
    groups = rows.where(F.col("n_bytes") >= archive.least_bytes).groupBy("payload_key")
    groups = groups.agg(F.count("*").alias("copies"), F.max("id_order").alias("first_id")).where("copies > 1")
    rows = lookup_join(rows, groups, "payload_key", weight="copies", spread_by=["id"])
    revisit = F.col("copies").isNotNull() & ~F.col("id_order").eqNullSafe(F.col("first_id"))
    size = archive.chunk_bytes
    cuts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("n_bytes") / size) - 1, F.lit(0).cast("bigint")))
    pieces = F.transform(cuts, lambda i: F.substring("payload", (i * size + 1).cast("int"), F.lit(size)))
    return rows.select(
        "id",
        "url",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id").cast("string")).alias("refers_to"),
        F.sha1("payload").alias("sha1"),
        "n_bytes",
        F.posexplode(F.when(revisit, F.array(F.lit("").cast("binary"))).otherwise(pieces)).alias("chunk_no", "chunk"),
        F.when(revisit, 1).otherwise(F.size(cuts)).cast("bigint").alias("n_chunks"),
    )


def _open(folder: str):
    """File system and path of a folder or file named with or without a scheme."""
    from pyarrow import fs

    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[len("file:") :].lstrip("/")
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def _quoted(text: str) -> str:
    for c in "%\r\n<>":
        text = text.replace(c, f"%{ord(c):02X}")
    return text


def _unquoted(text: str) -> str:
    import re

    return re.sub("%(25|0D|0A|3C|3E)", lambda m: chr(int(m[1], 16)), text)


def _heads(row: dict, date: str) -> bytes:
    """WARC and HTTP headers of a record."""
    import base64

    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n_bytes']}\r\n\r\n"
    length = len(http) + (row["n_bytes"] if row["record_type"] == "response" else 0)
    name = lambda i: "<urn:page:>" if i is None else f"<urn:page:{_quoted(i)}>"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {name(row['id'])}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(row['sha1'])).decode()}",
    ]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_quoted(row['url'])}")
    if row["record_type"] == "revisit":
        lines += [f"WARC-Refers-To: {name(row['refers_to'])}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def _written(folder: str, archive: Archive):
    """Chunk rows of a task to archives; one manifest row each."""

    def run(batches: Iterator) -> Iterator:
        import uuid
        import zlib

        import pyarrow as pa

        files, top = _open(folder)
        sink, path, records, size, member = None, None, 0, 0, None

        def listed():
            return pa.RecordBatch.from_pydict(
                {"path": [path], "records": pa.array([records], pa.int64()), "bytes": pa.array([size], pa.int64())}
            )

        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                if row["chunk_no"] == 0:
                    if sink is None:
                        files.create_dir(top, recursive=True)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        path, records, size = f"{folder.rstrip('/')}/{name}", 0, 0
                        sink = files.open_output_stream(f"{top}/{name}", compression=None, buffer_size=1 << 20)
                    member = zlib.compressobj(archive.level, zlib.DEFLATED, 31)
                    size += sink.write(member.compress(_heads(row, archive.date)))
                size += sink.write(member.compress(row["chunk"]))
                if row["chunk_no"] + 1 == row["n_chunks"]:
                    size += sink.write(member.compress(b"\r\n\r\n") + member.flush())
                    records += 1
                    if size >= archive.archive_bytes:
                        sink.close()
                        sink = None
                        yield listed()
        if sink is not None:
            sink.close()
            yield listed()

    return run


def write_archives(pages: DataFrame, archive: Archive = Archive(), folder: str | None = None, key: str = "page_id") -> DataFrame:
    """Write a record for each page below ``folder`` (default: a new staging folder); gives the manifest."""
    folder = folder or new_staging_path(pages.sparkSession, "warc")
    return stage(chunk_rows(pages, archive, key).mapInArrow(_written(folder, archive), _MANIFEST), "warc_manifest")


class _Inflated:
    """Bytes of an archive, with or without gzip members, a bounded piece at a time."""

    def __init__(self, source, packed: bool, piece: int = 1 << 16):
        import zlib

        self.source, self.packed, self.piece = source, packed, piece
        self.new = lambda: zlib.decompressobj(31)
        self.member, self.raw, self.held = None, b"", bytearray()

    def more(self) -> bool:
        """Take in another piece; False at the end."""
        if not self.packed:
            got = self.source.read(self.piece)
            self.held += got
            return bool(got)
        while True:
            self.raw = self.raw or self.source.read(self.piece)
            if not self.raw:
                if self.member is not None:
                    raise ValueError("archive ends inside a record")
                return False
            self.member = self.member or self.new()
            got = self.member.decompress(self.raw, self.piece)
            if self.member.eof:
                self.raw, self.member = self.member.unused_data, None
            else:
                self.raw = self.member.unconsumed_tail
            if got:
                self.held += got
                return True

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("archive ends inside a record")
        got = bytes(self.held[:n])
        del self.held[:n]
        return got

    def head(self) -> bytes | None:
        """Bytes up to and with the next empty line; None at the end."""
        while (end := self.held.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.held:
                    raise ValueError("archive ends inside a header")
                return None
        return self.take(end + 4)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _records(source: _Inflated, chunk_bytes: int) -> Iterator[tuple]:
    """(fields, declared bytes, chunk number, chunk, bytes so far, SHA-1 so far, last) for every chunk."""
    import base64
    import hashlib

    while (head := source.head()) is not None:
        if not head.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {head[:40]!r}")
        fields = _fields(head)
        left = int(fields["content-length"])
        declared = left
        if fields.get("content-type", "").startswith("application/http") and left:
            http = source.head() or b""
            left -= len(http)
            declared = int(_fields(http).get("content-length", left))
        digest, seen, number = hashlib.sha1(), 0, 0
        while True:
            chunk = source.take(min(left, chunk_bytes))
            left -= len(chunk)
            seen += len(chunk)
            digest.update(chunk)
            yield fields, declared, number, chunk, seen, base64.b32encode(digest.digest()).decode(), left == 0
            number += 1
            if not left:
                break
        if source.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")


def _chunked(schema, chunk_bytes: int, with_payload: bool):
    """Archives (rows of a manifest) to rows of the chunk table."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        rows, held = [], 0

        def given():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                files, place = _open(path)
                record = -1
                with files.open_input_stream(place, compression=None) as stream:
                    source = _Inflated(stream, path.endswith(".gz"))
                    for fields, declared, number, chunk, seen, digest, last in _records(source, chunk_bytes):
                        record += number == 0
                        uri = fields.get("warc-target-uri")
                        rows.append((
                            path, record, fields.get("warc-record-id"), number, fields.get("warc-type"),
                            None if uri is None else _unquoted(uri), fields.get("warc-refers-to"),
                            fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, declared,
                            chunk if with_payload else None, seen, digest, last,
                        ))
                        held += len(chunk) * with_payload + 300
                        if held >= _BATCH:
                            yield given()
                            rows, held = [], 0
        if rows:
            yield given()

    return run


def read_chunks(manifest: DataFrame, archive: Archive = Archive(), with_payload: bool = True) -> DataFrame:
    """The chunk table of the archives in ``manifest`` (column ``path``), a task for each archive.

    ``with_payload=False`` leaves ``chunk`` null, for readers of sizes and digests.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(manifest.sparkSession.createDataFrame([], _CHUNK).schema)
    paths = manifest.select("path")
    paths = paths.repartition(min(max(paths.count(), 1), 10_000))
    return paths.mapInArrow(_chunked(schema, archive.chunk_bytes, with_payload), _CHUNK)


def page_of(record_id: Column) -> Column:
    """The page id (text) in a record id; null for a null id and for other record ids."""
    inside = F.regexp_extract(record_id, r"^<urn:page:(.+)>$", 1)
    for code, c in (("0D", "\r"), ("0A", "\n"), ("3C", "<"), ("3E", ">"), ("25", "%")):
        inside = F.replace(inside, F.lit(f"%{code}"), F.lit(c))
    return F.when(F.length(inside) > 0, inside)


def read_records(chunks: DataFrame) -> DataFrame:
    """One row per record, from its last chunk: ``payload_bytes`` and ``payload_digest`` of the full payload.

    For a revisit they are those that its headers declare. ``intact``: a response's payload has the declared
    length and digest.
    """
    stored = F.col("record_type") != "revisit"
    same = (F.col("seen_digest") == F.col("declared_digest")) & (F.col("seen_bytes") == F.col("declared_bytes"))
    return chunks.where("last").select(
        "path",
        "record_no",
        page_of(F.col("record_id")).alias("page"),
        "target_uri",
        F.when(stored, F.col("seen_bytes")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(stored, F.col("seen_digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
        F.coalesce(~stored | same, F.lit(False)).alias("intact"),
    )


def warc_sql(least_bytes: int = 0) -> str:
    """Types, digests and lengths of the records of ``pages`` in DuckDB."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    value = " + ".join(f"{1 << (4 - k)} * (bits[5 * i + {k + 1}] = '1')::INT" for k in range(5))
    return f"""
WITH paid AS (
  SELECT page_id, COALESCE(html, '') AS payload FROM pages
), hashed AS (
  SELECT page_id, strlen(payload) AS n, unhex(sha1(payload))::BIT::VARCHAR AS bits,
         max(page_id) OVER (PARTITION BY payload) AS first_id
  FROM paid
)
SELECT page_id, n::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: ('{letters}')[1 + {value}]), 'string_agg', '') AS payload_digest,
       CASE WHEN n < {least_bytes} OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n < {least_bytes} OR page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM hashed
"""
