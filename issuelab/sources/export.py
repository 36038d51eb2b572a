"""Document-store exports: files of length-prefixed binary documents, one after the other, as a data source.

``spark.read.format("issue_export").schema(...).load(folder)`` reads every ``*.bson`` file below a folder, and
``df.write.format("issue_export").save(folder)`` writes one per task.

Reading: a file is planned in ranges of ``splitBytes``. A document belongs to the range in which it starts, but its
start is not marked, so each task looks for one: the first place at or behind its range's begin from which
``CHAIN`` documents in a row decode (or all up to the file's end) that begin with the same field as the file's first
(the store writes its id first; the end of a document can look like a short one, but not with that field). A task
goes on to the first document that starts behind its range, and requires that the search of the next task would
have found that place. So a wrong guess is an error, and never loses or repeats a document. A task holds one
document and a read buffer.

Values become the declared types: dates become timestamps, or ISO text where text is declared; ids become hex text;
embedded documents and arrays become structs, maps and arrays. A value of another type is null, a declared
field that a document lacks too; other fields are left out. ``_place`` (file, offset) may be declared as well.

Writing: a task's file has a name of its own and is moved to its place when the job commits. A row is a document
with its fields in order; null fields are written as null. Files are opened with ``pyarrow.fs``.

Rows travel as Arrow batches. Written ones are encoded a column at a time; those with types that have no such
rule (dates, decimals, maps and others) row by row.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)

# The source runs in tasks and travels there whole, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "issue_export"
PLACE = "_place"
#: Fixed values of the format: the least and the largest size of a document.
LEAST, LARGEST = 5, 48 << 20
CHAIN = 4
SPLIT_BYTES = 128 << 20
_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
#: Documents, and bytes of them, that a task turns into an Arrow batch; rows that it encodes at a time.
BATCH_ROWS, BATCH_BYTES, ENCODED_ROWS = 4096, 4 << 20, 1024


class Broken(ValueError):
    """Bytes that are no document."""


# --- the format -------------------------------------------------------------------------------------


def _name(data: bytes, at: int) -> tuple[str, int]:
    end = data.index(b"\0", at)
    return data[at:end].decode(), end + 1


def decode(data: bytes, at: int = 0, as_list: bool = False) -> tuple[dict | list, int]:
    """The document that starts at ``at``, and where it ends. Dates are aware datetimes, ids hex text."""
    try:
        size = struct.unpack_from("<i", data, at)[0]
        end = at + size
        if size < LEAST or end > len(data) or data[end - 1] != 0:
            raise Broken(f"no document at {at}")
        at += 4
        names, values = [], []
        while at < end - 1:
            kind = data[at]
            stop = data.index(b"\0", at + 1)
            names.append(data[at + 1 : stop].decode())
            at = stop + 1
            if kind == 0x02:  # texts and whole numbers are the most frequent
                size = struct.unpack_from("<i", data, at)[0]
                stop = at + 3 + size
                if size < 1 or stop >= len(data) or data[stop]:
                    raise Broken(f"no text at {at}")
                values.append(data[at + 4 : stop].decode())
                at = stop + 1
            elif kind == 0x10:
                values.append(struct.unpack_from("<i", data, at)[0])
                at += 4
            else:
                value, at = _value(kind, data, at)
                values.append(value)
        if at != end - 1:
            raise Broken(f"a document ends at {at}, not at {end - 1}")
    except (struct.error, IndexError, UnicodeDecodeError, OverflowError, RecursionError) as e:
        raise Broken(str(e)) from e
    except ValueError as e:
        raise e if isinstance(e, Broken) else Broken(str(e)) from e
    return (values if as_list else dict(zip(names, values))), end


def _value(kind: int, data: bytes, at: int) -> tuple[object, int]:
    if kind == 0x01:
        return struct.unpack_from("<d", data, at)[0], at + 8
    if kind in (0x02, 0x0D, 0x0E):
        size = struct.unpack_from("<i", data, at)[0]
        if size < 1 or at + 4 + size > len(data) or data[at + 3 + size]:
            raise Broken(f"no text at {at}")
        return data[at + 4 : at + 3 + size].decode(), at + 4 + size
    if kind in (0x03, 0x04):
        return decode(data, at, kind == 0x04)
    if kind == 0x05:
        size = struct.unpack_from("<i", data, at)[0]
        if size < 0 or at + 5 + size > len(data):
            raise Broken(f"no bytes at {at}")
        return data[at + 5 : at + 5 + size], at + 5 + size
    if kind == 0x07:
        if at + 12 > len(data):
            raise Broken(f"no id at {at}")
        return data[at : at + 12].hex(), at + 12
    if kind == 0x08:
        if data[at] > 1:
            raise Broken(f"no boolean at {at}")
        return bool(data[at]), at + 1
    if kind == 0x09:
        ms = struct.unpack_from("<q", data, at)[0]
        try:
            return _EPOCH + timedelta(milliseconds=ms), at + 8
        except OverflowError:  # outside the years 1 to 9999
            return None, at + 8
    if kind in (0x06, 0x0A, 0x7F, 0xFF):
        return None, at
    if kind == 0x0B:
        pattern, at = _name(data, at)
        return pattern, _name(data, at)[1]
    if kind == 0x10:
        return struct.unpack_from("<i", data, at)[0], at + 4
    if kind in (0x11, 0x12):
        return struct.unpack_from("<q", data, at)[0], at + 8
    if kind == 0x13:
        if at + 16 > len(data):
            raise Broken(f"no decimal at {at}")
        return data[at : at + 16], at + 16
    raise Broken(f"type {kind} at {at}")


def encode(fields: list[tuple[str, object]]) -> bytes:
    """A document of (name, value) pairs."""
    body = b"".join(_field(name, value) for name, value in fields)
    return struct.pack("<i", len(body) + 5) + body + b"\0"


def _field(name: str, value: object) -> bytes:
    key = name.encode() + b"\0"
    if value is None:
        return b"\x0a" + key
    if isinstance(value, bool):
        return b"\x08" + key + (b"\1" if value else b"\0")
    if isinstance(value, int):
        if -(1 << 31) <= value < 1 << 31:
            return b"\x10" + key + struct.pack("<i", value)
        return b"\x12" + key + struct.pack("<q", value)
    if isinstance(value, float):
        return b"\x01" + key + struct.pack("<d", value)
    if isinstance(value, datetime):
        aware = value if value.tzinfo else value.astimezone(UTC)
        return b"\x09" + key + struct.pack("<q", (aware - _EPOCH) // timedelta(milliseconds=1))
    if isinstance(value, (bytes, bytearray)):
        return b"\x05" + key + struct.pack("<i", len(value)) + b"\0" + bytes(value)
    if isinstance(value, T.Row):
        return b"\x03" + key + encode(list(zip(value.__fields__, value)))
    if isinstance(value, dict):
        return b"\x03" + key + encode([(str(k), v) for k, v in value.items()])
    if isinstance(value, (list, tuple)):
        return b"\x04" + key + encode([(str(k), v) for k, v in enumerate(value)])
    text = str(value).encode()
    return b"\x02" + key + struct.pack("<i", len(text) + 1) + text + b"\0"


def _tagged(column, kind: T.DataType) -> list[tuple[bytes, bytes]]:
    """Type byte and bytes of each value of an Arrow column."""
    null = (b"\x0a", b"")
    if isinstance(kind, T.StructType):
        fields = [_named(f.name, c, f.dataType) for f, c in zip(kind, column.flatten())]
        rows = zip(*fields) if fields else [()] * len(column)
        known = column.is_valid().to_pylist()
        return [(b"\x03", _document(b"".join(parts))) if k else null for k, parts in zip(known, rows)]
    if isinstance(kind, T.ArrayType):
        values, out, at = _tagged(column.flatten(), kind.elementType), [], 0
        for n in column.value_lengths().to_pylist():
            if n is None:
                out.append(null)
                continue
            parts = [tag + b"%d\0" % k + value for k, (tag, value) in enumerate(values[at : at + n])]
            out.append((b"\x04", _document(b"".join(parts))))
            at += n
        return out
    if isinstance(kind, T.TimestampType):
        return [null if v is None else (b"\x09", struct.pack("<q", v // 1000)) for v in column.cast("int64").to_pylist()]
    values = column.to_pylist()
    if isinstance(kind, T.StringType):
        texts = [None if v is None else v.encode() for v in values]
        return [null if t is None else (b"\x02", struct.pack("<i", len(t) + 1) + t + b"\0") for t in texts]
    if isinstance(kind, T.BooleanType):
        return [null if v is None else (b"\x08", b"\1" if v else b"\0") for v in values]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return [null if v is None else (b"\x01", struct.pack("<d", v)) for v in values]
    small = lambda v: -(1 << 31) <= v < 1 << 31
    return [null if v is None else (b"\x10", struct.pack("<i", v)) if small(v) else (b"\x12", struct.pack("<q", v)) for v in values]


def _named(name: str, column, kind: T.DataType) -> list[bytes]:
    """The field ``name`` of each row's document."""
    key = name.encode() + b"\0"
    return [tag + key + value for tag, value in _tagged(column, kind)]


def _document(body: bytes) -> bytes:
    return struct.pack("<i", len(body) + 5) + body + b"\0"


_BY_COLUMN = (
    T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.TimestampType
)


def by_column(kind: T.DataType) -> bool:
    """Whether values of the type can be encoded a column at a time."""
    if isinstance(kind, T.StructType):
        return all(by_column(f.dataType) for f in kind)
    return by_column(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, _BY_COLUMN)


def arrow_type(kind: T.DataType):
    """Arrow's type of a declared one."""
    import pyarrow as pa

    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.MapType):
        return pa.map_(arrow_type(kind.keyType), arrow_type(kind.valueType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, arrow_type(f.dataType)) for f in kind])
    plain = {
        T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.IntegerType: pa.int32(), T.LongType: pa.int64(),
        T.DoubleType: pa.float64(), T.FloatType: pa.float32(), T.TimestampType: pa.timestamp("us", tz="UTC"), T.BinaryType: pa.binary(),
    }
    for known, arrow in plain.items():
        if isinstance(kind, known):
            return arrow
    raise ValueError(f"no export values of type {kind.simpleString()}")


def typed_as(kind: T.DataType):
    """``as_type`` for one type, made once; structs become dicts, maps pairs, as Arrow takes them."""
    if isinstance(kind, T.StructType):
        inner = [(f.name, typed_as(f.dataType)) for f in kind]
        return lambda v: {n: of(v.get(n)) for n, of in inner} if isinstance(v, dict) else None
    if isinstance(kind, T.ArrayType):
        of = typed_as(kind.elementType)
        return lambda v: [of(x) for x in v] if isinstance(v, list) else None
    if isinstance(kind, T.MapType):
        of = typed_as(kind.valueType)
        return lambda v: [(k, of(x)) for k, x in v.items()] if isinstance(v, dict) else None
    if isinstance(kind, T.StringType):
        return lambda v: v if type(v) is str else as_type(v, kind)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        room = 1 << (31 if isinstance(kind, T.IntegerType) else 63)
        return lambda v: v if type(v) is int and -room <= v < room else as_type(v, kind)
    return lambda v: None if v is None else as_type(v, kind)


def as_type(value: object, kind: T.DataType) -> object:
    """``value`` as the declared type; null if it is of another one."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        if isinstance(value, datetime):
            return value.isoformat(timespec="milliseconds" if value.microsecond else "seconds").replace("+00:00", "Z")
        return value if isinstance(value, str) else None
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(kind, (T.IntegerType, T.LongType)):
        whole = isinstance(value, int) and not isinstance(value, bool) or isinstance(value, float) and value.is_integer()
        room = 1 << (31 if isinstance(kind, T.IntegerType) else 63)
        return int(value) if whole and -room <= value < room else None
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
    if isinstance(kind, T.TimestampType):
        return value if isinstance(value, datetime) else None
    if isinstance(kind, T.BinaryType):
        return value if isinstance(value, bytes) else None
    if isinstance(kind, T.ArrayType):
        return [as_type(v, kind.elementType) for v in value] if isinstance(value, list) else None
    if isinstance(kind, T.MapType):
        return {k: as_type(v, kind.valueType) for k, v in value.items()} if isinstance(value, dict) else None
    if isinstance(kind, T.StructType):
        return tuple(as_type(value.get(f.name), f.dataType) for f in kind) if isinstance(value, dict) else None
    raise ValueError(f"no export values of type {kind.simpleString()}")


# --- finding documents in a range -------------------------------------------------------------------


class _File:
    def __init__(self, stream, size: int):
        self.stream, self.size = stream, size
        self.lead = self._lead()

    def _lead(self) -> str | None:
        """Name of the first field of the file's first document."""
        head = self.read(0, 4)
        size = struct.unpack("<i", head)[0] if len(head) == 4 else 0
        if not LEAST <= size <= min(LARGEST, self.size):
            raise Broken("no document at offset 0")
        return next(iter(decode(self.read(0, size))[0]), None)

    def read(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(min(n, self.size - at))

    def starts_chain(self, at: int) -> bool:
        """Whether ``CHAIN`` documents in a row decode from here, or all up to the file's end, and begin alike."""
        for _ in range(CHAIN):
            if at == self.size:
                return True
            head = self.read(at, 4)
            size = struct.unpack("<i", head)[0] if len(head) == 4 else 0
            if not LEAST <= size <= min(LARGEST, self.size - at):
                return False
            try:
                document, _ = decode(self.read(at, size))
            except Broken:
                return False
            if next(iter(document), None) != self.lead:
                return False
            at += size
        return True

    def first_start(self, begin: int) -> int:
        """The first document at or behind ``begin``; the file's size if there is none."""
        import numpy as np

        if begin <= 0:
            return 0
        while begin < self.size:
            window = self.read(begin, (1 << 16) + 4)
            a = np.frombuffer(window, dtype=np.uint8).astype(np.int64)
            room = min(1 << 16, len(a) - 4)
            if room <= 0:
                break
            k = np.arange(room)
            sizes = a[:room] | a[1 : room + 1] << 8 | a[2 : room + 2] << 16 | a[3 : room + 3] << 24
            fits = (sizes >= LEAST) & (sizes <= LARGEST) & (begin + k + sizes <= self.size)
            inside = fits & (k + sizes <= len(a))
            fits[inside] = a[(k + sizes)[inside] - 1] == 0
            kinds = np.array([*range(0x00, 0x09), 0x09, 0x0A, 0x0B, 0x0D, 0x0E, 0x10, 0x11, 0x12, 0x13, 0x7F, 0xFF])
            fits &= np.isin(a[4 : room + 4], kinds)
            for at in np.flatnonzero(fits).tolist():
                if self.starts_chain(begin + at):
                    return begin + at
            begin += room
        return self.size

    def documents(self, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
        """(offset, bytes) of the documents that start in the range."""
        at = self.first_start(begin)
        held, base = b"", at
        while at < min(end, self.size):
            if at + 4 > base + len(held):
                held, base = self.read(at, 1 << 20), at
            size = struct.unpack_from("<i", held, at - base)[0] if len(held) >= at - base + 4 else 0
            if not LEAST <= size <= min(LARGEST, self.size - at):
                raise Broken(f"no document at offset {at}")
            if at + size > base + len(held):
                held, base = self.read(at, max(size, 1 << 20)), at
            yield at, held[at - base : at - base + size]
            at += size
        if end < self.size and self.first_start(end) != at:
            raise Broken(f"the documents around offset {end} cannot be told apart")


# --- the data source --------------------------------------------------------------------------------


def _open(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int
    size: int

    def __post_init__(self):
        super().__init__(None)


class ExportReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.root, self.schema = options["path"], schema
        self.split = int(options.get("splitbytes", SPLIT_BYTES))  # keys come in lower case

    def partitions(self) -> list[Range]:
        from pyarrow import fs

        files, top = _open(self.root)
        info = files.get_file_info(top)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.root)
        listed = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(top, recursive=True))
        ranges = []
        for f in sorted(listed, key=lambda f: f.path):
            if f.type == fs.FileType.File and f.path.endswith(".bson") and "/_" not in f.path[len(top) :]:
                ranges += [Range(f.path, k, min(k + self.split, f.size), f.size) for k in range(0, f.size, self.split)]
        return ranges or [Range("", 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        if not partition.size:
            return
        import pyarrow as pa

        files, _ = _open(self.root)
        schema = pa.schema([pa.field(f.name, arrow_type(f.dataType)) for f in self.schema])
        # A place is given by position, whatever its fields are called.
        placed = lambda kind: lambda place: dict(zip(kind.names, place))
        fields = [(f.name, placed(f.dataType) if f.name == PLACE else typed_as(f.dataType)) for f in self.schema]

        def batch(found: list[dict]) -> pa.RecordBatch:
            columns = [[of(document.get(name)) for document in found] for name, of in fields]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        with files.open_input_file(partition.path) as stream:
            found, size = [], 0
            for at, data in _File(stream, partition.size).documents(partition.begin, partition.end):
                document, _ = decode(data)
                document[PLACE] = (partition.path, at)
                found.append(document)
                size += len(data)
                if len(found) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield batch(found)
                    found, size = [], 0
            if found:
                yield batch(found)


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class ExportWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.root, self.overwrite = options["path"].rstrip("/"), overwrite

    def write(self, iterator: Iterator) -> Written:
        return self._write(encode(list(zip(row.__fields__, row))) for row in iterator)

    def _write(self, documents: Iterator[bytes]) -> Written:
        import uuid

        files, top = _open(self.root)
        sink, path = None, None
        for data in documents:
            if sink is None:
                files.create_dir(f"{top}/_pending", recursive=True)
                path = f"{top}/_pending/{uuid.uuid4().hex}.bson"
                sink = files.open_output_stream(path, buffer_size=1 << 20)
            sink.write(data)
        if sink is not None:
            sink.close()
        return Written(path)

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        files, top = _open(self.root)
        files.create_dir(top, recursive=True)
        if self.overwrite:
            for f in files.get_file_info(fs.FileSelector(top)):
                if f.path.endswith(".bson"):
                    files.delete_file(f.path)
        for m in messages:
            if m is not None and m.path:
                files.move(m.path, m.path.replace("/_pending/", "/"))
        self._clear(files, top)

    def abort(self, messages: list) -> None:
        self._clear(*_open(self.root))

    def _clear(self, files, top: str) -> None:
        """Files of attempts that did not count."""
        from pyarrow import fs

        if files.get_file_info(f"{top}/_pending").type == fs.FileType.Directory:
            files.delete_dir(f"{top}/_pending")


class ExportColumnWriter(ExportWriter, DataSourceArrowWriter):
    """Gets Arrow batches, for schemas of types that are encoded by column."""

    def __init__(self, options: dict, overwrite: bool, schema: T.StructType):
        super().__init__(options, overwrite)
        self.schema = schema

    def write(self, iterator: Iterator) -> Written:
        return self._write(
            b"".join(map(_document, map(b"".join, zip(*(_named(f.name, c, f.dataType) for f, c in zip(self.schema, part.columns))))))
            for batch in iterator
            for part in (batch.slice(at, ENCODED_ROWS) for at in range(0, batch.num_rows, ENCODED_ROWS))
        )


class ExportSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ExportReader(dict(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        if len(schema) and by_column(schema):
            return ExportColumnWriter(dict(self.options), overwrite, schema)
        return ExportWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ExportSource)
