"""Document-store exports: values, splits at any byte, damaged files, tasks' files."""

import random
import struct
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelab.sources import export, readers


def test_values_round_trip():
    when = datetime(2024, 2, 29, 12, 0, 0, 250_000, tzinfo=UTC)
    fields = [("a", None), ("b", True), ("c", -5), ("d", 1 << 40), ("e", 2.5), ("f", when), ("g", b"\0x"), ("h", "é\0"), ("i", [1, "x", None])]
    fields += [("j", Row(k=1, l=Row(m="n"))), ("o", {"p": [when]}), ("q", datetime(1601, 1, 1, tzinfo=UTC))]
    document, end = export.decode(export.encode(fields))
    assert end == len(export.encode(fields))
    want = dict(fields) | {"j": {"k": 1, "l": {"m": "n"}}}
    assert document == want


def test_kinds_that_only_the_store_writes():
    body = b"\x07_id\0" + bytes(range(12)) + b"\x0bre\0a+\0i\0" + b"\x13d\0" + b"\0" * 16 + b"\x11t\0" + struct.pack("<q", 9)
    body += b"\xffmin\0" + b"\x06u\0" + b"\x09far\0" + struct.pack("<q", 1 << 60)
    document, _ = export.decode(struct.pack("<i", len(body) + 5) + body + b"\0")
    assert document["_id"] == bytes(range(12)).hex() and document["t"] == 9 and document["min"] is None and document["far"] is None
    for wrong in (b"", b"\5\0\0\0\1", b"\x0c\0\0\0\x02a\0\xff\0\0\0\0", b"\7\0\0\0\x63a\0"):
        with pytest.raises(export.Broken):
            export.decode(wrong)


SCHEMA = "id long, title string, created_at string, when timestamp, labels array<string>, user struct<login:string,n:int>, x double"


def documents(n, seed=1):
    rng = random.Random(seed)
    for i in range(n):
        inner = [("login", f"u{i}"), ("n", i % 7)]
        when = datetime(2024, 1, 1, tzinfo=UTC) + timedelta(seconds=i)
        yield [
            ("_id", f"k{i}"), ("id", i), ("title", "t" * rng.randrange(300)), ("created_at", when), ("when", when),
            ("labels", ["a", None, "b"][: i % 4]), ("nested", [dict(inner), {"deep": [dict(inner)] * (i % 5)}]), ("user", dict(inner)),
            ("x", "no number" if i % 10 == 0 else i),
        ]


@pytest.mark.parametrize("split", [97, 1000, 1 << 27])
def test_every_document_once_whatever_the_splits(spark, tmp_path, split):
    for name, n in (("a.bson", 300), ("sub/b.bson", 40), ("empty.bson", 0)):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"".join(export.encode(d) for d in documents(n)))
    (tmp_path / "a.metadata.json").write_text("{}")
    export.register(spark)
    df = spark.read.format(export.FORMAT).schema(SCHEMA).option("splitBytes", split).load(str(tmp_path))
    rows = df.collect()
    assert sorted(r["id"] for r in rows) == sorted([*range(300), *range(40)])
    one = next(r for r in rows if r["id"] == 27)
    assert one["created_at"] == "2024-01-01T00:00:27Z" and one["labels"] == ["a", None, "b"] and one["user"] == ("u27", 6)
    assert one["x"] == 27.0 and next(r for r in rows if r["id"] == 30)["x"] is None
    assert df.where("when = timestamp'2024-01-01 00:00:27'").count() == 2
    if split == 1000:
        assert df.rdd.getNumPartitions() > 50


def test_damaged_files_are_errors(spark, tmp_path):
    data = b"".join(export.encode(d) for d in documents(200))
    export.register(spark)
    for name, wrong in (("cut", data[:-3]), ("noise", data[:20_000] + b"\x01\x02\x03" + data[20_000:])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.bson").write_bytes(wrong)
        for split in (5000, 1 << 27):
            with pytest.raises(Exception, match="document|around"):
                spark.read.format(export.FORMAT).schema("id long").option("splitBytes", split).load(str(tmp_path / name)).count()


def test_write_read_and_load(spark, tmp_path):
    path = str(tmp_path / "out")
    export.register(spark)
    df = spark.range(100, numPartitions=3).select(
        "id", F.concat(F.lit("o/r"), "id").alias("repo_full_name"), F.timestamp_seconds("id").alias("created_at"), F.lit("k").alias("_id"),
        F.array(F.lit("bug"), F.lit(None)).alias("labels"),
    )
    df.write.format(export.FORMAT).mode("overwrite").save(path)
    df.where("id < 10").write.format(export.FORMAT).mode("append").save(path)
    back = readers.load_issues(spark, "export", path)
    assert "_id" not in back.columns and back.count() == 110 and back.select("ingest_seq").distinct().count() == 110
    row = back.where("id = 7").first()
    assert row["created_at"] == "1970-01-01T00:00:07Z" and row["labels"] == ["bug", None] and row["title"] is None
    df.where("id < 5").write.format(export.FORMAT).mode("overwrite").save(path)
    assert readers.read_export(spark, path).count() == 5
    assert not (tmp_path / "out" / "_pending").exists()


def test_columns_are_encoded_as_rows_are(spark, tmp_path, monkeypatch):
    """Batches of columns give the documents that row by row writing gives, nulls and nested values included."""
    inner = "struct<a:array<struct<t:timestamp,s:string>>,n:long,e:array<array<int>>>"
    schema = T.StructType.fromDDL(f"s string, b boolean, i int, l long, d double, f float, t timestamp, u {inner}, h smallint")
    when = datetime(1969, 12, 31, 23, 59, 59, 999_100, tzinfo=UTC)
    rows = [
        ("é\0", True, -5, 1 << 40, 2.5, 0.1, when, ([(when, "x"), None, (None, None)], -(1 << 31), [[1, None], None, []]), 3),
        (None,) * 9, ("", False, 0, (1 << 31) - 1, float("nan"), -0.0, datetime(2024, 2, 29, tzinfo=UTC), (None, 1 << 31, None), -1),
    ] * 5
    df = spark.createDataFrame(rows, schema).coalesce(1)
    export.register(spark)
    assert export.by_column(schema) and not export.by_column(T.StructType.fromDDL("a map<string,int>"))
    monkeypatch.setattr(export, "ENCODED_ROWS", 4)
    files = []
    for name in ("columns", "rows"):
        df.write.format(export.FORMAT).mode("append").save(str(tmp_path / name))
        files.append(sorted(p.read_bytes() for p in (tmp_path / name).glob("*.bson")))
        monkeypatch.setattr(export, "by_column", lambda kind: False)
    assert files[0] == files[1] and any(files[0])
    back = spark.read.format(export.FORMAT).schema(schema[:8]).load(str(tmp_path / "columns")).collect()
    cut = lambda r: r["u"] and (r["s"], r["l"], r["u"]["n"], r["u"]["e"])
    assert [cut(r) for r in back[:3]] == [("é\0", 1 << 40, -(1 << 31), [[1, None], None, []]), None, ("", (1 << 31) - 1, 1 << 31, None)]
    place = spark.read.format(export.FORMAT).schema("_place struct<f:string,o:long>").load(str(tmp_path / "columns")).first()[0]
    assert place.o == 0 and place.f.endswith(".bson")


def test_rows_travel_in_batches(tmp_path):
    """Reader and writer hand over Arrow batches, not a Python row at a time."""
    schema = T.StructType([T.StructField("id", T.LongType())])
    source = export.ExportSource({"path": str(tmp_path)})
    written = source.writer(schema, False).write(iter([pa.RecordBatch.from_pydict({"id": [1, None, 3]})]))
    source.writer(schema, False).commit([written])
    reader = source.reader(schema)
    assert [b.to_pydict() for part in reader.partitions() for b in reader.read(part)] == [{"id": [1, None, 3]}]
