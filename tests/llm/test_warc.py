"""WARC: exact round trip of payloads in chunks, revisits, awkward pages, archives of several parts."""

import base64
import gzip
import hashlib
from collections import Counter, defaultdict

import duckdb
import pytest

from issuelab.llm import warc
from issuelab.operators import lookup

SCHEMA = "page_id bigint, url string, html string"


def made():
    rows = [(i, f"http://a/{i}", f"<p>{'x' * (i * 7 % 90)}é🙂\r\n\r\nWARC/1.1</p>") for i in range(60)]
    rows += [(100 + i, None, "copied <b>page</b>" * 5) for i in range(70)]  # a third of all rows
    return rows + [(300, "u", None), (301, "u\r\nX: y<%>", ""), (302, "v", "long " * 50_000)]


def expected(rows):
    most = defaultdict(list)
    for i, _, html in rows:
        most[html or ""].append(i)
    out = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        first = max(most[html or ""])
        out[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), *(
            ("response", None) if i == first else ("revisit", first)
        )] += 1
    return out


def found(back):
    number = lambda v: None if v is None else int(v)
    return Counter(
        (number(r["page"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"]))
        for r in back.collect()
    )


@pytest.mark.parametrize("archive", [warc.Archive(), warc.Archive(chunk_bytes=16, archive_bytes=500)])
def test_round_trip(spark, archive):
    rows = made()
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    manifest = warc.write_archives(pages, archive)
    chunks = warc.read_chunks(manifest, archive).cache()
    back = warc.read_records(chunks)
    assert found(back) == expected(rows) and back.where("not intact").count() == 0
    assert {(r["page"], r["target_uri"]) for r in back.collect()} == {(str(i), u) for i, u, _ in rows}
    parts = defaultdict(dict)
    digests = {}
    for r in chunks.where("record_type = 'response'").collect():
        assert len(r["chunk"]) <= archive.chunk_bytes
        parts[r["record_id"]][r["chunk_no"]] = bytes(r["chunk"])
        digests[r["record_id"], r["chunk_no"]] = r["seen_digest"]
    texts = {f"<urn:page:{i}>": (h or "").encode() for i, _, h in rows}
    for record, pieces in parts.items():
        assert b"".join(pieces[k] for k in range(len(pieces))) == texts[record]
        so_far = hashlib.sha1()
        for k in range(len(pieces)):  # each chunk row carries the digest up to it
            so_far.update(pieces[k])
            assert digests[record, k] == base64.b32encode(so_far.digest()).decode()
    if archive.archive_bytes == 500:
        assert manifest.count() > 6 and len(parts["<urn:page:302>"]) == 250_000 // 16
    chunks.unpersist()


def test_files_are_plain_warc(spark):
    manifest = warc.write_archives(spark.createDataFrame([(1, "http://a", "ab"), (2, None, "ab")], SCHEMA).coalesce(1))
    (row,) = manifest.collect()
    files, place = warc._open(row["path"])
    with files.open_input_stream(place, compression=None) as f:
        packed = f.read()
    assert row["records"] == 2 and row["bytes"] == len(packed)
    text = gzip.decompress(packed).decode()
    first, second = text.split("WARC/1.1\r\n")[1:]
    assert "WARC-Type: revisit" in first and "WARC-Refers-To: <urn:page:2>" in first and first.endswith("\r\n\r\n\r\n\r\n")
    assert "WARC-Type: response" in second and second.endswith("\r\n\r\nab\r\n\r\n") and "Target" not in second
    length = int(second.split("Content-Length: ")[1].split("\r\n")[0])
    assert length == len(second.split("\r\n\r\n", 1)[1]) - 4


def test_copies_beyond_the_broadcast_size(spark, monkeypatch):
    rows = made() + [(500 + i, "w", f"pair {i // 2}") for i in range(20)]
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookup, "HOT_KEYS", 1)
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(warc.read_records(warc.read_chunks(warc.write_archives(pages)))) == expected(rows)


def test_least_bytes_null_ids_repeated_rows_clashes(spark):
    rows = [(1, "a", "same"), (2, "b", "same"), (2, "b", "same"), (None, "c", "same"), (None, "d", "alone"), (5, "e", "xy"), (6, "f", "xy")]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'mine' payload", "1 id", "2 chunk", "'p' path", "'q' payload_key")
    archive = warc.Archive(least_bytes=3)
    got = found(warc.read_records(warc.read_chunks(warc.write_archives(pages, archive), with_payload=False)))
    kinds = Counter({(k[0], k[3], k[4]): n for k, n in got.items() if k[1] == 4})
    assert kinds == {(1, "revisit", 2): 1, (2, "response", None): 2, (None, "revisit", 2): 1}
    assert {(k[0], k[3]) for k in got if k[1] != 4} == {(None, "response"), (5, "response"), (6, "response")}


def test_empty_table(spark):
    manifest = warc.write_archives(spark.createDataFrame([], SCHEMA))
    assert manifest.count() == 0 and warc.read_records(warc.read_chunks(manifest)).count() == 0


def test_broken_archives_are_errors(spark, tmp_path):
    good = warc._heads({"id": "1", "url": None, "record_type": "response", "refers_to": None, "sha1": "00" * 20, "n_bytes": 5}, "d")
    for name, data in (("short", good + b"abc"), ("long", good + b"abcdefgh\r\n\r\n"), ("other", b"hello\r\n\r\n")):
        path = tmp_path / f"{name}.warc"
        path.write_bytes(data)
        with pytest.raises(Exception, match="record"):
            warc.read_chunks(spark.createDataFrame([(str(path),)], "path string")).count()


def test_sql_states_the_same():
    rows = made()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = expected(rows)
    columns = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    assert Counter(con.execute(f"SELECT {columns} FROM ({warc.warc_sql()})").fetchall()) == want
