"""One large JSON value read in many splits: elements equal those of a plain parse, wherever the splits fall."""

import json
import random

import pytest
from pyspark.sql import functions as F

from issuelab.sources import dumps, json_values

ODD = ["},", '"},{"', "\\", "\\\\", '\\"', "{[", "]}", "é🙂", " ", "a,b", " ", "", "line\nfeed", "},\n  {"]


def value(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 3)
    if kind == 0:
        return rng.choice([None, True, 1.5e3, -2, 10**20])
    if kind in (1, 2):
        return "".join(rng.choice(ODD) for _ in range(rng.randrange(6)))
    if kind == 3:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(ODD) + str(k): value(rng, depth + 1) for k in range(rng.randrange(4))}


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def found(spark, root, *files):
    rows = json_values.fragments(spark, str(root), "*.json", False)
    survey = json_values.survey(rows).cache()
    got = {}
    for r in json_values.elements(rows, survey).collect():
        got.setdefault(r["path"].rsplit("/", 1)[1], []).append(r["text"])
    return survey, got


@pytest.mark.parametrize("style", [{}, {"indent": 1}, {"separators": (",", ":"), "ensure_ascii": False}])
def test_elements_equal_a_plain_parse(spark, tmp_path, small_splits, style):
    rng = random.Random(str(style))
    want = {}
    for k in range(4):
        want[f"f{k}.json"] = [{"id": i, "v": value(rng)} if i % 7 else value(rng) for i in range(300)]
        # An element longer than several splits, of strings full of cuts.
        want[f"f{k}.json"].insert(rng.randrange(300), {"long": ["x},\"{" * 40 + "\\"] * 60})
        text = json.dumps(want[f"f{k}.json"], **style)
        (tmp_path / f"f{k}.json").write_text(text, encoding="utf-8")
    survey, got = found(spark, tmp_path)
    assert {r["kind"] for r in survey.collect()} == {"array"}
    assert survey.groupBy("path").count().agg(F.min("count")).first()[0] > 5
    key = lambda v: json.dumps(v, sort_keys=True)
    for name, values in want.items():
        assert sorted(key(json.loads(t)) for t in got[name]) == sorted(map(key, values)), name


def test_only_single_values_are_taken_apart(spark, tmp_path, small_splits):
    line = '{"id": %d, "t": "' + "y" * 40 + '", "o": {"a": [1, 2]}}'
    many = [line % i for i in range(500)]
    files = {
        "array.json": ("[" + ",\n".join(many) + "]\n", "array"),
        "lines.json": ("\n".join(many), None),
        "cut_first.json": ("\n".join([many[0][:30], *many[1:]]), None),  # ends inside a string
        "cut_first_open.json": ("\n".join(['{"id": 8', *many[1:]]) + "}", None),  # one bracket too few, one too many
        "two_arrays.json": ("[" + ",".join(many) + "]\n[1]", None),
        "open.json": ("[" + ",".join(many), None),
        "ends_in_cut.json": ("[1]},", None),
        "in_string.json": ('["' + ", ".join(many).replace('"', "'"), None),
        "object.json": ('{\n"a": [' + ",\n".join(many) + "]}", "object"),
        "object_line.json": ('{"a": 1}', None),
        "empty_array.json": ("[ \n ]", "array"),
        "scalar.json": ("17", None),
        "mark.json": ("﻿[1, 2]", "array"),
    }
    for name, (text, _) in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    survey, got = found(spark, tmp_path)
    kinds = {r["path"].rsplit("/", 1)[1]: r["kind"] for r in survey.collect()}
    assert kinds == {name: kind for name, (_, kind) in files.items()}
    assert sorted(got) == sorted(n for n, (_, k) in files.items() if k)
    assert [json.loads(t) for t in got["object.json"]] == [json.loads(files["object.json"][0])]
    assert len(got["array.json"]) == 500 and max(map(len, got["array.json"])) < 200


def test_merge_of_a_large_array_and_a_damaged_one(spark, tmp_path, small_splits):
    records = [{"id": i, "title": "t},{" * (i % 9), "labels": ["a", "b"]} for i in range(400)]
    (tmp_path / "good.json").write_text(json.dumps(records, indent=2))
    damaged = json.dumps(records[:50]).replace('"id": 7,', '"id": 7 7,')
    (tmp_path / "damaged.json").write_text(damaged)
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "cut.jsonl").write_text("\n".join(['{"id": 1, "title": "x'] + [json.dumps(r) for r in records]))
    merged = dumps.merge_dumps(spark, str(tmp_path))
    account = {r["file"].rsplit("/", 1)[1]: (r["status"], r["records"], r["bad_lines"]) for r in merged.report.collect()}
    assert account == {
        "good.json": ("document", 400, 0), "damaged.json": ("lines", 0, 1), "empty.json": ("document", 0, 0), "cut.jsonl": ("lines", 400, 1),
    }
    assert sorted(r["id"] for r in merged.records.collect()) == sorted([*range(400)] * 2)
    assert merged.records.where("raw like '%\n%'").count() == 0


def test_stitching_is_spread_over_tasks(spark, tmp_path):
    """Many small files are not stitched by one task."""
    from issuelab.session import stage

    for k in range(60):
        (tmp_path / f"f{k}.json").write_text(json.dumps([{"id": k}, {"id": k + 1}]))
    found = json_values.survey(json_values.fragments(spark, str(tmp_path), "*", False))
    assert found.select("path", F.spark_partition_id().alias("task")).select("task").distinct().count() > 1
    parts = json_values.elements(json_values.fragments(spark, str(tmp_path), "*", False), stage(found, "survey"))
    assert parts.groupBy("path").count().where("count = 2").count() == 60
