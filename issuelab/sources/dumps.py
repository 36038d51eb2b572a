"""Merging folders of issue dumps in mixed JSON layouts.

A file holds one JSON value (an array of records, or one record) or one JSON value per line. Which of the two
is told by a scan of its brackets (``json_values``), which also yields the elements of an array in parallel, so
that no file is ever one row. The other files are read by lines. Each element or line is checked once; its outcome
is written to the shared folder, and everything else is read from there.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelab.schemas import ISSUE_RAW
from issuelab.session import stage, use_utc
from issuelab.sources import json_values
from issuelab.sources.readers import DUMP_PATTERN


@dataclass(frozen=True)
class Merged:
    records: DataFrame  # schema columns, ``file``, and ``raw`` (the record as JSON text)
    report: DataFrame  # file, status, records, bad_lines


def _one_spelling(path: str) -> Column:
    """Local paths come as ``file:/x`` or ``file:///x``."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _checker() -> Column:
    """Column function: a text as one line of JSON, null if it is no JSON value.

    A value must fill the text: anything but white space after it makes it invalid. Repeated keys and
    NaN are accepted, the last value of a key counts. The text stays as it is but for line ends.
    """

    @F.arrow_udf(T.StringType())
    def checked(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            try:
                value = json.loads(text)
            except (ValueError, RecursionError):
                out.append(None)
                continue
            bare = text.strip()
            out.append(json.dumps(value, separators=(",", ":")) if "\n" in bare or "\r" in bare else bare)
        return pa.array(out, pa.string())

    return checked


def _lines(spark: SparkSession, root: str, pattern: str, recursive: bool, documents: DataFrame) -> DataFrame:
    """Lines that aren't blank of all files but ``documents`` (path): file, whether it is readable, and the checked text."""
    text = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", recursive)
        .text(root)
    )
    text = text.select(F.col("_metadata.file_path").alias("path"), "value")
    lines = text.join(F.broadcast(documents), "path", "left_anti").select(
        _one_spelling("path").alias("file"),
        F.is_valid_utf8("value").alias("readable"),
        F.make_valid_utf8("value").alias("value"),
    ).where(F.trim(F.translate("value", "\t\r\x0b\x0c", "    ")) != "")
    # A blank-looking rest of other white space is no JSON value, like any broken line.
    return lines.select("file", "readable", _checker()(F.col("value")).alias("raw"))


def _files(spark: SparkSession, root: str, pattern: str, recursive: bool) -> DataFrame:
    """Names of all matched files, from the listing that the driver holds for any scan.

    No scan yields a row of an empty file, so their names can come from nowhere else.
    """
    listed = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).text(root)
    names = spark.createDataFrame([(f,) for f in listed.inputFiles()], "file string")
    return names.select(_one_spelling("file").alias("file"))


def _documents(spark: SparkSession, root: str, pattern: str, recursive: bool) -> tuple[DataFrame, DataFrame]:
    """Records (path, raw) of the files that are one JSON value, and their paths (one row a file)."""
    rows = json_values.fragments(spark, root, pattern, recursive)
    found = stage(json_values.survey(rows), "survey")
    parts = json_values.elements(rows, found).withColumn("raw", _checker()("text"))
    blank = F.trim(F.translate("text", "\t\r\n", "   ")) == ""
    parts = stage(parts.select("path", "raw", blank.alias("blank")), "documents")
    sums = parts.groupBy("path").agg(
        F.count("*").alias("n"), F.count_if(F.col("raw").isNull()).alias("bad"), F.count_if("blank").alias("blank")
    )
    empty = "n = 1 and blank = 1"  # an array without elements
    paths = stage(sums.where(f"bad = 0 or ({empty})").select("path"), "paths")
    return parts.where("raw is not null"), paths


def merge_dumps(
    spark: SparkSession,
    root: str,
    strict: bool = False,
    schema: T.StructType = ISSUE_RAW,
    pattern: str = DUMP_PATTERN,
    recursive: bool = False,
) -> Merged:
    """Bag union of every record in ``root`` and an account per file.

    Lenient: malformed lines are left out and counted, undecodable files skipped and listed.
    Strict: either one raises. A field of the wrong type is null; the record stays.
    """
    use_utc(spark)
    parts, paths = _documents(spark, root, pattern, recursive)
    whole = parts.join(F.broadcast(paths), "path", "left_semi").select(_one_spelling("path").alias("file"), "raw")
    lines = stage(_lines(spark, root, pattern, recursive, paths), "lines")
    counted = lines.groupBy("file").agg(
        F.count("raw").alias("good"), F.count_if(F.col("raw").isNull()).alias("bad"), F.bool_and("readable").alias("readable")
    )
    documents = paths.select(_one_spelling("path").alias("file"))
    in_documents = documents.join(whole.groupBy("file").agg(F.count("*").alias("n")), "file", "left")
    in_documents = in_documents.select("file", F.coalesce("n", F.lit(0)).alias("doc_records"))
    per_file = _files(spark, root, pattern, recursive).join(counted, "file", "left").join(in_documents, "file", "left")
    skipped = F.coalesce(~F.col("readable"), F.lit(False))
    is_document = F.col("doc_records").isNotNull()
    report = stage(
        per_file.select(
            "file",
            F.when(skipped, "skipped").when(is_document, "document").otherwise("lines").alias("status"),
            F.when(skipped, 0).otherwise(F.coalesce("doc_records", "good", F.lit(0))).alias("records"),
            F.when(skipped | is_document, 0).otherwise(F.coalesce("bad", F.lit(0))).alias("bad_lines"),
        ),
        "report",
    )
    if strict:
        trouble = report.where((F.col("status") == "skipped") | (F.col("bad_lines") > 0)).first()
        if trouble is not None:
            raise ValueError(f"malformed dump: {trouble['file']} ({trouble['bad_lines']} bad lines)")

    as_lines = report.where(F.col("status") == "lines").select("file")
    # Within a file of lines an array is one record, as it stands.
    by_line = lines.where("raw is not null").join(as_lines, "file", "left_semi").select("file", "raw")
    every = by_line.unionByName(whole)
    parsed = every.select(F.from_json("raw", schema).alias("r"), "file", "raw")
    return Merged(parsed.select("r.*", "file", "raw"), report)


def report_totals(report: DataFrame) -> DataFrame:
    skipped = F.col("status") == "skipped"
    return report.agg(
        F.count("*").alias("files"),
        F.count_if(~skipped).alias("processed"),
        F.count_if(skipped).alias("skipped"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("bad_lines"), F.lit(0)).alias("bad_lines"),
    )


def write_merged(merged: Merged, path: str) -> None:
    """Records as JSON lines in ``path``/records, the account as JSON lines in ``path``/report."""
    merged.records.select("raw").write.mode("overwrite").text(f"{path}/records")
    merged.report.write.mode("overwrite").json(f"{path}/report")
