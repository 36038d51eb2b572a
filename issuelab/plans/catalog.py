"""The registered queries: (spark, folder of tables) -> DataFrame.

Each reads whole tables. Timestamps are shown as text and long texts as their MD5 so that results
compare value by value with the SQL in ``oracles``.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelab.functions import targets, text, timing, vectors
from issuelab.functions.labels import keyword_flags, without_nulls
from issuelab.operators import (
    clean,
    decide,
    embeddings,
    enrich,
    features,
    idsets,
    ingest,
    kpis,
    metrics,
    normalize,
    priors,
    splits,
)
from issuelab.plans import training, views
from issuelab.plans.dataset import training_table
from issuelab.schemas import BASE_FEATURES, CLEAN_COLS, LEGACY_FEATURES, STAGE1_FEATURES, STAGE2_FEATURES
from issuelab.session import new_staging_path, stage
from issuelab.sources import dumps, readers, writers
from issuelab.streaming import jobs, once, store

AS_OF = "2000-06-15T12:00:00Z"
DEFAULT_SINCE = "1995-01-01T00:00:00Z"
HORIZON = 30
FOLDS = 5

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def as_of() -> Column:
    return F.to_timestamp(F.lit(AS_OF))


def shown(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


# --- shared inputs -------------------------------------------------------------------------------


def raw(spark: SparkSession, d: str, body: bool = False) -> DataFrame:
    return views.raw_records(spark, d, text=body)


def clean_rows(spark: SparkSession, d: str, body: bool = False, columns=None) -> DataFrame:
    """Training table; without ``body`` the text columns are empty and the text join is skipped."""
    return training_table(raw(spark, d, body), columns=columns)


def store_rows(spark: SparkSession, d: str, body: bool = False) -> DataFrame:
    """Current issues with typed dates, as the dashboard sees them."""
    df = views.issue_facts(spark, d, text=body)
    return df.withColumn("labels", without_nulls()).withColumnsRenamed(
        {"created_ts": "created_at", "closed_ts": "closed_at"}
    )


def messages(spark: SparkSession, d: str, body: bool = False) -> DataFrame:
    """Raw records as broker messages; one in 53 is cut off and no longer JSON."""
    df = raw(spark, d, body)
    seq = F.col("ingest_seq")
    value = writers.message_value(df)
    return df.select(
        writers.message_key().alias("key"),
        F.when(seq % 53 == 0, F.left(value, F.char_length(value) - 1)).otherwise(value).alias("value"),
        F.timestamp_seconds(seq).alias("timestamp"),
        (seq % 3).cast("int").alias("partition"),
        seq.alias("offset"),
    )


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Narrow training rows with the horizon label and split, for the fitting queries."""
    columns = ["row_id", "repo_full_name", "created_ts", "ttf_hours", "days_to_close"]
    df = clean_rows(spark, d, columns=columns)
    return df.withColumn("y", features.within("days_to_close", HORIZON))


def split_rows(spark: SparkSession, d: str) -> DataFrame:
    return splits.with_time_split(stage(labelled(spark, d), "labelled"))


def train_rows(spark: SparkSession, d: str) -> DataFrame:
    return split_rows(spark, d).where("split = 'train'")


def quick_train_rows(spark: SparkSession, d: str) -> DataFrame:
    """Training part of the issues closed within the horizon."""
    quick = stage(labelled(spark, d).where(F.col("days_to_close") <= HORIZON), "quick")
    return splits.with_time_split(quick).where("split = 'train'")


# --- sources and sinks ---------------------------------------------------------------------------


def _dump(spark, d) -> str:
    """Raw records written as JSON lines per repository and run."""
    path = new_staging_path(spark, "raw")
    writers.append_by_repo(raw(spark, d).drop("ingest_seq"), path, "20240101_000000")
    return path


@query
def s1_jsonl_scan(spark, d):
    """Recursive scan of a dump; every row gets its place in the dump."""
    df = readers.read_jsonl(spark, _dump(spark, d), pattern="*.json")
    return df.groupBy("repo_full_name", "state").agg(
        F.count("*").alias("n"), F.sum("id").alias("id_sum"), F.count_distinct("ingest_seq").alias("places"),
        F.sum("comments").alias("comments"),
    )


EXPORTED = (
    "id long, repo_full_name string, state string, created_at string, closed_at timestamp, labels array<string>, "
    "user struct<login:string,since:timestamp>, comments int"
)


@query
def s2_store_export(spark, d):
    """A document-store export with nested documents, dates and ids, written and read back in many ranges."""
    path = new_staging_path(spark, "export")
    rows = views.issue_facts(spark, d).select(
        F.md5(F.col("id").cast("string")).alias("_id"), "id", "repo_full_name", "state", F.col("created_ts").alias("created_at"),
        F.col("closed_ts").alias("closed_at"), "labels", F.struct(F.col("user_login").alias("login"), F.col("created_ts").alias("since")).alias("user"),
        "comments",
    )
    writers.write_export(rows, path)
    back = readers.read_export(spark, path, T.StructType.fromDDL(EXPORTED), split_bytes=1 << 20)
    return back.select(
        "id", "repo_full_name", "state", "created_at", shown("closed_at"), F.array_join("labels", "|", "~").alias("labels"),
        F.col("user.login").alias("user_login"), F.date_format("user.since", views.ISO).alias("since"), "comments",
    )


@query
def s10_source_selector(spark, d):
    """The first of several folders that is there, through the selector."""
    missing = new_staging_path(spark, "missing")
    df = readers.load_issues(spark, "jsonl", [missing, _line_dump(spark, d), missing])
    return df.groupBy("repo_full_name").agg(F.count("*").alias("n"), F.sum("id").alias("id_sum"))


def _line_dump(spark, d) -> str:
    path = new_staging_path(spark, "lines")
    value = F.to_json(F.struct("id", "repo_full_name", "state"))
    rows = views.issue_facts(spark, d, activity=False).select(value.alias("value"))
    rows.write.text(f"{path}/part")
    return _named(spark, f"{path}/part", ".jsonl")


def _named(spark, path: str, ending: str) -> str:
    """The same files with the ending that dumps have."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name.startswith("part-"):
            files.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}{ending}"))
    return path


@query
def s5_sample(spark, d):
    """The first thousand rows of a dump whose file order is known: one file per run of ids."""
    path = new_staging_path(spark, "sampled")
    rows = views.issue_snapshots(spark, d, activity=False).select("id", "snap_no", "repo_full_name", "state")
    part = F.format_string("%05d", F.expr("id div 400"))
    rows.withColumn("run", part).repartition("run").sortWithinPartitions("run", "id", "snap_no").write.partitionBy("run").json(path)
    return readers.read_sample(spark, path, rows=1000, pattern="*.json").select("id", "repo_full_name", "state")


@query
def s3_parquet_scan(spark, d):
    return readers.read_store(spark, f"{d}/orders.parquet").select(
        "o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice")
    ).where("o_orderstatus = 'F'")


@query
def s4_mixed_merge(spark, d):
    """Issues written in three layouts with damaged lines, merged back: account per kind."""
    merged = dumps.merge_dumps(spark, _mixed_dump(spark, d), pattern="*", recursive=True)
    per_kind = merged.report.groupBy(F.regexp_extract("file", r"/kind=(\w+)/", 1).alias("kind")).agg(
        F.sum("records").alias("records"), F.sum("bad_lines").alias("bad_lines")
    )
    ids = merged.records.groupBy(F.regexp_extract("file", r"/kind=(\w+)/", 1).alias("kind")).agg(
        F.sum("id").alias("id_sum"), F.count("id").alias("with_id")
    )
    return per_kind.join(ids, "kind")


def _mixed_dump(spark, d) -> str:
    """Arrays, single objects and JSON lines (every 20th line cut short), derived from the issues."""
    root = new_staging_path(spark, "mixed")
    rec = views.issue_facts(spark, d, activity=False).select(
        "id", "number", "repo_full_name", "state", F.date_format("created_ts", views.ISO).alias("created_at")
    )
    body = F.to_json(F.struct(*rec.columns))
    kind = F.when(F.col("id") % 5000 == 7, "object").when(F.col("id") % 4 == 1, "array").otherwise("lines")
    rows = rec.select("id", kind.alias("kind"), body.alias("value"))
    lines = rows.where("kind = 'lines'").select(
        F.when(F.col("id") % 20 == 0, F.expr("left(value, length(value) - 3)")).otherwise(F.col("value"))
    )
    lines.write.text(f"{root}/kind=lines/")
    # One array document per file; a run of 4000 consecutive ids bounds what one file gathers.
    arrays = rows.where("kind = 'array'").groupBy(F.expr("id div 4000").alias("run")).agg(
        F.concat(F.lit("[\n"), F.array_join(F.sort_array(F.collect_list("value")), ",\n"), F.lit("\n]")).alias("value")
    )
    # A file each, all in one folder: a folder each would make every listing a job of thousands of tasks.
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{root}/kind=array/")
    objects = rows.where("kind = 'object'").select(F.regexp_replace("value", ",", ",\n").alias("value"))
    objects.write.option("maxRecordsPerFile", 1).text(f"{root}/kind=object/")
    return root


@query
def s7_store_scan(spark, d):
    return readers.dashboard_issues(store_rows(spark, d)).select(
        "id", shown("created_at"), shown("closed_at"), "labels_str"
    )


@query
def s8_line_counts(spark, d):
    """Lines of the documents' text export, counted over all files."""
    path = new_staging_path(spark, "text")
    views.table(spark, d, "documents").select(F.translate("text", "\r", "").alias("text")).write.text(path)
    return readers.line_counts(spark, path, "*").agg(F.sum("n").alias("n_lines"))


@query
def s9_embedding_bundle(spark, d):
    """Vectors saved under a model tag and loaded through the latest pointer."""
    root = new_staging_path(spark, "bundle")
    emb = views.table(spark, d, "embeddings").select(
        F.concat(F.lit("v#"), F.col("vec_id").cast("string")).alias("row_id"), "embedding"
    )
    doubled = emb.withColumn("embedding", F.transform("embedding", lambda x: x * 2))
    writers.write_embeddings(emb, root, "lab/older encoder")
    writers.write_embeddings(doubled, root, "lab/new-encoder v2")
    return readers.read_embeddings(spark, root).select(
        "row_id", F.size("embedding").alias("dim"), r6(vectors.l2_norm("embedding")).alias("norm")
    )


@query
def k2_training_parquet(spark, d):
    """Training table written, then scanned for the columns a trainer needs."""
    path = new_staging_path(spark, "table")
    writers.write_training(clean_rows(spark, d), path)
    df = readers.read_training(spark, path, ["row_id", "created_ts", "days_to_close"])
    return df.select("row_id", shown("created_ts"), F.round("days_to_close", 8).alias("days_to_close"))


@query
def k3_iso_export(spark, d):
    return writers.iso_export(clean_rows(spark, d, columns=["row_id", *writers.TS_COLS])).select("row_id", *writers.TS_COLS)


@query
def k4_dataset_meta(spark, d):
    meta = writers.dataset_meta(clean_rows(spark, d), data_source="store", cap_days_to_close=0.0)
    return meta.select(
        "n_rows", "data_source", "cap_days_to_close", F.size("columns").alias("n_columns")
    )


@query
def k5_append_by_repo(spark, d):
    """Two runs appended per repository and read back by partition."""
    path = new_staging_path(spark, "byrepo")
    df = raw(spark, d).select("id", "repo_full_name", "state", "ingest_seq")
    writers.append_by_repo(df.where("state = 'open'"), path, "20240101_000000")
    writers.append_by_repo(df.where("state = 'closed'"), path, "20240102_000000")
    back = spark.read.schema("id long, repo_full_name string, repo_key string, run_ts string").json(path)
    return back.groupBy("repo_key", "run_ts").agg(F.count("*").alias("n"), F.sum("id").alias("id_sum"))


@query
def k6_merge_report(spark, d):
    return dumps.report_totals(
        dumps.merge_dumps(spark, _mixed_dump(spark, d), pattern="*", recursive=True).report
    ).select("skipped", "records", "bad_lines")


@query
def k6_merged_output(spark, d):
    """The merged dump as written: its records read again, and the totals of the written account."""
    path = new_staging_path(spark, "merged")
    dumps.write_merged(dumps.merge_dumps(spark, _mixed_dump(spark, d), pattern="*", recursive=True), path)
    records = readers.read_jsonl(spark, f"{path}/records", with_order=False, pattern="*")
    account = spark.read.json(f"{path}/report").agg(F.sum("records").alias("reported"), F.sum("bad_lines").alias("bad_lines"))
    return records.groupBy("state").agg(F.count("*").alias("n"), F.sum("id").alias("id_sum")).crossJoin(F.broadcast(account))  # one row


@query
def k8_message_payload(spark, d):
    df = views.issue_facts(spark, d)
    return writers.message_payload(
        df.select("id", "repo_full_name", "state", "author_association", "comments", "is_pull_request")
    )


@query
def k9_state_upsert(spark, d):
    old = views.cursors(spark, d).withColumns(
        {"last_run_at": F.lit("2024-01-01T00:00:00Z"), "last_collected_count": F.lit(5).cast("long")}
    )
    issues = views.issue_facts(spark, d, activity=False)
    new = ingest.run_rows(issues, 1, F.lit(AS_OF)).where("collected > 1")
    return ingest.upsert_state(old, new)


# --- projections, filters, predicates ------------------------------------------------------------


@query
def p1_parse_json(spark, d):
    return enrich.parse_messages(messages(spark, d)).select(
        "kafka_key", "kafka_offset", "kafka_partition", "id", "repo_full_name", "number", "state",
        "comments", F.array_join("labels", "|", "~").alias("labels"), "created_at", "is_pull_request",
        "milestone",
    )


@query
def p2_required_keys(spark, d):
    return enrich.with_keys(enrich.parse_messages(messages(spark, d))).select(
        "kafka_offset", "id", "number"
    )


def _enriched(spark, d, body=False, labels: Column | None = None, **kw):
    df = raw(spark, d, body)
    for name in ("collected_at", *(() if body else ("title", "body"))):
        df = df.withColumn(name, F.lit(None).cast("string"))
    if labels is not None:
        df = df.withColumn("labels", labels)
    return enrich.clean_and_enrich(df, as_of=as_of(), **kw)


@query
def p4_processed_at(spark, d):
    """The time of processing, one for all rows of a batch."""
    rows = _enriched(spark, d)
    return rows.select("ingest_seq", shown("processed_at"), (F.col("processed_at") >= F.col("created_at")).alias("after_creation"))


@query
def p5_label_count(spark, d):
    labels = F.when(F.col("id") % 17 != 0, without_nulls())
    df = _enriched(spark, d, labels=labels, null_labels_as_minus_one=True)
    return df.select("ingest_seq", "label_count", "has_labels", "has_assignees", "is_closed")


@query
def p7_lengths(spark, d):
    return _enriched(spark, d, body=True).select("ingest_seq", "has_body", "body_length", "title_length")


@query
def p9_label_flags_exact(spark, d):
    labels = F.when(F.col("id") % 17 != 0, F.col("labels"))
    return _enriched(spark, d, labels=labels).select(
        "ingest_seq", "is_bug", "is_enhancement", "is_documentation", "is_question"
    )


@query
def p10_durations(spark, d):
    return _enriched(spark, d).select(
        "ingest_seq",
        r6("time_to_close_hours").alias("time_to_close_hours"),
        r6("time_to_first_comment_hours").alias("time_to_first_comment_hours"),
    )


@query
def p11_age(spark, d):
    return _enriched(spark, d).select("ingest_seq", r6("age_hours").alias("age_hours"))


@query
def p12_required_columns(spark, d):
    df = raw(spark, d).drop("first_comment_at", "author_association", "title")
    df = df.withColumn("is_pull_request", F.when(F.col("id") % 5 != 0, F.col("is_pull_request")))
    return clean.ensure_required(df).select(
        "ingest_seq", "is_pull_request", "first_comment_at", "author_association", "title"
    )


@query
def p13_drop_prs(spark, d):
    return clean.drop_pull_requests(raw(spark, d)).select("ingest_seq", "repo_full_name")


@query
def p14_labels(spark, d):
    df = views.issue_facts(spark, d).withColumn("labels", F.when(F.col("id") % 17 != 0, F.col("labels")))
    return df.select("id", F.array_join(without_nulls(), "|").alias("labels"))


@query
def p15_numeric_coerce(spark, d):
    """Counts and numbers spelt badly in several ways."""
    n = F.col("comments").cast("string")
    df = raw(spark, d).withColumns(
        {
            "comments": F.when(F.col("id") % 4 == 0, F.concat(n, F.lit(".7")))
            .when(F.col("id") % 4 == 1, "n/a")
            .when(F.col("id") % 4 == 2, n),
            "number": F.when(F.col("id") % 9 == 0, "x").otherwise(F.col("id").cast("string")),
        }
    )
    return clean.typed(df).select("ingest_seq", "comments", "number")


@query
def p16_lenient_times(spark, d):
    """Zulu, offset, empty, malformed and missing times."""
    df = views.issue_facts(spark, d, activity=False)
    local = F.date_format(F.col("created_ts"), "yyyy-MM-dd'T'HH:mm:ss")
    spelt = (
        F.when(F.col("id") % 5 == 0, F.concat(local, F.lit("Z")))
        .when(F.col("id") % 5 == 1, F.concat(local, F.lit("+02:00")))
        .when(F.col("id") % 5 == 2, "")
        .when(F.col("id") % 5 == 3, "yesterday")
    )
    return df.select("id", timing.parse_utc(spelt).alias("ts")).select("id", shown("ts"))


@query
def p18_sanity(spark, d):
    return clean.sane_times(views.issue_snapshots(spark, d)).select(
        "ingest_seq", shown("closed_ts"), shown("first_comment_ts")
    )


@query
def p20_cap(spark, d):
    return training_table(raw(spark, d), cap_days=30.0, columns=["row_id", "days_to_close"]).select(
        "row_id", F.round("days_to_close", 8).alias("days_to_close")
    )


@query
def p21_clean_table(spark, d):
    """The clean table's 29 columns; texts as digests, made before the de-duplication, so that no text is shuffled."""
    texts = ["title", "body", "text"]
    digests = lambda rows: rows.withColumns({f"{c}_md5": F.md5(c) for c in texts})
    columns = [f"{c}_md5" if c in texts else c for c in CLEAN_COLS]
    df = training_table(raw(spark, d, body=True), columns=columns, derive=digests)
    return df.select(
        *[c for c in df.columns if c not in (*(f"{t}_md5" for t in texts), "labels", *writers.TS_COLS, "ttf_hours", "days_to_close")],
        *[F.col(f"{c}_md5").alias(c) for c in texts],
        F.array_join("labels", "|").alias("labels"),
        *[shown(c) for c in writers.TS_COLS],
        r6("ttf_hours").alias("ttf_hours"),
        F.round("days_to_close", 8).alias("days_to_close"),
    )


@query
def p22_horizon_label(spark, d):
    return clean_rows(spark, d, columns=["row_id", "days_to_close"]).select(
        "row_id",
        features.within("days_to_close", 30).alias("close_within_30"),
        features.within("days_to_close", 7).alias("close_within_7"),
    )


@query
def p23_regression_rows(spark, d):
    rows = clean_rows(spark, d, columns=["row_id", "days_to_close", "created_ts"])
    kept = training.regression_rows(rows, training.Settings(), at_least=1)
    return kept.select("row_id", F.round("days_to_close", 8).alias("days_to_close"), "part")


@query
def p24_leak_guard(spark, d):
    """Each numeric or time column of the cleaned issues: its values, and whether the guard lets it be a feature."""
    table = clean_rows(spark, d)
    names = [f.name for f in table.schema if isinstance(f.dataType, (T.NumericType, T.TimestampType))]
    sums = table.agg(*[F.count(c).alias(c) for c in names])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n"), F.lit(_allowed(c)).alias("allowed")) for c in names]))
    return sums.select(pairs.alias("p")).select("p.*")


def _allowed(column: str) -> bool:
    try:
        features.check_no_leak(["comments", column])
    except ValueError:
        return False
    return True


@query
def p25_t0_mode(spark, d):
    df = features.at_creation(clean_rows(spark, d, columns=["row_id", "comments", "ttf_hours"]))
    return df.select(
        "row_id",
        "comments",
        *[r6(e).alias(n) for n, e in features.ttf_features(F.col("ttf_hours"), 24.0).items()],
    )


@query
def p26_normalize_issue(spark, d):
    df = normalize.normalize_issues(views.api_issues(spark, d), collected_at=F.lit(AS_OF))
    return df.select(
        "id", "collected_at", "repo_full_name", "number", "state", "user_login",
        F.array_join("labels", "|").alias("labels"), F.array_join("assignees", "|").alias("assignees"),
        "num_assignees", "milestone", "is_pull_request", "created_at", "first_comment_at",
    )


@query
def p26_string_labels(spark, d):
    """API issues whose labels are plain strings (odd ids) or objects as JSON text (even ids)."""
    given = F.transform("labels", lambda x: F.when(F.col("id") % 2 == 0, F.to_json(F.struct(x["name"].alias("name")))).otherwise(x["name"]))
    out = normalize.normalize_issues(views.api_issues(spark, d).withColumn("labels", given), collected_at=F.lit(AS_OF))
    return out.select("id", F.array_join("labels", "|").alias("labels"), F.size("labels").alias("n"))


@query
def p27_normalize_live(spark, d):
    return normalize.normalize_live_issues(views.api_issues(spark, d)).select(
        "id", "repo_full_name", "user_login",
        F.array_join("labels", "|", "~").alias("labels"),
        F.array_join("assignees", "|", "~").alias("assignees"),
    )


@query
def p28_normalize_repo(spark, d):
    return normalize.normalize_repos(views.api_repos(spark, d), F.lit(AS_OF)).select(
        "id", "full_name", "name", "owner_login", F.array_join("topics", "|").alias("topics"),
        "stargazers_count", "license", "has_issues",
    )


@query
def p29_since_filter(spark, d):
    return ingest.changed_since(
        views.issue_snapshots(spark, d, activity=False), views.cursors(spark, d), DEFAULT_SINCE, "closed"
    ).select("ingest_seq", "repo_full_name", "since")


@query
def p30_repo_skip(spark, d):
    return ingest.collectable_repos(views.api_repos(spark, d), 1000).select("id", "full_name", "has_issues")


@query
def p31_column_names(spark, d):
    df = views.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return kpis.lower_names(df.toDF("C_CustKey", "  C_Name ", "c_mktsegment "))


@query
def p32_audit_prep(spark, d):
    return kpis.audit_columns(store_rows(spark, d)).select(
        "id", F.round("days_to_close", 8).alias("days_to_close"), "resolved_30d", "created_month"
    )


@query
def p33_clean_text(spark, d):
    bare = text.clean_markup("html")
    return views.table(spark, d, "pages").select(
        "page_id", F.md5(bare).alias("text"), F.char_length(bare).alias("n")
    )


@query
def p34_serving_impute(spark, d):
    df = views.issue_facts(spark, d)
    df = df.withColumn("comments", F.when(F.col("id") % 5 == 0, 0).when(F.col("id") % 5 != 1, F.col("comments")))
    return features.with_activity(df).select("id", "comments", "num_assignees")


@query
def p35_legacy_features(spark, d):
    return rounded(features.legacy_features(clean_rows(spark, d, columns=["row_id", *LEGACY_FEATURES])), "ttf_hours")


@query
def p36_scored_view(spark, d):
    scored = views.scores(spark, d).select("id", "p")
    df = store_rows(spark, d, body=True).join(scored, "id")
    return kpis.scored_view(df, "p").withColumn("created_at", shown("created_at")).withColumn("title", F.md5("title"))


# --- joins ---------------------------------------------------------------------------------------


@query
def j1_embedding_align(spark, d):
    """Issues with their vector; the unmatched residue class drops out of the inner join."""
    emb = views.table(spark, d, "embeddings").select("vec_id", "embedding")
    return embeddings.align(views.vectors(spark, d), emb, key="vec_id", strict=False).select(
        "id", "vec_id", r6(vectors.l2_norm("embedding")).alias("norm")
    )


@query
def j2_repo_prior_lookup(spark, d):
    rows = split_rows(spark, d)
    fitted = priors.fit_rate_priors(rows.where("split = 'train'"), "y")
    return rounded(
        features.join_priors(rows, fitted).select("row_id", "repo_count_train", "repo_posrate_train"),
        "repo_count_train", "repo_posrate_train",
    )


@query
def j3_serving_priors(spark, d):
    """Median priors of the regression stage looked up for every open issue."""
    fitted = priors.fit_median_priors(quick_train_rows(spark, d), "days_to_close")
    df = features.join_priors(
        store_rows(spark, d).where("state = 'open'").select("id", "repo_full_name"), fitted
    ).select("id", "repo_count_train", "repo_median_days_train")
    return rounded(rounded(df, "repo_count_train"), "repo_median_days_train", places=8)


@query
def j4_cursor_lookup(spark, d):
    repos = views.issue_facts(spark, d, activity=False).select("repo_full_name").distinct()
    return ingest.with_since(repos, views.cursors(spark, d), DEFAULT_SINCE)


@query
def j5_first_comment(spark, d):
    """The first collection of every issue."""
    df = views.issue_snapshots(spark, d).where("snap_no = 0").select(
        "id", "repo_full_name", "updated_ts", "comments", "is_pull_request"
    )
    return ingest.with_first_comment(df, views.comments(spark, d), 40).select(
        "id", shown("first_comment_ts")
    )


@query
def j6_unsent_ids(spark, d):
    batch = views.issue_snapshots(spark, d, activity=False).select(
        "id", "state", F.col("ingest_seq").alias("seq")
    )
    sent = views.table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"))
    return ingest.unsent(batch, sent)


@query
def j6_unsent_by_set(spark, d):
    """The same with the sent ids as bitmaps, of two runs."""
    batch = views.issue_snapshots(spark, d, activity=False).select("id", "state", F.col("ingest_seq").alias("seq"))
    sent = views.table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("id"))
    runs = [idsets.id_set(sent.where(F.col("id") % 2 == k)) for k in (0, 1)]
    return ingest.unsent_by_set(batch, idsets.union(*runs))


# --- aggregations --------------------------------------------------------------------------------


@query
def a1_total(spark, d):
    return kpis.total(views.issue_snapshots(spark, d, activity=False))


@query
def a2_top_repos(spark, d):
    return kpis.top_counts(views.issue_snapshots(spark, d, activity=False), "repo_full_name", 5)


@query
def a3_state_counts(spark, d):
    return kpis.counts_by(store_rows(spark, d), "state")


@query
def a4_flag_count(spark, d):
    return kpis.flag_count(_enriched(spark, d), "is_bug")


@query
def a5_keyword_counts(spark, d):
    return kpis.keyword_classes(store_rows(spark, d))


@query
def a6_bug_share(spark, d):
    return rounded(kpis.bug_share(readers.dashboard_issues(store_rows(spark, d))), "bug_pct")


@query
def a7_new_today(spark, d):
    return kpis.new_today(store_rows(spark, d), F.lit("1996-03-01").cast("timestamp"))


@query
def a8_velocity(spark, d):
    return rounded(kpis.velocity(store_rows(spark, d)), "avg_days")


@query
def a9_open_ratio(spark, d):
    return rounded(kpis.open_ratio(store_rows(spark, d)), "open_pct")


@query
def a10_audit_kpis(spark, d):
    df = kpis.audit_columns(views.issue_facts(spark, d, activity=False).withColumnsRenamed(
        {"created_ts": "created_at", "closed_ts": "closed_at"}
    ))
    df = rounded(kpis.audit_kpis(df), "mean_days", "sla_30d_pct")
    return rounded(df, "median_days", places=8)


@query
def a11_class_balance(spark, d):
    return kpis.counts_by(kpis.audit_columns(store_rows(spark, d)), "resolved_30d")


@query
def a12_histogram(spark, d):
    return rounded(kpis.histogram(kpis.audit_columns(store_rows(spark, d)), "days_to_close"), "lower")


@query
def a13_label_combos(spark, d):
    return kpis.top_counts(readers.dashboard_issues(store_rows(spark, d)), "labels_str", 5)


@query
def a14_priors_cls(spark, d):
    table = stage(priors.rate_table(train_rows(spark, d), "y"), "rates")
    return rounded(
        table.crossJoin(F.broadcast(priors.rate_globals(table))),  # one row
        "posrate", "global_count", "global_posrate",
    )


@query
def a15_priors_reg(spark, d):
    train = quick_train_rows(spark, d)
    table = stage(priors.median_table(train, "days_to_close"), "medians")
    return rounded(
        table.crossJoin(F.broadcast(priors.median_globals(table, train, "days_to_close"))),  # one row
        "median_days", "global_count", "global_median", places=8,
    )


@query
def a16_ttf_fill(spark, d):
    return rounded(priors.ttf_fill(train_rows(spark, d)), "ttf_fill")


@query
def a17_class_weight(spark, d):
    return rounded(priors.class_weight(train_rows(spark, d), "y"), "scale_pos_weight")


@query
def a18_max_cursor(spark, d):
    return ingest.newest_update(raw(spark, d))


@query
def a19_path_counts(spark, d):
    """Dump written per repository and run, its lines counted and named by file."""
    path = new_staging_path(spark, "dump")
    df = views.issue_facts(spark, d, activity=False).select("id", "repo_full_name")
    writers.append_by_repo(df, path, "20240101_000000")
    return ingest.counts_per_path(readers.line_counts(spark, path, "*.json"))


@query
def a20_run_summary(spark, d):
    """One run in which the repositories of one name failed."""
    snaps = views.issue_snapshots(spark, d, activity=False)
    broken = F.endswith("repo_full_name", F.lit("/BUILDING"))
    failed = snaps.where(broken).select("repo_full_name").distinct().withColumn("kind", F.lit("Timeout"))
    runs = ingest.run_rows(snaps.where(~broken), 2, F.lit(AS_OF))
    return ingest.run_summary(runs.unionByName(ingest.failed_rows(failed, F.lit(AS_OF))))


@query
def a21_describe(spark, d):
    return kpis.describe_table(clean_rows(spark, d)).select(
        "n_rows", F.array_join("columns", ",").alias("columns")
    )


# --- windows and order ---------------------------------------------------------------------------


@query
def w1_snapshot_dedup(spark, d):
    return clean.snapshot_dedup(views.issue_snapshots(spark, d, activity=False)).select(
        "ingest_seq", "repo_full_name"
    )


@query
def w2_latest_state(spark, d):
    return clean.latest_state(views.issue_snapshots(spark, d, activity=False)).select(
        "repo_full_name", "number", "ingest_seq", shown("updated_ts")
    )


@query
def w3_time_split(spark, d):
    return split_rows(spark, d).select("row_id", "split")


@query
def w4_cv_folds(spark, d):
    return splits.with_time_folds(train_rows(spark, d), FOLDS).select("row_id", "fold")


@query
def w5_oof_coverage(spark, d):
    folded = splits.with_time_folds(train_rows(spark, d), FOLDS)
    return rounded(splits.oof_coverage(folded, "fold"), "coverage")


@query
def w6_repo_first_seen(spark, d):
    """Organisation listings first, then searches by stars."""
    place = F.when(F.col("src_rank") == 1, -F.col("stargazers_count")).otherwise(F.col("seq"))
    repos = views.api_repos(spark, d).withColumn("place", place)
    return ingest.first_seen_repos(repos, 600, ["src_rank", "place", "seq"]).select(
        "full_name", "src_rank", "seq"
    )


@query
def w8_recent_open(spark, d):
    return kpis.recent_open(store_rows(spark, d), 20).select("id", shown("created_at"))


@query
def w9_newest_first(spark, d):
    """The live poll: newest twenty issues of any state."""
    df = views.issue_facts(spark, d, activity=False)
    return df.orderBy(F.desc("created_ts"), "id").limit(20).select("id", "state", shown("created_ts"))


@query
def w9_backfill_order(spark, d):
    """The backfill: two pages of each repository, oldest issue first."""
    df = views.issue_facts(spark, d, activity=False)
    return ingest.first_pages(df, 2, order=("created_ts", "id")).select("id", "repo_full_name")


@query
def w10_truncate(spark, d):
    df = views.issue_snapshots(spark, d, activity=False)
    df = df.withColumn("id", F.col("ingest_seq"))
    return ingest.first_pages(df, 1).select("ingest_seq", "repo_full_name")


@query
def w10_page_report(spark, d):
    return ingest.page_report(views.issue_snapshots(spark, d, activity=False), 1)


@query
def w11_preview(spark, d):
    """Preview of the first hundred rows by id."""
    return kpis.preview(views.issue_facts(spark, d, activity=False).orderBy("id")).select("id", "state")


@query
def w12_daily_filled(spark, d):
    df = kpis.daily_counts(views.issue_facts(spark, d, activity=False), "created_ts")
    return df.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n")


# --- set operations ------------------------------------------------------------------------------


@query
def u1_union(spark, d):
    """Bag union of two dumped sources with different fields."""
    a = views.issue_facts(spark, d, activity=False).select("id", "repo_full_name", "state")
    b = views.issue_snapshots(spark, d, activity=False).select("id", "repo_full_name", "snap_no")
    root = new_staging_path(spark, "sources")
    a.select(F.to_json(F.struct(*a.columns))).write.text(f"{root}/one")
    b.select(F.to_json(F.struct(*b.columns))).write.text(f"{root}/two")
    fields = T.StructType.fromDDL("id long, repo_full_name string, state string, snap_no int")
    both = dumps.merge_dumps(spark, root, schema=fields, pattern="*", recursive=True).records
    return both.groupBy("repo_full_name", "state").agg(
        F.count("*").alias("n"), F.count("snap_no").alias("with_snap"), F.sum("id").alias("id_sum")
    )


@query
def u2_repo_sources(spark, d):
    """Organisation and search listings unioned with their source rank."""
    repos = views.api_repos(spark, d).select("full_name", "seq")
    org = repos.where("seq % 2 = 0").withColumn("src_rank", F.lit(0))
    search = repos.where("seq % 2 = 1").withColumn("src_rank", F.lit(1))
    return org.union(search).groupBy("full_name").agg(
        F.min("src_rank").alias("best_source"), F.count("*").alias("n")
    )


@query
def u3_feature_concat(spark, d):
    """Tabular columns and the embedding side by side in one vector."""
    emb = views.table(spark, d, "embeddings")
    keyed = F.col("vec_id").cast("string").alias("row_id")
    tab = emb.select(keyed, F.col("label").cast("double").alias("label"), F.size("embedding").cast("double").alias("dim"))
    both = training.vectorized(tab, ["label", "dim"], emb.select(keyed, "embedding"))
    full = vector_to_array("features")
    return both.select("row_id", F.size(full).alias("n"), F.round(vectors.l2_norm(full), 4).alias("norm"))


# --- scalar functions ----------------------------------------------------------------------------


@query
def f1_full_text(spark, d):
    df = views.issue_facts(spark, d, text=True, activity=False)
    t = text.full_text()
    return df.select("id", F.md5(t).alias("text"), F.char_length(t).alias("n"))


@query
def f4_calendar(spark, d):
    return views.issue_facts(spark, d, activity=False).select(
        "id", F.weekday("created_ts").alias("created_dow"), F.hour("created_ts").alias("created_hour"),
        timing.month_of("created_ts").alias("month"),
    )


@query
def f7_ttf_features(spark, d):
    df = views.issue_facts(spark, d)
    hours = features.nonnegative_hours("created_ts", "first_comment_ts")
    return df.select(
        "id", r6(hours).alias("ttf_hours"),
        *[r6(e).alias(n) for n, e in features.ttf_features(hours, 24.0).items()],
    )


@query
def f8_label_flags_substr(spark, d):
    df = views.issue_facts(spark, d).withColumn("labels_str", F.array_join("labels", " "))
    return df.select("id", *[e.alias(n) for n, e in keyword_flags().items()])


@query
def f9_author_onehot(spark, d):
    df = views.issue_facts(spark, d, activity=False)
    return df.select(
        "id",
        *[e.alias(n) for n, e in features.author_flags().items()],
        *[e.alias(f"serving_{n}") for n, e in features.author_flags(serving=True).items()],
    )


@query
def f11_overlap(spark, d):
    df = views.issue_facts(spark, d, activity=False)
    iso = F.when(F.col("id") % 10 == 3, "not a time").otherwise(F.date_format("created_ts", views.ISO))
    return df.select("id", timing.step_back(iso, 900).alias("since"), timing.step_back(iso, -5).alias("same"))


@query
def f12_path_repo(spark, d):
    """Three spellings of dump paths per customer."""
    df = views.repo_names(spark, d)
    org, name = F.split_part("repo_full_name", F.lit("/"), F.lit(1)), F.split_part("repo_full_name", F.lit("/"), F.lit(2))
    path = (
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("data/raw/issues/"), org, F.lit("/"), name, F.lit(".jsonl")))
        .when(
            F.col("c_custkey") % 3 == 1,
            F.concat(F.lit("data/"), ingest.dump_file_name("repo_full_name", F.lit("20240102_030405"))),
        )
        .otherwise(F.concat(F.lit("data/raw/"), name, F.lit(".jsonl")))
    )
    repo = text.repo_from_path(path)
    return df.select("c_custkey", repo.alias("repo"), text.org_of(repo).alias("org"))


@query
def f13_sanitize(spark, d):
    df = views.table(spark, d, "part")
    odd = F.concat("p_brand", F.lit("/"), "p_type", F.lit(" & "), "p_name")
    return df.select("p_partkey", text.file_safe_repo(odd).alias("safe"))


@query
def f15_split_items(spark, d):
    df = views.table(spark, d, "part").select(
        "p_partkey", text.split_items(F.concat(F.lit(" "), "p_type", F.lit(" , "), "p_name", F.lit(",x "))).alias("items")
    )
    return df.select("p_partkey", F.array_join("items", "|").alias("items"))


@query
def f16_risk_band(spark, d):
    df = views.scores(spark, d).withColumn("p", F.when(F.col("id") % 13 != 0, F.col("p")))
    return df.select("id", decide.risk_band("p").alias("band"))


@query
def f17_l2norm(spark, d):
    unit = views.table(spark, d, "embeddings").select("vec_id", vectors.l2_normalized("embedding").alias("u"))
    return unit.select(
        "vec_id", r6(F.get("u", F.lit(0))).alias("first"), r6(F.element_at("u", -1)).alias("last"),
        r6(vectors.l2_norm("u")).alias("norm"),
    )


@query
def f18_target_transform(spark, d):
    df = views.scores(spark, d).where("days is not null")
    return df.select(
        "id", r6(targets.to_log("days")).alias("log_days"), r6(targets.from_log("r", 30)).alias("pred_days")
    )


@query
def f19_weights(spark, d):
    return views.scores(spark, d).where("days is not null").select("id", r6(targets.short_weight("days")).alias("w"))


@query
def f20_model_tag(spark, d):
    df = views.table(spark, d, "part")
    return df.select("p_partkey", text.model_tag(F.concat(F.lit("lab/"), "p_name", F.lit(" é#1"))).alias("tag"))


@query
def f20_run_stamp(spark, d):
    df = views.issue_facts(spark, d, activity=False)
    return df.select("id", timing.run_stamp("created_ts").alias("stamp"))


# --- models, metrics, decisions ------------------------------------------------------------------


MODEL_COLS = [
    "row_id", "repo_full_name", "created_ts", *BASE_FEATURES, "ttf_hours", "labels_str",
    "author_association", "days_to_close",
]


def _rate_fit(spark, d, body=False):
    df = stage(clean_rows(spark, d, body, MODEL_COLS), "clean")
    rows = splits.with_time_split(df.withColumn("y", features.within("days_to_close", HORIZON)))
    train = rows.where("split = 'train'")
    fill = priors.ttf_fill(train).first()["ttf_fill"]
    return rows, priors.fit_rate_priors(train, "y"), fill


@query
def m1_tabular(spark, d):
    rows, fitted, fill = _rate_fit(spark, d, body=True)
    return rounded(features.tabular_features(rows, fitted, fill), *STAGE1_FEATURES)


@query
def m1_tabular_stage2(spark, d):
    train = quick_train_rows(spark, d)
    fitted = priors.fit_median_priors(train, "days_to_close")
    fill = priors.ttf_fill(train).first()["ttf_fill"]
    df = features.tabular_features(clean_rows(spark, d, columns=MODEL_COLS), fitted, fill, moment="t0")
    df = rounded(df.select("row_id", *STAGE2_FEATURES), *STAGE2_FEATURES[:-1])
    return rounded(df, STAGE2_FEATURES[-1], places=8)


@query
def m5_fold_priors(spark, d):
    folded = splits.with_time_folds(train_rows(spark, d), FOLDS)
    return rounded(priors.fold_rate_tables(folded, "y", FOLDS), "posrate")


@query
def m6_fold_medians(spark, d):
    folded = splits.with_time_folds(quick_train_rows(spark, d), FOLDS)
    return rounded(priors.fold_median_tables(folded, "days_to_close", FOLDS), "median_days", places=8)


@query
def m7_best_threshold(spark, d):
    return rounded(metrics.best_threshold(views.scores(spark, d)), "threshold", "f1")


@query
def m9_confusion(spark, d):
    return metrics.confusion(views.scores(spark, d), 0.31).withColumnRenamed("count", "n")


@query
def m9_threshold_metrics(spark, d):
    return rounded(metrics.threshold_metrics(views.scores(spark, d), 0.31), "precision", "recall", "f1")


@query
def m10_logloss_brier(spark, d):
    return rounded(metrics.probability_losses(views.scores(spark, d)), "logloss", "brier")


@query
def m11_roc_auc(spark, d):
    return rounded(metrics.ranking_metrics(views.scores(spark, d)).select("roc_auc"), "roc_auc")


@query
def m11_roc_points(spark, d):
    return rounded(metrics.roc_curve(views.scores(spark, d)).replace(float("inf"), 2.0, ["score"]), "score", "fpr", "tpr")


@query
def m12_avg_precision(spark, d):
    return rounded(metrics.ranking_metrics(views.scores(spark, d)).select("pr_auc"), "pr_auc")


@query
def m12_pr_points(spark, d):
    return rounded(metrics.pr_curve(views.scores(spark, d)), "score", "precision", "recall")


def _dayscores(spark, d):
    df = views.scores(spark, d).where(F.col("days") <= HORIZON)
    return df.select("id", "created_ts", "days", targets.from_log("r", HORIZON).alias("pred"))


@query
def m13_reg_metrics(spark, d):
    df = metrics.regression_metrics(_dayscores(spark, d), "days")
    return rounded(df, *df.columns)


@query
def m14_baseline(spark, d):
    rows = splits.with_time_split(stage(_dayscores(spark, d), "days"), order=["created_ts", "id"])
    df = metrics.median_baseline(rows.where("split = 'train'"), rows.where("split = 'test'"), "days")
    return rounded(df, *df.columns)


@query
def m16_serving_features(spark, d):
    train = train_rows(spark, d)
    fitted, fill = priors.fit_rate_priors(train, "y"), priors.ttf_fill(train).first()["ttf_fill"]
    requests = views.raw_records(spark, d).where("state = 'open'").withColumns(
        {
            "row_id": F.col("ingest_seq"),
            "labels": without_nulls(),
            "created_at": F.when(F.col("id") % 23 != 0, F.col("created_at")),
        }
    )
    rows = features.serving_rows(requests, as_of())
    df = features.tabular_features(rows, fitted, fill, serving=True)
    return rounded(df, *STAGE1_FEATURES)


@query
def m17_decision(spark, d):
    return rounded(decide.triage(views.scores(spark, d)).select("id", "is_fast", "est_days"), "est_days")


@query
def m18_score_response(spark, d):
    df = decide.score_response(views.scores(spark, d), 0.31, "encoder-a", "stage1-v2", "stage2-v2")
    return rounded(df, "predicted_days_to_close")


@query
def m20_run_record(spark, d):
    """Long-form metrics of two splits as experiment rows."""
    rows = splits.with_time_split(
        stage(views.scores(spark, d), "scores"), order=["created_ts", "id"]
    )
    part = lambda s: metrics.as_long_form(
        metrics.probability_losses(rows.where(F.col("split") == s)), f"{s}_"
    )
    measured = part("train").unionByName(part("test"))
    params = training.parameters(spark, {"horizon": 30.0, "folds": FOLDS})
    record = training.run_record("r1", "stage1", params, measured)
    rounded_text = F.round(F.col("value").try_cast("double"), 6).cast("string")
    return record.withColumn("value", F.when(F.col("kind") == "metric", rounded_text).otherwise(F.col("value")))


#: The queries take larger steps and at most 30 rounds, so that each takes a minute or two on a small table.
QUERY = training.Settings(patience=10, step=0.3, rounds=30)


def _texts(spark, d, *more):
    """Cleaned issues (``more`` columns beside the model's), written once, with their text vectors.

    Words are counted before the de-duplication.
    """
    columns = [*MODEL_COLS, *more, "word_counts"]
    rows = training_table(raw(spark, d, body=True), columns=columns, derive=embeddings.word_counts)
    table = stage(rows, "clean")
    return table.drop("word_counts"), stage(embeddings.embed_counts(table), "vectors")


@query
def m2_text_features(spark, d):
    """Vectors of all documents: their size, and that they have length 1 (or 0 without weighted words)."""
    docs = views.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("row_id"), "text")
    out = embeddings.embed(docs, embeddings.text_encoder(256).fit(docs))
    norm = F.round(vectors.l2_norm("embedding"), 4)
    return out.select("row_id", F.size("embedding").alias("dim"), norm.isin(0.0, 1.0).alias("unit"))


def _checked_record(record: DataFrame, fixed: list[str], shares: list[str]) -> DataFrame:
    """Of a run's record the values that don't hang on the learner, and that its scores are shares."""
    value = F.col("value").try_cast("double")
    kept = record.where(F.col("name").isin(fixed)).select("name", F.round(value, 6).alias("value"))
    good = record.where(F.col("name").isin(shares)).select(
        F.lit("shares").alias("name"), F.sum(value.between(0, 1).cast("double")).over(Window.partitionBy()).alias("value")
    )
    return kept.unionByName(good.distinct())


@query
def m3_stage1(spark, d):
    """The classifier trained with the defaults but for the size and number of steps."""
    table, vecs = _texts(spark, d)
    _, measured, params = training.train_stage1(table, vecs, QUERY)
    shares = [f"{part}_{m}" for part in ("train", "dev", "test") for m in ("roc_auc", "precision", "recall", "f1")]
    return _checked_record(
        training.run_record("r1", "stage1", params, measured),
        ["scale_pos_weight", "ttf_fill", "cv_oof_coverage", "n_features", "embedding_dim", "folds"],
        [*shares, "threshold_from_oof"],
    )


@query
def m4_stage2(spark, d):
    """The regressor trained with the defaults but for the size and number of steps."""
    table, vecs = _texts(spark, d)
    _, measured, params = training.train_stage2(table, vecs, QUERY)
    return _checked_record(
        training.run_record("r1", "stage2", params, measured),
        ["baseline_test_mae", "baseline_test_rmse", "baseline_test_median_ae", "ttf_fill", "n_features", "embedding_dim"],
        [f"{part}_acc_within_7d" for part in ("train", "dev", "test")],
    )


@query
def m5_oof(spark, d):
    """Out-of-fold scores of the training part; the scores themselves hang on the learner."""
    table, vecs = _texts(spark, d)
    rows = splits.with_time_split(table.withColumn("y", features.within("days_to_close", HORIZON)))
    train = stage(rows.where("split = 'train'").drop("split"), "train")
    oof, _ = training.oof_predictions(train, QUERY, vecs)
    return oof.select("row_id", "y", "fold", F.col("p").between(0, 1).alias("in_range"))


@query
def m8_isotonic(spark, d):
    """Calibrated scores: never falling as the raw score rises."""
    df = views.scores(spark, d)
    return training.calibrated(df, training.fit_calibrator(df)).select("id", r6("p").alias("p"))


@query
def m15_score_open(spark, d):
    """Both stages trained, saved, loaded again and applied to every open issue."""
    table, vecs = _texts(spark, d, "labels", "created_at", "first_comment_at", "is_closed")
    one, _, _ = training.train_stage1(table, vecs, QUERY)
    two, _, _ = training.train_stage2(table, vecs, QUERY)
    path = new_staging_path(spark, "models")
    training.save_bundle(one, f"{path}/one")
    training.save_bundle(two, f"{path}/two")
    requests = table.where("is_closed = 0")
    scored = training.score_stage1(requests, training.load_bundle(spark, f"{path}/one"), vecs, as_of=as_of())
    both = training.score_stage2(scored, training.load_bundle(spark, f"{path}/two"), vecs, as_of=as_of())
    p, out = F.col("p"), decide.triage(both, cut=one.threshold)
    # The scores hang on the learner; what follows from them must hold for every open issue.
    return out.select(
        "row_id",
        (p.between(0, 1) & (F.col("is_fast").cast("int") == (p >= one.threshold).cast("int"))).alias("fast_follows_p"),
        F.col("r").isNotNull().alias("has_days"),
        (decide.risk_band("p") == F.when(p < 0.26, "red").otherwise("green")).alias("band_follows_p"),
    )


# --- streams -------------------------------------------------------------------------------------


def _land(sent: DataFrame, drops: int, *by: str) -> str:
    """Broker messages landed as files: in each drop as many as a shuffle has tasks, so that no task grows with the drop.

    Messages of one key lie in one file. ``by``: columns that name a folder each.
    """
    spark = sent.sparkSession
    path = new_staging_path(spark, "landed")
    sent.repartition(drops * _drop_files(spark, drops), "key").write.partitionBy(*by).json(path)
    return path


def _drop_files(spark, drops: int) -> int:
    return -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // drops)


def _landed(spark, d) -> str:
    """All messages, landed in four drops."""
    return _land(messages(spark, d), 4)


def _stream(spark, path: str, drops: int = 4) -> DataFrame:
    """Landed messages as a stream, a drop at a time."""
    return readers.read_stream(spark, path, max_files=_drop_files(spark, drops))


@query
def t2_stream_enrich(spark, d):
    """The stream's rows, enriched by the code that serves tables."""
    out, ck = new_staging_path(spark, "enriched"), new_staging_path(spark, "ck")
    stream = jobs.enriched(_stream(spark, _landed(spark, d)), as_of=as_of())
    q = jobs.start_log(stream, out, ck)
    q.awaitTermination()
    return spark.read.parquet(out).select(
        "kafka_offset", "id", shown("created_at"), "is_closed", "label_count",
        r6("time_to_close_hours").alias("time_to_close_hours"), r6("age_hours").alias("age_hours"),
    )


@query
def t4_stream_upsert(spark, d):
    """Store after streaming every snapshot: one row per issue, the latest update."""
    path, ck = new_staging_path(spark, "store"), new_staging_path(spark, "ck")
    stream = jobs.enriched(_stream(spark, _landed(spark, d)), as_of=as_of())
    q = jobs.start_upsert(stream, path, ck, interval=None)
    q.awaitTermination()
    store.compact(spark, path, through=1)
    return store.read_current(spark, path).select("id", "repo_full_name", "state", shown("updated_at"))


@query
def t5_backfill_then_live(spark, d):
    """Open issues' history loaded first, everything else followed as a stream."""
    path, ck = new_staging_path(spark, "store"), new_staging_path(spark, "ck")
    sent = messages(spark, d)
    is_open = F.get_json_object("value", "$.state") == "open"
    history = sent.where(is_open)
    landed = _land(sent.where(~is_open | is_open.isNull()), 2)
    live = jobs.enriched(_stream(spark, landed, 2), as_of=as_of())
    jobs.backfill_then_live(jobs.enriched(history, as_of=as_of()), live, path, ck).awaitTermination()
    return store.read_current(spark, path).select("id", "repo_full_name", "state", shown("updated_at"))


@query
def t6_stream_dedup(spark, d):
    """Ids emitted once over the whole run."""
    out, ck = new_staging_path(spark, "once"), new_staging_path(spark, "ck")
    stream = jobs.enriched(_stream(spark, _landed(spark, d)), as_of=as_of()).select("id", "repo_full_name")
    q = jobs.start_log(jobs.emit_once(stream), out, ck)
    q.awaitTermination()
    return spark.read.parquet(out)


@query
def t6_emit_new(spark, d):
    """Ids emitted once on a fresh checkpoint, but for those that a store holds already."""
    out, ck = new_staging_path(spark, "once"), new_staging_path(spark, "ck")
    known = views.table(spark, d, "orders").where(F.col("o_orderkey") % 5 == 0).select(F.col("o_orderkey").alias("id"))
    stream = jobs.enriched(_stream(spark, _landed(spark, d)), as_of=as_of()).select("id", "repo_full_name")
    jobs.start_log(once.emit_new(stream, known), out, ck).awaitTermination()
    return spark.read.parquet(out)


@query
def t5_resumed_backfill(spark, d):
    """Open issues' history as a stream of its own, handed over to the live stream, and both started again."""
    path, ck = new_staging_path(spark, "store"), new_staging_path(spark, "ck")
    is_open = F.get_json_object("value", "$.state") == "open"
    # The messages are made once and landed in a folder each.
    kind = F.when(is_open, "history").otherwise("live").alias("kind")
    landed = _land(messages(spark, d).select("*", kind), 3, "kind")
    for _ in range(2):
        history, live = (
            jobs.enriched(_stream(spark, f"{landed}/kind={k}", 3), as_of=as_of()) for k in ("history", "live")
        )
        jobs.resume_backfill(history, live, path, ck).awaitTermination()
    return store.read_current(spark, path).select("id", "repo_full_name", "state", shown("updated_at"))


@query
def t7_cursor_step(spark, d):
    """One run over a dump that was written before; two repositories fail."""
    path = new_staging_path(spark, "collected")
    raw(spark, d).drop("ingest_seq").write.json(path)
    issues = readers.read_jsonl(spark, path, pattern="*.json").withColumn("updated_ts", timing.parse_utc("updated_at"))
    cursors = views.cursors(spark, d)
    failed = views.repo_names(spark, d).select("repo_full_name").distinct().orderBy("repo_full_name").limit(2)
    failed = failed.withColumn("kind", F.lit("Timeout"))
    return ingest.collect_step(issues, cursors, DEFAULT_SINCE, 1, 900, run_at=F.lit(AS_OF), failed=failed)
