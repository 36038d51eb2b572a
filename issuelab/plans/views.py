"""Issue-tracker data derived from the given star-schema tables.

Each view is a plain DataFrame expression over whole tables. Columns that need the text or line-item
joins are added only when asked for, so a query that reads neither does not pay for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from issuelab.session import use_utc

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up once per path."""
    use_utc(spark)
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Rows spread by key: the fact table's files may be too few to keep every core busy.

    The number is given, as adaptive execution would merge these narrow rows into few tasks, and the wide text
    work behind them would run there.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("long") * 1_000_000)


def repo_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer key to repository name."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey",
        F.col("c_name").alias("user_login"),
        F.concat("n_name", F.lit("/"), "c_mktsegment").alias("repo_full_name"),
    )


def line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    return (
        _spread(lines, "l_orderkey")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.count_distinct("l_suppkey").alias("n_supp"),
            F.max((F.col("l_returnflag") == "R").cast("int")).alias("any_ret"),
        )
    )


def issue_facts(
    spark: SparkSession, sf_dir: str, text: bool = False, activity: bool = True
) -> DataFrame:
    """One row per issue. ``text`` adds title and body, ``activity`` adds the line-item columns."""
    key = F.col("o_orderkey")
    created = _plus_seconds(F.col("o_orderdate").cast("timestamp"), (key * 7919) % 86400)
    orders = table(spark, sf_dir, "orders")
    named = orders.join(repo_names(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "repo_full_name", "user_login", "o_orderstatus", "o_orderpriority", "o_orderdate"
    )
    df = _spread(named, "o_orderkey").select(
        key.alias("id"),
        key.alias("number"),
        "repo_full_name",
        "user_login",
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("state"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "OWNER")
        .when(F.col("o_orderpriority") == "2-HIGH", "MEMBER")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "CONTRIBUTOR")
        .when(F.col("o_orderpriority") == "5-LOW", "COLLABORATOR")
        .alias("author_association"),
        created.alias("created_ts"),
        ((key * 1299709) % 432000).alias("ttf_secs"),
        (key % 7 == 3).alias("is_pull_request"),
    )
    closed = F.when(F.col("id") % 97 == 0, _plus_seconds(F.col("created_ts"), F.lit(-86400))).otherwise(
        _plus_seconds(F.col("created_ts"), (F.col("id") * 104729) % 7776000)
    )
    df = df.withColumn("closed_ts", F.when(F.col("o_orderstatus") == "F", closed))
    if activity:
        stats = line_stats(spark, sf_dir)
        df = df.join(stats, df.id == stats.l_orderkey, "left").withColumns(
            {
                "comments": F.coalesce("n_lines", F.lit(0)).cast("int"),
                "num_assignees": F.coalesce("n_supp", F.lit(0)).cast("int"),
            }
        )
        df = df.withColumns(
            {
                "first_comment_ts": F.when(
                    F.col("comments") > 0,
                    _plus_seconds(F.col("created_ts"), F.col("ttf_secs") - 3600),
                ),
                "label0": F.when(F.col("any_ret") == 1, "kind/bug")
                .when(F.col("id") % 3 == 0, "documentation")
                .when(F.col("id") % 3 == 1, "help wanted"),
                "label1": F.when(F.col("id") % 5 == 0, "bug")
                .when(F.col("id") % 5 == 1, "enhancement")
                .when(F.col("id") % 5 == 2, "question")
                .when(F.col("id") % 5 == 3, "Security"),
                "label2": F.when(F.col("id") % 11 == 4, "good first issue").when(
                    F.col("id") % 11 == 5, "Debug,docker"
                ),
            }
        ).withColumn("labels", F.array("label0", "label1", "label2"))
        df = df.drop("l_orderkey", "n_lines", "n_supp", "any_ret")
    if text:
        docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))
        n_docs = docs.agg(F.count("*").alias("n_docs"))
        df = (
            df.crossJoin(F.broadcast(n_docs))  # one row
            .join(docs, F.col("id") % (F.col("n_docs") + 50) == F.col("doc_id"), "left")
            .withColumn("title", F.substring("body", 1, 40))
            .drop("n_docs", "doc_id")
        )
    return df.drop("o_orderstatus")


def issue_snapshots(
    spark: SparkSession, sf_dir: str, text: bool = False, activity: bool = True
) -> DataFrame:
    """Repeated collections of the same issue: later update (1) and exact repeat (2)."""
    df = issue_facts(spark, sf_dir, text, activity)
    snaps = F.filter(
        F.array(
            F.lit(0),
            F.when(F.col("id") % 10 == 0, F.lit(1)),
            F.when(F.col("id") % 25 == 0, F.lit(2)),
        ),
        lambda x: x.isNotNull(),
    )
    df = df.withColumn("snap_no", F.explode(snaps))
    bump = F.when(F.col("snap_no") == 1, 3600).otherwise(0)
    return df.withColumns(
        {
            "ingest_seq": F.col("id") * 4 + F.col("snap_no"),
            "updated_ts": F.when(
                F.col("id") % 33 != 0, _plus_seconds(F.col("created_ts"), F.col("ttf_secs") + bump)
            ),
        }
    ).drop("ttf_secs")


def _iso(c: str) -> Column:
    return F.date_format(c, ISO)


def raw_records(spark: SparkSession, sf_dir: str, text: bool = True) -> DataFrame:
    """Snapshots in the flat record shape: ISO text dates, label arrays with nulls, no typed dates."""
    df = issue_snapshots(spark, sf_dir, text=text)
    dates = {
        "created_at": "created_ts",
        "updated_at": "updated_ts",
        "closed_at": "closed_ts",
        "first_comment_at": "first_comment_ts",
    }
    df = df.withColumns({k: _iso(v) for k, v in dates.items()})
    keep = [
        "repo_full_name", "id", F.col("number").cast("int").alias("number"), "state",
        *(["title", "body"] if text else []),
        "user_login", "author_association", "labels", "comments", "num_assignees",
        *dates, "is_pull_request", "ingest_seq",
    ]
    return df.select(*keep)


def api_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues in the nested API shape (text left out)."""
    df = issue_facts(spark, sf_dir)
    name = lambda c: F.when(c.isNotNull(), F.struct(c.alias("name")))
    return df.select(
        "id",
        F.col("number").cast("int").alias("number"),
        "repo_full_name",
        "state",
        F.when(F.col("id") % 13 != 0, F.struct(F.col("user_login").alias("login"))).alias("user"),
        "author_association",
        F.when(
            F.col("id") % 17 != 0,
            F.array(
                F.struct(F.col("label0").alias("name")),
                F.struct(F.col("label1").alias("name")),
                F.struct(F.when(F.col("id") % 6 == 0, F.lit("")).otherwise(F.col("label2")).alias("name")),
            ),
        ).alias("labels"),
        "comments",
        _iso("created_ts").alias("created_at"),
        _iso("closed_ts").alias("closed_at"),
        F.when(
            F.col("id") % 4 != 0,
            F.array(
                F.struct(F.concat(F.lit("dev"), (F.col("id") % 19).cast("string")).alias("login")),
                F.struct(
                    F.when(F.col("id") % 3 != 0, F.concat(F.lit("ops"), (F.col("id") % 5).cast("string"))).alias("login")
                ),
            ),
        ).alias("assignees"),
        F.when(F.col("id") % 8 == 0, F.struct(F.concat(F.lit("v"), (F.col("id") % 3).cast("string")).alias("title"))).alias("milestone"),
        F.when(
            F.col("is_pull_request"), F.create_map(F.lit("url"), F.concat(F.lit("pulls/"), F.col("id").cast("string")))
        )
        .when(F.col("id") % 7 == 4, F.create_map().cast("map<string,string>"))
        .alias("pull_request"),
    )


def api_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories in the nested API shape, with source rank and arrival number."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        key.alias("id"),
        F.concat("n_name", F.lit("/"), "c_mktsegment").alias("full_name"),
        F.col("c_mktsegment").alias("name"),
        F.when(key % 9 != 0, F.struct(F.col("n_name").alias("login"))).alias("owner"),
        F.when(key % 4 != 0, F.array(F.lower("c_mktsegment"), F.lit("oss"))).alias("topics"),
        F.floor("c_acctbal").cast("long").alias("stargazers_count"),
        F.when(key % 11 == 0, False).when(key % 11 != 1, True).alias("has_issues"),
        F.when(
            key % 5 != 0, F.struct(F.when(key % 2 == 0, "MIT").otherwise("Apache-2.0").alias("spdx_id"))
        ).alias("license"),
        (key % 2).cast("int").alias("src_rank"),
        key.alias("seq"),
    )


def cursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored incremental cursors: one repository per nation has one."""
    nation = table(spark, sf_dir, "nation")
    start = F.lit("1998-01-01 00:00:00").cast("timestamp")
    since = _plus_seconds(start, F.col("n_nationkey").cast("long") * 30 * 86400)
    return nation.select(
        F.concat("n_name", F.lit("/BUILDING")).alias("repo_full_name"), _iso_of(since).alias("since")
    )


def _iso_of(c: Column) -> Column:
    return F.date_format(c, ISO)


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment events: several per issue."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    opened = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    secs = (F.col("o_orderkey") * 7919) % 86400 + (
        F.col("l_partkey") * 31 + F.col("l_linenumber") * 977
    ) % 432000
    return line.join(opened, line.l_orderkey == opened.o_orderkey).select(
        F.col("l_orderkey").alias("issue_id"),
        F.col("l_linenumber").alias("comment_no"),
        _plus_seconds(F.col("o_orderdate").cast("timestamp"), secs).alias("comment_ts"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic score with many ties, a log-days prediction and the 30-day outcome."""
    key = F.col("o_orderkey")
    close_secs = (key * 104729) % 7776000
    closed = F.col("o_orderstatus") == "F"
    orders = table(spark, sf_dir, "orders")
    return _spread(orders, "o_orderkey").select(
        key.alias("id"),
        (((key * 7919) % 1000) / F.lit(1000.0)).alias("p"),
        F.log(F.lit(1.0) + (key * 104729) % 40).alias("r"),
        (closed & (close_secs <= 2592000)).cast("int").alias("y"),
        F.when(closed, close_secs / F.lit(86400.0)).alias("days"),
        F.col("o_orderdate").cast("timestamp").alias("created_ts"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues with the id of their embedding; one residue class has no vector."""
    emb = table(spark, sf_dir, "embeddings").agg((F.count("*") + 1).alias("m"))
    issues = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return issues.crossJoin(F.broadcast(emb)).select("id", (F.col("id") % F.col("m")).alias("vec_id"))
