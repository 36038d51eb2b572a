"""Messages landed for the streams: files grow in number with the tasks of a shuffle, drops stay."""

from pyspark.sql import functions as F

from issuelab.plans import catalog


def sent(spark, n=400):
    rows = spark.range(n).select(F.concat(F.lit("k"), F.col("id") % 97).alias("key"), F.col("id").alias("offset"))
    return rows.select("key", F.lit("{}").alias("value"), F.lit(0).alias("partition"), "offset")


def test_a_drop_is_as_many_files_as_a_shuffle_has_tasks(spark, tmp_path):
    path = catalog._land(sent(spark), 4)
    back = spark.read.schema("key string, offset long").json(path).withColumn("file", F.col("_metadata.file_path"))
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert back.select("file").distinct().count() > 4 and back.count() == 400 and shuffled > 4
    assert back.groupBy("key").agg(F.count_distinct("file").alias("n")).where("n > 1").isEmpty()
    query = catalog._stream(spark, path).select("offset").writeStream.format("parquet")
    query = query.option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
    done = query.trigger(availableNow=True).start()
    done.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400
    assert 1 < len([p for p in done.recentProgress if p["numInputRows"]]) <= 4


def test_two_kinds_are_landed_at_once(spark):
    kind = F.when(F.col("offset") % 3 == 0, "history").otherwise("live").alias("kind")
    path = catalog._land(sent(spark).select("*", kind), 3, "kind")
    read = lambda k: spark.read.schema("key string, offset long").json(f"{path}/kind={k}")
    assert sorted(r["offset"] for r in read("history").collect()) == list(range(0, 400, 3))
    assert read("live").count() == 266
