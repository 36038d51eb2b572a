"""Text vectors from counts that were made before the de-duplication."""

import random

from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from issuelab.operators import embeddings
from issuelab.plans import catalog


def test_counts_give_the_encoders_vectors(spark):
    rows = [("a", "One two, two three"), ("b", "two"), ("c", None), ("d", ""), ("e", "é x1 \n two four FIVE")]
    df = spark.createDataFrame(rows, "row_id string, text string")
    want = embeddings.embed(df, embeddings.text_encoder().fit(df.select(F.coalesce("text", F.lit("")).alias("text"))))
    got = embeddings.embed_counts(embeddings.word_counts(df).drop("text"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_text_is_shuffled(spark, sf, monkeypatch):
    kept = []
    monkeypatch.setattr(catalog, "stage", lambda df, label: kept.append(df) or df)
    catalog._texts(spark, str(sf))
    plan = kept[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by(struct(" in plan and "word_counts" in plan
    assert not [line for line in plan.splitlines() if "max_by(struct(" in line and ("text#" in line or "body, body#" in line)]


def test_the_clean_table_query_shuffles_digests(spark, sf):
    plan = catalog.p21_clean_table(spark, str(sf))._jdf.queryExecution().optimizedPlan().toString()
    gathered = [line for line in plan.splitlines() if "max_by(struct(" in line]
    assert gathered and all("body_md5" in line and "text, text#" not in line for line in gathered)


def test_words_are_hashed_as_the_encoder_does(spark, monkeypatch):
    """Any characters, words of any length, texts without a word between them, small pieces and batches."""
    rng = random.Random(7)
    signs = "aZ09_-. \néİK\U0001f600K"
    texts = ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(300)]
    texts += ["x" * k for k in range(20)] + ["ab" * 500, "a b" * 300, "end", "", "start", None, "İIK", "I" * 700]
    df = spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(texts)], "row_id string, text string").repartition(3)
    words = RegexTokenizer(inputCol="t", outputCol="w", pattern=r"\W+").transform(df.withColumn("t", F.coalesce("text", F.lit(""))))
    want = HashingTF(inputCol="w", outputCol="c", numFeatures=64).transform(words).select("row_id", vector_to_array("c"))
    want = {i: [int(n) for n in c] for i, c in want.collect()}
    monkeypatch.setattr(embeddings, "LONG_WORD", 16)
    for piece in (50, 1 << 20):
        monkeypatch.setattr(embeddings, "PIECE_BYTES", piece)
        got = embeddings.word_counts(df).select("row_id", "word_counts")
        assert {i: c for i, c in got.collect()} == want
