"""Tables that every operator must get through."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Names of result and helper columns, to clash with.
CLASHING = (
    "ids n_tokens decoded base spans added copies text_key score predicted n_words n_lines kept _words row "
    "node n_shingles component_id shard shard_bytes bits bytes h n"
).split()


def awkward_docs(spark):
    long = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do " * 20_000
    rows = [
        (1, "The cat and the dog sat in the house by the river. " * 3),
        (1, "The cat and the dog sat in the house by the river. " * 3),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, long),
        (6, long),
        (None, "one row without an id"),
        (None, None),
        (7, "é́\U0001f642 ﬁn \x1c\x00 <|endoftext|> a"),
        (8, "x"),
    ]
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def with_clashes(docs):
    from pyspark.sql import functions as F

    taken = {c.lower() for c in docs.columns}
    return docs.withColumns({c: F.lit("mine") for c in CLASHING if c not in taken})
