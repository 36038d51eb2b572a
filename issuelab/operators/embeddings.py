"""Text vectors: fitting, applying, aligning with rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VECTOR_SCHEMA = "row_id string, embedding array<float>"
#: Bytes of texts handed to Python at a time, and of those looked at together; longer words are hashed one by one.
BATCH_BYTES, PIECE_BYTES, LONG_WORD = 8 << 20, 1 << 20, 256


def text_encoder(dims: int = 64) -> Pipeline:
    """Words to hashed, document-frequency weighted, unit-length vectors."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"\W+"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dims),
            IDF(inputCol="_counts", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol="_unit", p=2.0),
        ]
    )


def embed(df: DataFrame, encoder: PipelineModel) -> DataFrame:
    """(row_id, embedding) for every row; a missing text counts as empty."""
    filled = df.select("row_id", F.coalesce("text", F.lit("")).alias("text"))
    return encoder.transform(filled).select(
        "row_id", vector_to_array("_unit", "float32").alias("embedding")
    )


def word_counts(df: DataFrame, dims: int = 64) -> DataFrame:
    """``df`` with ``word_counts``: of each text the numbers of words by hash, as the encoder's first two steps count them.

    A few bytes a place, so rows can be shuffled with them and without their texts. Words are told apart and hashed
    by arrays, for the texts of an Arrow batch at once.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.withColumn("word_counts", _counter(dims)(F.coalesce("text", F.lit(""))))


def _counter(dims: int):
    long, piece = LONG_WORD, PIECE_BYTES

    @F.arrow_udf("array<int>")
    def count(texts):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        letters = np.arange(256, dtype=np.uint8)
        letters[ord("A") : ord("Z") + 1] += 32
        is_word = np.zeros(256, bool)
        is_word[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_"]] = True

        def turned(x, by):
            return (x << np.uint32(by)) | (x >> np.uint32(32 - by))

        def mixed(k):
            return turned(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)

        def hashed(data, starts, sizes):
            """Murmur3 (32 bits, seed 42) of the words, as signed numbers. ``data`` ends with 4 more bytes."""
            fours = np.ndarray((len(data) - 3,), "<u4", buffer=data, strides=(1,))
            h = np.full(len(starts), 42, np.uint32)
            whole = sizes // 4
            open_ = np.flatnonzero((whole > 0) & (sizes <= long))
            for k in range(long // 4):
                open_ = open_[whole[open_] > k]
                if not len(open_):
                    break
                h[open_] = turned(h[open_] ^ mixed(fours[starts[open_] + 4 * k]), 13) * np.uint32(5) + np.uint32(0xE6546B64)
            # So long a word goes by itself, lest every step of it passes over arrays of few words.
            for w in np.flatnonzero(sizes > long).tolist():
                x = 42
                for k in mixed(data[starts[w] : starts[w] + 4 * whole[w]].view("<u4")).tolist():
                    x ^= k
                    x = (((x << 13) | (x >> 19)) * 5 + 0xE6546B64) & 0xFFFFFFFF
                h[w] = x
            rest = sizes % 4
            tail = fours[starts + 4 * whole] & np.array([0, 0xFF, 0xFFFF, 0xFFFFFF], np.uint32)[rest]
            h ^= mixed(tail)
            h ^= sizes.astype(np.uint32)
            h ^= h >> np.uint32(16)
            h *= np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
            h *= np.uint32(0xC2B2AE35)
            h ^= h >> np.uint32(16)
            return h.view(np.int32)

        def counts_of(data, ends):
            """Of the texts that end at ``ends`` in ``data`` (lower case, 4 more bytes)."""
            word = is_word[data[:-4]]
            first, last = word.copy(), word.copy()
            first[1:] &= ~word[:-1]
            last[:-1] &= ~word[1:]
            # Neighbouring texts share no word.
            inner = ends[(ends > 0) & (ends < len(word))]
            first[inner], last[inner - 1] = word[inner], word[inner - 1]
            starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
            of = np.repeat(np.arange(len(ends)), np.diff(np.searchsorted(starts, ends), prepend=0))
            places = of * dims + hashed(data, starts, stops - starts) % dims
            return np.bincount(places, minlength=len(ends) * dims).astype(np.int32)

        # Of all other characters only these two become ASCII letters in lower case.
        if pc.any(pc.match_substring_regex(texts, "[\u0130\u212a]")).as_py():
            texts = pc.replace_substring(pc.replace_substring(texts, "\u0130", "i\u0307"), "\u212a", "k")
        texts = texts.cast(pa.large_binary())
        _, places, held = texts.buffers()
        offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        every = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
        out, at = [np.zeros(0, np.int32)], 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + piece, side="right")) - 1)
            data = np.zeros(offsets[to] - offsets[at] + 4, np.uint8)
            data[:-4] = letters[every[offsets[at] : offsets[to]]]
            out.append(counts_of(data, offsets[at + 1 : to + 1] - offsets[at]))
            at = to
        rows = np.arange(len(texts) + 1, dtype=np.int32) * dims
        return pa.ListArray.from_arrays(pa.array(rows), pa.array(np.concatenate(out)))

    return count


def embed_counts(df: DataFrame) -> DataFrame:
    """(row_id, embedding) of rows with ``word_counts``, weighted by these rows' document frequencies: the encoder's rest."""
    counts = df.select("row_id", array_to_vector("word_counts").alias("_counts"))
    rest = Pipeline(stages=text_encoder().getStages()[2:])
    return rest.fit(counts).transform(counts).select(
        "row_id", vector_to_array("_unit", "float32").alias("embedding")
    )


def embed_with(
    df: DataFrame,
    make_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_size: int = 64,
    normalize: bool = True,
) -> DataFrame:
    """(row_id, embedding) from an external encoder, loaded once per task and fed Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = make_encoder()
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start : start + batch_size]
                out = np.asarray(encode(part["text"].tolist()), dtype=np.float32)
                if len(out) != len(part):
                    raise ValueError(f"encoder gave {len(out)} vectors for {len(part)} texts")
                if normalize:
                    norm = np.linalg.norm(out, axis=1, keepdims=True)
                    out = out / np.where(norm > 0, norm, 1)
                yield pd.DataFrame({"row_id": part["row_id"].to_numpy(), "embedding": list(out)})

    texts = df.select("row_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(run, VECTOR_SCHEMA)


def align(df: DataFrame, vectors: DataFrame, key: str = "row_id", strict: bool = True) -> DataFrame:
    """Rows with their vector, in one join; a row without one stops the job, or drops out if not ``strict``."""
    joined = df.join(vectors, key, "left")
    missing = F.col("embedding").isNull()
    if not strict:
        return joined.where(~missing)
    lost = F.concat(F.lit(f"no embedding for {key}="), F.col(key).cast("string"), F.lit("; embed the same table again"))
    return joined.withColumn("embedding", F.when(missing, F.raise_error(lost)).otherwise(F.col("embedding")))
