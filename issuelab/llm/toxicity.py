"""Toxicity: a convolutional text classifier over hashed words, trained in tasks, in numpy.

A text becomes the hashes of its words (runs of letters, lower case). Every word has a trained vector plus
those of its first and last letters (hashed), filters of widths 1 to 3 run over the whole text, and each
filter keeps its largest values (max pooling over ``pool`` places). The first vector component starts as
the smoothed log-odds of the word among the training labels. Thresholds are calibrated by language: the
language is read off the text's function words, and the score is shifted so that the best cut of each
language lies at 0.5. Labels, lang, source and ids are never inputs of a score.

Training reads every labelled row outside the held-out fold. The log-odds are counted over all of them by Spark.
The rows are dealt by a hash to shards of about ``sample_rows`` rows and ``sample_words`` words; a task trains the
common start on each, and the models are averaged, weighted by their rows. One shard makes ``epochs`` passes, several
make fewer (2 at least), as there is more to learn from. The cuts come from the scores of all labelled rows, counted
in steps of 0.001. Only a text of more than ``sample_words`` words is no example: a task could not hold it.
Scoring covers every row and whole texts.

Defined results: null and empty texts have no words and get the score of the bias alone. Rows with equal
texts get equal scores. Labels of a repeated or null doc_id: rows without a label or id don't train, the
largest label of an id counts. Without any training rows the score is 0. Columns named like a result
column are replaced.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from issuelab.llm.common import bind, bounded_batches, text_of
from issuelab.llm.quality import STOP_WORDS
from issuelab.operators.lookup import fits_broadcast
from issuelab.session import stage

log = logging.getLogger(__name__)

FOLDS = 5
LANGUAGES = tuple(STOP_WORDS)


@dataclass(frozen=True)
class Training:
    """Sizes of the fit; ``sample_rows`` and ``sample_words`` are those of a shard."""

    sample_rows: int = 6000
    sample_words: int = 2_500_000
    buckets: int = 1 << 16
    size: int = 8
    filters: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    pool: int = 2
    epochs: int = 5
    batch: int = 64
    step: float = 0.02
    seed: int = 7


@dataclass
class Model:
    """Plain arrays, so that a task carries them: one projection table per filter width and offset."""

    buckets: int
    vectors: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    pool: int
    stops: np.ndarray | None = None
    shifts: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES) + 1))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def features(text: Column, buckets: int) -> Column:
    """Words as hashes: three numbers a word (whole, first letters, last letters)."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    number = lambda w, seed: F.pmod(F.xxhash64(F.lit(seed), w), F.lit(buckets)).cast("int")
    return F.flatten(
        F.transform(
            words, lambda w: F.array(number(w, 1), number(F.substring(w, 1, 6), 2), number(F.right(w, F.lit(5)), 3))
        )
    )


def stop_tables(spark: SparkSession, buckets: int) -> np.ndarray:
    """For each language, which hashes are function words of it."""
    rows = [(k, " ".join(group)) for k, group in enumerate(STOP_WORDS.values())]
    lists = spark.createDataFrame(rows, "k int, text string").select("k", features(F.col("text"), buckets).alias("ids"))
    tables = np.zeros((len(LANGUAGES), buckets), bool)
    for r in lists.collect():
        tables[r["k"], r["ids"][::3]] = True
    return tables


def language(tables: np.ndarray, ids: np.ndarray) -> int:
    """Number of the language with most function words in the text; the last number if there are none."""
    counts = np.count_nonzero(tables.take(ids[:, 0], axis=1), axis=1)
    return int(counts.argmax()) if counts.any() else len(LANGUAGES)


def _word_vectors(vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
    x = vectors.take(ids[:, 0], axis=0)
    x += vectors.take(ids[:, 1], axis=0)
    x += vectors.take(ids[:, 2], axis=0)
    return x


def _activations(model: Model, x: np.ndarray) -> list[np.ndarray]:
    """Filter outputs at every place where the window fits, by width; x: (words, size)."""
    out = []
    for weights, bias in zip(model.filters, model.biases):
        width, n = weights.shape[0], len(x) - weights.shape[0] + 1
        if n <= 0:
            out.append(np.zeros((0, weights.shape[2]), np.float32))
            continue
        total = x[:n] @ weights[0]
        for k in range(1, width):
            total += x[k : k + n] @ weights[k]
        out.append(total + bias)
    return out


def _pooled(model: Model, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The ``pool`` largest non-negative outputs of each filter, largest first, and their places."""
    values, places = [], []
    for a, weights in zip(_activations(model, x), model.filters):
        top = np.zeros((model.pool, weights.shape[2]), np.float32)
        where = np.full(top.shape, -1)
        columns = np.arange(weights.shape[2])
        for k in range(min(model.pool, len(a))):
            spot = a.argmax(axis=0)
            best = a[spot, columns]
            top[k], where[k] = np.maximum(best, 0), np.where(best > 0, spot, -1)
            a[spot, columns] = -np.inf
        values.append(top)
        places.append(where)
    return np.concatenate([v.ravel() for v in values]), places


_CHUNK = 1 << 16


def logit(model: Model, ids: np.ndarray) -> float:
    """Raw score of one text; very long texts go in overlapping chunks."""
    reach = max(w.shape[0] for w in model.filters) - 1
    if len(ids) <= _CHUNK:
        pooled = _pooled(model, _word_vectors(model.vectors, ids))[0]
    else:
        best: list[np.ndarray] = []
        for start in range(0, len(ids), _CHUNK):
            a = _activations(model, _word_vectors(model.vectors, ids[start : start + _CHUNK + reach]))
            own = [np.sort(v[:_CHUNK], axis=0)[-model.pool :] for v in a]
            best = own if not best else [np.sort(np.concatenate(p), axis=0)[-model.pool :] for p in zip(best, own)]
        pooled = np.concatenate(
            [np.pad(np.maximum(b[::-1], 0), ((0, model.pool - len(b)), (0, 0))).ravel() for b in best]
        )
    return float(pooled @ model.weights + model.bias)


def _start(texts: list[np.ndarray], labels: np.ndarray, t: Training) -> Model:
    """The common start from the texts at hand."""
    counts = np.zeros((2, t.buckets))
    for ids, y in zip(texts, labels):
        counts[int(y), np.unique(ids)] += 1
    return _start_of(counts, len(labels), labels.sum(), t)


def _start_of(counts: np.ndarray, rows: int, toxic: int, t: Training) -> Model:
    """Vectors whose first component is the log-odds of a hash between the classes, by texts that hold it."""
    rng = np.random.default_rng(t.seed)
    counts = counts + 1
    share = np.log(counts[1] / (toxic + 2)) - np.log(counts[0] / (rows - toxic + 2))
    vectors = rng.normal(0, 0.1, (t.buckets, t.size)).astype(np.float32)
    evidence = np.minimum(1, counts.sum(axis=0) / 12)
    vectors[:, 0] = np.clip(share * evidence, -1, 4) / 3
    filters, biases = [], []
    for width in t.widths:
        w = rng.normal(0, 0.15, (width, t.size, t.filters)).astype(np.float32)
        w[:, 0, : t.filters // 2] += 0.7 / width
        filters.append(w)
        biases.append(np.full(t.filters, -0.3, np.float32))
    n = sum(t.pool * t.filters for _ in t.widths)
    return Model(t.buckets, vectors, filters, biases, np.full(n, 0.1, np.float32), -2.0, t.pool)


def _balance(rows: int, toxic: int) -> float:
    return max(1.0, (rows - toxic) / max(1, toxic))


def train(texts: list[np.ndarray], labels: np.ndarray, t: Training) -> Model:
    """A model of the texts at hand."""
    return _learn(_start(texts, labels, t), texts, labels, t, t.epochs, _balance(len(labels), labels.sum()), t.seed)


def _learn(model: Model, texts: list[np.ndarray], labels: np.ndarray, t: Training, passes: int, positive: float, seed: int) -> Model:
    """Adagrad on the logistic loss, classes weighted alike; only pooled places carry gradients. ``model`` is changed."""
    rng = np.random.default_rng(seed)
    sums = {
        "v": np.full(model.vectors.shape, 1e-3, np.float32),
        "w": np.full(model.weights.shape, 1e-3, np.float32),
        "b": 1e-3,
        "f": [np.full(f.shape, 1e-3, np.float32) for f in model.filters],
        "c": [np.full(b.shape, 1e-3, np.float32) for b in model.biases],
    }
    each = t.pool * t.filters
    for _ in range(passes):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), t.batch):
            gw, gb = np.zeros_like(model.weights), 0.0
            gf, gc = [np.zeros_like(f) for f in model.filters], [np.zeros_like(b) for b in model.biases]
            touched, pulls = [], []
            for i in order[at : at + t.batch]:
                ids = texts[i]
                x = _word_vectors(model.vectors, ids)
                pooled, places = _pooled(model, x)
                p = 1 / (1 + np.exp(-np.clip(pooled @ model.weights + model.bias, -30, 30)))
                g = (p - labels[i]) * (positive if labels[i] else 1.0) / t.batch
                gw += g * pooled
                gb += g
                for k, where in enumerate(places):
                    slot, column = np.nonzero(where >= 0)
                    if not len(slot):
                        continue
                    pull = (g * model.weights[k * each : (k + 1) * each].reshape(t.pool, -1)[slot, column])[:, None]
                    spot = where[slot, column]
                    np.add.at(gc[k], column, pull[:, 0])
                    for j in range(model.filters[k].shape[0]):
                        np.add.at(gf[k].transpose(0, 2, 1)[j], column, pull * x[spot + j])
                        touched.append(ids[spot + j])
                        pulls.append(pull * model.filters[k][j][:, column].T)
            sums["w"] += gw * gw
            model.weights -= t.step * gw / np.sqrt(sums["w"])
            sums["b"] += gb * gb
            model.bias -= t.step * gb / np.sqrt(sums["b"])
            for k in range(len(gf)):
                sums["f"][k] += gf[k] ** 2
                model.filters[k] -= t.step * gf[k] / np.sqrt(sums["f"][k])
                sums["c"][k] += gc[k] ** 2
                model.biases[k] -= t.step * gc[k] / np.sqrt(sums["c"][k])
            if touched:
                rows, inverse = np.unique(np.concatenate(touched).ravel(), return_inverse=True)
                gv = np.zeros((len(rows), t.size), np.float32)
                np.add.at(gv, inverse, np.repeat(np.concatenate(pulls), 3, axis=0))
                sums["v"][rows] += gv * gv
                model.vectors[rows] -= t.step * gv / np.sqrt(sums["v"][rows])
    return model


def _best_cut(scores: np.ndarray, rows: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with most F1, in the middle between its neighbours; ``rows`` and ``toxic``: how many at each score."""
    order = np.argsort(-scores)
    s, n, y = scores[order], rows[order].cumsum(), toxic[order].cumsum()
    k = int(np.argmax(2 * y / (n + y[-1])))
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k] - 1e-3)


#: Scores of the calibration are counted in steps of 1 / STEPS, up to +-40.
STEPS = 1000


def calibrate(model: Model, examples: DataFrame) -> None:
    """A shift for each language; languages with few examples of a class use the cut over all.

    The driver gets counts by language and step.
    """

    @F.arrow_udf("long")
    def place(words: pa.Array) -> pa.Array:
        out = np.zeros(len(words), np.int64)
        for k, ids in enumerate(_texts_of(words)):
            step = round(STEPS * min(max(logit(model, ids), -40), 40))
            out[k] = language(model.stops, ids) * 1_000_000 + step + 500_000
        return pa.array(out)

    counts = examples.groupBy(place("ids").alias("place")).agg(F.count("*").alias("n"), F.sum("label").alias("toxic"))
    got = np.array([tuple(r) for r in counts.collect()], np.int64)
    spoken, steps, n, toxic = got[:, 0] // 1_000_000, (got[:, 0] % 1_000_000 - 500_000), got[:, 1], got[:, 2]

    def cut(own: np.ndarray) -> float:
        at, where = np.unique(steps[own], return_inverse=True)
        return _best_cut(at / STEPS, np.bincount(where, n[own]), np.bincount(where, toxic[own]))

    overall = cut(spoken >= 0) if 0 < toxic.sum() < n.sum() else 0.0
    model.shifts = np.full(len(LANGUAGES) + 1, overall)
    for k in range(len(LANGUAGES) + 1):
        own = spoken == k
        if 8 <= toxic[own].sum() < n[own].sum() - 8:
            model.shifts[k] = cut(own)


def _texts_of(words: pa.Array) -> list[np.ndarray]:
    flat, ends = words.values.to_numpy(zero_copy_only=False), words.offsets.to_numpy()
    return [flat[a:b].reshape(-1, 3) for a, b in zip(ends[:-1], ends[1:])]


def _packed(model: Model) -> np.ndarray:
    return np.concatenate([np.ravel(a) for a in (model.vectors, *model.filters, *model.biases, model.weights, [model.bias])])


def _unpacked(like: Model, values: np.ndarray) -> Model:
    parts, at = [], 0
    for a in (like.vectors, *like.filters, *like.biases, like.weights):
        parts.append(values[at : at + a.size].reshape(a.shape).astype(np.float32))
        at += a.size
    k = len(like.filters)
    return Model(like.buckets, parts[0], parts[1 : k + 1], parts[k + 1 : -1], parts[-1], float(values[at]), like.pool)


#: Labels that may be broadcast, also bounded by ``lookup.BROADCAST_BYTES``.
LABELS = 2_000_000
#: Tasks that add up the shards' models; the driver gets one sum of each.
ADDERS = 4
_SHARD = "shard int, n long, model binary"


def _trained(examples: DataFrame, start: Model, t: Training, shards: int, positive: float) -> Model:
    """Average of the models that the shards make of the common start."""
    passes = max(min(2, t.epochs), -(-t.epochs // shards))

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by([("spread", "ascending"), ("doc_id", "ascending"), ("label", "ascending")]).combine_chunks()
        texts = [ids for c in group.column("ids").chunks for ids in _texts_of(c)]
        shard, labels = group.column("shard")[0].as_py(), group.column("label").to_numpy().astype(np.float32)
        own = _unpacked(start, _packed(start))  # a copy: workers keep the function for further shards
        values = _packed(_learn(own, texts, labels, t, passes, positive, t.seed + shard))
        kinds = (pa.int32(), pa.int64(), pa.binary())
        row = ([shard], [len(texts)], [values.astype(np.float64).tobytes()])
        return pa.table([pa.array(v, k) for v, k in zip(row, kinds)], ["shard", "n", "model"])

    def add(batches):
        n, total = 0, 0.0
        for batch in batches:
            for rows, data in zip(batch.column("n").to_pylist(), batch.column("model")):
                n, total = n + rows, total + rows * np.frombuffer(data.as_buffer(), np.float64)
        if n:
            arrays = [pa.array([0], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["shard", "n", "model"])

    tasks = min(shards, 2000)
    models = examples.repartition(tasks, "shard").groupBy("shard").applyInArrow(learn, _SHARD)
    slot = F.pmod(F.col("shard"), F.lit(ADDERS))
    sums = models.repartition(ADDERS, slot).sortWithinPartitions("shard").mapInArrow(add, _SHARD).collect()
    sums = sorted((r["n"], bytes(r["model"])) for r in sums)
    total = sum(np.frombuffer(data, np.float64) for _, data in sums)
    return _unpacked(start, total / sum(n for n, _ in sums))


def _examples(docs: DataFrame, labels: DataFrame, t: Training, text: str) -> DataFrame:
    """doc_id, label, word hashes, place in the order, and whether the row trains; a fifth is kept for the calibration.

    The hashes of a text beyond the room are null.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    # Texts are not shuffled as long as the labels fit a broadcast.
    known = stage(known, "labels")
    known = F.broadcast(known) if fits_broadcast(known, LABELS) else known
    rows = docs.select("doc_id", text_of(text).alias("text")).join(known, "doc_id")
    # No filter on the hashes: it would be pushed below the join, and every text hashed there and once more above.
    ids = bind(features(F.col("text"), t.buckets), lambda ids: F.when(F.size(ids) <= 3 * t.sample_words, ids))
    spread = F.xxhash64(F.lit(t.seed), F.col("doc_id"))
    return rows.select(
        "doc_id", "label", ids.alias("ids"), spread.alias("spread"), (F.pmod(spread, F.lit(5)) != 0).alias("trains")
    )


def fit(docs: DataFrame, labels: DataFrame, t: Training = Training(), text: str = "text") -> Model | None:
    """Train on all labelled rows outside the held-out fold; a fifth of them is kept for the calibration."""
    bounded_batches(docs.sparkSession)
    # A text that alone exceeds the room is no example; its hashes are not written.
    every = stage(_examples(docs, labels, t, text), "toxicity").where("ids is not null")
    sums = (F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("toxic"), F.sum(F.size("ids") / 3).alias("words"))
    sizes = {r["trains"]: r for r in every.groupBy("trains").agg(*sums).collect()}
    n, toxic = (sum(r[c] for r in sizes.values()) for c in ("n", "toxic"))
    if not 0 < toxic < n:
        log.warning("no toxicity model: %d usable labelled texts, not of both classes; all scores are 0", n)
        return None
    if True in sizes:
        learning, size = every.where("trains"), sizes[True]
    else:  # a handful of rows
        learning, size = every, sizes[False]
    seen = learning.select("label", F.explode(F.array_distinct("ids")).alias("id")).groupBy("label", "id").count().collect()
    counts = np.zeros((2, t.buckets))
    for r in seen:
        counts[r["label"], r["id"]] = r["count"]
    start = _start_of(counts, size["n"], size["toxic"], t)
    shards = max(1, -(-size["n"] // t.sample_rows), int(-(-size["words"] // t.sample_words)))
    # Equal ids may carry different texts, so a shard is told by the text as well.
    shard = F.pmod(F.xxhash64("spread", F.size("ids"), F.hash("ids")), F.lit(shards)).cast("int")
    dealt = learning.select("doc_id", "label", "ids", "spread", shard.alias("shard"))
    model = _trained(dealt, start, t, shards, _balance(size["n"], size["toxic"]))
    model.stops = stop_tables(docs.sparkSession, t.buckets)
    calibrate(model, every)
    return model


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    bounded_batches(docs.sparkSession)
    if model is None:
        scored = docs.withColumn("score", F.lit(0.0))
    else:
        @F.arrow_udf(DoubleType())
        def rate(words: pa.Array) -> pa.Array:
            raw = np.zeros(len(words))
            for k, ids in enumerate(_texts_of(words)):
                raw[k] = logit(model, ids) - model.shifts[language(model.stops, ids)]
            return pa.array(1 / (1 + np.exp(-np.clip(raw, -40, 40))), pa.float64())

        scored = docs.withColumn("score", rate(features(text_of(text), model.buckets)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """Only the rows that are not predicted toxic, with their own columns."""
    held = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return score(held, model).where("predicted = 0").select("row.*")
