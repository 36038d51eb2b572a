"""The two-stage model: will an issue close within the horizon, and in how many days."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass, replace
from functools import reduce
from itertools import groupby

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelab.functions.targets import from_log, short_weight, to_log
from issuelab.operators import boosting, metrics, splits
from issuelab.operators.embeddings import align
from issuelab.operators.features import (
    RepoPriors,
    check_no_leak,
    fixed_features,
    history_features,
    join_all_histories,
    serving_rows,
    tabular_features,
    ttf_features,
    within,
)
from issuelab.operators.priors import (
    class_weight,
    fit_median_priors,
    fit_rate_priors,
    fold_median_tables,
    fold_medians,
    fold_rate_tables,
    rate_globals,
    ttf_fill,
)
from issuelab.schemas import TTF_FEATURES, feature_order
from issuelab.session import stage

MIN_REGRESSION_ROWS = 500


@dataclass(frozen=True)
class Settings:
    """Training choices; defaults follow the model description.

    Boosting stops once ``patience`` rounds in a row have not lowered the held-out loss, at ``rounds`` at
    the latest, and the model keeps the best round. A round is ``depth`` passes over the rows.
    """

    horizon: float = 30.0
    folds: int = 5
    rounds: int = 8000
    patience: int = 250
    depth: int = 4
    leaves: int = 64
    step: float = 0.03
    subsample: float = 0.8
    columns: float = 0.8
    min_child_weight: float = 8.0
    l2: float = 10.0
    bins: int = 64
    seed: int = 42
    moment: str = "latest"
    calibrate: bool = True
    weighted: bool = True
    train: float = 0.8
    dev: float = 0.1
    test: float = 0.1


@dataclass(frozen=True)
class Bundle:
    """A fitted stage with all it needs for scoring."""

    model: boosting.BoostedTrees
    priors: RepoPriors
    fill: float
    settings: Settings
    version: str
    threshold: float = 0.5
    calibrator: IsotonicRegressionModel | None = None

    @property
    def features(self) -> list[str]:
        return feature_order(self.priors.feature)


def vectorized(rows: DataFrame, tabular: Iterable[str], vectors: DataFrame | None) -> DataFrame:
    """Tabular columns, then the text vector, as one ``features`` vector."""
    names = list(tabular)
    check_no_leak(names)
    if vectors is not None:
        rows = align(rows, vectors).withColumn("embedding_vec", array_to_vector("embedding"))
        names = [*names, "embedding_vec"]
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error").transform(rows)


def in_one_array(rows: DataFrame, tabular: Iterable[str], vector: str | None = None) -> DataFrame:
    """Tabular columns, then the ``vector``, as one array of doubles ``features``: what the learner and its trees read.

    As with :func:`vectorized` a null or NaN stops the job; no vector object is made of a row on the way.
    """
    names = list(tabular)
    check_no_leak(names)
    return rows.withColumn("features", _joined([_numbers(names)], vector))


def _numbers(columns: Iterable[Column | str]) -> Column:
    """Array of doubles; a null or NaN stops the job."""
    known = [(F.col(c) if isinstance(c, str) else c).cast("double") for c in columns]
    bad = reduce(lambda a, b: a | b, [c.isNull() | F.isnan(c) for c in known])
    return F.when(bad, F.raise_error(F.lit("null or NaN among the features"))).otherwise(F.array(*known))


def _joined(arrays: list[Column], vector: str | None) -> Column:
    return F.concat(*arrays, *([F.col(vector).cast("array<double>")] if vector else []))


def _feature_runs(value: str) -> list[tuple[bool, list[str]]]:
    """The features in their order, in runs that hang on the fit (true) or not."""
    fitted = {*TTF_FEATURES, "repo_count_train", value}
    order = feature_order(value)
    check_no_leak(order)
    return [(own, list(names)) for own, names in groupby(order, lambda c: c in fitted)]


_KEPT = ("row_id", "y", "label", "weight", "part")


def _shared_rows(
    rows: DataFrame, fitted: dict[int, RepoPriors], s: Settings, vectors: DataFrame | None, more: tuple[str, ...] = ()
) -> DataFrame:
    """What the fits share, written once: features that are not fitted, each fit's history numbers, the text vector.

    Runs of features are arrays: the code that reads some thirty columns for each fit is too long for the JVM to compile.
    """
    kept = (*_KEPT, *more)
    runs = enumerate(_feature_runs(next(iter(fitted.values())).feature))
    fixed = fixed_features(rows, s.moment, keep=kept).select(
        *[F.col(f"_keep_{c}").alias(c) for c in kept], "repo_full_name", "ttf_hours",
        *[_numbers(names).alias(f"_fixed_{k}") for k, (own, names) in runs if not own],
    )
    joined = join_all_histories(fixed, fitted)
    if vectors is not None:
        joined = align(joined, vectors.select("row_id", "embedding"))
    return stage(joined, "learning")


def _rows_of_fit(shared: DataFrame, fit: int, priors: RepoPriors, fill: float) -> DataFrame:
    """A fit's learning rows: its own features beside the shared ones, as one vector. No join, so no need to write them."""
    own = {**ttf_features(F.col("ttf_hours"), fill), **history_features(f"_cnt_{fit}", f"_value_{fit}", priors)}
    arrays = [
        _numbers(own[c] for c in names) if fitted else F.col(f"_fixed_{k}")
        for k, (fitted, names) in enumerate(_feature_runs(priors.feature))
    ]
    vector = "embedding" if "embedding" in shared.columns else None
    return shared.select(*_KEPT, _joined(arrays, vector).alias("features"))


def _learning_rows(
    rows: DataFrame, priors: RepoPriors, fill: float, s: Settings, vectors: DataFrame | None
) -> DataFrame:
    """Learning rows of a single fit."""
    return _rows_of_fit(_shared_rows(rows, {0: priors}, s, vectors), 0, priors, fill)


def _fit(ready: dict[int, tuple[DataFrame, str]], objective: str, s: Settings) -> dict[int, boosting.BoostedTrees]:
    """Models of several fits, grown together. ``ready``: learning rows of a fit and the part that ends it."""
    rows = None
    for fit, (own, held) in ready.items():
        own = own.where(F.col("part").isin("train", held)).select(
            F.lit(fit).alias("fit"), (F.col("part") == held).alias("held"), "row_id", "label", "weight", "features"
        )
        rows = own if rows is None else rows.unionByName(own)
    choices = boosting.Boosting(
        objective, s.rounds, s.patience, s.depth, s.leaves, s.step, s.l2, s.min_child_weight, s.subsample, s.columns,
        s.bins, s.seed,
    )
    return {fit: model for fit, (model, _) in boosting.fit_many(rows, choices).items()}


def _probability(model: boosting.BoostedTrees, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumnRenamed("prediction", "p")


def fit_calibrator(scored: DataFrame) -> IsotonicRegressionModel:
    """Isotonic fit on (p, y).

    Rows collapse to one weighted point per score first. The library pools neighbours within range
    partitions, so only the pooled blocks meet in the driver.
    """
    points = scored.groupBy("p").agg(
        F.avg(F.col("y").cast("double")).alias("label"), F.count("*").cast("double").alias("weight")
    )
    return IsotonicRegression(
        featuresCol="p", labelCol="label", weightCol="weight", predictionCol="calibrated"
    ).fit(points)


def calibrated(scored: DataFrame, calibrator: IsotonicRegressionModel | None) -> DataFrame:
    if calibrator is None:
        return scored
    return calibrator.transform(scored).withColumn("p", F.col("calibrated")).drop("calibrated")


# --- stage 1 -------------------------------------------------------------------------------------


def _stage1_rows(table: DataFrame, s: Settings) -> DataFrame:
    rows = table.withColumn("y", within("days_to_close", s.horizon))
    return splits.with_time_split(rows, train=s.train, dev=s.dev, test=s.test)


def _with_class_weight(rows: DataFrame, positive: float) -> DataFrame:
    return rows.withColumns(
        {
            "label": F.col("y").cast("double"),
            "weight": F.when(F.col("y") == 1, positive).otherwise(1.0),
        }
    )


#: Priors and fill of each fit.
Fitted = dict[int, tuple[RepoPriors, float]]


def _by_fold(rows: DataFrame) -> dict[int, tuple]:
    """Rows (for_fold, values) by fold."""
    return {r["for_fold"]: tuple(r)[1:] for r in rows.collect()}


def _fold_fits(tables: DataFrame, value: str, shown: dict[int, tuple], folded: DataFrame, s: Settings) -> Fitted:
    """Priors and fill of each fold. ``tables``: written priors of all folds; ``shown``: fallbacks by fold."""
    fills = _by_fold(fold_medians(folded, "ttf_hours", s.folds))
    out = {}
    for fold in range(s.folds):
        own = tables.where(F.col("for_fold") == fold).drop("for_fold")
        count, middle = shown.get(fold, (1.0, None))
        out[fold] = RepoPriors(own, value, count, middle or 0.0), fills.get(fold, (0.0,))[0]
    return out


def _stage1_fits(folded: DataFrame, s: Settings) -> Fitted:
    """Refitted inside each fold; all priors come from one pass, and so do all fills."""
    tables = stage(fold_rate_tables(folded, "y", s.folds), "foldrates")
    return _fold_fits(tables, "posrate", _by_fold(rate_globals(tables, ("for_fold",))), folded, s)


def _ready_folds(shared: DataFrame, fits: Fitted, s: Settings) -> dict[int, tuple[DataFrame, str]]:
    """Learning rows of each fold. ``shared``: of the training part also ``fold``."""
    train, ready = shared.where("part = 'train'"), {}
    for fold in range(s.folds):
        held = F.coalesce(F.col("fold") == fold, F.lit(False))
        own = train.where(F.col("fold").isNull() | (F.col("fold") <= fold))
        own = own.withColumn("part", F.when(held, "test").otherwise("train"))
        ready[fold] = _rows_of_fit(own, fold, *fits[fold]), "test"
    return ready


def _ready(
    rows: DataFrame, fits: Fitted, whole: tuple[RepoPriors, float], s: Settings, vectors: DataFrame | None
) -> tuple[DataFrame, dict[int, tuple[DataFrame, str]]]:
    """Learning rows of the final model (fit number ``folds``) and of each fold."""
    fits = {**fits, s.folds: whole}
    shared = _shared_rows(rows, {fit: p for fit, (p, _) in fits.items()}, s, vectors, ("fold",))
    return _rows_of_fit(shared, s.folds, *whole), _ready_folds(shared, fits, s)


def _oof(models: dict[int, boosting.BoostedTrees], ready: dict[int, tuple[DataFrame, str]]) -> DataFrame:
    """Scores (row_id, y, fold, p) of each fold's held-out rows by its own model."""
    oof = None
    for fold, (rows, held) in ready.items():
        out = _probability(models[fold], rows.where(F.col("part") == held))
        out = out.select("row_id", "y", F.lit(fold).alias("fold"), "p")
        oof = out if oof is None else oof.unionByName(out)
    return stage(oof, "oof")


def oof_predictions(train: DataFrame, s: Settings, vectors: DataFrame | None = None) -> tuple[DataFrame, list[int]]:
    """Out-of-fold scores (row_id, y, fold, p) and trees kept per fold."""
    folded = stage(splits.with_time_folds(train, s.folds), "folded")
    fits = _stage1_fits(folded, s)
    rows = _with_class_weight(folded, class_weight(train, "y").first()["scale_pos_weight"])
    shared = _shared_rows(
        rows.withColumn("part", F.lit("train")), {fold: p for fold, (p, _) in fits.items()}, s, vectors, ("fold",)
    )
    ready = _ready_folds(shared, fits, s)
    models = _fit(ready, "logistic", s)
    return _oof(models, ready), [models[fold].getNumTrees for fold in ready]


def train_stage1(
    table: DataFrame, vectors: DataFrame | None = None, s: Settings = Settings()
) -> tuple[Bundle, DataFrame, DataFrame]:
    """Classifier bundle, long-form metrics of the splits, and the run's parameters."""
    rows = stage(_stage1_rows(table, s).withColumnRenamed("split", "part"), "stage1")
    train = rows.where("part = 'train'")
    priors, fill = fit_rate_priors(train, "y"), ttf_fill(train).first()["ttf_fill"]
    positive = class_weight(train, "y").first()["scale_pos_weight"]
    rows = rows.withColumn("fold", splits.time_fold_column(train, s.folds))
    fits = _stage1_fits(rows.where("part = 'train'"), s)
    ready, folds = _ready(_with_class_weight(rows, positive), fits, (priors, fill), s, vectors)
    models = _fit({**folds, s.folds: (ready, "dev")}, "logistic", s)
    model = models.pop(s.folds)
    oof, sizes = _oof(models, folds), [m.getNumTrees for m in models.values()]
    valid = oof.count()
    coverage = valid / max(1, train.count())
    splits.require_oof(valid, coverage)
    chosen = metrics.best_threshold(oof).first()
    scored = stage(_probability(model, ready).select("row_id", "y", "part", "p"), "scored")
    calibrator = fit_calibrator(scored.where("part = 'dev'")) if s.calibrate else None
    scored = calibrated(scored, calibrator)
    bundle = Bundle(model, priors, fill, s, "stage1-trees-1", chosen["threshold"], calibrator)
    long = [
        metrics.as_long_form(
            metrics.classification_metrics(scored.where(F.col("part") == part), bundle.threshold), f"{part}_"
        )
        for part in ("train", "dev", "test")
    ]
    spark = table.sparkSession
    facts = {
        **asdict(s),
        "threshold_from_oof": chosen["threshold"],
        "oof_best_f1": chosen["f1"],
        "cv_trees_median": _middle(sizes),
        "cv_oof_coverage": coverage,
        "ttf_fill": fill,
        "trees": model.getNumTrees,
        "scale_pos_weight": positive,
        **_inputs(bundle),
    }
    return bundle, long[0].unionByName(long[1]).unionByName(long[2]), parameters(spark, facts)


# --- stage 2 -------------------------------------------------------------------------------------


def regression_rows(table: DataFrame, s: Settings, at_least: int = MIN_REGRESSION_ROWS) -> DataFrame:
    """Issues closed within the horizon, split by time; too few of them is an error."""
    rows = stage(table.where(F.col("days_to_close") <= s.horizon), "stage2")
    n = rows.count()
    if n < at_least:
        raise ValueError(f"too few issues closed within {s.horizon} days: {n}")
    days = F.col("days_to_close")
    rows = rows.withColumns(
        {"y": days, "label": to_log(days), "weight": short_weight(days) if s.weighted else F.lit(1.0)}
    )
    rows = splits.with_time_split(rows, train=s.train, dev=s.dev, test=s.test)
    return rows.withColumnRenamed("split", "part")


def _stage2_fits(folded: DataFrame, s: Settings) -> Fitted:
    """Refitted inside each fold; all priors come from one pass, and so do all fallbacks and fills."""
    tables = stage(fold_median_tables(folded, "y", s.folds), "foldmedians")
    counts = _by_fold(tables.groupBy("for_fold").agg(F.coalesce(F.avg("cnt"), F.lit(1.0))))
    middles = _by_fold(fold_medians(folded, "y", s.folds))
    shown = {fold: (*counts[fold], *middles.get(fold, (None,))) for fold in counts}
    return _fold_fits(tables, "median_days", shown, folded, s)


def cv_best_rounds(train: DataFrame, s: Settings, vectors: DataFrame | None = None) -> list[int]:
    """Best number of trees per fold on its test block."""
    folded = stage(splits.with_time_folds(train, s.folds), "folded")
    fits = _stage2_fits(folded, s)
    rows = folded.withColumn("part", F.lit("train"))
    shared = _shared_rows(rows, {fold: p for fold, (p, _) in fits.items()}, s, vectors, ("fold",))
    ready = _ready_folds(shared, fits, s)
    models = _fit(ready, "pseudo_huber", s)
    return [models[fold].getNumTrees for fold in ready]


def train_stage2(
    table: DataFrame, vectors: DataFrame | None = None, s: Settings = Settings()
) -> tuple[Bundle, DataFrame, DataFrame]:
    """Regressor bundle, long-form metrics (with the median baseline), and the run's parameters."""
    rows = regression_rows(table, s)
    train = rows.where("part = 'train'")
    priors, fill = fit_median_priors(train, "y"), ttf_fill(train).first()["ttf_fill"]
    rows = rows.withColumn("fold", splits.time_fold_column(train, s.folds))
    fits = _stage2_fits(rows.where("part = 'train'"), s)
    ready, folds = _ready(rows, fits, (priors, fill), s, vectors)
    models = _fit({**folds, s.folds: (ready, "dev")}, "pseudo_huber", s)
    model = models.pop(s.folds)
    rounds = [m.getNumTrees for m in models.values()]
    days = from_log("prediction", s.horizon)
    scored = stage(model.transform(ready).select("row_id", "y", "part", days.alias("pred")), "scored")
    of = lambda part: scored.where(F.col("part") == part)
    long = metrics.as_long_form(metrics.median_baseline(of("train"), of("test")), "baseline_test_")
    for part in ("train", "dev", "test"):
        long = long.unionByName(metrics.as_long_form(metrics.regression_metrics(of(part)), f"{part}_"))
    bundle = Bundle(model, priors, fill, s, "stage2-trees-1")
    facts = {
        **asdict(s), "cv_trees_median": _middle(rounds), "ttf_fill": fill, "trees": model.getNumTrees, **_inputs(bundle)
    }
    return bundle, long, parameters(table.sparkSession, facts)


def _inputs(bundle: Bundle) -> dict:
    """What the model reads: tabular names, and how wide the text vector is."""
    width = bundle.model.numFeatures
    return {"features": ",".join(bundle.features), "n_features": width, "embedding_dim": width - len(bundle.features)}


def _middle(values: list[int]) -> int:
    ordered = sorted(values)
    k = len(ordered)
    return (ordered[(k - 1) // 2] + ordered[k // 2]) // 2


# --- records, bundles, scoring -------------------------------------------------------------------


def parameters(spark: SparkSession, facts: dict) -> DataFrame:
    """(name, value) rows of a run's parameters."""
    return spark.createDataFrame([(k, str(v)) for k, v in facts.items()], "name string, value string")


def run_record(run_id: str, stage_name: str, params: DataFrame, measured: DataFrame) -> DataFrame:
    """Experiment rows (run_id, stage, kind, name, value)."""
    tag = lambda df, kind: df.select(
        F.lit(run_id).alias("run_id"),
        F.lit(stage_name).alias("stage"),
        F.lit(kind).alias("kind"),
        "name",
        F.col("value").cast("string").alias("value"),
    )
    return tag(params, "param").unionByName(tag(measured, "metric"))


def append_run(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def save_bundle(bundle: Bundle, path: str) -> None:
    """Model, calibrator and priors with one row of parameters."""
    spark = bundle.priors.table.sparkSession
    boosting.save(spark, bundle.model, f"{path}/model")
    if bundle.calibrator is not None:
        bundle.calibrator.write().overwrite().save(f"{path}/calibrator")
    bundle.priors.table.write.mode("overwrite").parquet(f"{path}/priors")
    row = {
        **asdict(bundle.settings),
        "fill": bundle.fill,
        "version": bundle.version,
        "threshold": bundle.threshold,
        "threshold_source": "oof_f1",
        "has_calibrator": bundle.calibrator is not None,
        "prior": bundle.priors.value,
        "global_count": bundle.priors.global_count,
        "global_value": bundle.priors.global_value,
    }
    spark.createDataFrame([row]).write.mode("overwrite").json(f"{path}/params")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    row = spark.read.json(f"{path}/params").first().asDict()
    priors = RepoPriors(
        spark.read.parquet(f"{path}/priors"), row["prior"], row["global_count"], row["global_value"]
    )
    s = replace(Settings(), **{k: row[k] for k in asdict(Settings())})
    calibrator = IsotonicRegressionModel.load(f"{path}/calibrator") if row["has_calibrator"] else None
    model = boosting.load(spark, f"{path}/model")
    return Bundle(model, priors, row["fill"], s, row["version"], row["threshold"], calibrator)


def _serving_vectors(requests: DataFrame, bundle: Bundle, vectors, as_of) -> DataFrame:
    """Requests as ``_request`` with ``features``; ``_scorable`` is false where the text vector is missing."""
    rows = serving_rows(requests.withColumn("_request", F.struct(*requests.columns)), as_of)
    tab = tabular_features(
        rows, bundle.priors, bundle.fill, bundle.settings.moment, serving=True, keep=("row_id", "_request")
    )
    names = list(bundle.features)
    width = bundle.model.numFeatures - len(names)
    if width == 0:
        tab = tab.withColumn("_scorable", F.lit(True))
    else:
        if vectors is not None:
            tab = tab.join(vectors.select("row_id", "embedding"), "row_id", "left")
        else:
            tab = tab.withColumn("embedding", F.lit(None).cast("array<float>"))
        blank = F.array_repeat(F.lit(0.0).cast("float"), width)
        tab = tab.withColumn("_scorable", F.coalesce(F.size("embedding") == width, F.lit(False)))
        tab = tab.withColumn("embedding", F.when(F.col("_scorable"), F.col("embedding")).otherwise(blank))
    return in_one_array(tab, names, "embedding" if width else None)


def score_stage1(requests: DataFrame, bundle: Bundle, vectors: DataFrame | None = None, as_of=None) -> DataFrame:
    """Requests with the calibrated probability ``p``; a row that cannot be scored gets null."""
    ready = _serving_vectors(requests, bundle, vectors, as_of).select("_request", "_scorable", "features")
    scored = calibrated(_probability(bundle.model, ready), bundle.calibrator)
    return scored.select("_request.*", F.when(F.col("_scorable"), F.col("p")).alias("p"))


def score_stage2(requests: DataFrame, bundle: Bundle, vectors: DataFrame | None = None, as_of=None) -> DataFrame:
    """Requests with the log-days prediction ``r``; a row that cannot be scored gets null."""
    ready = _serving_vectors(requests, bundle, vectors, as_of).select("_request", "_scorable", "features")
    scored = bundle.model.transform(ready)
    return scored.select("_request.*", F.when(F.col("_scorable"), F.col("prediction")).alias("r"))
