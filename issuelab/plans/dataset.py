"""Raw dump to training table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from issuelab.operators.clean import (
    capped,
    clean_and_dedup,
    drop_pull_requests,
    ensure_required,
    latest_state,
    row_id,
    sane_times,
    training_columns,
    typed,
    with_identity,
)
from issuelab.operators.features import add_features_and_targets, derived_columns, with_text
from issuelab.sources.readers import load_issues
from issuelab.sources.writers import write_jsonl, write_meta, write_training


def training_table(
    raw: DataFrame,
    cap_days: float = 0.0,
    order: str = "ingest_seq",
    columns: Sequence[str] | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Clean, de-duplicate, derive features and targets, name rows, cap, project.

    With ``columns`` only those are built, and only what they need goes through the de-duplication:
    where just the length of a text is wanted, the text itself is never shuffled. ``derive`` adds further
    columns that hang on one raw row alone, also before the de-duplication.
    """
    if columns is None:
        df = add_features_and_targets(clean_and_dedup(raw, order))
        return training_columns(capped(df.withColumn("row_id", row_id()), cap_days))
    derived = derived_columns()
    wanted = [*columns, *(["days_to_close"] if cap_days else [])]
    inputs = [i for c in wanted if c != "row_id" for i in (derived[c][0] if c in derived else [c])]
    keys = ["repo_full_name", "number", "created_ts", "updated_ts", order]
    rows = with_text(with_identity(typed(drop_pull_requests(ensure_required(raw)))))
    rows = derive(rows) if derive else rows
    latest = latest_state(rows.select(*dict.fromkeys([*keys, *inputs])), order)
    made = {c: derived[c][1] for c in wanted if c in derived}
    latest = sane_times(latest).withColumns({**made, "row_id": row_id()})
    return capped(latest, cap_days).select(*columns)


def build_dataset(
    spark: SparkSession, source: str, location: str, out: str, cap_days: float = 0.0, **store: str
) -> DataFrame:
    """Build the training table and write it as parquet and JSON lines with its description."""
    path = f"{out}/issues_clean_latest"
    write_training(training_table(load_issues(spark, source, location, **store), cap_days), path)
    built = spark.read.parquet(path)
    if built.isEmpty():
        raise ValueError("no rows left after cleaning")
    write_jsonl(built, f"{path}_jsonl")
    write_meta(built, f"{out}/dataset_meta", data_source=source, cap_days_to_close=cap_days, parquet_path=path)
    return built
