"""Incremental collection as table operations: cursors, truncation, first answers, run state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuelab.functions.text import file_safe_repo, org_of, repo_from_path
from issuelab.functions.timing import parse_utc, step_back
from issuelab.operators import idsets
from issuelab.operators.lookup import lookup_join
from issuelab.operators.ordering import running_totals

REPO = "repo_full_name"
PER_PAGE = 100
COLLECTION_ORDER = ("updated_ts", "id")  # oldest change first; id breaks ties


def with_since(issues: DataFrame, cursors: DataFrame, default_since: str) -> DataFrame:
    """Add each repository's stored cursor, or the default where there is none."""
    stored = cursors.select(REPO, F.nullif("since", F.lit("")).alias("since"))
    joined = lookup_join(issues, stored, REPO)
    return joined.withColumn("since", F.coalesce("since", F.lit(default_since)))


def changed_since(
    issues: DataFrame, cursors: DataFrame, default_since: str, state: str = "all"
) -> DataFrame:
    """Issues updated at or after the cursor, optionally only open or closed ones."""
    if state not in ("all", "open", "closed"):
        raise ValueError("state must be all, open or closed")
    df = issues if state == "all" else issues.where(F.col("state") == state)
    df = with_since(df, cursors, default_since)
    return df.where(F.col("updated_ts") >= parse_utc("since"))


def collectable_repos(repos: DataFrame, max_repos: int, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Of the first ``max_repos`` repositories, those with a name and issues not switched off."""
    first = repos.orderBy(*order).limit(max_repos)
    return first.where((F.col("full_name") != "") & F.coalesce("has_issues", F.lit(True)))


def first_seen_repos(repos: DataFrame, max_total: int, order: Sequence[str]) -> DataFrame:
    """First arrival of every repository name across the ordered sources, then the total cap."""
    w = Window.partitionBy("full_name").orderBy(*order)
    named = repos.where(F.col("full_name").isNotNull() & (F.col("full_name") != ""))
    firsts = named.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return firsts.orderBy(*order).limit(max_total)


def _cut_rows(df: DataFrame, order: Sequence[str], position: int) -> DataFrame:
    """Order keys of the row at ``position`` (0-based) in each repository that has that many rows."""
    narrow = df.select(REPO, *order).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(narrow, list(order), ["_one"], [REPO])
    return ranked.where(F.col("_one_before") == position).select(
        REPO, *[F.col(c).alias(f"_cut_{c}") for c in order], F.col("_one_all").alias("_rows")
    )


def _before_cut(order: Sequence[str]) -> Column:
    key = F.struct(*order)
    cut = F.struct(*[F.col(f"_cut_{c}").alias(c) for c in order])
    return F.col("_rows").isNull() | (key < cut)


def _mark_cut(issues: DataFrame, ranked: DataFrame, order: Sequence[str], limit: int) -> DataFrame:
    """Add the order keys of the first row beyond ``limit`` in the row's repository, if any."""
    spread = [c for c in ("id", "number") if c in issues.columns]
    return lookup_join(issues, _cut_rows(ranked, order, limit), REPO, weight="_rows", spread_by=spread)


def first_pages(
    issues: DataFrame, max_pages: int, order: Sequence[str] = COLLECTION_ORDER
) -> DataFrame:
    """First ``max_pages`` pages of each repository in collection order.

    ``order`` must tell the rows of a repository apart.
    """
    marked = _mark_cut(issues, issues, order, max_pages * PER_PAGE)
    return marked.where(_before_cut(order)).select(*issues.columns)


def page_report(issues: DataFrame, max_pages: int) -> DataFrame:
    """Collected rows per repository and whether the page cap was reached, even exactly."""
    cap = max_pages * PER_PAGE
    per_repo = issues.groupBy(REPO).agg(F.count("*").alias("available"))
    return per_repo.select(
        REPO,
        F.least("available", F.lit(cap)).alias("collected"),
        (F.ceil(F.col("available") / PER_PAGE) >= max_pages).alias("truncated"),
    )


def with_first_comment(
    issues: DataFrame,
    comments: DataFrame,
    max_fetch: int,
    order: Sequence[str] = COLLECTION_ORDER,
) -> DataFrame:
    """Earliest comment of the first ``max_fetch`` commented issues (no pull requests) per repository."""
    eligible = ~F.col("is_pull_request") & (F.coalesce("comments", F.lit(0)) > 0)
    marked = _mark_cut(issues, issues.where(eligible), order, max_fetch)
    first = comments.groupBy("issue_id").agg(F.min("comment_ts").alias("_first"))
    # Every issue keeps its own key, so no key is heavier than one issue's row.
    joined = marked.join(first, marked.id == first.issue_id, "left")
    return joined.withColumn(
        "first_comment_ts", F.when(eligible & _before_cut(order), F.col("_first"))
    ).select(*[c for c in issues.columns if c != "first_comment_ts"], "first_comment_ts")


def unsent(batch: DataFrame, sent: DataFrame, order: str = "seq") -> DataFrame:
    """First arrival of each id in the batch that was not sent before."""
    return _firsts(batch, order).join(sent.select("id").distinct(), "id", "left_anti")


def _firsts(batch: DataFrame, order: str) -> DataFrame:
    return batch.groupBy("id").agg(F.min_by(F.struct(*batch.columns), order).alias("r")).select("r.*")


def unsent_by_set(batch: DataFrame, sent: DataFrame, order: str = "seq") -> DataFrame:
    """``unsent``, with the ids sent before as a set of bitmaps (``idsets.id_set``)."""
    return idsets.without(_firsts(batch, order), sent)


def newest_update(issues: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """Latest update per repository in its original spelling; the first row wins ties.

    ``seq`` may be any sortable place of a row.
    """
    timed = issues.select(REPO, "updated_at", seq, parse_utc("updated_at").alias("_ts")).where("_ts is not null")
    per_time = timed.groupBy(REPO, "_ts").agg(F.min_by("updated_at", seq).alias("_text"))
    return per_time.groupBy(REPO).agg(F.max_by("_text", "_ts").alias("max_updated"))


def next_cursors(issues: DataFrame, overlap_seconds: int, seq: str = "ingest_seq") -> DataFrame:
    """Cursor for the next run: the newest update moved back by the overlap."""
    return newest_update(issues, seq).select(
        REPO, step_back("max_updated", overlap_seconds).alias("since")
    )


def upsert_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """Run state per repository: new values win, old ones stay where nothing new is known."""
    values = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c != REPO]
    o = old.select(F.col(REPO).alias("_o"), *[F.col(c).alias(f"_o_{c}") for c in old.columns if c != REPO])
    n = new.select(F.col(REPO).alias("_n"), *[F.col(c).alias(f"_n_{c}") for c in new.columns if c != REPO])
    side = lambda c: [F.col(f"_{s}_{c}") for s, d in (("n", new), ("o", old)) if c in d.columns]
    return o.join(n, F.col("_o") == F.col("_n"), "full_outer").select(
        F.coalesce("_n", "_o").alias(REPO), *[F.coalesce(*side(c)).alias(c) for c in values]
    )


def run_rows(issues: DataFrame, max_pages: int, run_at: Column) -> DataFrame:
    """Run state of a successful collection."""
    return page_report(issues, max_pages).select(
        REPO,
        run_at.alias("last_run_at"),
        F.col("collected").alias("last_collected_count"),
        F.col("truncated").alias("last_truncated"),
        F.lit("ok").alias("last_status"),
    )


def failed_rows(failed: DataFrame, run_at: Column) -> DataFrame:
    """Run state of collections that failed; ``failed`` has the repository and the ``kind`` of error."""
    return failed.select(
        REPO,
        run_at.alias("last_run_at"),
        F.lit(0).cast("long").alias("last_collected_count"),
        F.lit(False).alias("last_truncated"),
        F.concat(F.lit("error: "), "kind").alias("last_status"),
    )


def run_summary(runs: DataFrame) -> DataFrame:
    return runs.agg(
        F.count("*").alias("repos"),
        F.coalesce(F.sum("last_collected_count"), F.lit(0)).alias("issues"),
        F.count_if("last_truncated").alias("truncated_repos"),
        F.count_if(F.startswith("last_status", F.lit("error"))).alias("errors"),
    )


def collect_step(
    issues: DataFrame,
    cursors: DataFrame,
    default_since: str,
    max_pages: int,
    overlap_seconds: int,
    seq: str = "ingest_seq",
    run_at: Column | None = None,
    failed: DataFrame | None = None,
) -> DataFrame:
    """One incremental run: read from the cursor, cap the pages, return the state with advanced cursors.

    The state has the run's outcome of every repository of ``cursors`` or with changes. Repositories in
    ``failed`` (with the ``kind`` of error) keep their cursor. Repeated rows from the overlap are removed
    later by the latest-state step.
    """
    now = run_at if run_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if failed is not None:
        issues = issues.join(failed.select(REPO), REPO, "left_anti")
    changed = changed_since(issues, cursors, default_since)
    kept = first_pages(changed, max_pages, (*COLLECTION_ORDER, seq))
    runs = run_rows(changed, max_pages, now)
    idle = cursors.select(REPO).join(changed.select(REPO).distinct(), REPO, "left_anti")
    if failed is not None:
        idle = idle.join(failed.select(REPO), REPO, "left_anti")
        runs = runs.unionByName(failed_rows(failed, now))
    idle = idle.select(
        REPO,
        now.alias("last_run_at"),
        F.lit(0).cast("long").alias("last_collected_count"),
        F.lit(False).alias("last_truncated"),
        F.lit("ok").alias("last_status"),
    )
    state = upsert_state(cursors, next_cursors(kept, overlap_seconds, seq))
    return upsert_state(state, runs.unionByName(idle))


def counts_per_path(lines_per_file: DataFrame, path: str = "path") -> DataFrame:
    """Line counts per repository and organisation named by the file path; unnamed files drop out."""
    named = lines_per_file.withColumn("repo", repo_from_path(path)).where("repo is not null")
    return named.groupBy("repo", org_of("repo").alias("org")).agg(F.sum("n").alias("n"))


def dump_file_name(repo: Column | str, stamp: Column | str) -> Column:
    """Name of one repository's dump file in one run."""
    return F.concat(F.lit("issues_"), file_safe_repo(repo), F.lit("_"), stamp, F.lit(".jsonl"))

