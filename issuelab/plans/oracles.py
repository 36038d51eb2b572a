"""ANSI SQL for the registered queries, run by DuckDB on the same tables.

``SQL`` maps a query name to its text. Shared sub-queries are common table expressions; each query
names those it needs and gets their inputs with them.
"""

from __future__ import annotations

from issuelab.functions.text import WHITESPACE

AS_OF = "TIMESTAMP '2000-06-15 12:00:00'"
DEFAULT_SINCE = "1995-01-01T00:00:00Z"

_WS = "||".join(f"chr({ord(c)})" for c in WHITESPACE)


def _shown(c: str, alias: str | None = None) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {alias or c}"


def _iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%SZ')"


def _days(a: str, b: str) -> str:
    return f"date_diff('second', {a}, {b}) / 86400.0E0"


def _hours(a: str, b: str) -> str:
    return f"date_diff('second', {a}, {b}) / 3600.0E0"


_CTES: dict[str, tuple[list[str], str]] = {
    "names": (
        [],
        """SELECT c_custkey, c_name AS user_login, n_name || '/' || c_mktsegment AS repo_full_name
           FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "stats": (
        [],
        """SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_supp,
                  max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS any_ret
           FROM lineitem GROUP BY l_orderkey""",
    ),
    "base": (
        ["names", "stats"],
        """SELECT o_orderkey AS id, o_orderkey AS number, repo_full_name, user_login,
                  CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS state, o_orderstatus,
                  CASE o_orderpriority WHEN '1-URGENT' THEN 'OWNER' WHEN '2-HIGH' THEN 'MEMBER'
                       WHEN '3-MEDIUM' THEN 'CONTRIBUTOR' WHEN '5-LOW' THEN 'COLLABORATOR' END AS author_association,
                  o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS created_ts,
                  (o_orderkey * 1299709) % 432000 AS ttf_secs,
                  o_orderkey % 7 = 3 AS is_pull_request,
                  coalesce(n_lines, 0) AS comments, coalesce(n_supp, 0) AS num_assignees,
                  CASE WHEN any_ret = 1 THEN 'kind/bug' WHEN o_orderkey % 3 = 0 THEN 'documentation'
                       WHEN o_orderkey % 3 = 1 THEN 'help wanted' END AS label0,
                  CASE o_orderkey % 5 WHEN 0 THEN 'bug' WHEN 1 THEN 'enhancement' WHEN 2 THEN 'question'
                       WHEN 3 THEN 'Security' END AS label1,
                  CASE o_orderkey % 11 WHEN 4 THEN 'good first issue' WHEN 5 THEN 'Debug,docker' END AS label2,
                  d.text AS body, substr(d.text, 1, 40) AS title
           FROM orders JOIN names ON o_custkey = c_custkey
           LEFT JOIN stats ON l_orderkey = o_orderkey
           LEFT JOIN documents d ON d.doc_id = o_orderkey % ((SELECT count(*) FROM documents) + 50)""",
    ),
    "facts": (
        ["base"],
        """SELECT *,
                  CASE WHEN o_orderstatus = 'F' THEN
                       CASE WHEN id % 97 = 0 THEN created_ts - INTERVAL 1 DAY
                            ELSE created_ts + to_seconds((id * 104729) % 7776000) END END AS closed_ts,
                  CASE WHEN comments > 0 THEN created_ts + to_seconds(ttf_secs - 3600) END AS first_comment_ts,
                  concat_ws(' ', label0, label1, label2) AS labels_str
           FROM base""",
    ),
    "snaps": (
        ["facts"],
        """SELECT facts.*, snap_no, id * 4 + snap_no AS ingest_seq,
                  CASE WHEN id % 33 <> 0 THEN created_ts + to_seconds(ttf_secs + CASE WHEN snap_no = 1 THEN 3600 ELSE 0 END) END AS updated_ts
           FROM facts, (VALUES (0), (1), (2)) s(snap_no)
           WHERE snap_no = 0 OR (snap_no = 1 AND id % 10 = 0) OR (snap_no = 2 AND id % 25 = 0)""",
    ),
    "pass1": (
        ["snaps"],
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repo_full_name, number, updated_ts
                                                       ORDER BY ingest_seq DESC) AS rn1
                          FROM snaps WHERE NOT is_pull_request) WHERE rn1 = 1""",
    ),
    "pass2": (
        ["pass1"],
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY repo_full_name, number
                                     ORDER BY coalesce(updated_ts, created_ts) DESC, updated_ts DESC NULLS FIRST, ingest_seq DESC) AS rn2
                          FROM pass1) WHERE rn2 = 1""",
    ),
    "sane": (
        ["pass2"],
        """SELECT * REPLACE (CASE WHEN closed_ts >= created_ts THEN closed_ts END AS closed_ts,
                             CASE WHEN first_comment_ts >= created_ts THEN first_comment_ts END AS first_comment_ts,
                             coalesce(title, '') AS title, coalesce(body, '') AS body)
           FROM pass2""",
    ),
    "train_all": (
        ["sane"],
        f"""SELECT *, repo_full_name || '#' || CAST(number AS VARCHAR) AS row_id,
                   trim(title || ' ' || body, {_WS}) AS text,
                   (CASE WHEN label0 IS NULL THEN 0 ELSE 1 END + CASE WHEN label1 IS NULL THEN 0 ELSE 1 END
                     + CASE WHEN label2 IS NULL THEN 0 ELSE 1 END) AS labels_count,
                   length(title) AS title_len, length(body) AS body_len,
                   CASE WHEN length(body) > 0 THEN 1 ELSE 0 END AS has_body,
                   isodow(created_ts) - 1 AS created_dow, hour(created_ts) AS created_hour,
                   CASE WHEN first_comment_ts >= created_ts THEN {_hours('created_ts', 'first_comment_ts')} END AS ttf_hours,
                   {_days('created_ts', 'closed_ts')} AS days_to_close,
                   CASE WHEN closed_ts IS NULL THEN 0 ELSE 1 END AS is_closed
            FROM sane""",
    ),
    "clean": (
        ["train_all"],
        "SELECT *, CASE WHEN days_to_close <= 30 THEN 1 ELSE 0 END AS resolved_30d FROM train_all",
    ),
    "ranked": (
        ["clean"],
        """SELECT *, resolved_30d AS y, row_number() OVER (ORDER BY created_ts, row_id) - 1 AS pos, count(*) OVER () AS n
           FROM clean""",
    ),
    "split": (
        ["ranked"],
        """SELECT *, CASE WHEN pos < CAST(floor(n * 0.8E0) AS BIGINT) THEN 'train'
                          WHEN pos < CAST(floor(n * 0.8E0) AS BIGINT) + CAST(floor(n * 0.1E0) AS BIGINT) THEN 'dev'
                          ELSE 'test' END AS split FROM ranked""",
    ),
    "train": (["split"], "SELECT * FROM split WHERE split = 'train'"),
    "quick": (
        ["clean"],
        """SELECT * FROM (SELECT *, row_number() OVER (ORDER BY created_ts, row_id) - 1 AS pos, count(*) OVER () AS n
                          FROM clean WHERE days_to_close <= 30)
           WHERE pos < CAST(floor(n * 0.8E0) AS BIGINT)""",
    ),
    "folded": (
        ["train"],
        """SELECT * EXCLUDE (pos, n), CASE WHEN tpos >= tn - 5 * (tn // 6) THEN (tpos - (tn - 5 * (tn // 6))) // (tn // 6) END AS fold
           FROM (SELECT *, row_number() OVER (ORDER BY created_ts, row_id) - 1 AS tpos, count(*) OVER () AS tn FROM train)""",
    ),
    "quick_folded": (
        ["quick"],
        """SELECT * EXCLUDE (pos, n), CASE WHEN tpos >= tn - 5 * (tn // 6) THEN (tpos - (tn - 5 * (tn // 6))) // (tn // 6) END AS fold
           FROM (SELECT *, row_number() OVER (ORDER BY created_ts, row_id) - 1 AS tpos, count(*) OVER () AS tn FROM quick)""",
    ),
    "rates": (
        ["train"],
        "SELECT repo_full_name, count(*) AS cnt, avg(y) AS posrate FROM train GROUP BY repo_full_name",
    ),
    "rate_g": (
        ["rates", "train"],
        "SELECT (SELECT avg(cnt) FROM rates) AS global_count, (SELECT avg(y) FROM train) AS global_posrate",
    ),
    "meds": (
        ["quick"],
        "SELECT repo_full_name, count(*) AS cnt, median(days_to_close) AS median_days FROM quick GROUP BY repo_full_name",
    ),
    "med_g": (
        ["meds", "quick"],
        "SELECT (SELECT avg(cnt) FROM meds) AS global_count, (SELECT median(days_to_close) FROM quick) AS global_median",
    ),
    "store": (
        ["facts"],
        "SELECT *, created_ts AS created_at, closed_ts AS closed_at, concat_ws(', ', label0, label1, label2) AS comma_labels FROM facts",
    ),
    "audit": (
        ["store"],
        f"""SELECT *, CASE WHEN d < 0 THEN 0 ELSE d END AS days_to_close, CASE WHEN d <= 30 THEN 1 ELSE 0 END AS resolved
            FROM (SELECT *, {_days('created_at', 'closed_at')} AS d FROM store)""",
    ),
    "sc": (
        [],
        """SELECT o_orderkey AS id, ((o_orderkey * 7919) % 1000) / 1000.0E0 AS p,
                  ln(1.0E0 + (o_orderkey * 104729) % 40) AS r,
                  CASE WHEN o_orderstatus = 'F' AND (o_orderkey * 104729) % 7776000 <= 2592000 THEN 1 ELSE 0 END AS y,
                  CASE WHEN o_orderstatus = 'F' THEN ((o_orderkey * 104729) % 7776000) / 86400.0E0 END AS days,
                  o_orderdate AS created_ts
           FROM orders""",
    ),
    "clip": (["sc"], "SELECT *, greatest(least(p, 1 - 1e-6), 1e-6) AS q FROM sc"),
    "curve": (
        ["sc"],
        """SELECT p AS score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
                  sum(pos) OVER () AS n_pos, sum(neg) OVER () AS n_neg
           FROM (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY p)
           WINDOW w AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ),
    "dayscore": (
        ["sc"],
        """SELECT id, created_ts, days AS y, greatest(least(exp(r) - 1, 30.0E0), 0.0E0) AS pred
           FROM sc WHERE days <= 30""",
    ),
    "cur": (
        [],
        """SELECT n_name || '/BUILDING' AS repo_full_name,
                  strftime(TIMESTAMP '1998-01-01 00:00:00' + to_days(n_nationkey * 30), '%Y-%m-%dT%H:%M:%SZ') AS since
           FROM nation""",
    ),
    "repos": (
        [],
        """SELECT c_custkey AS id, n_name || '/' || c_mktsegment AS full_name, c_mktsegment AS name, n_name,
                  CAST(floor(c_acctbal) AS BIGINT) AS stargazers_count,
                  CASE c_custkey % 11 WHEN 0 THEN FALSE WHEN 1 THEN NULL ELSE TRUE END AS has_issues,
                  CAST(c_custkey % 2 AS INTEGER) AS src_rank, c_custkey AS seq
           FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "cmts": (
        [],
        """SELECT l_orderkey AS issue_id,
                  o_orderdate + to_seconds((o_orderkey * 7919) % 86400 + (l_partkey * 31 + l_linenumber * 977) % 432000) AS comment_ts
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "good_msgs": (["snaps"], "SELECT * FROM snaps WHERE ingest_seq % 53 <> 0"),
}


def _with(names: list[str], body: str) -> str:
    order: list[str] = []

    def need(name: str) -> None:
        for dep in _CTES[name][0]:
            need(dep)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS (\n{_CTES[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


SQL: dict[str, str] = {}


def _add(name: str, ctes: str, body: str) -> None:
    SQL[name] = _with(ctes.split(), body)


def _flags(joined: str) -> str:
    words = {
        "has_bug": ["bug"],
        "has_docs": ["doc", "documentation"],
        "has_feature": ["feature", "enhancement"],
        "has_question": ["question", "help wanted"],
        "has_security": ["security", "vulnerability", "cve"],
        "has_good_first_issue": ["good first issue"],
        "has_help_wanted": ["help wanted"],
    }
    return ", ".join(
        "CASE WHEN " + " OR ".join(f"contains(lower({joined}), '{w}')" for w in ws) + f" THEN 1.0E0 ELSE 0.0E0 END AS {n}"
        for n, ws in words.items()
    )


def _authors(missing: str, prefix: str = "") -> str:
    a = f"upper(coalesce(author_association, '{missing}'))"
    own = {"owner": "OWNER", "member": "MEMBER", "contributor": "CONTRIBUTOR", "none": "NONE"}
    flags = [f"CASE WHEN {a} = '{v}' THEN 1.0E0 ELSE 0.0E0 END AS {prefix}author_is_{k}" for k, v in own.items()]
    flags.append(
        f"CASE WHEN {a} NOT IN ('OWNER', 'MEMBER', 'CONTRIBUTOR', 'NONE') THEN 1.0E0 ELSE 0.0E0 END AS {prefix}author_is_other"
    )
    return ", ".join(flags)


def _ttf(hours: str, fill: str) -> str:
    return f"""CASE WHEN {hours} IS NULL THEN 1.0E0 ELSE 0.0E0 END AS ttf_missing,
        round(least(coalesce({hours}, {fill}), 72.0E0), 6) AS ttf_capped_72h,
        round(ln(1 + greatest(coalesce({hours}, {fill}), 0.0E0)), 6) AS ttf_log1p"""


_add("s3_parquet_scan", "", "SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM orders WHERE o_orderstatus = 'F'")
_add(
    "s4_mixed_merge", "",
    """SELECT kind, CAST(sum(CASE WHEN bad THEN 0 ELSE 1 END) AS BIGINT) AS records,
              CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS bad_lines,
              CAST(sum(CASE WHEN bad THEN 0 ELSE id END) AS BIGINT) AS id_sum,
              CAST(sum(CASE WHEN bad THEN 0 ELSE 1 END) AS BIGINT) AS with_id
       FROM (SELECT id, kind, kind = 'lines' AND id % 20 = 0 AS bad
             FROM (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5000 = 7 THEN 'object' WHEN o_orderkey % 4 = 1 THEN 'array' ELSE 'lines' END AS kind FROM orders))
       GROUP BY kind""",
)
_add("s7_store_scan", "store", f"SELECT id, {_shown('created_at')}, {_shown('closed_at')}, comma_labels AS labels_str FROM store")
_add(
    "s8_line_counts", "",
    "SELECT CAST(sum(length(replace(text, chr(13), '')) - length(replace(replace(text, chr(13), ''), chr(10), '')) + 1) AS BIGINT) AS n_lines FROM documents",
)
_add(
    "s9_embedding_bundle", "",
    """SELECT 'v#' || CAST(vec_id AS VARCHAR) AS row_id, CAST(len(embedding) AS INTEGER) AS dim,
              round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) * 2, 6) AS norm
       FROM embeddings""",
)
_add(
    "k3_iso_export", "clean",
    "SELECT row_id, " + ", ".join(f"strftime({c}, '%Y-%m-%dT%H:%M:%S+00:00') AS {c}" for c in ("created_ts", "updated_ts", "closed_ts", "first_comment_ts")) + " FROM clean",
)
_add("k4_dataset_meta", "clean", "SELECT count(*) AS n_rows, 'store' AS data_source, 0.0E0 AS cap_days_to_close, 29 AS n_columns FROM clean")
_add(
    "k5_append_by_repo", "snaps",
    """SELECT regexp_replace(replace(repo_full_name, '/', '__'), '[^A-Za-z0-9_.-]+', '_', 'g') AS repo_key,
              CASE state WHEN 'open' THEN '20240101_000000' ELSE '20240102_000000' END AS run_ts,
              count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum
       FROM snaps GROUP BY 1, 2""",
)
_add(
    "k6_merge_report", "",
    """SELECT 0 AS skipped, CAST(sum(CASE WHEN bad THEN 0 ELSE 1 END) AS BIGINT) AS records, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS bad_lines
       FROM (SELECT o_orderkey % 5000 <> 7 AND o_orderkey % 4 <> 1 AND o_orderkey % 20 = 0 AS bad FROM orders)""",
)
_add(
    "k8_message_payload", "facts",
    """SELECT CAST(id AS VARCHAR) AS key,
              CAST(json_object('id', id, 'repo_full_name', repo_full_name, 'state', state, 'author_association', author_association,
                               'comments', comments, 'is_pull_request', is_pull_request) AS VARCHAR) AS value
       FROM facts""",
)
_add(
    "k9_state_upsert", "facts cur",
    """SELECT coalesce(n.repo_full_name, o.repo_full_name) AS repo_full_name, since,
              coalesce(n.last_run_at, o.last_run_at) AS last_run_at,
              coalesce(n.last_collected_count, o.last_collected_count) AS last_collected_count, last_truncated, last_status
       FROM (SELECT *, '2024-01-01T00:00:00Z' AS last_run_at, 5 AS last_collected_count FROM cur) o
       FULL JOIN (SELECT repo_full_name, '2000-06-15T12:00:00Z' AS last_run_at, least(count(*), 100) AS last_collected_count,
                         TRUE AS last_truncated, 'ok' AS last_status
                  FROM facts GROUP BY repo_full_name HAVING count(*) > 1) n ON o.repo_full_name = n.repo_full_name""",
)
_ok = lambda expr, alias: f"CASE WHEN ingest_seq % 53 <> 0 THEN {expr} END AS {alias}"
_add(
    "p1_parse_json", "snaps",
    f"""SELECT CAST(id AS VARCHAR) AS kafka_key, ingest_seq AS kafka_offset, CAST(ingest_seq % 3 AS INTEGER) AS kafka_partition,
               {_ok('id', 'id')}, {_ok('repo_full_name', 'repo_full_name')}, {_ok('CAST(number AS INTEGER)', 'number')},
               {_ok('state', 'state')}, {_ok('CAST(comments AS INTEGER)', 'comments')},
               {_ok("coalesce(label0, '~') || '|' || coalesce(label1, '~') || '|' || coalesce(label2, '~')", 'labels')},
               {_ok(_iso('created_ts'), 'created_at')}, {_ok('is_pull_request', 'is_pull_request')}, CAST(NULL AS VARCHAR) AS milestone
        FROM snaps""",
)
_add("p2_required_keys", "good_msgs", "SELECT ingest_seq AS kafka_offset, id, CAST(number AS INTEGER) AS number FROM good_msgs")
_nlab = "((label0 IS NOT NULL)::INT + (label1 IS NOT NULL)::INT + (label2 IS NOT NULL)::INT)"
_add(
    "p5_label_count", "snaps",
    f"""SELECT ingest_seq, CASE WHEN id % 17 <> 0 THEN {_nlab} ELSE -1 END AS label_count,
               id % 17 <> 0 AND {_nlab} > 0 AS has_labels, num_assignees > 0 AS has_assignees, state = 'closed' AS is_closed
        FROM snaps""",
)
_add(
    "p7_lengths", "snaps",
    """SELECT ingest_seq, coalesce(length(body) > 0, FALSE) AS has_body, CAST(coalesce(length(body), 0) AS INTEGER) AS body_length,
              CAST(coalesce(length(title), 0) AS INTEGER) AS title_length FROM snaps""",
)
_exact = lambda v, alias: f"CASE WHEN id % 17 <> 0 THEN (label0 = '{v}' OR label1 = '{v}' OR label2 = '{v}') END AS {alias}"
_add(
    "p9_label_flags_exact", "snaps",
    f"""SELECT ingest_seq, {_exact('bug', 'is_bug')}, {_exact('enhancement', 'is_enhancement')},
               {_exact('documentation', 'is_documentation')}, {_exact('question', 'is_question')} FROM snaps""",
)
_add(
    "p10_durations", "snaps",
    f"""SELECT ingest_seq, round({_hours('created_ts', 'closed_ts')}, 6) AS time_to_close_hours,
               round({_hours('created_ts', 'first_comment_ts')}, 6) AS time_to_first_comment_hours FROM snaps""",
)
_add("p11_age", "snaps", f"SELECT ingest_seq, round({_hours('created_ts', AS_OF)}, 6) AS age_hours FROM snaps")
_add(
    "p12_required_columns", "snaps",
    """SELECT ingest_seq, CASE WHEN id % 5 = 0 THEN FALSE ELSE is_pull_request END AS is_pull_request,
              CAST(NULL AS VARCHAR) AS first_comment_at, CAST(NULL AS VARCHAR) AS author_association, CAST(NULL AS VARCHAR) AS title
       FROM snaps""",
)
_add("p13_drop_prs", "snaps", "SELECT ingest_seq, repo_full_name FROM snaps WHERE NOT is_pull_request")
_add("p14_labels", "facts", "SELECT id, CASE WHEN id % 17 = 0 THEN '' ELSE concat_ws('|', label0, label1, label2) END AS labels FROM facts")
_add(
    "p15_numeric_coerce", "snaps",
    """SELECT ingest_seq, CASE WHEN id % 4 IN (0, 2) THEN comments ELSE 0 END AS comments,
              CASE WHEN id % 9 <> 0 THEN id END AS number FROM snaps""",
)
_add(
    "p16_lenient_times", "facts",
    f"""SELECT id, {_shown("CASE id % 5 WHEN 0 THEN created_ts WHEN 1 THEN created_ts - INTERVAL 2 HOUR END", 'ts')} FROM facts""",
)
_add(
    "p18_sanity", "snaps",
    f"""SELECT ingest_seq, {_shown('CASE WHEN closed_ts >= created_ts THEN closed_ts END', 'closed_ts')},
               {_shown('CASE WHEN first_comment_ts >= created_ts THEN first_comment_ts END', 'first_comment_ts')} FROM snaps""",
)
_add("p20_cap", "clean", "SELECT row_id, round(days_to_close, 8) AS days_to_close FROM clean WHERE days_to_close IS NULL OR days_to_close <= 30")
_add(
    "p21_clean_table", "clean",
    f"""SELECT row_id, repo_full_name, number, author_association, comments, num_assignees,
               {', '.join(f'{_iso(t)} AS {a}' for t, a in (('created_ts', 'created_at'), ('updated_ts', 'updated_at')))},
               {_iso('pass2_closed')} AS closed_at, {_iso('pass2_first')} AS first_comment_at,
               labels_str, CAST(labels_count AS INTEGER) AS labels_count, CAST(title_len AS INTEGER) AS title_len,
               CAST(body_len AS INTEGER) AS body_len, has_body, CAST(created_dow AS INTEGER) AS created_dow,
               CAST(created_hour AS INTEGER) AS created_hour, is_closed, resolved_30d,
               md5(title) AS title, md5(body) AS body, md5(text) AS text, replace(labels_pipe, '~', '|') AS labels,
               {_shown('created_ts')}, {_shown('updated_ts')}, {_shown('closed_ts')}, {_shown('first_comment_ts')},
               round(ttf_hours, 6) AS ttf_hours, round(days_to_close, 8) AS days_to_close
        FROM (SELECT c.*, p.closed_ts AS pass2_closed, p.first_comment_ts AS pass2_first, concat_ws('|', c.label0, c.label1, c.label2) AS labels_pipe
              FROM clean c JOIN pass2 p ON c.ingest_seq = p.ingest_seq)""",
)
_add(
    "p22_horizon_label", "clean",
    """SELECT row_id, resolved_30d AS close_within_30, CASE WHEN days_to_close <= 7 THEN 1 ELSE 0 END AS close_within_7 FROM clean""",
)
_add(
    "p23_regression_rows", "clean",
    """SELECT row_id, round(days_to_close, 8) AS days_to_close,
              CASE WHEN pos < CAST(floor(n * 0.8E0) AS BIGINT) THEN 'train'
                   WHEN pos < CAST(floor(n * 0.8E0) AS BIGINT) + CAST(floor(n * 0.1E0) AS BIGINT) THEN 'dev' ELSE 'test' END AS part
       FROM (SELECT *, row_number() OVER (ORDER BY created_ts, row_id) - 1 AS pos, count(*) OVER () AS n FROM clean WHERE days_to_close <= 30)""",
)
_add(
    "p25_t0_mode", "clean",
    f"SELECT row_id, 0 AS comments, {_ttf('CAST(NULL AS DOUBLE)', '24.0E0')} FROM clean",
)
_names = "CASE WHEN id % 17 = 0 THEN '' ELSE concat_ws('|', label0, label1, CASE WHEN id % 6 = 0 THEN NULL ELSE label2 END) END"
_add(
    "p26_normalize_issue", "facts",
    f"""SELECT id, '2000-06-15T12:00:00Z' AS collected_at, repo_full_name, CAST(number AS INTEGER) AS number, state,
               CASE WHEN id % 13 <> 0 THEN user_login END AS user_login, {_names} AS labels,
               CASE WHEN id % 4 = 0 THEN '' ELSE concat_ws('|', 'dev' || CAST(id % 19 AS VARCHAR),
                    CASE WHEN id % 3 <> 0 THEN 'ops' || CAST(id % 5 AS VARCHAR) END) END AS assignees,
               CASE WHEN id % 4 = 0 THEN 0 ELSE 2 END AS num_assignees,
               CASE WHEN id % 8 = 0 THEN 'v' || CAST(id % 3 AS VARCHAR) END AS milestone, is_pull_request,
               {_iso('created_ts')} AS created_at, CAST(NULL AS VARCHAR) AS first_comment_at
        FROM facts""",
)
_add(
    "p27_normalize_live", "facts",
    """SELECT id, repo_full_name, CASE WHEN id % 13 <> 0 THEN user_login END AS user_login,
              CASE WHEN id % 17 = 0 THEN '' ELSE coalesce(label0, '~') || '|' || coalesce(label1, '~') || '|'
                   || CASE WHEN id % 6 = 0 THEN '' ELSE coalesce(label2, '~') END END AS labels,
              CASE WHEN id % 4 = 0 THEN '' ELSE 'dev' || CAST(id % 19 AS VARCHAR) || '|'
                   || CASE WHEN id % 3 <> 0 THEN 'ops' || CAST(id % 5 AS VARCHAR) ELSE '~' END END AS assignees
       FROM facts""",
)
_add(
    "p28_normalize_repo", "repos",
    """SELECT id, full_name, name, CASE WHEN id % 9 <> 0 THEN n_name END AS owner_login,
              CASE WHEN id % 4 <> 0 THEN lower(name) || '|oss' ELSE '' END AS topics, stargazers_count,
              CASE WHEN id % 5 <> 0 THEN CASE WHEN id % 2 = 0 THEN 'MIT' ELSE 'Apache-2.0' END END AS license, has_issues
       FROM repos""",
)
_add(
    "p29_since_filter", "snaps cur",
    f"""SELECT ingest_seq, repo_full_name, since FROM (
          SELECT snaps.*, coalesce(cur.since, '{DEFAULT_SINCE}') AS since FROM snaps LEFT JOIN cur USING (repo_full_name))
        WHERE state = 'closed' AND updated_ts >= strptime(since, '%Y-%m-%dT%H:%M:%SZ')""",
)
_add(
    "p30_repo_skip", "repos",
    """SELECT id, full_name, has_issues FROM (SELECT * FROM repos ORDER BY seq LIMIT 1000)
       WHERE full_name <> '' AND coalesce(has_issues, TRUE)""",
)
_add("p31_column_names", "", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
_add(
    "p32_audit_prep", "audit",
    "SELECT id, round(days_to_close, 8) AS days_to_close, resolved AS resolved_30d, strftime(created_at, '%Y-%m') AS created_month FROM audit",
)
_bare = f"trim(replace(regexp_replace(html, '<[^>]+>', '', 'g'), chr(10), ' '), {_WS})"
_add("p33_clean_text", "", f"SELECT page_id, md5({_bare}) AS text, CAST(length({_bare}) AS INTEGER) AS n FROM pages")
_add(
    "p34_serving_impute", "facts",
    """SELECT id, CASE WHEN id % 5 = 0 THEN 1 WHEN id % 5 = 1 THEN NULL WHEN comments = 0 THEN 1 ELSE comments END AS comments,
              CASE WHEN num_assignees = 0 THEN 1 ELSE num_assignees END AS num_assignees FROM facts""",
)
_add(
    "p35_legacy_features", "clean",
    "SELECT row_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ("comments", "num_assignees", "labels_count"))
    + ", 0.0E0 AS title_len, 0.0E0 AS body_len, 0.0E0 AS has_body, CAST(created_dow AS DOUBLE) AS created_dow, CAST(created_hour AS DOUBLE) AS created_hour, round(coalesce(ttf_hours, 0.0E0), 6) AS ttf_hours FROM clean",
)
_add("p36_scored_view", "store sc", f"SELECT number, md5(title) AS title, p, {_shown('store.created_at', 'created_at')} FROM store JOIN sc USING (id)")

_norm = "sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))"
_add(
    "j1_embedding_align", "",
    f"""SELECT id, vec_id, round({_norm}, 6) AS norm
        FROM (SELECT o_orderkey AS id, o_orderkey % ((SELECT count(*) FROM embeddings) + 1) AS vec_id FROM orders) JOIN embeddings USING (vec_id)""",
)
_prior1 = "round(ln(1 + coalesce(CAST(cnt AS DOUBLE), global_count)), 6) AS repo_count_train, round(coalesce(posrate, global_posrate), 6) AS repo_posrate_train"
_prior2 = "round(ln(1 + coalesce(CAST(cnt AS DOUBLE), global_count)), 6) AS repo_count_train, round(coalesce(median_days, global_median), 8) AS repo_median_days_train"
_add("j2_repo_prior_lookup", "split rates rate_g", f"SELECT row_id, {_prior1} FROM split LEFT JOIN rates USING (repo_full_name), rate_g")
_add("j3_serving_priors", "facts meds med_g", f"SELECT id, {_prior2} FROM facts LEFT JOIN meds USING (repo_full_name), med_g WHERE state = 'open'")
_add(
    "j4_cursor_lookup", "facts cur",
    f"SELECT repo_full_name, coalesce(since, '{DEFAULT_SINCE}') AS since FROM (SELECT DISTINCT repo_full_name FROM facts) LEFT JOIN cur USING (repo_full_name)",
)
_add(
    "j5_first_comment", "snaps cmts",
    f"""SELECT id, {_shown('CASE WHEN eligible AND nth <= 40 THEN first_ts END', 'first_comment_ts')}
        FROM (SELECT id, NOT is_pull_request AND comments > 0 AS eligible,
                     sum(CASE WHEN NOT is_pull_request AND comments > 0 THEN 1 ELSE 0 END)
                       OVER (PARTITION BY repo_full_name ORDER BY updated_ts NULLS FIRST, id ROWS UNBOUNDED PRECEDING) AS nth
              FROM snaps WHERE snap_no = 0)
        LEFT JOIN (SELECT issue_id, min(comment_ts) AS first_ts FROM cmts GROUP BY issue_id) ON issue_id = id""",
)
_add(
    "j6_unsent_ids", "snaps",
    """SELECT id, state, ingest_seq AS seq FROM snaps WHERE snap_no = 0
       AND id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')""",
)

_add("a1_total", "snaps", "SELECT count(*) AS n FROM snaps")
_add("a2_top_repos", "snaps", "SELECT repo_full_name, count(*) AS n FROM snaps GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5")
_add("a3_state_counts", "store", "SELECT state, count(*) AS n FROM store GROUP BY 1")
_add("a4_flag_count", "snaps", "SELECT count(*) FILTER (WHERE label0 = 'bug' OR label1 = 'bug' OR label2 = 'bug') AS n FROM snaps")
_any = lambda rx: " OR ".join(f"coalesce(regexp_matches(lower(label{i}), '{rx}'), FALSE)" for i in range(3))
_add(
    "a5_keyword_counts", "store",
    f"SELECT count(*) FILTER (WHERE {_any('bug')}) AS bugs, count(*) FILTER (WHERE {_any('enhancement|feature')}) AS features FROM store",
)
_add(
    "a6_bug_share", "store",
    """SELECT count(*) FILTER (WHERE contains(lower(comma_labels), 'bug')) AS bugs,
              round(avg(CASE WHEN contains(lower(comma_labels), 'bug') THEN 1.0E0 ELSE 0.0E0 END) * 100, 6) AS bug_pct FROM store""",
)
_add("a7_new_today", "store", "SELECT count(*) FILTER (WHERE CAST(created_at AS DATE) = DATE '1996-03-01') AS n FROM store")
_add("a8_velocity", "store", f"SELECT round(avg({_days('created_at', 'closed_at')}), 6) AS avg_days, count(*) AS closed FROM store WHERE closed_at IS NOT NULL")
_add(
    "a9_open_ratio", "store",
    "SELECT count(*) FILTER (WHERE state = 'open') AS open, round(avg(CASE WHEN state = 'open' THEN 1.0E0 ELSE 0.0E0 END) * 100, 6) AS open_pct FROM store",
)
_add(
    "a10_audit_kpis", "audit",
    "SELECT count(*) AS n, round(avg(days_to_close), 6) AS mean_days, round(median(days_to_close), 8) AS median_days, round(avg(resolved) * 100, 6) AS sla_30d_pct FROM audit",
)
_add("a11_class_balance", "audit", "SELECT resolved AS resolved_30d, count(*) AS n FROM audit GROUP BY 1")
_add(
    "a12_histogram", "audit",
    """SELECT CAST(b AS INTEGER) AS bin, round(lo + b * w, 6) AS lower, count(days_to_close) AS n
       FROM (SELECT unnest(range(50)) AS b) bins
       CROSS JOIN (SELECT min(days_to_close) AS lo, (max(days_to_close) - min(days_to_close)) / 50 AS w FROM audit)
       LEFT JOIN (SELECT days_to_close, least(floor((days_to_close - (SELECT min(days_to_close) FROM audit))
                     / ((SELECT (max(days_to_close) - min(days_to_close)) / 50 FROM audit))), 49) AS own
                  FROM audit WHERE days_to_close IS NOT NULL) v ON own = b
       GROUP BY b, lo, w""",
)
_add("a13_label_combos", "store", "SELECT comma_labels AS labels_str, count(*) AS n FROM store GROUP BY 1 ORDER BY n DESC, 1 LIMIT 5")
_add(
    "a14_priors_cls", "rates rate_g",
    "SELECT repo_full_name, cnt, round(posrate, 6) AS posrate, round(global_count, 6) AS global_count, round(global_posrate, 6) AS global_posrate FROM rates, rate_g",
)
_add(
    "a15_priors_reg", "meds med_g",
    "SELECT repo_full_name, cnt, round(median_days, 8) AS median_days, round(global_count, 6) AS global_count, round(global_median, 8) AS global_median FROM meds, med_g",
)
_add("a16_ttf_fill", "train", "SELECT round(coalesce(median(ttf_hours), 0.0E0), 6) AS ttf_fill FROM train")
_add(
    "a17_class_weight", "train",
    "SELECT CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg, round(CAST(greatest(sum(1 - y), 1) AS DOUBLE) / greatest(sum(y), 1), 6) AS scale_pos_weight FROM train",
)
_add(
    "a18_max_cursor", "snaps",
    f"SELECT repo_full_name, {_iso('max(updated_ts)')} AS max_updated FROM snaps WHERE updated_ts IS NOT NULL GROUP BY 1",
)
_add(
    "a19_path_counts", "facts",
    "SELECT repo_full_name AS repo, split_part(repo_full_name, '/', 1) AS org, count(*) AS n FROM facts GROUP BY 1, 2",
)
_add(
    "a20_run_summary", "snaps",
    """SELECT count(*) AS repos, CAST(sum(CASE WHEN broken THEN 0 ELSE least(c, 200) END) AS BIGINT) AS issues,
              count(*) FILTER (WHERE NOT broken AND ceil(c / 100.0E0) >= 2) AS truncated_repos, count(*) FILTER (WHERE broken) AS errors
       FROM (SELECT repo_full_name, repo_full_name LIKE '%/BUILDING' AS broken, count(*) AS c FROM snaps GROUP BY 1)""",
)
_add(
    "a21_describe", "clean",
    """SELECT count(*) AS n_rows, 'row_id,repo_full_name,number,title,body,labels,author_association,comments,num_assignees,created_at,updated_at,closed_at,first_comment_at,created_ts,updated_ts,closed_ts,first_comment_ts,text,labels_str,labels_count,title_len,body_len,has_body,created_dow,created_hour,ttf_hours,is_closed,days_to_close,resolved_30d' AS columns
       FROM clean""",
)

_add(
    "w1_snapshot_dedup", "snaps",
    """SELECT ingest_seq, repo_full_name FROM (SELECT *, row_number() OVER (PARTITION BY repo_full_name, number, updated_ts ORDER BY ingest_seq DESC) AS rn FROM snaps)
       WHERE rn = 1""",
)
_add(
    "w2_latest_state", "snaps",
    f"""SELECT repo_full_name, number, ingest_seq, {_shown('updated_ts')} FROM (
          SELECT *, row_number() OVER (PARTITION BY repo_full_name, number
                      ORDER BY coalesce(updated_ts, created_ts) DESC, updated_ts DESC NULLS FIRST, ingest_seq DESC) AS rn2
          FROM (SELECT *, row_number() OVER (PARTITION BY repo_full_name, number, updated_ts ORDER BY ingest_seq DESC) AS rn FROM snaps) WHERE rn = 1)
        WHERE rn2 = 1""",
)
_add("w3_time_split", "split", "SELECT row_id, split FROM split")
_add("w4_cv_folds", "folded", "SELECT row_id, CAST(fold AS INTEGER) AS fold FROM folded")
_add("w5_oof_coverage", "folded", "SELECT count(*) AS n, count(fold) AS valid, round(count(fold) / CAST(count(*) AS DOUBLE), 6) AS coverage FROM folded")
_add(
    "w6_repo_first_seen", "repos",
    """SELECT full_name, src_rank, seq FROM (
         SELECT *, CASE WHEN src_rank = 1 THEN -stargazers_count ELSE seq END AS place,
                row_number() OVER (PARTITION BY full_name ORDER BY src_rank, CASE WHEN src_rank = 1 THEN -stargazers_count ELSE seq END, seq) AS rn FROM repos)
       WHERE rn = 1 ORDER BY src_rank, place, seq LIMIT 600""",
)
_add("w8_recent_open", "store", f"SELECT id, {_shown('created_at')} FROM (SELECT * FROM store WHERE state = 'open' ORDER BY created_at DESC, id LIMIT 20)")
_add("w9_newest_first", "facts", f"SELECT id, state, {_shown('created_ts')} FROM (SELECT * FROM facts ORDER BY created_ts DESC, id LIMIT 20)")
_add(
    "w10_truncate", "snaps",
    """SELECT ingest_seq, repo_full_name FROM (
         SELECT *, row_number() OVER (PARTITION BY repo_full_name ORDER BY updated_ts NULLS FIRST, ingest_seq) AS rn FROM snaps)
       WHERE rn <= 100""",
)
_add(
    "w10_page_report", "snaps",
    "SELECT repo_full_name, least(count(*), 100) AS collected, ceil(count(*) / 100.0E0) >= 1 AS truncated FROM snaps GROUP BY 1",
)
_add("w11_preview", "facts", "SELECT id, state FROM facts ORDER BY id LIMIT 100")
_add(
    "w12_daily_filled", "facts",
    """SELECT strftime(day, '%Y-%m-%d') AS day, count(id) AS n
       FROM (SELECT unnest(generate_series((SELECT CAST(CAST(min(created_ts) AS DATE) AS TIMESTAMP) FROM facts),
                                           (SELECT CAST(CAST(max(created_ts) AS DATE) AS TIMESTAMP) FROM facts), INTERVAL 1 DAY)) AS day) c
       LEFT JOIN facts ON CAST(created_ts AS DATE) = CAST(c.day AS DATE)
       GROUP BY c.day""",
)

_add(
    "u1_union", "facts snaps",
    """SELECT repo_full_name, state, count(*) AS n, count(snap_no) AS with_snap, CAST(sum(id) AS BIGINT) AS id_sum
       FROM (SELECT id, repo_full_name, state, CAST(NULL AS INTEGER) AS snap_no FROM facts
             UNION ALL SELECT id, repo_full_name, CAST(NULL AS VARCHAR) AS state, snap_no FROM snaps)
       GROUP BY 1, 2""",
)
_add("u2_repo_sources", "repos", "SELECT full_name, CAST(min(seq % 2) AS INTEGER) AS best_source, count(*) AS n FROM repos GROUP BY 1")

_txt = f"trim(coalesce(title, '') || ' ' || coalesce(body, ''), {_WS})"
_add("f1_full_text", "facts", f"SELECT id, md5({_txt}) AS text, CAST(length({_txt}) AS INTEGER) AS n FROM facts")
_add(
    "f4_calendar", "facts",
    "SELECT id, CAST(isodow(created_ts) - 1 AS INTEGER) AS created_dow, CAST(hour(created_ts) AS INTEGER) AS created_hour, strftime(created_ts, '%Y-%m') AS month FROM facts",
)
_add(
    "f7_ttf_features", "facts",
    f"""SELECT id, round(h, 6) AS ttf_hours, {_ttf('h', '24.0E0')}
        FROM (SELECT id, CASE WHEN first_comment_ts >= created_ts THEN {_hours('created_ts', 'first_comment_ts')} END AS h FROM facts)""",
)
_add("f8_label_flags_substr", "facts", f"SELECT id, {_flags('labels_str')} FROM facts")
_add("f9_author_onehot", "facts", f"SELECT id, {_authors('NONE')}, {_authors('OTHER', 'serving_')} FROM facts")
_add(
    "f11_overlap", "facts",
    f"""SELECT id, CASE WHEN id % 10 = 3 THEN 'not a time' ELSE {_iso('created_ts - INTERVAL 900 SECOND')} END AS since,
               CASE WHEN id % 10 = 3 THEN 'not a time' ELSE {_iso('created_ts')} END AS same FROM facts""",
)
_add(
    "f12_path_repo", "names",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 2 THEN repo_full_name END AS repo,
              CASE WHEN c_custkey % 3 <> 2 THEN split_part(repo_full_name, '/', 1) END AS org FROM names""",
)
_add(
    "f13_sanitize", "",
    "SELECT p_partkey, regexp_replace(replace(p_brand || '/' || p_type || ' & ' || p_name, '/', '__'), '[^A-Za-z0-9_.-]+', '_', 'g') AS safe FROM part",
)
_add("f15_split_items", "", f"SELECT p_partkey, trim(p_type, {_WS}) || '|' || trim(p_name, {_WS}) || '|x' AS items FROM part")
_add(
    "f16_risk_band", "sc",
    "SELECT id, CASE WHEN id % 13 = 0 THEN NULL WHEN p < 0.26 THEN 'red' ELSE 'green' END AS band FROM sc",
)
_add(
    "f17_l2norm", "",
    f"""SELECT vec_id, round(embedding[1] / {_norm}, 6) AS first, round(embedding[-1] / {_norm}, 6) AS last, 1.0E0 AS norm FROM embeddings""",
)
_add(
    "f18_target_transform", "sc",
    "SELECT id, round(ln(1 + days), 6) AS log_days, round(greatest(least(exp(r) - 1, 30.0E0), 0.0E0), 6) AS pred_days FROM sc WHERE days IS NOT NULL",
)
_add("f19_weights", "sc", "SELECT id, round(1.0E0 / sqrt(1.0E0 + days), 6) AS w FROM sc WHERE days IS NOT NULL")
_add("f20_model_tag", "", "SELECT p_partkey, replace(p_name, ' ', '_') || '_é_1' AS tag FROM part")

_base8 = ("comments", "num_assignees", "labels_count", "title_len", "body_len", "has_body", "created_dow", "created_hour")
_add(
    "m1_tabular", "split rates rate_g",
    f"""SELECT row_id, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _base8)},
               {_ttf('ttf_hours', '(SELECT coalesce(median(ttf_hours), 0.0E0) FROM split WHERE split = ' + chr(39) + 'train' + chr(39) + ')')},
               0.0E0 AS body_missing, {_flags('labels_str')}, {_authors('NONE')}, {_prior1}
        FROM split LEFT JOIN rates USING (repo_full_name), rate_g""",
)
_add(
    "m1_tabular_stage2", "clean quick meds med_g",
    f"""SELECT row_id, 0.0E0 AS comments, CAST(num_assignees AS DOUBLE) AS num_assignees, CAST(labels_count AS DOUBLE) AS labels_count,
               0.0E0 AS title_len, 0.0E0 AS body_len, 0.0E0 AS has_body,
               CAST(created_dow AS DOUBLE) AS created_dow, CAST(created_hour AS DOUBLE) AS created_hour,
               {_ttf('CAST(NULL AS DOUBLE)', '(SELECT coalesce(median(ttf_hours), 0.0E0) FROM quick)')},
               0.0E0 AS body_missing, {_flags('labels_str')}, {_authors('NONE')}, {_prior2}
        FROM clean LEFT JOIN meds USING (repo_full_name), med_g""",
)
_add(
    "m5_fold_priors", "folded",
    """SELECT CAST(f AS INTEGER) AS for_fold, repo_full_name, count(*) AS cnt, round(avg(y), 6) AS posrate
       FROM folded, (SELECT unnest(range(5)) AS f) WHERE coalesce(fold, -1) < f GROUP BY 1, 2""",
)
_add(
    "m6_fold_medians", "quick_folded",
    """SELECT CAST(f AS INTEGER) AS for_fold, repo_full_name, count(*) AS cnt, round(median(days_to_close), 8) AS median_days
       FROM quick_folded, (SELECT unnest(range(5)) AS f) WHERE coalesce(fold, -1) < f GROUP BY 1, 2""",
)
_pr = "SELECT score, tp / CAST(tp + fp AS DOUBLE) AS precision, tp / CAST(n_pos AS DOUBLE) AS recall FROM curve"
_add(
    "m7_best_threshold", "curve",
    f"""SELECT round(score, 6) AS threshold, round(f1, 6) AS f1
        FROM (SELECT score, 2 * precision * recall / (precision + recall + 1e-12) AS f1 FROM ({_pr}))
        ORDER BY f1 DESC, score LIMIT 1""",
)
_add("m9_confusion", "clip", "SELECT y, CASE WHEN q >= 0.31 THEN 1 ELSE 0 END AS pred, count(*) AS n FROM clip GROUP BY 1, 2")
_add(
    "m9_threshold_metrics", "clip",
    """SELECT round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 6) AS recall,
              round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 6) AS f1
       FROM (SELECT count(*) FILTER (WHERE q >= 0.31 AND y = 1) AS tp, count(*) FILTER (WHERE q >= 0.31 AND y = 0) AS fp,
                    count(*) FILTER (WHERE q < 0.31 AND y = 1) AS fn FROM clip)""",
)
_losses = "round(avg(-(y * ln(q) + (1 - y) * ln(1 - q))), 6) AS logloss, round(avg((q - y) * (q - y)), 6) AS brier"
_add("m10_logloss_brier", "clip", f"SELECT {_losses} FROM clip")
_add(
    "m11_roc_auc", "curve",
    "SELECT round(sum(pos * (n_neg - fp + neg / 2.0E0)) / (CAST(max(n_pos) AS DOUBLE) * max(n_neg)), 6) AS roc_auc FROM curve",
)
_add(
    "m11_roc_points", "curve",
    """SELECT round(score, 6) AS score, round(fp / CAST(n_neg AS DOUBLE), 6) AS fpr, round(tp / CAST(n_pos AS DOUBLE), 6) AS tpr FROM curve
       UNION ALL SELECT 2.0E0, 0.0E0, 0.0E0""",
)
_add(
    "m12_avg_precision", "curve",
    "SELECT round(sum(pos / CAST(n_pos AS DOUBLE) * (tp / CAST(tp + fp AS DOUBLE))), 6) AS pr_auc FROM curve",
)
_add(
    "m12_pr_points", "curve",
    f"""SELECT round(score, 6) AS score, round(precision, 6) AS precision, round(recall, 6) AS recall FROM ({_pr})
        UNION ALL SELECT NULL, 1.0E0, 0.0E0""",
)


def _reg(source: str) -> str:
    return f"""SELECT round(avg(abs(y - pred)), 6) AS mae, round(sqrt(avg((y - pred) * (y - pred))), 6) AS rmse,
        round(1 - avg((y - pred) * (y - pred)) / var_pop(y), 6) AS r2, round(median(abs(y - pred)), 6) AS median_ae,
        round(1 - var_pop(y - pred) / var_pop(y), 6) AS explained_variance,
        round(avg(CASE WHEN abs(y - pred) <= 3 THEN 1.0E0 ELSE 0.0E0 END), 6) AS acc_within_3d,
        round(avg(CASE WHEN abs(y - pred) <= 7 THEN 1.0E0 ELSE 0.0E0 END), 6) AS acc_within_7d,
        round(avg(CASE WHEN abs(y - pred) <= 14 THEN 1.0E0 ELSE 0.0E0 END), 6) AS acc_within_14d
        FROM {source}"""


_add("m13_reg_metrics", "dayscore", _reg("dayscore"))
_add(
    "m14_baseline", "dayscore",
    """, placed AS (SELECT *, row_number() OVER (ORDER BY created_ts, id) - 1 AS pos, count(*) OVER () AS n FROM dayscore),
       test AS (SELECT y, (SELECT median(y) FROM placed WHERE pos < CAST(floor(n * 0.8E0) AS BIGINT)) AS pred FROM placed
                WHERE pos >= CAST(floor(n * 0.8E0) AS BIGINT) + CAST(floor(n * 0.1E0) AS BIGINT)) """ + _reg("test"),
)
_add(
    "m16_serving_features", "snaps train rates rate_g",
    f"""SELECT ingest_seq AS row_id, CAST(comments AS DOUBLE) AS comments, CAST(num_assignees AS DOUBLE) AS num_assignees,
               CAST({_nlab} AS DOUBLE) AS labels_count, CAST(coalesce(length(title), 0) AS DOUBLE) AS title_len,
               CAST(coalesce(length(body), 0) AS DOUBLE) AS body_len, CASE WHEN length(body) > 0 THEN 1.0E0 ELSE 0.0E0 END AS has_body,
               CAST(isodow(made_ts) - 1 AS DOUBLE) AS created_dow, CAST(hour(made_ts) AS DOUBLE) AS created_hour,
               {_ttf('h', '(SELECT coalesce(median(ttf_hours), 0.0E0) FROM train)')},
               CASE WHEN body IS NULL THEN 1.0E0 ELSE 0.0E0 END AS body_missing, {_flags('labels_str')}, {_authors('OTHER')}, {_prior1}
        FROM (SELECT *, CASE WHEN first_comment_ts >= made_ts THEN {_hours('made_ts', 'first_comment_ts')} END AS h
              FROM (SELECT *, CASE WHEN id % 23 <> 0 THEN created_ts ELSE {AS_OF} END AS made_ts FROM snaps WHERE state = 'open'))
        LEFT JOIN rates USING (repo_full_name), rate_g""",
)
_add(
    "m17_decision", "sc",
    "SELECT id, p >= 0.31 AS is_fast, round(greatest(0.0E0, exp(r) - 1) + greatest(0.0E0, 60 - p * 100), 6) AS est_days FROM sc",
)
_add(
    "m18_score_response", "sc",
    """SELECT id, p AS prob_resolved_30d, CASE WHEN p >= 0.31 THEN 1 ELSE 0 END AS predicted_label_resolved_30d,
              round(r, 6) AS predicted_days_to_close, 'encoder-a' AS embed_model, 0.31E0 AS threshold,
              'stage1-v2' AS classifier_version, 'stage2-v2' AS regressor_version FROM sc""",
)
_add(
    "m20_run_record", "clip",
    f""", placed AS (SELECT *, row_number() OVER (ORDER BY created_ts, id) - 1 AS pos, count(*) OVER () AS n FROM clip),
        parted AS (SELECT *, CASE WHEN pos < CAST(floor(n * 0.8E0) AS BIGINT) THEN 'train'
                                  WHEN pos < CAST(floor(n * 0.8E0) AS BIGINT) + CAST(floor(n * 0.1E0) AS BIGINT) THEN 'dev' ELSE 'test' END AS split FROM placed),
        m AS (SELECT split, {_losses} FROM parted WHERE split <> 'dev' GROUP BY split)
        SELECT 'r1' AS run_id, 'stage1' AS stage, * FROM (
          SELECT 'metric' AS kind, split || '_logloss' AS name, CAST(logloss AS VARCHAR) AS value FROM m
          UNION ALL SELECT 'metric', split || '_brier', CAST(brier AS VARCHAR) FROM m
          UNION ALL SELECT 'param', 'horizon', '30.0' UNION ALL SELECT 'param', 'folds', '5')""",
)

_add(
    "t2_stream_enrich", "good_msgs",
    f"""SELECT ingest_seq AS kafka_offset, id, {_shown('created_ts', 'created_at')}, state = 'closed' AS is_closed, 3 AS label_count,
               round({_hours('created_ts', 'closed_ts')}, 6) AS time_to_close_hours, round({_hours('created_ts', AS_OF)}, 6) AS age_hours
        FROM good_msgs""",
)
_add(
    "t4_stream_upsert", "good_msgs",
    f"""SELECT id, repo_full_name, state, {_shown('updated_ts', 'updated_at')} FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_ts DESC NULLS LAST, ingest_seq DESC) AS rn FROM good_msgs) WHERE rn = 1""",
)
_add("t6_stream_dedup", "good_msgs", "SELECT DISTINCT id, repo_full_name FROM good_msgs")
_add(
    "t7_cursor_step", "snaps cur names",
    f"""
        , failed AS (SELECT DISTINCT repo_full_name FROM names ORDER BY 1 LIMIT 2),
        ch AS (
          SELECT s.repo_full_name, updated_ts, row_number() OVER (PARTITION BY s.repo_full_name ORDER BY updated_ts, id, ingest_seq) AS rn
          FROM snaps s LEFT JOIN cur c ON s.repo_full_name = c.repo_full_name
          WHERE updated_ts >= strptime(coalesce(c.since, '{DEFAULT_SINCE}'), '%Y-%m-%dT%H:%M:%SZ')
            AND s.repo_full_name NOT IN (SELECT repo_full_name FROM failed)),
        nw AS (SELECT repo_full_name, {_iso('max(updated_ts) - INTERVAL 900 SECOND')} AS since FROM ch WHERE rn <= 100 GROUP BY 1),
        runs AS (SELECT repo_full_name, count(*) AS c FROM ch GROUP BY 1),
        every AS (SELECT repo_full_name FROM cur UNION SELECT repo_full_name FROM runs UNION SELECT repo_full_name FROM failed)
        SELECT repo_full_name, coalesce(nw.since, cur.since) AS since, '2000-06-15T12:00:00Z' AS last_run_at,
               least(coalesce(c, 0), 100) AS last_collected_count, coalesce(ceil(c / 100.0E0) >= 1, FALSE) AS last_truncated,
               CASE WHEN repo_full_name IN (SELECT repo_full_name FROM failed) THEN 'error: Timeout' ELSE 'ok' END AS last_status
        FROM every LEFT JOIN cur USING (repo_full_name) LEFT JOIN nw USING (repo_full_name) LEFT JOIN runs USING (repo_full_name)""",
)
SQL["t5_backfill_then_live"] = SQL["t4_stream_upsert"]
_add(
    "s1_jsonl_scan", "snaps",
    """SELECT repo_full_name, state, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum, count(*) AS places, CAST(sum(comments) AS BIGINT) AS comments
       FROM snaps GROUP BY 1, 2""",
)
_add(
    "s5_sample", "snaps",
    "SELECT id, repo_full_name, state FROM (SELECT * FROM snaps ORDER BY id // 400, id, snap_no LIMIT 1000)",
)
_add("k2_training_parquet", "clean", f"SELECT row_id, {_shown('created_ts')}, round(days_to_close, 8) AS days_to_close FROM clean")
_add(
    "u3_feature_concat", "",
    """SELECT CAST(vec_id AS VARCHAR) AS row_id, CAST(2 + len(embedding) AS INTEGER) AS n,
              round(sqrt(label * label + len(embedding) * len(embedding)
                + list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 4) AS norm
       FROM embeddings""",
)
_add("f20_run_stamp", "facts", "SELECT id, strftime(created_ts, '%Y%m%d_%H%M%S') AS stamp FROM facts")
_add(
    "w9_backfill_order", "facts",
    """SELECT id, repo_full_name FROM (
         SELECT *, row_number() OVER (PARTITION BY repo_full_name ORDER BY created_ts, id) AS rn FROM facts) WHERE rn <= 200""",
)
_add(
    "m2_text_features", "",
    "SELECT CAST(doc_id AS VARCHAR) AS row_id, 256 AS dim, TRUE AS unit FROM documents",
)
_add(
    "m5_oof", "folded",
    "SELECT row_id, y, CAST(fold AS INTEGER) AS fold, TRUE AS in_range FROM folded WHERE fold IS NOT NULL",
)
_add(
    "m15_score_open", "clean",
    "SELECT row_id, TRUE AS fast_follows_p, TRUE AS has_days, TRUE AS band_follows_p FROM clean WHERE is_closed = 0",
)
_add(
    "m8_isotonic", "sc",
    """
       , pts AS (SELECT p, sum(y) AS s, count(*) AS c, row_number() OVER (ORDER BY p) AS i FROM sc GROUP BY p),
       runs AS (SELECT i, p, sum(s) OVER w AS ss, sum(c) OVER w AS cc FROM pts WINDOW w AS (ORDER BY p)),
       means AS (SELECT a.i AS i, b.i AS k, (b.ss - a.ss + x.s) / CAST(b.cc - a.cc + x.c AS DOUBLE) AS mean
                 FROM runs a JOIN pts x ON x.i = a.i JOIN runs b ON b.i >= a.i),
       lows AS (SELECT i AS j, k, min(mean) OVER (PARTITION BY i ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS low FROM means),
       fit AS (SELECT k AS i, max(low) AS v FROM lows GROUP BY k)
       SELECT id, round(v, 6) AS p FROM sc JOIN pts USING (p) JOIN fit USING (i)""",
)
_add(
    "m3_stage1", "train folded",
    """SELECT 'scale_pos_weight' AS name, round(CAST(greatest(sum(1 - y), 1) AS DOUBLE) / greatest(sum(y), 1), 6) AS value FROM train
       UNION ALL SELECT 'ttf_fill', round(coalesce(median(ttf_hours), 0.0E0), 6) FROM train
       UNION ALL SELECT 'cv_oof_coverage', round(count(fold) / CAST(count(*) AS DOUBLE), 6) FROM folded
       UNION ALL SELECT 'n_features', 90.0E0 UNION ALL SELECT 'embedding_dim', 64.0E0 UNION ALL SELECT 'folds', 5.0E0
       UNION ALL SELECT 'shares', 13.0E0""",
)
_add(
    "m4_stage2", "clean quick",
    """
       , placed AS (SELECT *, row_number() OVER (ORDER BY created_ts, row_id) - 1 AS place, count(*) OVER () AS m FROM clean WHERE days_to_close <= 30),
       test AS (SELECT abs(days_to_close - (SELECT median(days_to_close) FROM quick)) AS e FROM placed
                WHERE place >= CAST(floor(m * 0.8E0) AS BIGINT) + CAST(floor(m * 0.1E0) AS BIGINT))
       SELECT 'baseline_test_mae' AS name, round(avg(e), 6) AS value FROM test
       UNION ALL SELECT 'baseline_test_rmse', round(sqrt(avg(e * e)), 6) FROM test
       UNION ALL SELECT 'baseline_test_median_ae', round(median(e), 6) FROM test
       UNION ALL SELECT 'ttf_fill', round(coalesce(median(ttf_hours), 0.0E0), 6) FROM quick
       UNION ALL SELECT 'n_features', 90.0E0 UNION ALL SELECT 'embedding_dim', 64.0E0
       UNION ALL SELECT 'shares', 3.0E0""",
)
_add(
    "s2_store_export", "facts",
    f"""SELECT id, repo_full_name, state, {_iso('created_ts')} AS created_at, {_shown('closed_ts', 'closed_at')},
               coalesce(label0, '~') || '|' || coalesce(label1, '~') || '|' || coalesce(label2, '~') AS labels,
               user_login, {_iso('created_ts')} AS since, comments FROM facts""",
)
_add("s10_source_selector", "facts", "SELECT repo_full_name, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum FROM facts GROUP BY 1")
_add(
    "p4_processed_at", "snaps",
    f"SELECT ingest_seq, strftime({AS_OF}, '%Y-%m-%d %H:%M:%S') AS processed_at, {AS_OF} >= created_ts AS after_creation FROM snaps",
)
_add(
    "p26_string_labels", "facts",
    """SELECT id, CASE WHEN id % 17 = 0 THEN '' ELSE concat_ws('|', label0, label1, third) END AS labels,
              CASE WHEN id % 17 = 0 THEN 0 ELSE (label0 IS NOT NULL)::INT + (label1 IS NOT NULL)::INT + (third IS NOT NULL)::INT END AS n
       FROM (SELECT *, CASE WHEN id % 6 <> 0 THEN label2 WHEN id % 2 = 1 THEN '' END AS third FROM facts)""",
)
_add(
    "k6_merged_output", "",
    """WITH told AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS state,
                       o_orderkey % 5000 <> 7 AND o_orderkey % 4 <> 1 AND o_orderkey % 20 = 0 AS bad FROM orders)
       SELECT state, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum, (SELECT count(*) FROM told WHERE NOT bad) AS reported,
              (SELECT count(*) FROM told WHERE bad) AS bad_lines FROM told WHERE NOT bad GROUP BY state""",
)
_LEAKS = ("updated_ts", "closed_ts", "first_comment_ts", "is_closed", "days_to_close", "resolved_30d")
_SAFE = (
    "number", "comments", "num_assignees", "created_ts", "labels_count", "title_len", "body_len", "has_body", "created_dow",
    "created_hour", "ttf_hours",
)
_add(
    "p24_leak_guard", "clean",
    " UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS n, {str(c in _SAFE).upper()} AS allowed FROM clean" for c in _SAFE + _LEAKS),
)
SQL["j6_unsent_by_set"] = SQL["j6_unsent_ids"]
SQL["t5_resumed_backfill"] = SQL["t4_stream_upsert"]
_add("t6_emit_new", "good_msgs", "SELECT DISTINCT id, repo_full_name FROM good_msgs WHERE id % 5 <> 0")
