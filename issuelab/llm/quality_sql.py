"""DuckDB SQL for the quality rules, written from the same threshold table."""

from __future__ import annotations

from issuelab.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS, WINDOW


def _rules() -> str:
    checks = []
    for rule in RULES:
        value, base = f"{rule.measure} * {rule.scale}", rule.per or "1"
        if rule.low is not None:
            checks.append(f"{value} >= {rule.low} * {base}")
        if rule.high is not None:
            checks.append(f"{value} <= {rule.high} * {base}")
    return " AND ".join(checks)


def quality_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted({w for group in STOP_WORDS.values() for w in group}))
    window = " || ' ' || ".join(f"w[i + {k}]" for k in range(WINDOW))
    return f"""
    WITH base AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
        list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
          lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
      FROM documents
    ), starts AS (
      SELECT r, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM base WHERE len(w) >= {WINDOW}
    ), windows AS (
      SELECT r, i, {window} AS v FROM starts JOIN base USING (r)
    ), repeated AS (
      SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, v) AS c FROM windows) WHERE c > 1
    ), covered AS (
      SELECT r, sum(least({WINDOW}, coalesce(n - i, {WINDOW}))) AS n_repeat
      FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS n FROM repeated) GROUP BY r
    ), counts AS (
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l) AS BIGINT) AS n_lines,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        CAST(len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS BIGINT) AS n_stop_words,
        CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words
      FROM base LEFT JOIN covered USING (r)
    ), judged AS (
      SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
      FROM counts
    )
    SELECT *, NOT base_failed AND {_rules()} AS kept FROM judged
    """
