"""String rules as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the source data's text rules treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind (SQL ``trim`` removes spaces only)."""
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(WHITESPACE))


def full_text(title: Column | str = "title", body: Column | str = "body") -> Column:
    """Title and body in one stripped string; nulls count as empty."""
    return strip(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))))


def clean_markup(c: Column | str) -> Column:
    """Drop ``<...>`` tags, turn newlines into blanks, strip; null becomes empty."""
    bare = F.regexp_replace(c, "<[^>]+>", "")
    return F.coalesce(strip(F.translate(bare, "\n", " ")), F.lit(""))


def split_items(c: Column | str) -> Column:
    """Comma list to an array of stripped items."""
    return F.transform(F.split(c, ","), strip)


def file_safe_repo(c: Column | str) -> Column:
    """``owner/name`` to a file-name part: ``owner__name``, other odd characters to ``_``."""
    return F.regexp_replace(F.replace(c, F.lit("/"), F.lit("__")), "[^A-Za-z0-9_.-]+", "_")


def model_tag(c: Column | str) -> Column:
    """Last path segment of a model name with anything but letters, digits, ``-_.`` as ``_``."""
    last = F.element_at(F.split(c, "/"), -1)
    return F.regexp_replace(last, r"(?U)[^\p{Alnum}\-_.]", "_")


def repo_from_path(path: Column | str) -> Column:
    """Repository named by a dump's path, or null.

    ``.../issues/<org>/<repo>.jsonl`` first, then ``issues_<owner>__<repo>_<8 digits>_<6 digits>.jsonl``,
    then the folders that this library writes, ``repo_key=<owner>__<repo>/run_ts=.../``.
    """
    parts = F.split(path, "/")
    at = F.array_position(parts, "issues").cast("int")  # 1-based, 0 when absent
    org, file = F.get(parts, at), F.get(parts, at + 1)
    nested = F.when(
        (at > 0) & F.endswith(file, F.lit(".jsonl")) & ~F.startswith(file, F.lit("issues_")),
        F.concat(org, F.lit("/"), F.regexp_replace(file, r"\.jsonl$", "")),
    )
    # Fixed value: the pattern of dump file names.
    named = r"(?:^|/)issues_([A-Za-z0-9_.-]+)__([A-Za-z0-9_.-]+)_\d{8}_\d{6}\.jsonl$"
    flat = F.when(
        F.regexp_like(path, F.lit(named)),
        F.concat(F.regexp_extract(path, named, 1), F.lit("/"), F.regexp_extract(path, named, 2)),
    )
    folder = r"/repo_key=([A-Za-z0-9_.-]+)__([A-Za-z0-9_.-]+)/run_ts="
    ours = F.when(
        F.regexp_like(path, F.lit(folder)),
        F.concat(F.regexp_extract(path, folder, 1), F.lit("/"), F.regexp_extract(path, folder, 2)),
    )
    return F.coalesce(nested, flat, ours)


def org_of(repo: Column | str) -> Column:
    """Part before the first ``/``; null without one."""
    c = F.col(repo) if isinstance(repo, str) else repo
    return F.when(F.contains(c, F.lit("/")), F.substring_index(c, "/", 1))
