"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words, as every operator here counts them: runs without ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Bytes of texts handed to a Python worker at a time.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Hand rows to Python by bytes, not by number: texts differ in length by orders of magnitude."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def kept_in_worker(kind: str, call: str, make: Callable[[], object]) -> object:
    """``make()``, kept by the Python worker for further tasks of the same call, one of a kind at a time.

    For loaded files and memories of bounded size; results must not depend on what is kept.
    """
    state = sys.modules.setdefault("_issuelab_worker_state", types.ModuleType("_issuelab_worker_state"))
    known = state.__dict__.setdefault("kept", {})
    if known.get(kind, (None,))[0] != call:
        known.pop(kind, None)
        release_memory()
        known[kind] = (call, make())
    return known[kind][1]


def release_memory() -> None:
    """Give back to the system what earlier tasks of this Python worker have freed: workers live on from job to job."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for a text without words."""
    return F.filter(F.split(text, SPACE_CLASS), lambda w: w != "")


def spare_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, also where lambdas inside ``use`` read it per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
