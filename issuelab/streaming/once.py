"""Emit-once with managed state: ids that were sent, kept per bucket of ids, with expiry and a start from the store.

The state of a bucket is a map of ids in the state store, on disk; only the ids of a micro-batch are looked up.
``known`` (ids sent before, from the issue store or another log) fills the state when a query starts on a
fresh checkpoint, so a lost or new checkpoint sends nothing again. With ``keep`` an id is forgotten that long after
it was last seen, which bounds the state by the ids of that time; without, it is kept for good.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from issuelab.session import use_disk_state

# The processor travels to the tasks whole, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 10
_BUCKET = "_once_bucket"


class SeenIds(StatefulProcessor):
    def __init__(self, id_type: T.DataType, keep_ms: int | None):
        self.id_schema = T.StructType([T.StructField("id", id_type)])
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        mark = T.StructType([T.StructField("seen", T.BooleanType())])
        self.seen = handle.getMapState("seen", self.id_schema, mark, self.keep_ms)

    def _is_new(self, key: Any) -> bool:
        """Whether the id is not known; it is from now on, for another ``keep``."""
        known = self.seen.containsKey((key,))
        if not known or self.keep_ms is not None:
            self.seen.updateValue((key,), (True,))
        return not known

    def handleInputRows(self, key: Any, rows: Iterator, timerValues: Any) -> Iterator:
        for part in rows:
            ids = part["id"].tolist()
            # A null id cannot be told from another: such rows are not sent.
            part = part[[i == i and i is not None and self._is_new(i) for i in ids]]
            if len(part):
                yield part

    def handleInitialState(self, key: Any, initialState: Any, timerValues: Any) -> None:
        for i in initialState["id"].tolist():
            self.seen.updateValue((i,), (True,))

    def close(self) -> None:
        pass


def emit_new(stream: DataFrame, known: DataFrame | None = None, keep_ms: int | None = None) -> DataFrame:
    """First row of each id that ``known`` (column ``id``, or none) does not hold, over the whole run of a stream.

    Rows of one micro-batch with the same id: the first that arrives. Maps of ids need the RocksDB state store,
    which is set for the session here: a session built elsewhere has another.
    """
    use_disk_state(stream.sparkSession)
    id_type = stream.schema["id"].dataType
    bucket = F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).alias(_BUCKET)
    rows = stream.where("id is not null").select("*", bucket)
    start = None
    if known is not None:
        start = known.where("id is not null").select(F.col("id").cast(id_type).alias("id"), bucket).distinct().groupBy(_BUCKET)
    return rows.groupBy(_BUCKET).transformWithStateInPandas(
        statefulProcessor=SeenIds(id_type, keep_ms),
        outputStructType=stream.schema,
        outputMode="Append",
        timeMode="None" if keep_ms is None else "ProcessingTime",
        initialState=start,
    )
