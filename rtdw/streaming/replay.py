"""A bounded table replayed as a stream: its parts arrive one after the other.

``Replay.stream`` is an ordinary file stream; ``run`` starts the query, puts the parts into
the stream's folder one at a time (written aside by as many tasks as Spark likes and
renamed into place, so a part arrives whole) and waits until each is processed: every
part is one micro-batch. Tests and the catalogue use it to stand in for a topic.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..session import settings, state_dir
from ..sinks.keyed import CODEC, _fs, list_names, remove

PART = "_arrival"
#: an execution's shuffle files go with it; else those of all batches stay until the driver collects garbage
SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


class Replay:
    """``parts``: the batches in order of arrival, all of one schema. ``dealt``: a table and the
    number of the part of each of its rows (a column), whose parts stand first in ``parts``; they
    are written in one pass over the table. A part may come again later: ``again`` names, by
    its number, the part of which it is a copy. ``drop``: a part's files go once it is processed and
    does not come again, as a topic's would."""

    def __init__(self, parts: Sequence[DataFrame], name: str, dealt: tuple[DataFrame, Column] | None = None,
                 again: dict[int, int] | None = None, drop: bool = False):
        self.parts, self.spark = list(parts), parts[0].sparkSession
        self.dealt, self.again, self.drop = dealt, again or {}, drop
        self.path = state_dir(self.spark, f"{name}-input-{uuid.uuid4().hex[:8]}")
        fs, p = _fs(self.spark, f"{self.path}/in")
        fs.mkdirs(p)
        self.schema = self.parts[0].schema
        self.stream = self.spark.readStream.schema(self.schema).parquet(f"{self.path}/in/part-*")

    def _deal(self) -> set[int]:
        """Write the dealt table, a folder a part; the parts that have rows. Every task keeps a
        file open for each part: no sort of the rows by part."""
        if self.dealt is None:
            return set()
        rows, part = self.dealt
        open_files = {"spark.sql.maxConcurrentOutputFileWriters": str(len(self.parts) + 1),
                      "spark.sql.optimizer.plannedWrite.enabled": "false"}
        with settings(self.spark, open_files):
            rows.select(*self.schema.fieldNames(), part.alias(PART)).write.partitionBy(PART) \
                .option("compression", CODEC).parquet(f"{self.path}/dealt")
        return {int(n.split("=")[1]) for n in list_names(self.spark, f"{self.path}/dealt") if n.startswith(PART)}

    def _feed(self, k: int, part: DataFrame, dealt: bool = False) -> None:
        aside = f"{self.path}/dealt/{PART}={k}" if dealt else f"{self.path}/aside/part-{k}"
        if k in self.again:
            part = self.spark.read.schema(self.schema).parquet(f"{self.path}/in/part-{self.again[k]}")
        if not dealt:
            part.select(*self.schema.fieldNames()).write.mode("overwrite").option("compression", CODEC).parquet(aside)
        fs, source = _fs(self.spark, aside)
        fs.rename(source, _fs(self.spark, f"{self.path}/in/part-{k}")[1])

    def run(self, writer: DataStreamWriter) -> StreamingQuery:
        """Feed all parts to the query; returns it, stopped, for its progress."""
        with settings(self.spark, SHUFFLES):
            dealt = self._deal()
            q = writer.start()
            try:
                for k, part in enumerate(self.parts):
                    self._feed(k, part, k in dealt)
                    q.processAllAvailable()
                    if self.drop:
                        later = {of for n, of in self.again.items() if n > k}
                        for n in {k, self.again.get(k, k)} - later:
                            # the folder stays: the query may be listing it just now
                            for name in list_names(self.spark, f"{self.path}/in/part-{n}"):
                                remove(self.spark, f"{self.path}/in/part-{n}/{name}")
            finally:
                q.stop()
        return q


def in_time_order(df: DataFrame, name: str, time_col: str, closing: DataFrame | None = None,
                  parts: int = 3, drop: bool = False) -> Replay:
    """``df`` cut at quantiles of its time; rows without a time come first. ``closing``: records of
    the far future, the last part, which move the watermark past every window. ``drop``: as in ``Replay``."""
    at = F.unix_micros(F.col(time_col).cast("timestamp"))
    with settings(df.sparkSession, SHUFFLES):
        cuts = df.select(F.percentile_approx(at.cast("double"), [k / parts for k in range(1, parts)], 100)).first()[0] or []
    edges = [float("-inf"), *cuts, float("inf")]
    time = F.coalesce(at.cast("double"), F.lit(float("-inf")))
    ranges = [df.where((time >= low) & (time < high)) for low, high in zip(edges, edges[1:])]
    number = sum((F.when(time >= cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    return Replay(ranges + ([closing.select(*df.columns)] if closing is not None else []), name, (df, number), drop=drop)


def late_rows(query: StreamingQuery) -> int:
    """WM3: rows that the query's operators dropped behind the watermark, from its
    progress (which Spark keeps for the last batches, 100 by default)."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress
               for s in (p["stateOperators"] if isinstance(p, dict) else [x.jsonValue() if hasattr(x, "jsonValue") else
                         {"numRowsDroppedByWatermark": x.numRowsDroppedByWatermark} for x in p.stateOperators]))
