"""Rows to drop that several sources share, found while manifest lines arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from fissure.operators import dedup

LINES = "signature string, dataset string, row long, cwe string, language string, code_before_hash string, code_after_hash string, commit_url string"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FIELDS = ["k0", "k1", "dataset", "row"]


class Representatives(StatefulProcessor):
    """Of each key the best row so far, and while it has rows of one source alone, those rows.

    When a second source arrives, the rows that waited are dropped, all but the best; from then on whatever is not better than the best goes at once, and a better row sends the old best after it. So each row is dropped once at most, and what all
    batches have dropped is what one batch would have. The rows that wait are in the state store, which is read a page at a time.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "k0 int, k1 long, dataset string, row long, several boolean")
        self.waiting = handle.getListState("waiting", "dataset string, row long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        *best, several = self.best.get() if self.best.exists() else (None, False)
        best = tuple(best) if best != [None] else None
        for frame in rows:
            found = [(int(a), int(b), c, int(d)) for a, b, c, d in frame[FIELDS].itertuples(index=False)]
            first = min(found if best is None else [best, *found])
            now = several or len({x[2] for x in found} | ({best[2]} if best else set())) > 1
            if not now:
                self.waiting.appendList([x[2:] for x in found])
            else:
                out = [x[2:] for x in found if x != first]
                if several and best != first:
                    out.append(best[2:])
                if not several:
                    for x in self.waiting.get() if self.waiting.exists() else ():
                        if tuple(x) != first[2:]:
                            out.append(tuple(x))
                        if len(out) >= 10_000:
                            yield pd.DataFrame(out, columns=FIELDS[2:])
                            out = []
                    self.waiting.clear()
                if out:
                    yield pd.DataFrame(out, columns=FIELDS[2:])
            best, several = first, now
        if best is not None:
            self.best.update((*best, several))

    def close(self) -> None:
        pass


def drops(lines: DataFrame, mode: str = "compat", key: str = "signature") -> DataFrame:
    """(dataset, row) of the rows of a stream of manifest lines that ``dedup.drops`` would drop of all that have arrived. A line is to arrive once; a key's lines pass through one task."""
    lines = lines.filter(F.col(key) != "") if mode == "fixed" else lines.filter(F.col(key).isNotNull())
    ranked = lines.select(key, *[c.alias(name) for c, name in zip(dedup.rank_key(mode), FIELDS, strict=True)])
    ranked = ranked.withColumn("k0", F.col("k0").cast("int")).withColumn("k1", F.col("k1").cast("long"))
    return ranked.groupBy(key).transformWithStateInPandas(statefulProcessor=Representatives(), outputStructType="dataset string, row long", outputMode="Append", timeMode="None")


def run_available(spark: SparkSession, folder: str, out: str, checkpoint: str, mode: str = "compat") -> StreamingQuery:
    """Process the Parquet files of lines that are in ``folder`` and stop; the next call goes on where this one ended, with its state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    lines = spark.readStream.schema(LINES).parquet(folder)
    return drops(lines, mode).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
