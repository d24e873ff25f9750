"""Runs of one kind on a stream: the rows of ``turns.islands``, kept up to date.

Rows of a key wait in state until the watermark has passed them; then they join, in order, the
key's open run. Whatever comes in, the runs it can touch are told again, those of waiting rows
as they stand now, so at any time the latest row of each (key, run) is the result over all
rows so far. A late row before the watermark only makes runs more, never fewer, so no told
run is left over. A timer folds the waiting rows of a key that has fallen silent. Rows later
than the watermark are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from quorumtext.runtime import ship_package

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "key string, island long, kind string, start timestamp, n long"


class Runs(StatefulProcessor):
    """Input: key string, at timestamp, number long (the order of equal times), kind string."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "island long, kind string, start long, n long")
        self.waiting = handle.getListState("waiting", "at long, number long, kind string")

    def _fold(self, run: tuple | None, rows: list[tuple]) -> list[tuple]:
        """All runs from ``run`` (island, kind, start, n) on, after the rows (at, number, kind)."""
        runs = [run] if run else []
        for at, _, kind in rows:
            if runs and runs[-1][1] == kind:
                runs[-1] = (*runs[-1][:3], runs[-1][3] + 1)
            else:
                runs.append((runs[-1][0] + 1 if runs else 1, kind, at, 1))
        return runs

    def _settle(self, key: str, rows: list[tuple], watermark: int) -> Iterator[pd.DataFrame]:
        run = tuple(self.open.get()) if self.open.exists() else None
        rows = sorted(rows, key=lambda r: r[:2])
        done = [r for r in rows if r[0] // 1000 <= watermark]
        told = self._fold(run, rows)
        settled = self._fold(run, done)
        if settled:
            self.open.update(settled[-1])
        rest = rows[len(done) :]
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(rest[-1][0] // 1000 + 1)
        else:
            self.waiting.clear()
        yield pd.DataFrame({"key": key, "island": [r[0] for r in told], "kind": [r[1] for r in told], "start": pd.to_datetime([r[2] for r in told], unit="us"), "n": [r[3] for r in told]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for b in rows:
            at = b["at"].astype("datetime64[us]").astype("int64")
            new += zip(at.tolist(), b["number"].tolist(), [None if pd.isna(k) else k for k in b["kind"]], strict=True)
        waiting = [tuple(r) for r in self.waiting.get()]
        yield from self._settle(key[0], waiting + new, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(key[0], [tuple(r) for r in self.waiting.get()], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def island_updates(rows: DataFrame, key: str, at: str, number: str, kind: str, late: str = "10 minutes") -> DataFrame:
    """(key, island, kind, start, n) of a stream, each told anew as it changes; the session's state store must be RocksDB."""
    ship_package(rows.sparkSession)
    timed = rows.select(F.col(key).cast("string").alias("key"), F.col(at).cast("timestamp").alias("at"), F.col(number).cast("long").alias("number"), F.col(kind).alias("kind")).where("key IS NOT NULL AND at IS NOT NULL")
    return timed.withWatermark("at", late).groupBy("key").transformWithStateInPandas(statefulProcessor=Runs(), outputStructType=OUT, outputMode="Update", timeMode="EventTime")


def follow(rows: DataFrame, key: str, at: str, number: str, kind: str, to: str, state: str, late: str = "10 minutes") -> StreamingQuery:
    """Keep the runs of a stream at ``to``; what has come is taken, then the query ends. ``state`` is its checkpoint.

    Each batch is a folder, replaced whole if the batch is run again; ``current`` reads the latest row of each run.
    """

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{to}/batch={n}")

    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return island_updates(rows, key, at, number, kind, late).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()


def current(spark: SparkSession, to: str) -> DataFrame:
    """(key, island, kind, start, n) as of the last batch."""
    w = Window.partitionBy("key", "island").orderBy(F.desc("batch"), F.desc("n"))
    told = spark.read.parquet(to).withColumn("_k", F.row_number().over(w))
    return told.where("_k = 1").drop("_k", "batch")
