"""Keyed upsert: a table holding the latest row per key.

Each micro-batch contributes its last row per key. ``UpsertLog`` appends them as a
version folder (a replay overwrites it) and readers take the newest per key.
``UpsertTable`` is for many batches: it keeps its rows by bucket of the key and merges
versions in levels. ``KeyValueUpsert`` sends rows to an external store instead.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from weir.operators.running import latest_per_key


class UpsertLog:
    def __init__(self, path: str, keys: list[str], seq: str):
        self.path, self.keys, self.seq = path, keys, seq

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, self.keys, self.seq).write.mode("overwrite").parquet(
            f"{self.path}/batch_id={batch_id}"
        )

    def read(self, spark: SparkSession) -> DataFrame:
        log = spark.read.parquet(self.path)
        values = [c for c in log.columns if c not in (*self.keys, "batch_id")]
        return log.groupBy(*self.keys).agg(
            *[F.max_by(c, "batch_id").alias(c) for c in values]
        )

    def compact(self, spark: SparkSession, target: str) -> "UpsertLog":
        """Write the current table as version 0 of a new log."""
        self.read(spark).write.mode("overwrite").parquet(f"{target}/batch_id=0")
        return UpsertLog(target, self.keys, self.seq)


class UpsertTable:
    """Runs of batches, ``run=<first>-<last>``, each with the latest row per key of its
    batches in ``bucket=<b>`` folders.

    A micro-batch is a run of its own. ``fanout`` neighbouring runs of one level (runs of
    as many batches) become one of the next, so there are at most ``fanout`` runs a level
    and a row is rewritten once a level: reading and merging do not grow with the number
    of batches but with its logarithm. A key has its rows in one bucket of each run;
    ``lookup`` reads the buckets of the keys it is asked for.

    A run counts once it is complete (its writer's mark is there), and the longest run
    from each batch on is the one that is read. So a merge that was cut off is as if it
    had not begun, and a batch that is replayed after it was merged changes nothing.
    Merged runs stay until ``vacuum``, for readers that began before.
    """

    RUN = re.compile(r"run=([0-9]+)-([0-9]+)$")

    def __init__(self, path: str, keys: list[str], seq: str, buckets: int = 64, fanout: int = 8):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.path, self.keys, self.seq = path.rstrip("/"), keys, seq
        self.buckets, self.fanout = buckets, fanout

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        covered = [r for r in self.runs(spark) if r[0] <= batch_id <= r[1] and r != (batch_id, batch_id)]
        if not covered:
            self._write(latest_per_key(batch, self.keys, self.seq), (batch_id, batch_id))
        self.merge(spark)

    def merge(self, spark: SparkSession) -> None:
        """Merge neighbours until no level is full."""
        while True:
            chosen = self._full(self.runs(spark))
            if not chosen:
                return
            rows = self._newest(self._rows(spark, chosen))
            self._write(rows, (chosen[0][0], chosen[-1][1]))

    def read(self, spark: SparkSession) -> DataFrame:
        return self._newest(self._rows(spark, self.runs(spark)))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows of the given keys. Few are expected: their buckets are found first."""
        spark = keys.sparkSession
        wanted = keys.select(*self.keys, self._bucket().alias("bucket")).distinct()
        buckets = [r[0] for r in wanted.select("bucket").distinct().collect()]  # at most ``buckets``
        rows = self._rows(spark, self.runs(spark)).where(F.col("bucket").isin(buckets))
        on = [rows[k].eqNullSafe(wanted[k]) for k in self.keys]
        return self._newest(rows.join(wanted.drop("bucket"), on, "left_semi"))

    def runs(self, spark: SparkSession) -> list[tuple[int, int]]:
        """Complete runs that are read: from each batch on, the longest."""
        longest: dict[int, int] = {}
        for first, last in self._complete(spark):
            longest[first] = max(last, longest.get(first, last))
        found: list[tuple[int, int]] = []
        for first in sorted(longest):
            if not found or first > found[-1][1]:
                found.append((first, longest[first]))
        return found

    def vacuum(self, spark: SparkSession) -> int:
        """Delete runs that others hold; the number deleted."""
        kept, n = set(self.runs(spark)), 0
        for run in self._complete(spark):
            if run not in kept:
                files, path = self._files(spark, self._folder(run))
                n += bool(files.delete(path, True))
        return n

    def _full(self, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The latest ``fanout`` neighbours of one level."""

        def level(run: tuple[int, int]) -> int:
            n, size = 0, run[1] - run[0] + 1
            while size >= self.fanout:
                n, size = n + 1, size // self.fanout
            return n

        for end in range(len(runs), self.fanout - 1, -1):
            part = runs[end - self.fanout : end]
            if len({level(r) for r in part}) == 1:
                return part
        return []

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, run: tuple[int, int]) -> None:
        bucketed = rows.drop("bucket").withColumn("bucket", self._bucket())
        bucketed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._folder(run))

    def _rows(self, spark: SparkSession, runs: list[tuple[int, int]]) -> DataFrame:
        if not runs:
            raise FileNotFoundError(f"no complete run in {self.path}")
        frames = [spark.read.parquet(self._folder(r)).withColumn("_run", F.lit(r[1])) for r in runs]
        first, *rest = frames
        for frame in rest:
            first = first.unionByName(frame, allowMissingColumns=True)
        return first

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in (*self.keys, "bucket", "_run")]
        newest = F.max_by(F.struct(*values), "_run").alias("_row")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "_row.*")

    def _folder(self, run: tuple[int, int]) -> str:
        return f"{self.path}/run={run[0]}-{run[1]}"

    def _files(self, spark: SparkSession, path: str):
        """The path in its own file system, whichever that is."""
        hadoop = spark._jvm.org.apache.hadoop.fs
        place = hadoop.Path(path)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()), place

    def _complete(self, spark: SparkSession) -> list[tuple[int, int]]:
        files, place = self._files(spark, self.path)
        if not files.exists(place):
            return []
        found = []
        for status in files.listStatus(place):
            match = self.RUN.search(status.getPath().getName())
            if match and files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found.append((int(match[1]), int(match[2])))
        return found


class KeyValueUpsert:
    """Calls ``put(rows)`` once per partition with the last row per key; ``put`` must
    set values (not add to them), so that repeating a batch changes nothing."""

    def __init__(self, keys: list[str], seq: str, put: Callable[[Iterable[Row]], None]):
        self.keys, self.seq, self.put = keys, seq, put

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, self.keys, self.seq).foreachPartition(self.put)
