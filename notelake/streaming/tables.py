"""Tables that streams write: a base and the deltas since, in one folder.

``<path>/base-<version>``                      all rows up to the version
``<path>/delta-<version>-<writer>-<batch>``    the rows of one micro-batch

A micro-batch writes one delta. Versions count up over all writers, so a second checkpoint on the
same table goes on where the first one ended; a batch that is retried finds its own folder by
writer and batch number and replaces it under the version it had. A folder counts once its
write is complete (Spark's ``_SUCCESS``). After ``max_deltas`` deltas they are merged into a new base,
so reading costs the rows of the base and of a bounded number of batches. Folders of older versions
are left for readers that still hold them, and ``vacuum`` deletes them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDER = re.compile(r"(base|delta)-(\d{12})(?:-([0-9a-f]{8})-(\d{9}))?$")


class StreamTable:
    """``keys``: a row replaces the earlier ones of its key (the last version stands; of one version,
    and before the version if ``newest`` is given, the row with the largest of those columns). Without
    keys rows are only added. ``gone`` names a boolean column that withdraws a key."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), newest: Sequence[str] = (), gone: str | None = None,
                 max_deltas: int = 8):
        self.spark, self.path, self.keys, self.newest, self.gone, self.max_deltas = spark, path.rstrip("/"), list(keys), list(newest), gone, max_deltas
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._hadoop.getFileSystem(spark._jsc.hadoopConfiguration())

    def folders(self, complete: bool = True) -> list[tuple[str, int, str | None, str]]:
        """(kind, version, writer and batch, name) of the folders there are."""
        if not self._fs.exists(self._hadoop):
            return []
        found = []
        for status in self._fs.listStatus(self._hadoop):
            m = _FOLDER.match(status.getPath().getName())
            if m and (not complete or self._fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))):
                found.append((m[1], int(m[2]), f"{m[3]}-{m[4]}" if m[3] else None, m[0]))
        return sorted(found, key=lambda f: (f[1], f[0] == "delta"))

    def live(self) -> list[tuple[str, int, str | None, str]]:
        """The last base and the deltas after it."""
        all_ = self.folders()
        base = max((f[1] for f in all_ if f[0] == "base"), default=-1)
        return [f for f in all_ if (f[1] == base and f[0] == "base") or (f[1] > base and f[0] == "delta")]

    @staticmethod
    def writer(ckpt: str, batch_id: int) -> str:
        return f"{hashlib.md5(ckpt.encode()).hexdigest()[:8]}-{batch_id:09d}"

    def rows_of(self, folders: Sequence[tuple[str, int, str | None, str]]) -> DataFrame | None:
        parts = [self.spark.read.parquet(f"{self.path}/{f[3]}") for f in folders]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None

    def _newest(self, rows: DataFrame) -> DataFrame:
        if not self.keys:
            return rows
        values = [c for c in rows.columns if c not in self.keys]
        rank = F.struct(*self.newest, "_version", *[c for c in values if c not in (*self.newest, "_version")])
        return rows.groupBy(*self.keys).agg(F.max(rank).alias("_r")).select(*self.keys, *[F.col("_r")[c].alias(c) for c in values])

    def read(self, without: str | None = None) -> DataFrame | None:
        """The rows that stand, or None; ``without`` leaves out the delta of one writer and batch (a
        retry reads the state before itself)."""
        rows = self.rows_of([f for f in self.live() if f[2] is None or f[2] != without])
        if rows is None:
            return None
        rows = self._newest(rows)
        return (rows.filter(~F.col(self.gone)).drop(self.gone) if self.gone else rows).drop("_version")

    def write(self, rows: DataFrame, ckpt: str, batch_id: int) -> None:
        """The delta of a micro-batch."""
        me = self.writer(ckpt, batch_id)
        there = self.folders(complete=False)
        own = [f for f in there if f[2] == me]
        version = own[0][1] if own else max((f[1] for f in there), default=0) + 1
        rows.withColumn("_version", F.lit(version).cast("long")).write.mode("overwrite").parquet(f"{self.path}/delta-{version:012d}-{me}")

    def merge(self) -> None:
        """A new base if there are many deltas."""
        live = self.live()
        deltas = [f for f in live if f[0] == "delta"]
        if len(deltas) > self.max_deltas:
            last = deltas[-1][1]
            self._newest(self.rows_of(live)).write.mode("overwrite").parquet(f"{self.path}/base-{last:012d}")

    def vacuum(self) -> None:
        """Delete the folders that the last base replaces."""
        live = {f[3] for f in self.live()}
        base = max((f[1] for f in self.folders() if f[0] == "base"), default=-1)
        for kind, version, _, name in self.folders():
            if name not in live and version <= base:
                self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.path, name), True)

