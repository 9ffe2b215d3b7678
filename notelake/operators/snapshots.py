"""K1, K2, S10 on versions: a note table whose state is a manifest.

``<path>/data/run-<id>/<month column>=<month>/``   the files of one run
``<path>/manifest/<version>.json``                 the folders of each month, and the runs so far

A run writes its files first and then its manifest, by a rename that fails if the version is there:
readers see the old version or the new one. A run that dies before the rename has changed nothing,
and a run whose id a manifest holds is not applied again. Only months that a run touches get new
folders; the files of the others stay as they are. Readers choose their folders by month, so a
cutoff or lookback (P2, P3) on months reads no other files.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class NoteTable:
    """Notes by month; ``key`` names the column that identifies a note."""

    def __init__(self, spark: SparkSession, path: str, month: str = "email_month", key: str = "path"):
        self.spark, self.path, self.month, self.key = spark, path.rstrip("/"), month, key
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _list(self, name: str) -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def manifest(self) -> dict:
        """``version, months`` (month to folders) and ``runs`` of the last version."""
        versions = [n for n in self._list("manifest") if n.endswith(".json") and not n.startswith(".")]
        if not versions:
            return {"version": 0, "months": {}, "runs": []}
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/manifest/{versions[-1]}").first()[0]
        return json.loads(text)

    def _switch(self, manifest: dict) -> None:
        name = f"manifest/{manifest['version']:012d}.json"
        draft = self._at(f"manifest/.draft-{manifest['runs'][-1]}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self._fs.exists(self._at(name)) or not self._fs.rename(draft, self._at(name)):
            raise RuntimeError(f"version {manifest['version']} was written by another run")

    def read(self, since: str | None = None, months: list[str] | None = None) -> DataFrame | None:
        """The notes of all months, of those from ``since`` on, or of some; None if there are none."""
        held = self.manifest()["months"]
        some = [f for m, fs in sorted(held.items()) if (since is None or m >= since) and (months is None or m in months)
                for f in fs]
        parts = [self.spark.read.parquet(f"{self.path}/data/{f}").withColumn(self.month, F.lit(f.rsplit("=", 1)[1])) for f in some]
        out = None
        for p in parts:
            out = p if out is None else out.unionByName(p)
        return out

    def _write(self, notes: DataFrame, run: str, folders: Callable[[list[str], str], list[str]]) -> None:
        now = self.manifest()
        if run in now["runs"]:
            return
        notes.write.mode("overwrite").partitionBy(self.month).parquet(f"{self.path}/data/run-{run}")
        months = dict(now["months"])
        for d in self._list(f"data/run-{run}"):
            if d.startswith(f"{self.month}="):
                m = d.split("=", 1)[1]
                months[m] = folders(months.get(m, []), f"run-{run}/{d}")
        self._switch({"version": now["version"] + 1, "months": months, "runs": [*now["runs"], run]})

    def append(self, notes: DataFrame, run: str) -> None:
        """K1: add notes (with the month column)."""
        self._write(notes, run, lambda had, new: [*had, new])

    def update(self, changed: DataFrame, run: str) -> None:
        """K2: put changed notes (all columns) in the place of those of the same key: only the months
        that hold one are written again."""
        now = self.manifest()
        if run in now["runs"]:
            return
        touched = [r[0] for r in changed.select(self.month).distinct().collect()]      # months: as many as the table has
        kept = self.read(months=touched)
        rows = changed if kept is None else kept.join(changed.select(self.key), self.key, "left_anti").unionByName(changed)
        self._write(rows, run, lambda had, new: [new])

    def vacuum(self) -> None:
        """Delete the folders that the last version does not hold."""
        held = {f for fs in self.manifest()["months"].values() for f in fs}
        for run in self._list("data"):
            for d in self._list(f"data/{run}"):
                if d.startswith(f"{self.month}=") and f"{run}/{d}" not in held:
                    self._fs.delete(self._at(f"data/{run}/{d}"), True)
