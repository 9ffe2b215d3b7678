"""Listings of many folders: whole, and with a bounded number of tasks."""

import hashlib

from notelake.operators import files as FL
from notelake.sources import vault as V


def _tasks(spark, group: str, run) -> list[int]:
    """Tasks of the stages that ``run`` starts."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return [i.numTasks for s in stages if (i := tracker.getStageInfo(s))]


def test_listing_tasks_do_not_follow_the_folders(spark, tmp_path):
    room = 4 * spark.sparkContext.defaultParallelism
    for i in range(2 * room + 40):
        d = tmp_path / f"top {i % 2}" / f"f{i:04d}"
        d.mkdir(parents=True)
        (d / "n.md").write_text(f"text {i}")
    conf = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, got = spark.conf.get(conf), {}
    root = f"file://{tmp_path}"
    assert 0 < max(_tasks(spark, "inventory", lambda: got.update(inventory=FL.file_inventory(spark, root)))) <= room
    assert 0 < max(_tasks(spark, "notes", lambda: got.update(notes=V.read_files(spark, root)))) <= room
    assert spark.conf.get(conf) == before
    want = {(f"top {i % 2}", f"f{i:04d}/n.md", hashlib.sha256(f"text {i}".encode()).hexdigest()) for i in range(2 * room + 40)}
    assert {(r.folder, r.rel_path, r.sha256) for r in got["inventory"].collect()} == want
    assert {r.path for r in got["notes"].select("path").collect()} == {f"{a}/{b}" for a, b, _ in want}
