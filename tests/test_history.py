"""Note versions by manifest, and probes of a bucketed history."""

import uuid

import pytest
from pyspark.sql import functions as F

from notelake.operators import history as H
from notelake.operators.snapshots import NoteTable


def notes(spark, *rows):
    return spark.createDataFrame(list(rows), "path string, content string, email_month string")


def state(table, **kw):
    df = table.read(**kw)
    return sorted(tuple(r) for r in df.select("path", "content", "email_month").collect()) if df is not None else []


def test_versions_switch_at_once_and_touch_only_their_months(spark, tmp_path):
    t = NoteTable(spark, f"file://{tmp_path}/notes")
    assert state(t) == [] and t.manifest()["version"] == 0
    t.append(notes(spark, ("a", "1", "2024-01"), ("b", "1", "2024-02"), ("c", "1", "2024-03")), "r1")
    t.append(notes(spark, ("d", "1", "2024-02")), "r2")
    before = t.manifest()["months"]
    t.update(notes(spark, ("b", "2", "2024-02"), ("e", "2", "2024-02")), "r3")
    assert state(t) == [("a", "1", "2024-01"), ("b", "2", "2024-02"), ("c", "1", "2024-03"), ("d", "1", "2024-02"), ("e", "2", "2024-02")]
    after = t.manifest()["months"]
    assert after["2024-01"] == before["2024-01"] and after["2024-03"] == before["2024-03"] and after["2024-02"] != before["2024-02"]
    assert state(t, since="2024-03") == [("c", "1", "2024-03")] and state(t, months=["2024-01"]) == [("a", "1", "2024-01")]
    t.append(notes(spark, ("x", "again", "2024-01")), "r1")              # a run that is done is not applied again
    assert t.manifest()["version"] == 3 and len(state(t)) == 5
    t.vacuum()
    assert len(state(t)) == 5


def test_a_run_that_dies_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    t = NoteTable(spark, f"file://{tmp_path}/notes")
    t.append(notes(spark, ("a", "1", "2024-01")), "r1")
    with monkeypatch.context() as m:
        m.setattr(NoteTable, "_switch", lambda self, manifest: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            t.update(notes(spark, ("a", "2", "2024-01")), "r2")
    assert state(t) == [("a", "1", "2024-01")] and t.manifest()["version"] == 1
    t.update(notes(spark, ("a", "2", "2024-01")), "r2")                  # the run is repeated
    assert state(t) == [("a", "2", "2024-01")]
    stale = {"version": 2, "months": {}, "runs": ["r9"]}
    with pytest.raises(RuntimeError, match="another run"):
        t._switch(stale)


def test_history_is_not_shuffled(spark, tmp_path):
    name = f"history_{uuid.uuid4().hex[:8]}"
    key = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("message_id"))
    H.save_history(key(0, 3000), name, ["message_id"], 8, f"file://{tmp_path}/h")
    H.save_history(key(2000, 4000), name, ["message_id"], 8, f"file://{tmp_path}/h")
    new = key(3500, 4600).unionByName(spark.createDataFrame([(None,)], "message_id string"))
    try:
        flagged = H.known(new, name, ["message_id"])
        assert flagged.groupBy("known").count().orderBy("known").collect() == [(False, 601), (True, 500)]
        assert H.unknown(new, name, ["message_id"]).count() == 601
        for df in (flagged, H.unknown(new, name, ["message_id"])):
            plan = df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
            executed = df._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan
            history_side = [x for x in executed.split("Sort") if name in x or "Bucketed: true" in x]
            assert history_side and not any("Exchange" in x for x in history_side)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_only_files_with_a_namesake_of_their_length_are_opened(spark, tmp_path):
    from notelake.operators import files as FL
    content = {"old/a.txt": "same", "new/a.txt": "same", "old/b [1].txt": "left!", "new/b [1].txt": "right", "old/c.txt": "x" * 500, "new/c.txt": "y" * 501,
               "old/d.txt": "alone" * 200, "old/big.txt": "z" * 900, "new/big.txt": "z" * 900, "other/a.txt": "same"}
    for name, text in content.items():
        p = tmp_path / "root" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    root = f"file://{tmp_path}/root"
    pairs = spark.createDataFrame([("old", "new")], "old string, new string")
    was = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")       # opening a longer file is an error
    try:
        files = FL.file_inventory(spark, root, with_hash=False)
        got = FL.with_needed_hashes(spark, root, files, pairs, at_once=3).collect()
        assert sorted(f"{r.folder}/{r.rel_path}" for r in got if r.sha256) == ["new/a.txt", "new/b [1].txt", "old/a.txt", "old/b [1].txt"]
        assert len(got) == len(content)
        plan = {r.rel_path: (r.outcome, r.dst) for r in FL.plan_merge(spark.createDataFrame(got, files.schema.add("sha256", "string")), pairs).collect()}
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", was)
    assert plan == {"a.txt": ("duplicate_removed", None), "b [1].txt": ("moved", "new/b [1]_1.txt"), "c.txt": ("moved", "new/c_1.txt"),
                    "d.txt": ("moved", "new/d.txt"), "big.txt": ("moved", "new/big_1.txt")}
