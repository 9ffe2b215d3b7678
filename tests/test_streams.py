"""Stream tables and the streaming jobs against the batch results: random splits, retries, replays."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

from notelake.operators import calendar as C
from notelake.streaming import jobs as S
from notelake.streaming.tables import StreamTable


def arrivals(spark, path, df, run, seed, parts=3):
    """Write ``df`` in random portions and run the job after each."""
    rows, rnd = df.collect(), random.Random(seed)
    rnd.shuffle(rows)
    for k in range(parts):
        spark.createDataFrame(rows[k::parts], df.schema).coalesce(1).write.mode("append").parquet(path)
        out = run(S.table_stream(spark, path, df.schema, max_files=1))
    return out


def test_versions_go_on_over_writers_and_merges(spark, tmp_path):
    t = StreamTable(spark, f"file://{tmp_path}/t", ["k"], max_deltas=2)
    rows = lambda *x: spark.createDataFrame(list(x), "k int, v int")
    assert t.read() is None
    t.write(rows((1, 1), (2, 1)), "one", 0)
    t.write(rows((1, 2)), "one", 1)
    t.write(rows((1, 0), (3, 1)), "two", 0)
    t.write(rows((1, 3)), "one", 1)                   # a retry replaces itself under its own version
    got = lambda: sorted(tuple(r) for r in t.read().select("k", "v").collect())
    assert got() == [(1, 0), (2, 1), (3, 1)] and [f[1] for f in t.live()] == [1, 2, 3]
    assert sorted(tuple(r) for r in t.read(without=t.writer("two", 0)).select("k", "v").collect()) == [(1, 3), (2, 1)]
    t.merge()
    assert [(f[0], f[1]) for f in t.live()] == [("base", 3)] and got() == [(1, 0), (2, 1), (3, 1)]
    t.write(rows((2, 9)), "one", 2)
    assert got() == [(1, 0), (2, 9), (3, 1)]
    t.vacuum()
    assert [(f[0], f[1]) for f in t.folders()] == [("base", 3), ("delta", 4)] and got() == [(1, 0), (2, 9), (3, 1)]


def test_first_row_of_a_key_is_defined_and_replays_add_nothing(spark, tmp_path):
    df = spark.createDataFrame([(i % 40 if i % 7 else None, f"v{i:03d}", i) for i in range(200)], "id long, v string, n int")
    path, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    run = lambda ckpt: lambda s: S.stream_notify(s, out, f"file://{tmp_path}/{ckpt}", ["id"], F.col("v"))
    df.coalesce(1).write.parquet(path)
    got = run("a")(S.table_stream(spark, path, df.schema))
    want = sorted((tuple(r) for r in df.groupBy("id").agg(F.min(F.struct("v", "n")).alias("m")).select("id", "m.*").collect()), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    df.withColumn("v", F.lit("000")).coalesce(1).write.mode("append").parquet(path)       # later rows of known keys
    for ckpt in ("a", "b"):
        assert sorted(map(tuple, run(ckpt)(S.table_stream(spark, path, df.schema, max_files=1)).collect()), key=repr) == want


def test_a_batch_reads_no_history_of_its_checkpoint(spark, tmp_path, monkeypatch):
    df = spark.range(60).select("id")
    path, out, read = f"file://{tmp_path}/in", f"file://{tmp_path}/out", []
    rows_of = StreamTable.rows_of
    monkeypatch.setattr(StreamTable, "rows_of", lambda self, folders: read.append(len(folders)) or rows_of(self, folders))
    monkeypatch.setattr(StreamTable, "read", lambda self, without=None: df)
    arrivals(spark, path, df, lambda s: S.stream_notify(s, out, f"file://{tmp_path}/ckpt", ["id"]), 1)
    assert read == [] and rows_of(StreamTable(spark, out), StreamTable(spark, out).live()).count() == 60


def test_keys_are_told_apart_without_python(spark, tmp_path, monkeypatch):
    """One Python call a key took a millisecond; the state store is probed natively."""
    monkeypatch.setattr(GroupedData, "applyInPandasWithState", lambda *a, **k: pytest.fail("Python for each key"))
    df = spark.createDataFrame([(i % 50 if i % 9 else None, ["x", None][i % 2], 0.5 * (99 - i)) for i in range(100)], "id long, v string, d double")
    path, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    got = arrivals(spark, path, df, lambda s: S.stream_notify(s, out, f"file://{tmp_path}/ckpt", ["id"], F.lit("same")), 3)
    firsts = {}
    for k in range(3):                                 # the batches of the arrivals: a key stays with the first that has it
        rows, rnd = df.collect(), random.Random(3)
        rnd.shuffle(rows)
        text = lambda r: f'{{"id":{"null" if r.id is None else r.id},"v":{"null" if r.v is None else chr(34) + r.v + chr(34)},"d":{r.d}}}'
        for r in sorted(rows[k::3], key=text):         # of rows of one order the first by text
            firsts.setdefault(r.id, tuple(r))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(firsts.values(), key=repr)


def test_latest_over_a_second_checkpoint(spark, tmp_path):
    schema, path, out = "k int, v int", f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    def run(ckpt):
        s = S.table_stream(spark, path, spark.createDataFrame([], schema).schema, max_files=1).groupBy("k").agg(F.sum("v").alias("s"))
        return sorted(map(tuple, S.stream_latest(s, ["k"], out, f"file://{tmp_path}/{ckpt}").collect()))
    add = lambda *v: spark.createDataFrame([(1, x) for x in v], schema).coalesce(1).write.mode("append").parquet(path)
    for v in (1, 2, 3):
        add(v)
    assert run("a") == [(1, 6)]
    add(100)
    assert run("b") == [(1, 106)]
    assert run("a") == [(1, 106)]


@pytest.mark.parametrize("seed", [1, 2])
def test_calendar_equals_batch_for_any_arrival(spark, tmp_path, seed):
    rnd = random.Random(seed)
    def row(sheet, i, version):
        return (sheet, i, rnd.choice(["", "", f"Creator {rnd.randint(1, 3)}"]), "REEL", f"d{version}", 10.0, date(2024, 1, rnd.randint(10, 28)),
                date(2024, 1, rnd.randint(10, 28)) if rnd.random() < 0.5 else None, version)
    schema = "sheet string, row int, client string, type string, deliverables string, rate double, reel date, record date, edit int"
    rows = [row(s, i, 0) for s in ("Alpha x", "Beta y", "Affiliate z") for i in range(12)]
    rows += [row(r[0], r[1], 1 + n) for n, r in enumerate(rnd.sample(rows, 8))]          # edits
    df = spark.createDataFrame(rows, schema)
    existing = spark.createDataFrame([("[T] Creator 1 - Alpha Reel", date(2024, 1, 12), "old"), ("other", date(2024, 1, 1), "stays")],
                                     "title string, day date, description string")
    rules = spark.createDataFrame([("alpha", "Alpha", 1)], "keyword string, brand string, rank int")
    now = F.lit("2024-01-15 10:00:00").cast("timestamp_ntz")
    args = (existing, f"file://{tmp_path}/out")
    rest = (now, rules, "[T]", "src", ["edit"])
    path = f"file://{tmp_path}/in"
    got = arrivals(spark, path, df, lambda s: S.stream_calendar(s, *args, f"file://{tmp_path}/a", *rest), seed)
    last = df.groupBy("sheet", "row").agg(F.max_by(F.struct(*df.columns[2:]), "edit").alias("r")).select("sheet", "row", "r.*")
    want = sorted(map(tuple, C.events_after(C.plan_calendar(last, existing, now, rules, "[T]", "src"), existing).collect()))
    assert sorted(map(tuple, got.collect())) == want and len(want) > 10
    again = S.stream_calendar(S.table_stream(spark, path, df.schema, max_files=1), *args, f"file://{tmp_path}/b", *rest)
    assert sorted(map(tuple, again.collect())) == want
    touched = [f for f in StreamTable(spark, f"{args[1]}/calendar").live() if f[2] and f[2].startswith(StreamTable.writer(f"file://{tmp_path}/b", 0)[:8])]
    assert all(StreamTable(spark, f"{args[1]}/calendar").rows_of([f]).count() == 0 for f in touched)     # a replay changes no key


def test_calendar_keeps_a_row_of_events_once(spark, tmp_path):
    """The events of a row share its description: one row a sheet row is written, not one an event."""
    schema = "sheet string, row int, client string, type string, deliverables string, rate double, reel date, story_1 date, record date"
    days = [date(2024, 1, 20), None, date(2023, 12, 1), date(2024, 1, 9)]
    rows = [("Beta y", i, ["", "Creator 1", " "][i % 3], "REEL", "d", float(i % 2), days[i % 4], date(2024, 2, 1 + i), days[(i + 1) % 4]) for i in range(20)]
    df = spark.createDataFrame([*rows, ("One", 1, "c", None, None, None, None, None, days[2])], schema)
    rules = spark.createDataFrame([("beta", "Beta", 1)], "keyword string, brand string, rank int")
    args = (F.lit("2024-01-15 10:00:00").cast("timestamp_ntz"), rules, "[T]", "src")
    cols = ["sheet", "row", "col_pos", "day", "title", "description"]
    live = lambda d: sorted(map(tuple, C.calendar_events(d, *args).filter("NOT stale").select(cols).collect()))
    packed = C.row_events(df, *args)
    flat = packed.select("sheet", "row", "description", F.explode("dates").alias("e")).select("sheet", "row", "e.*", "description").select(cols)
    assert sorted(map(tuple, flat.collect())) == live(df) and packed.count() == 19 < flat.count()
    existing = spark.createDataFrame([], "title string, day date, description string")
    path, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    run = lambda s: S.stream_calendar(s, existing, out, f"file://{tmp_path}/a", *args)
    df.coalesce(1).write.parquet(path)
    run(S.table_stream(spark, path, df.schema))
    events = StreamTable(spark, f"{out}/events")
    assert events.rows_of(events.live()).count() == 19
    later = df.filter("row = 7").withColumn("story_1", F.lit("2024-03-03").cast("date"))        # one date of one row
    later.coalesce(1).write.mode("append").parquet(path)
    got = run(S.table_stream(spark, path, df.schema))
    last = StreamTable(spark, f"{out}/calendar").live()[-1:]
    assert sorted(r.day for r in events.rows_of([(*f[:3], f"../calendar/{f[3]}") for f in last]).collect()) == [date(2024, 2, 8), date(2024, 3, 3)]
    want = df.filter("row <> 7 OR sheet = 'One'").unionAll(later)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, C.events_after(C.plan_calendar(want, existing, *args), existing).collect()))
