"""Structured Streaming jobs.

Each job reads a table path as a file stream, runs with ``trigger(availableNow=True)`` (process
what is there, then stop; rerun on a schedule) and takes the paths of its result and of its
checkpoint, so the next run goes on where the last one ended. Results are ``StreamTable`` folders:
a micro-batch that is retried replaces its own delta, and versions go on over checkpoints. What a
batch reads does not grow with the batches before it: keys that were seen are in the state store
of the checkpoint, and tables are merged after some batches. Results equal the batch jobs on the
same input, however it is split and in whatever order it comes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notelake.operators.calendar import row_events
from notelake.session import materialise
from notelake.streaming.tables import StreamTable

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EXACT = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def table_stream(spark: SparkSession, path: str, schema: T.StructType | None = None, max_files: int | None = None) -> DataFrame:
    """A parquet table as a stream of its files; ``path`` is the table (a folder of part files)."""
    r = spark.readStream.format("parquet").schema(schema or spark.read.parquet(path).schema)
    return (r.option("maxFilesPerTrigger", max_files) if max_files else r).load(path)


def run_stream(stream: DataFrame, ckpt: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Run what is there through ``sink(batch, batch_id)``. State is kept in RocksDB unless the
    session names another provider."""
    spark = stream.sparkSession
    given = spark.conf.get(_PROVIDER, None)
    if given is None or given.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        q = stream.writeStream.outputMode(mode).option("checkpointLocation", ckpt) \
            .foreachBatch(sink).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        if given is not None:
            spark.conf.set(_PROVIDER, given)
        else:
            spark.conf.unset(_PROVIDER)


def marked_new(stream: DataFrame, key: Sequence[str], order: Column | None = None) -> DataFrame:
    """``_key, _order, _row, _new`` of each row of a stream, and a row without ``_row`` (``_new``) for
    each key that no earlier batch of the checkpoint had. Keys are kept in the state store; a key
    costs one native probe, however many rows a batch has."""
    rows = stream.select(F.to_json(F.struct(*key), _EXACT).alias("_key"),
                         F.coalesce(order if order is not None else F.lit(""), F.lit("")).alias("_order"),
                         F.struct("*").alias("_row"), F.lit(False).alias("_new"))
    new = rows.select("_key").dropDuplicates(["_key"])
    return rows.unionByName(new.withColumn("_new", F.lit(True)), allowMissingColumns=True)


def first_of_new(marked: DataFrame) -> DataFrame:
    """Of a batch of ``marked_new``: for each new key its first row by ``order`` (a string), then by
    the row's text."""
    rank = F.when(~F.col("_new"), F.struct("_order", F.to_json("_row", _EXACT)))
    first = marked.groupBy("_key").agg(F.max("_new").alias("_new"), F.min_by("_row", rank).alias("_row"))
    return first.filter("_new").select("_row.*")


def append_unseen(stream: DataFrame, out: str, ckpt: str, key: Sequence[str], order: Column | None = None) -> DataFrame:
    """Append the rows of a stream to the table, each key once, over all batches, runs and
    checkpoints. A batch reads the table only for what other checkpoints have written."""
    spark = stream.sparkSession
    table = StreamTable(spark, out)
    mine = table.writer(ckpt, 0).split("-")[0]

    def sink(batch: DataFrame, batch_id: int) -> None:
        here = StreamTable(batch.sparkSession, out)
        batch = first_of_new(batch)
        others = [f for f in here.live() if f[2] is None or not f[2].startswith(mine)]
        if others:
            had = here.rows_of(others).select(F.struct(*key).alias("_had")).distinct()
            batch = batch.join(had, F.struct(*key).eqNullSafe(F.col("_had")), "left_anti")
        here.write(batch, ckpt, batch_id)

    run_stream(marked_new(stream, key, order), ckpt, sink)
    table.merge()
    return table.read().select(*stream.columns)


def stream_sync(source: DataFrame, existing: DataFrame, out: str, ckpt: str, name: str = "base_name",
                key: Sequence[str] = ("message_id",), order: Column | None = None) -> DataFrame:
    """Repeated sync that skips what exists: messages whose ``name`` is a note (J4) and
    those that an earlier batch or run has written (by ``key``). Returns the table so far."""
    ex = existing.select(F.col(existing.columns[0]).alias(name)).distinct()
    return append_unseen(source.join(ex, name, "left_anti").select(*source.columns), out, ckpt, key, order)


def stream_notify(source: DataFrame, out: str, ckpt: str, key: Sequence[str] = ("message_id",), order: Column | None = None) -> DataFrame:
    """Notify once per message id over all runs, however late a message comes."""
    return append_unseen(source, out, ckpt, key, order)


def stream_calendar(source: DataFrame, existing: DataFrame, out: str, ckpt: str, now, rules: DataFrame, tag: str, src: str,
                    edited: Sequence[str] = ()) -> DataFrame:
    """Sheets re-synced as their rows arrive, in any order, edits included. Kept are the rows by
    (sheet, row) (the last to come stands, or the one with the largest ``edited`` columns), the events
    that rows make, by (sheet, row) with an array over the columns, and the calendar by (title, day). A
    batch plans the sheets that it touches, writes the events of the rows whose events changed or went,
    and then the (title, day) keys of the events that did:
    the last event in sheet order, or what ``existing`` has if no row makes one any more. Returns the
    calendar after the last batch, which is that of the batch job (Q12) on all rows."""
    spark = source.sparkSession
    place = ["sheet", "row"]

    def tables(s: SparkSession) -> tuple[StreamTable, StreamTable, StreamTable]:
        return (StreamTable(s, f"{out}/rows", place, edited), StreamTable(s, f"{out}/events", place, gone="gone"),
                StreamTable(s, f"{out}/calendar", ["title", "day"], gone="gone"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows, events, calendar = tables(batch.sparkSession)
        me = rows.writer(ckpt, batch_id)
        rows.write(batch, ckpt, batch_id)
        touched = materialise(batch.select("sheet").distinct(), "calendar-touched")
        # written, as the ranges of the planner would evaluate it twice
        now_rows = materialise(rows.read().join(touched, "sheet", "left_semi"), "calendar-rows")
        made = row_events(now_rows, now, rules, tag, src)
        had = events.read(without=me)
        had = made.limit(0) if had is None else had.join(touched, "sheet", "left_semi")
        value = F.struct("description", "dates")
        both = made.select(*place, value.alias("new")).join(had.select(*place, value.alias("old")), place, "full")
        changed = materialise(both.filter(~F.col("new").eqNullSafe(F.col("old"))), "calendar-changed")
        events.write(changed.select(*place, F.coalesce("new", "old").alias("e"), F.col("new").isNull().alias("gone")).select(*place, "e.*", "gone"),
                     ckpt, batch_id)
        new, old = F.col("new.dates"), F.col("old.dates")
        moved = F.when(F.col("new.description") == F.col("old.description"), F.concat(F.array_except(new, old), F.array_except(old, new))) \
            .when(F.col("new").isNull(), old).when(F.col("old").isNull(), new).otherwise(F.concat(new, old))
        keys = materialise(changed.select(F.explode(moved).alias("k")).select("k.title", "k.day").distinct(), "calendar-keys")
        last = events.read().select(*place, "description", F.explode("dates").alias("e")) \
            .select(*place, "e.*", "description").join(keys, ["title", "day"], "left_semi").groupBy("title", "day") \
            .agg(F.max_by("description", F.struct(*place, "col_pos")).alias("description"))
        calendar.write(keys.join(last, ["title", "day"], "left").withColumn("gone", F.col("description").isNull()), ckpt, batch_id)

    run_stream(source, ckpt, sink)
    for t in tables(spark):
        t.merge()
    made = tables(spark)[2].read()
    before = existing.select("title", "day", "description")
    return before if made is None else made.select("title", "day", "description").unionByName(before.join(made, ["title", "day"], "left_anti"))


def stream_latest(stream: DataFrame, keys: Sequence[str], out: str, ckpt: str) -> DataFrame:
    """T4: a streaming aggregation kept current: each batch writes only the groups that changed
    (update mode), and the table is the last version of each group, whatever checkpoint wrote it."""
    run_stream(stream, ckpt, lambda batch, i: StreamTable(batch.sparkSession, out, keys).write(batch, ckpt, i), mode="update")
    table = StreamTable(stream.sparkSession, out, keys)
    table.merge()
    return table.read().select(*stream.columns)
