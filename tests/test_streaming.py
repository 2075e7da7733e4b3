import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from uptake.plans.catalog import CFG, tables
from uptake.sources import dirty
from uptake.streaming.events import clean_stream, dedup_stream, split_writer, stream_checkpoint, weekly_active_stream


def _stage(spark, df):
    d = tempfile.mkdtemp(prefix="uptake-stream-")
    df.write.mode("overwrite").parquet(d)
    return d, df.schema


def test_stream_clean_dedup_and_weekly(spark):
    t = tables(spark, SF_SMALL)
    raw = dirty.raw_events(t).drop("ingest_seq")
    src, schema = _stage(spark, raw)
    out = tempfile.mkdtemp(prefix="uptake-out-")
    ck = stream_checkpoint(spark, tempfile.mkdtemp(prefix="run-").rsplit("/", 1)[-1])
    stream = clean_stream(spark.readStream.schema(schema).parquet(src), CFG)
    q = stream.writeStream.foreachBatch(split_writer(f"{out}/clean", f"{out}/quarantine")) \
        .option("checkpointLocation", f"{ck}/clean").trigger(availableNow=True).start()
    q.awaitTermination()
    clean = spark.read.parquet(f"{out}/clean")
    quarantine = spark.read.parquet(f"{out}/quarantine")
    assert clean.count() + quarantine.count() == raw.count()
    assert clean.where(F.col("estimated_minutes_saved") < 0).count() == 0

    # a replayed micro-batch overwrites its own epoch folder: no duplicates
    # (availableNow over one folder of files is a single epoch, 0)
    assert {r.epoch_id for r in clean.select("epoch_id").distinct().collect()} == {0}
    n_clean, n_quarantine = clean.count(), quarantine.count()
    split_writer(f"{out}/clean", f"{out}/quarantine")(clean_stream(spark.read.schema(schema).parquet(src), CFG), 0)
    clean = spark.read.parquet(f"{out}/clean")  # re-list: the replay replaced the files
    assert clean.count() == n_clean
    assert spark.read.parquet(f"{out}/quarantine").count() == n_quarantine

    # X-1: the duplicated ids collapse to one row each
    ded = dedup_stream(spark.readStream.schema(clean.schema).parquet(f"{out}/clean").drop("epoch_id"))
    q2 = ded.writeStream.format("memory").queryName("dedup_out").option("checkpointLocation", f"{ck}/dedup") \
        .trigger(availableNow=True).start()
    q2.awaitTermination()
    got = spark.table("dedup_out")
    assert got.count() == got.select("event_id").distinct().count() == clean.select("event_id").distinct().count()

    # X-3: weekly windows start on Mondays and match the batch distinct counts closely
    wk = weekly_active_stream(spark.readStream.schema(t.events.schema).parquet(_stage(spark, t.events)[0]),
                              t.users, CFG)
    q3 = wk.writeStream.format("memory").queryName("wau_out").outputMode("complete") \
        .option("checkpointLocation", f"{ck}/wau").trigger(availableNow=True).start()
    q3.awaitTermination()
    rows = spark.table("wau_out").collect()
    assert rows and all(r.week_start_date.weekday() == 0 for r in rows)
