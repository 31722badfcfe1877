import datetime as dt
import random
import shutil

from pyspark.sql import functions as F

from foliospark.streaming import events as S


def test_sessions_stream_equals_batch_on_closed_ones(spark, sf, tmp_path):
    shutil.copy(f"{sf}/events.parquet", tmp_path / "events.parquet")
    q = S.sessions(S.event_stream(spark, str(tmp_path)), late="1 hour")
    run = q.writeStream.format("memory").queryName("sessions").outputMode("append").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "cp")
    ).start()
    run.awaitTermination()
    got = {tuple(r) for r in spark.table("sessions").select("user_id", "start", "events").collect()}
    batch = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    end = batch.agg(F.max("ts")).first()[0]
    every = S.sessions(batch)
    wanted = {tuple(r) for r in every.select("user_id", "start", "events").collect()}
    open_ = every.where(F.col("end") > F.lit(end) - F.expr("INTERVAL 1 HOUR")).count()
    assert got <= wanted and len(wanted) - len(got) <= open_


def test_facts_stream(spark, sf, tmp_path):
    shutil.copy(f"{sf}/events.parquet", tmp_path / "events.parquet")
    run = S.event_stream(spark, str(tmp_path)).writeStream.foreachBatch(S.upsert_facts(str(tmp_path / "facts"))).option(
        "checkpointLocation", str(tmp_path / "cp2")
    ).trigger(availableNow=True).start()
    run.awaitTermination()
    got = S.stored_facts(spark, str(tmp_path / "facts"))
    batch = spark.read.parquet(f"{sf}/events.parquet")
    assert got.count() == batch.select("user_id", "event_type").distinct().count()


def test_windows(spark, sf):
    batch = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    assert S.windows(batch, "1 hour", "30 minutes").agg(F.sum("events")).first()[0] == 2 * batch.count()


def test_facts_by_bucket(spark, tmp_path):
    schema = "user_id bigint, event_type string, value double, ts timestamp"
    row = lambda u, k, v, s: (u, k, v, dt.datetime(2024, 1, 1, 0, 0, s))
    batches = [
        [row(u, "a", float(u), 1) for u in range(40)], [row(3, "a", 9.0, 2), row(3, "b", 1.0, 2)],
        [row(3, "a", 0.5, 0)], [row(3, "a", 11.0, 5)]
    ]
    write, folder = S.upsert_facts(str(tmp_path / "f"), buckets=8), str(tmp_path / "f")
    for number, rows in enumerate(batches):
        for _ in range(2):  # a repeated batch changes nothing
            write(spark.createDataFrame(rows, schema), number)
    got = {(r["user_id"], r["key"]): r["value"] for r in S.stored_facts(spark, folder).collect()}
    assert got == {(u, "a"): float(u) for u in range(40)} | {(3, "a"): 11.0, (3, "b"): 1.0}
    kept = S._versions(spark, folder)
    assert sorted(map(len, kept.values())) == [1] * 7 + [2] and max(max(v) for v in kept.values()) == 3


def test_forward_fill_over_ranges(spark):
    rng = random.Random(1)
    rows = [
        (
            i, rng.choice([1, 1, 1, 2, None]),
            dt.datetime(2024, 1, 1 + rng.randrange(20), rng.randrange(24)) if rng.random() > 0.02 else None,
            rng.choice([None, None, float(i)])
        ) for i in range(600)
    ]
    df = spark.createDataFrame(rows, "event_id bigint, user_id bigint, ts timestamp, value double")
    got = {r["event_id"]: r["filled"] for r in S.forward_fill(df, "value", seconds=86_400 * 3).collect()}
    last, wanted = {}, {}
    for i, u, t, v in sorted(rows, key=lambda r: (r[2] or dt.datetime.min, r[0])):
        last[u] = v if v is not None else last.get(u)
        wanted[i] = last[u]
    assert got == wanted
